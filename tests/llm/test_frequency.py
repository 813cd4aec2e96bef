import random
from collections import Counter

import regex
from pyspark.sql import functions as F

from larkspur.llm import frequency


def test_words_against_brute_force(spark):
    r = random.Random(3)
    words = ["the", "Été", "été", "naïve", "don't", "x1y", "日本", "ab-cd", "Straße"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 12))) for _ in range(700)] + [None, "", "!!!"]
    n, k = Counter(), Counter()
    for t in texts:
        found = regex.findall(r"\p{L}+", t.lower()) if t else []
        n.update(found)
        k.update(set(found))
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    for at_once in (1_000_000, 40, 1):  # in memory, split once, split again and again
        got = {r["term"]: (r["occurrences"], r["records"]) for r in frequency.radix_sum(frequency.count_words(df, partial=at_once), at_once).collect()}
        assert got == {t: (n[t], k[t]) for t in n}


def test_values_and_marks(spark):
    rows = [(d, p) for d in range(100) for p in ("NN", "NN")] + [(1, "rare"), (2, "rare"), (3, None)] + [(d, "mid") for d in range(10)]
    df = spark.createDataFrame(rows, "doc bigint, pos string")
    t = frequency.radix_sum(frequency.count_values(df, "doc", "pos"))
    m = frequency.marked(t, df.select(F.count_distinct("doc").alias("all_records")))
    assert {r["term"]: (r["occurrences"], r["records"], r["mark"]) for r in m.collect()} == {"NN": (200, 100, "common"), "rare": (2, 2, "rare"), "mid": (10, 10, None)}


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "text string, term string")
    assert frequency.radix_sum(frequency.count_words(df)).count() == 0
    long = spark.createDataFrame([("word " * 200_000,)], "text string")
    assert frequency.radix_sum(frequency.count_words(long)).collect() == [("word", 200_000, 1)]
