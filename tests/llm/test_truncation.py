import random

from larkspur.llm import truncation


def sentences(r, n):
    who, did, what, when = ["The baker", "My sister", "A tourist"], ["repaired", "painted", "carried"], ["the engine", "a bicycle", "two umbrellas"], ["this morning", "during the festival", "near the station"]
    return " ".join(f"{r.choice(who)} {r.choice(did)} {r.choice(what)} {r.choice(when)}." for _ in range(n))


def judged(spark, rows):
    df = spark.createDataFrame(rows, "id bigint, text string, source string")
    return {r["key"]: r["why"] for r in truncation.judged(df, "id", "text", "source").collect()}


def test_planted_cuts(spark):
    r = random.Random(9)
    rows = [(k, sentences(r, r.randrange(1, 6)), "news") for k in range(400)]
    rows += [(400 + k, sentences(r, 2)[:-1].replace(". ", "\n"), None) for k in range(60)]  # captions without full stops
    cut = {
        1000: "The baker repaired the engine near the sta",
        1001: "My sister painted the",
        1002: "A tourist carried two umb…",
        1003: "The baker painted a [...]",
        1004: "A tourist carried a bicycle. https://t.exam",
        1005: "My sister carried the engine during the festi�",
        1006: "A tourist carried a bicycle. https:/",
    }
    whole = {
        2000: None, 2001: "", 2002: "  \n", 2003: "The baker repaired the engine this morning", 2004: "My sister carried a bicycle. #OpenDay", 2005: "See https://t.example/abcd1234", 2006: "A tourist painted the engine this morning...",
        2007: "The baker repaired a bicycle. 🔥", 2008: "My sister painted the engine. @some_one", 2009: "ok (2016)", 2010: "The baker repaired the engine. ❤️", 2011: '{"a": 1}', 2012: "mail to desk@mail.example",
    }
    rows += [(900 + k, "See https://t.example/x%07d" % k, "news") for k in range(20)]
    rows += [(k, t, "news") for k, t in {**cut, **whole}.items()]
    got = judged(spark, rows)
    assert {k for k, w in got.items() if w and k >= 1000} == set(cut)
    assert sum(w is not None for k, w in got.items() if k < 900) == 0
    assert 2000 not in got and got[1000] == "word" and got[1001] == "sentence" and got[1004] == "link"


def test_last_words_longer_than_the_end(spark):
    r = random.Random(5)
    rows = [(k, sentences(r, 3), "news") for k in range(100)]
    long = {
        1000: "See https://t.example/" + "station" * 90,
        1001: "See https://t.example/" + "q" * 380 + "/station/engine/the",
        1002: "mail to " + "desk." * 90 + "the@mail.example",
        1003: "See https://t.example/" + "x" * 500 + " " * 5 + "...",
        1004: "My sister carried the #" + "engine_" * 70 + "the",
    }
    got = judged(spark, rows + [(k, t, "news") for k, t in long.items()])
    assert {k: got[k] for k in long} == dict.fromkeys(long)
    e = truncation.ends(spark.createDataFrame([(1, None, "a " + "b" * 450), (2, None, "a " + "b" * 450 + " c" * 10), (3, None, "a " + "b" * 450 + " …")], "key int, source string, text string"))
    assert {x["key"]: (x["front"] == "", x["chars"], x["mark"]) for x in e.collect()} == {1: (True, 452, False), 2: (False, 472, False), 3: (True, 452, True)}


def test_limits(spark):
    df = spark.createDataFrame([("a", 140)] * 12 + [("a", n) for n in range(100, 200)] + [(None, 7)] * 6, "source string, chars int")
    assert {(r["source"], r["chars"]) for r in truncation.limits(df).collect()} == {("a", 140), (None, 7)}


def test_trie(spark):
    v = spark.createDataFrame([("car", 3, 1), ("cart", 2, 0), ("once", 1, 0)], "token string, n bigint, ends bigint")
    assert dict(truncation.trie(v).collect()) == {"c": 5, "ca": 5, "car": 2}


def test_pieces_that_stand_elsewhere_too(spark):
    # In a large corpus a piece of a common word stands within texts now and then; beside the word it is still a piece, and a rare word with few below it none.
    r = random.Random(2)
    rows = [(k, sentences(r, 6), "news") for k in range(700)] + [(900 + k, f"The baker repaired the engi and sta here. {sentences(r, 2)}", "news") for k in range(3)]
    rows += [(950 + k, "The bake oven and the bakes stand here.", "news") for k in range(3)]
    rows += [(1000, "My sister carried the engi", "news"), (1001, "A tourist carried a bicycle near the sta", "news"), (1002, "The baker painted the oven", "news")]
    got = judged(spark, rows)
    assert (got[1000], got[1001], got[1002]) == ("word", "word", None) and sum(w is not None for k, w in got.items() if k < 1000) == 0


def test_empty_and_long(spark):
    assert judged(spark, []) == {}
    assert judged(spark, [(1, "word " * 100_000 + "end.", None), (2, "日" * 50_000 + "。", "x")]) == {1: None, 2: None}
