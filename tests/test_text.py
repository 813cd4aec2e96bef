from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larkspur.functions import text as T

ENTITIES = "struct<hashtags:array<struct<text:string,indices:array<int>>>,user_mentions:array<struct<indices:array<int>>>,urls:array<struct<indices:array<int>>>,media:array<struct<indices:array<int>>>>"


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


def test_break_hashtag(spark):
    for a, b in {"HelloWorld": "Hello World", "NASALaunch": "NASALaunch", "iPhone": "i Phone", "ÉtéBonjour": "Été Bonjour", "ABC": "ABC", "": ""}.items():
        assert one(spark, a, T.break_hashtag) == b


def test_simple_and_tidy(spark):
    assert one(spark, "RT @u see https://t.co/x #Tag", T.simple_text) == "mention see url hashtag"
    assert one(spark, "RT .a  b", T.tidy_text) == "a b"
    assert one(spark, None, T.tidy_text) is None


def rewritten(spark, rows):
    df = spark.createDataFrame(rows, f"k int, text string, e {ENTITIES}")
    return {r[0]: r[1] for r in df.select("k", T.entity_text(F.col("text"), F.col("e"))).collect()}


def test_entity_cases(spark):
    url = lambda *at: ([], [], [{"indices": list(a)} for a in at], [])
    rows = [
        (1, "see http://x ok", url((4, 12))),
        (2, "see http://x ok", url((4, 12), (4, 12))),
        (3, "abc xyz", ([], [{"indices": [4, 20]}], None, None)),
        (4, "a #HelloWorld b", ([{"text": "HelloWorld", "indices": [2, 13]}], None, None, None)),
        (5, "plain", None),
        (6, "plain", (None, [None], [{"indices": None}, {"indices": []}, {"indices": [1]}, {"indices": [None, 2]}], None)),
    ]
    assert rewritten(spark, rows) == {1: "see  ok", 2: "see ok", 3: "abc ", 4: "a Hello World b", 5: "plain", 6: "plain"}


def walked(text, items):
    """The entities character by character, as a person would do it: at an item's start skip up to its last character, which the replacement takes."""
    out, k, items = [], 0, sorted(items, key=lambda i: i[0])
    waiting = [(s, f) for s, f in items]
    for k, c in enumerate(text):
        if waiting and k >= waiting[0][0]:
            if k >= waiting[0][1] - 1:
                out.append("User")
                waiting.pop(0)
        else:
            out.append(c)
    return "".join(out)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet="ab é😀 #", max_size=14), st.lists(st.tuples(st.integers(0, 14), st.integers(0, 5)), max_size=4)), min_size=1, max_size=40))
def test_entities_against_walk(spark, cases):
    rows = [(k, t, ([], [{"indices": [s, s + n]} for s, n in es], [], [])) for k, (t, es) in enumerate(cases)]
    assert rewritten(spark, rows) == {k: walked(t, [(s, s + n) for s, n in es]) for k, (t, es) in enumerate(cases)}


def test_robust_field(spark):
    df = spark.createDataFrame([(None, " a\t b ", "")], "a string, b string, c string")
    assert df.select(*[T.robust_field(F.col(c)).alias(c) for c in "abc"]).first() == ("<unk>", "a b", " ")


def test_human_size(spark):
    for n, s in {512: "0.50KB", 1_048_576: "1024.00KB", 1_048_577: "1.00MB", 3 * 1024**3: "3.00GB"}.items():
        assert one(spark, n, T.human_size, "bigint") == s


def test_role_value_and_base_name(spark):
    assert one(spark, "Ann-Marie", T.role_value) == "AnnMarie"
    assert one(spark, "a  book!", T.role_value) == "a book"
    for a in ("verb.gz", "verb-1.gz", "verb-0-2-1.gz"):
        assert one(spark, a, T.base_name) == "verb"
