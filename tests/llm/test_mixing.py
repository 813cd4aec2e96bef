import random

import pytest

from larkspur.llm import mixing


@pytest.fixture
def docs(spark):
    r = random.Random(4)
    rows = [(k, s, r.randrange(1, 400)) for k, s in enumerate(["a"] * 3000 + ["b"] * 300 + ["c"] * 60)] + [(9001, None, 5), (9002, "a", 0), (9003, "other", 7), (9004, "a", None)]
    return spark.createDataFrame(rows, "id bigint, source string, tokens int")


def targets(spark, *rows):
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int")


def test_shares(spark, docs):
    t = targets(spark, ("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 4), ("none", 0.1, 2))
    m = mixing.mixture(docs, t, "id", "source", "tokens").cache()
    r = {x["source"]: x for x in mixing.reached(m, docs, t, "source", "tokens").collect()}
    for s, share in {"a": 5 / 9, "b": 3 / 9, "c": 1 / 9}.items():
        assert abs(r[s]["actual_share"] - share) < 0.006
    assert r["none"]["actual_share"] == 0 and r["c"]["most_copies"] <= 4 and r["b"]["most_copies"] <= 3 and r["a"]["most_copies"] == 1
    assert m.count() == m.select("key").distinct().count() and m.where("key > 9000").count() == 0
    assert sorted(m.collect()) == sorted(mixing.mixture(docs.repartition(13), t, "id", "source", "tokens").collect())


def test_total_and_seed(spark, docs):
    t = targets(spark, ("a", 0.8, 1), ("b", 0.2, 2))
    one, two = (mixing.mixture(docs, t, "id", "source", "tokens", total=60_000, seed=s) for s in (1, 2))
    for m in (one, two):
        assert abs(m.selectExpr("sum(tokens * copies)").first()[0] - 60_000) < 500
    assert {r["key"] for r in one.collect()} != {r["key"] for r in two.collect()}


def test_short_texts_are_likelier(spark):
    df = spark.range(4000).selectExpr("id", "'a' as source", "case when id % 2 = 0 then 16 else 256 end as tokens")
    n = dict(mixing.mixture(df, targets(spark, ("a", 1.0, 1)), "id", "source", "tokens", total=200_000).groupBy("tokens").count().collect())
    assert abs(n[16] / n[256] - (256 / 16) ** mixing.DAMPING) < 0.2


def test_nothing(spark, docs):
    assert mixing.mixture(docs.limit(0), targets(spark, ("a", 1.0, 1)), "id", "source", "tokens").count() == 0
    assert mixing.mixture(docs, targets(spark, ("zz", 1.0, 1), (None, 0.5, 1), ("a", None, 2)), "id", "source", "tokens").count() == 0


def test_equal_documents(spark):
    df = spark.range(1000).selectExpr("id", "'a' as source", "10 as tokens")
    m = mixing.mixture(df, targets(spark, ("a", 1.0, 3)), "id", "source", "tokens", total=25_000)
    assert m.selectExpr("sum(copies)", "min(copies)", "max(copies)").first() == (2500, 2, 3)


def test_long_documents_are_passed_over(spark):
    # Very uneven lengths: in each source a few documents hold most tokens. The shares stay within the tolerance and one short document.
    r = random.Random(12)
    rows = [(k, r.choice("ab"), int(min(60_000, 20 / r.random() ** 1.2))) for k in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, source string, tokens int")
    t = targets(spark, ("a", 0.7, 2), ("b", 0.3, 3))
    m = mixing.mixture(df, t, "id", "source", "tokens", total=0.9 * sum(n for *_, n in rows)).cache()
    got = {x["source"]: x["actual_share"] for x in mixing.reached(m, df, t, "source", "tokens").collect()}
    assert abs(got["a"] - 0.7) < 0.003 and abs(got["b"] - 0.3) < 0.003
    assert m.where("source = 'a' and copies > 2 or copies > 3").count() == 0


def test_selection_by_hand(spark):
    fine = mixing.LEVELS[-1]
    rows = [("a", 4, fine), ("a", 50, 2 * fine), ("a", 3, 3 * fine), ("a", 9, 4 * fine), ("a", 2, 5 * fine), ("b", 5, fine)]
    d = spark.createDataFrame(rows, "source string, tokens int, place bigint")
    spans = mixing.selected(d, {"a": 10.0, "b": 7.0, "c": 1.0}, {"a": 0.0, "b": 0.0, "c": 0.0})
    taken = [t for s, t, p in rows if any(a < p < b and t <= m for a, b, m in spans[s])]
    assert taken == [4, 3, 2, 5]
