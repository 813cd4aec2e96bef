from pyspark.sql import functions as F

from larkspur.functions.paths import json_path
from larkspur.operators import tweets as W
from larkspur.streaming.tweets import start, tweet_stream

LINES = [
    '{"user":{"id":1},"text":"a","lang":"en"}',
    '{"user":{"id":2},"text":"a","lang":"EN"}',
    '{"user":{"id":3},"text":"a"}',
    '{"text":"no user"}',
    '{"user":{"id":"abc"},"text":"a"}',
    '{"user":{"id":1',
    "null",
    "[1]",
    "",
    '{"user":{"id":"7"},"text":"","lang":"en"}',
    '{"user":{"id":8},"lang":"en"}',
    '{"user":{"id":9},"text":"outer","lang":"fr","retweeted_status":{"text":"inner","lang":"en"}}',
    '{"user":{"id":10},"text":"o","lang":"en","retweeted_status":{"user":{"id":11},"text":"m","lang":"en","retweeted_status":{"text":"deep","lang":"en","entities":{"media":[{"indices":[0,1]}]}}}}',
    '{"user":{"id":12},"text":"x","lang":"en","retweeted_status":null,"entities":null}',
    '{"user":{"id":13},"text":"x","lang":"en","entities":"oops"}',
    '{"user":{"id":14},"text":"x","lang":"en","entities":{"media":[]}}',
    "{'user':{id:15},'text':'lenient','lang':'en'}\r",
]


def lines(spark):
    return spark.createDataFrame([(x,) for x in LINES], "value string")


def test_parse(spark):
    assert sorted(r["id"] for r in W.parse_tweets(lines(spark)).collect()) == [1, 2, 3, 7, 8, 9, 10, 12, 13, 14, 15]


def test_filter(spark):
    got = {r["id"]: r["tweet"]["text"] for r in W.filter_tweets(W.parse_tweets(lines(spark)), ["en"]).collect()}
    assert got == {1: "a", 2: "a", 7: "", 9: "inner", 10: "deep", 12: "x", 13: "x", 14: "x", 15: "lenient"}
    assert W.filter_tweets(W.parse_tweets(lines(spark))).count() == 10


def test_retweets_of_any_depth(spark):
    def nested(n, inner):
        for k in range(n):
            inner = f'{{"user":{{"id":{k}}},"text":"{k}","lang":"fr","retweeted_status":{inner}}}'
        return inner

    end = '{"user":{"id":99},"text":"the \\"end\\" {","lang":"en","entities":{"media":[{"indices":[0,1]}]}%s}'
    rows = [(n, nested(n, end % more)) for n in (1, 4, 5, 6, 9, 40) for more in ("", ',"retweeted_status":null', ',"retweeted_status":[{"text":"no"}]', ',"retweeted_status":"no"')]
    rows += [(7, nested(7, end % "").replace('"', "'").replace("\\'", '\\"').replace("'retweeted_status'", "retweeted_status"))]
    got = W.filter_tweets(W.parse_tweets(spark.createDataFrame(rows, "n int, value string")), ["en"]).select("n", "tweet.*").collect()
    assert len(got) == len(rows) and all((r["user_id"], r["text"], r["lang"], r["entities"]["media"][0]["indices"]) == (99, 'the "end" {', "en", [0, 1]) for r in got)


def test_images(spark):
    assert [r["id"] for r in W.with_images(W.filter_tweets(W.parse_tweets(lines(spark)))).collect()] == [10]


def test_clashing_columns_and_empty(spark):
    df = lines(spark).selectExpr("value", "'x' as id", "'y' as tweet", "'z' as text")
    assert W.parse_tweets(df).where("id = 1").count() == 1
    assert W.tweet_text(W.filter_tweets(W.parse_tweets(lines(spark).limit(0)))).count() == 0


def test_serialize_and_paths(spark):
    t = W.serialize(W.filter_tweets(W.parse_tweets(lines(spark)), ["en"]))
    assert t.where("id = 9").select(F.get_json_object("json", "$.text")).first()[0] == "inner"
    df = spark.createDataFrame([('{"user":{"id":5},"a":null,"b":"x"}',)], "j string")
    j = F.col("j")
    assert df.select(json_path(j, "long", "user", "id"), json_path(j, "string", "a"), json_path(j, "long", "b"), json_path(j, "long", "b", "c")).first() == (5, None, None, None)


def test_split(spark):
    low, high = W.split_priority(spark.range(5).withColumnRenamed("id", "priority"))
    assert (low.count(), high.count()) == (3, 2)


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("\n".join(LINES))
    start(tweet_stream(spark, str(tmp_path / "in"), ("en",)), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
