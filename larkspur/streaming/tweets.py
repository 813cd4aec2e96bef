"""The tweet operators on a stream: they keep no state, so the same functions run on a folder that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators.tweets import filter_tweets, parse_tweets, tweet_text
from larkspur.sources.text import stream_lines


def tweet_stream(spark: SparkSession, folder: str, langs: tuple[str, ...] = ()) -> DataFrame:
    """id, text of the tweets in files as they come in."""
    return tweet_text(filter_tweets(parse_tweets(stream_lines(spark, folder)), langs)).select("id", "text")


def start(stream: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends to Parquet files; with once, what is there now and then ends."""
    w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start(out)
