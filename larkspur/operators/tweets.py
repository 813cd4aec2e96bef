"""Tweets: parsing, unwrapping of retweets, filters and normalised text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import entity_text, simple_text, tidy_text
from larkspur.schema import DEPTH, tweet

OPTIONS = {"mode": "PERMISSIVE", "allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def parse_tweets(df: DataFrame, value: str = "value", depth: int = DEPTH) -> DataFrame:
    """The rows whose line is a JSON object with a whole number (or a string of one) at user.id, with it as id and the tweet as tweet.

    Any other line is dropped without error: broken, empty, no object, no such id. Members of a wrong type count as missing. Other columns stay; those named id or tweet are replaced.
    """
    t = F.from_json(F.col(f"`{value}`"), tweet(depth), OPTIONS)
    return df.withColumn("tweet", t).withColumn("id", F.col("tweet.user.id").try_cast("bigint")).where("id is not null")


def _plain(x: Column) -> Column:
    return F.when(x.isNotNull(), F.struct(x["user"]["id"].try_cast("bigint").alias("user_id"), x["text"].alias("text"), x["lang"].alias("lang"), x["entities"].alias("entities")))


def _last(rest: Column) -> Column:
    """The tweet at the end of the chain that begins with the JSON rest, however long it is; null if rest is no object."""

    def below(x: Column) -> Column:
        there = F.from_json(x, "retweeted_status STRUCT<text:STRING>", OPTIONS)["retweeted_status"].isNotNull()
        return F.when(there, F.from_json(x, "retweeted_status STRING", OPTIONS)["retweeted_status"])

    # Every level has a brace, so there are no more levels than braces.
    braces = F.length(rest) - F.length(F.replace(rest, F.lit("{")))
    first = below(F.concat(F.lit('{"retweeted_status":'), rest, F.lit("}")))
    last = F.aggregate(F.array_repeat(F.lit(0), braces.cast("int")), first, lambda x, _: F.coalesce(below(x), x))
    return F.transform(F.array(F.from_json(last, tweet(0), OPTIONS)), _plain)[0]


def innermost(t: Column, depth: int = DEPTH) -> Column:
    """The tweet at the end of the chain of retweets, as struct<user_id, text, lang, entities>. depth: the levels that t has as types."""
    levels = []
    for k in range(depth, -1, -1):
        x = t
        for _ in range(k):
            x = x["retweeted_status"]
        if k == depth:
            levels.append(F.when(x["retweeted_status"].isNotNull(), _last(x["retweeted_status"])))
        levels.append(_plain(x))
    return F.coalesce(*levels)


def filter_tweets(df: DataFrame, langs: tuple[str, ...] | list[str] = (), depth: int = DEPTH) -> DataFrame:
    """A retweet is replaced by the tweet at its end; then tweets without text fall out, and, if languages are given, those in no such language.

    An empty text stays; letter case of languages doesn't matter; a null language passes only without languages. The column tweet becomes struct<user_id, text, lang, entities>.
    """
    out = df.withColumn("tweet", innermost(F.col("tweet"), depth)).where("tweet.text is not null")
    return out.where(F.lower("tweet.lang").isin([x.lower() for x in langs])) if langs else out


def with_images(df: DataFrame, entities: str = "tweet.entities") -> DataFrame:
    """The rows with at least one element in media; a missing or null array has none."""
    return df.where(F.coalesce(F.size(F.col(entities)["media"]), F.lit(0)) > 0)


def tweet_text(df: DataFrame, simple: bool = False) -> DataFrame:
    """Adds text: the normalised text of the column tweet."""
    t = F.col("tweet")
    return df.withColumn("text", simple_text(t["text"]) if simple else tidy_text(entity_text(t["text"], t["entities"])))


def serialize(df: DataFrame, id_col: str = "id", tweet_col: str = "tweet") -> DataFrame:
    """id and the tweet as JSON."""
    return df.select(F.col(id_col).alias("id"), F.to_json(tweet_col).alias("json"))


def split_priority(df: DataFrame, least: int = 3, priority: str = "priority") -> tuple[DataFrame, DataFrame]:
    """(lower, high) rows by priority."""
    return df.where(F.col(priority) < least), df.where(F.col(priority) >= least)
