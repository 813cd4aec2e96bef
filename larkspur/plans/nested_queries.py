"""Queries of problem 4: nested entities and relationships as flat tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators.nested import dewey_nodes, flat_table, node_array
from larkspur.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object of the entity arrays at each retweet level, and every object and synset of the relationships."""
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null")
    roots = ["entities", "retweeted_status"]
    # Redelivered rows are equal in all but the time: a tweet's node paths are kept once, and tweets without any are not shuffled.
    tweets = t.select("tweet_id", F.transform(node_array(t, roots), lambda n: n["node_path"]).alias("paths")).where(F.size("paths") > 0).dropDuplicates(["tweet_id"])
    images = table(spark, sf_dir, "relationships")
    return tweets.select(F.lit("tweet").alias("record_kind"), F.col("tweet_id").alias("record_id"), F.explode("paths").alias("node_path")).unionByName(
        dewey_nodes(images.where("image_id is not null"), "image_id", ["relationships"]).select(F.lit("image").alias("record_kind"), "record_id", "node_path")
    )


def p4_relationship_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the relationships themselves, with the parent's label and the predicate."""
    f = flat_table(table(spark, sf_dir, "relationships"), "image_id", "relationships")
    return f.select("record_id", F.array_join(F.col("label").cast("array<string>"), ".").alias("label"), "predicate")


def p4_object_synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the objects' synsets; parent_label leads to the row of the relationship."""
    return _image_synsets(spark, sf_dir, "relationships[].object.synsets")


def _dotted(c: str) -> Column:
    return F.array_join(F.col(c).cast("array<string>"), ".").alias(c)


def _image_synsets(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    return flat_table(table(spark, sf_dir, "relationships"), "image_id", path).select("record_id", _dotted("label"), _dotted("parent_label"), "value")


def p4_relation_synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the relations' own synsets."""
    return _image_synsets(spark, sf_dir, "relationships[].synsets")


def p4_subject_synsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of the subjects' synsets."""
    return _image_synsets(spark, sf_dir, "relationships[].subject.synsets")


#: Where tweets have entities: their own and those of the retweet levels.
LEVELS = ("entities", "retweeted_status.entities", "retweeted_status.retweeted_status.entities")


def _tweet_entities(spark: SparkSession, sf_dir: str, name: str, *values: str) -> DataFrame:
    """The flat tables of one entity array at each level, told apart by schema_path; the parent is the tweet itself."""
    t = table(spark, sf_dir, "tweets").where("tweet_id is not null")
    parts = [flat_table(t, "tweet_id", f"{level}.{name}").select("record_id", F.lit(f"{level}.{name}").alias("schema_path"), _dotted("label"), _dotted("parent_label"), *values) for level in LEVELS]
    # Redelivered rows are equal in all but the time, and a label stands once in a row.
    return reduce(DataFrame.unionByName, parts).distinct()


def p4_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of hashtags."""
    return _tweet_entities(spark, sf_dir, "hashtags", "text", "indices")


def p4_user_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of mentions."""
    return _tweet_entities(spark, sf_dir, "user_mentions", "indices")


def p4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of links."""
    return _tweet_entities(spark, sf_dir, "urls", "indices")


def p4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table of media."""
    return _tweet_entities(spark, sf_dir, "media", "indices")


QUERIES = {f.__name__: f for f in (p4_found, p4_relationship_objects, p4_object_synsets, p4_relation_synsets, p4_subject_synsets, p4_hashtags, p4_user_mentions, p4_urls, p4_media)}


def _entities(path: str, value: str) -> str:
    return " union all ".join(
        f"select 'tweet' as record_kind, tweet_id as record_id, '{path}{a}[' || (i - 1) || ']' as node_path from t, unnest(range(1, coalesce(len({value}.{a}), 0) + 1)) as u(i) where {value}.{a}[i] is not null"
        for a in ("hashtags", "user_mentions", "urls", "media")
    )


def _synsets(path: str, value: str) -> str:
    return f"select 'image' as record_kind, image_id as record_id, 'relationships[' || (i - 1) || ']{path}[' || (j - 1) || ']' as node_path from r, unnest(range(1, coalesce(len({value}), 0) + 1)) as u(j) where ({value})[j] is not null"


ORACLE = {
    "p4_found": "with t as (select tweet_id, any_value(entities) as entities, any_value(retweeted_status) as retweeted_status from tweets where tweet_id is not null group by tweet_id), "
    "r as (select image_id, i, relationships[i] as x from relationships, unnest(range(1, coalesce(len(relationships), 0) + 1)) as u(i) where relationships[i] is not null) "
    + " union all ".join(
        [
            _entities("entities.", "entities"),
            _entities("retweeted_status.entities.", "retweeted_status.entities"),
            _entities("retweeted_status.retweeted_status.entities.", "retweeted_status.retweeted_status.entities"),
            "select 'image' as record_kind, image_id as record_id, 'relationships[' || (i - 1) || ']' as node_path from r",
            _synsets(".synsets", "x.synsets"),
            _synsets(".object.synsets", "x.object.synsets"),
            _synsets(".subject.synsets", "x.subject.synsets"),
        ]
    ),
    "p4_relationship_objects": "select image_id as record_id, '0.' || (i - 1) as label, relationships[i].predicate as predicate from relationships, unnest(range(1, coalesce(len(relationships), 0) + 1)) as u(i) where relationships[i] is not null",
    "p4_object_synsets": "with r as (select image_id, i, relationships[i].object.synsets as s from relationships, unnest(range(1, coalesce(len(relationships), 0) + 1)) as u(i) where relationships[i] is not null) "
    "select image_id as record_id, '0.' || (i - 1) || '.2.' || (j - 1) as label, '0.' || (i - 1) as parent_label, s[j] as value from r, unnest(range(1, coalesce(len(s), 0) + 1)) as u(j) where s[j] is not null",
}


def _image_synsets_sql(value: str, number: int) -> str:
    return (
        f"with r as (select image_id, i, relationships[i].{value} as s from relationships, unnest(range(1, coalesce(len(relationships), 0) + 1)) as u(i) where relationships[i] is not null) "
        f"select image_id as record_id, '0.' || (i - 1) || '.{number}.' || (j - 1) as label, '0.' || (i - 1) as parent_label, s[j] as value from r, unnest(range(1, coalesce(len(s), 0) + 1)) as u(j) where s[j] is not null"
    )


def _tweet_entities_sql(name: str, number: int, *values: str) -> str:
    # The arrays of a tweet's own entities are numbered from 0, those of its retweet levels from 0 and from 4.
    return "with t as (select tweet_id, any_value(entities) as entities, any_value(retweeted_status) as retweeted_status from tweets where tweet_id is not null group by tweet_id) " + " union all ".join(
        f"select tweet_id as record_id, '{level}.{name}' as schema_path, '{number + first}.' || (i - 1) as label, '' as parent_label, {', '.join(f'{level}.{name}[i].{v} as {v}' for v in values)} "
        f"from t, unnest(range(1, coalesce(len({level}.{name}), 0) + 1)) as u(i) where {level}.{name}[i] is not null"
        for level, first in zip(LEVELS, (0, 0, 4), strict=True)
    )


ORACLE |= {
    "p4_relation_synsets": _image_synsets_sql("synsets", 1),
    "p4_subject_synsets": _image_synsets_sql("subject.synsets", 3),
    "p4_hashtags": _tweet_entities_sql("hashtags", 0, "text", "indices"),
    "p4_user_mentions": _tweet_entities_sql("user_mentions", 1, "indices"),
    "p4_urls": _tweet_entities_sql("urls", 2, "indices"),
    "p4_media": _tweet_entities_sql("media", 3, "indices"),
}
