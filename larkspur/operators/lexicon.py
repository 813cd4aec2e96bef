"""The lexicon of relations: built from relationships seen in images, and read for matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def offsets(wordnet: DataFrame) -> DataFrame:
    """name and id (offset in eight digits, hyphen, part of speech) of a table name, syn_offset, pos. A name with several offsets has the smallest."""
    i = F.concat(F.lpad(F.col("syn_offset").cast("string"), 8, "0"), F.lit("-"), F.col("pos"))
    return wordnet.where("name is not null and syn_offset is not null and pos is not null").groupBy("name").agg(F.min(i).alias("id"))


def relationship_rows(images: DataFrame, key: str = "image_id", col: str = "relationships") -> DataFrame:
    """seq (key, place), predicate and the first synset name of relation, object and subject, null where there is none. Null elements are left out."""
    r = images.select(F.col(key).alias("key"), F.posexplode(col).alias("place", "r")).where("r is not null")
    first = lambda c: F.get(c, F.lit(0))
    return r.select(
        F.struct("key", "place").alias("seq"), F.col("r.predicate").alias("predicate"), first(F.col("r.synsets")).alias("rel_name"), first(F.col("r.object.synsets")).alias("obj_name"), first(F.col("r.subject.synsets")).alias("subj_name")
    )


def resolved(rows: DataFrame, wordnet: DataFrame) -> DataFrame:
    """rows with rel, obj and subj: the ids of the names, null for none or an unknown one."""
    o = offsets(wordnet)
    for part in ("rel", "obj", "subj"):
        rows = rows.join(o.select(F.col("name").alias(f"{part}_name"), F.col("id").alias(part)), f"{part}_name", "left")
    return rows


def raw_triples(r: DataFrame) -> DataFrame:
    """rel, obj, subj of rows with all three; equal rows stay."""
    return r.where("rel is not null and obj is not null and subj is not null").select("rel", "obj", "subj")


def relations(r: DataFrame) -> DataFrame:
    """predicate (the first seen), rel, objects, subjects (sets in order) of rows with a relation; objects and subjects join on their own."""
    members = lambda c: F.array_sort(F.collect_set(c))
    return r.where("rel is not null").groupBy("rel").agg(F.min_by("predicate", "seq").alias("predicate"), members("obj").alias("objects"), members("subj").alias("subjects")).select("predicate", "rel", "objects", "subjects")


def synsets(r: DataFrame) -> DataFrame:
    """id and name of all synsets met, in the order relation, object, subject; the first name of an id counts."""
    parts = [r.where(f"{p} is not null").select(F.col(p).alias("id"), F.col(f"{p}_name").alias("name"), F.struct("seq", F.lit(k).alias("k")).alias("seen")) for k, p in enumerate(("rel", "obj", "subj"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("id").agg(F.min_by("name", "seen").alias("name"))


def build_lexicon(images: DataFrame, wordnet: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw triples, relations, synsets)."""
    r = resolved(relationship_rows(images), wordnet)
    return raw_triples(r), relations(r), synsets(r)


def member_list(c: Column) -> Column:
    """A set from a list with commas."""
    return F.array_distinct(F.split(c, ","))


def last_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """One row a key: the one with the greatest seq."""
    w = Window.partitionBy(key).orderBy(F.desc(seq))
    return df.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def triple_index(raw: DataFrame) -> DataFrame:
    """rel, o, s, freq: how often two synsets stand in a relation, in either order."""
    there = raw.select("rel", F.col("obj").alias("o"), F.col("subj").alias("s"))
    back = raw.select("rel", F.col("subj").alias("o"), F.col("obj").alias("s"))
    return there.unionByName(back).groupBy("rel", "o", "s").agg(F.count(F.lit(1)).alias("freq"))
