"""Dictionaries, and term streams encoded by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.protobuf import term_example
from larkspur.functions.text import UNKNOWN
from larkspur.session import numbered

#: The id of what isn't in a dictionary. It is also the first entry's id.
UNKNOWN_ID = 0


def dictionary(counts: DataFrame, key: str) -> DataFrame:
    """token, id, n: ids from 0 by falling count, then by token. Numbered in parts (numbered), so a large dictionary is no single task's either."""
    d = counts.where(F.col(key).isNotNull()).select(F.col(key).alias("token"), "n")
    return numbered(d, [F.desc("n"), "token"], "id").select("token", F.col("id").cast("int").alias("id"), "n")


def checked(words: DataFrame) -> DataFrame:
    """The dictionary; an error at run time if a token stands in it twice."""
    w = words.groupBy("token").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("k"))
    return w.select("token", F.when(F.col("k") > 1, F.raise_error(F.concat(F.lit("twice in the dictionary: "), F.col("token"))).cast("int")).otherwise(F.col("id")).alias("id"))


def looked_up(terms: DataFrame, words: DataFrame, pos: DataFrame | None = None) -> DataFrame:
    """terms with word_id and pos_id, null for what isn't in a dictionary. Spark broadcasts a dictionary if its size allows, else shuffles; hot words are split by its skew join."""
    out = terms.join(checked(words).select(F.col("token").alias("lemma"), F.col("id").alias("word_id")), "lemma", "left")
    if pos is None:
        return out.withColumn("pos_id", F.lit(None).cast("int"))
    return out.join(checked(pos).select(F.col("token").alias("pos"), F.col("id").alias("pos_id")), "pos", "left")


def _rows(terms: DataFrame) -> DataFrame:
    sub = F.col("sub") if "sub" in terms.columns else F.lit(0)
    return terms.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("idx", sub.alias("sub"), "lemma", "pos", "word_id", "pos_id"))).alias("a"))


def encode_text(terms: DataFrame, words: DataFrame, pos: DataFrame | None = None) -> DataFrame:
    """doc_id and text: known words, <unk> for others; with parts of speech, each followed by @ and the known one or <unk>."""
    known = lambda v, i: F.when(i.isNotNull(), v).otherwise(UNKNOWN)
    a = _rows(looked_up(terms, words, pos))
    word = lambda t: known(t["lemma"], t["word_id"])
    both = lambda t: F.concat(word(t), F.lit("@"), known(t["pos"], t["pos_id"]))
    return a.select("doc_id", F.array_join(F.transform("a", word if pos is None else both), " ").alias("text"))


def encode_ids(terms: DataFrame, words: DataFrame, pos: DataFrame, oov_id: int = UNKNOWN_ID) -> DataFrame:
    """doc_id, text and pos: lists of ids, oov_id for what isn't in a dictionary."""
    ids = lambda f: F.transform("a", lambda t: F.coalesce(t[f], F.lit(oov_id)))
    return _rows(looked_up(terms, words, pos)).select("doc_id", ids("word_id").alias("text"), ids("pos_id").alias("pos"))


def to_examples(ids: DataFrame) -> DataFrame:
    """doc_id and example: the two lists as an Example's bytes, pos first."""
    return ids.select("doc_id", term_example("pos", "text").alias("example"))
