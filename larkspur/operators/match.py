"""Scores of documents by the relations of the lexicon that their terms hold.

Inputs are refs (doc_id, place, ref): a document's references in order, and the lexicon's tables. References of another form than a synset's id, or not among the synsets, don't count. The lexicon's
tables are joined; Spark broadcasts them if their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.terms import is_synset

# The priorities.
HIGH, SECOND, THIRD, NORMAL = 3, 2, 1, 0


def known_refs(refs: DataFrame, synsets: DataFrame, rels: DataFrame) -> DataFrame:
    """refs that count, with is_rel: whether the reference is a relation (it is an object otherwise)."""
    ids = synsets.select(F.col("id").alias("ref")).distinct()
    r = rels.select(F.col("rel").alias("ref"), F.lit(True).alias("is_rel")).distinct()
    return refs.where(is_synset(F.col("ref"))).join(ids, "ref", "left_semi").join(r, "ref", "left").withColumn("is_rel", F.coalesce("is_rel", F.lit(False)))


def named(ids: Column, names: Column) -> Column:
    """The names of ids, in order of the ids; several between brackets with strokes."""
    n = F.transform(F.array_sort(ids), lambda i: F.coalesce(F.try_element_at(names, i), F.lit("null")))
    return F.when(F.size(n) > 1, F.concat(F.lit("("), F.array_join(n, "|"), F.lit(")"))).otherwise(F.array_join(n, "|"))


def score_v1(refs: DataFrame, relations: DataFrame, synsets: DataFrame) -> DataFrame:
    """doc_id, priority, matches.

    Priority 3: a relation of the document has among its objects one the document holds and that isn't among its subjects, and has a subject the document holds; the first such relation is
    written in matches. 2: a relation has an object or subject the document holds. 1: two or more references count. 0: one. Documents without any are dropped.
    relations: rel, objects, subjects; rel once. synsets: id, name.
    """
    k = known_refs(refs, synsets, relations)
    docs = k.groupBy("doc_id").agg(F.count_if("is_rel").alias("rels"), F.collect_set(F.when(~F.col("is_rel"), F.col("ref"))).alias("objs"))
    first = k.where("is_rel").groupBy("doc_id", "ref").agg(F.min("place").alias("place"))
    j = first.join(relations.select(F.col("rel").alias("ref"), "objects", "subjects"), "ref").join(docs.select("doc_id", "objs"), "doc_id")
    j = j.select("doc_id", "place", "ref", F.array_intersect("objs", "objects").alias("o"), F.array_intersect("objs", "subjects").alias("s"))
    full = (F.size(F.array_except("o", "s")) > 0) & (F.size("s") > 0)
    best = j.groupBy("doc_id").agg(F.min(F.when(full, F.struct("place", "ref", "o", "s"))).alias("best"), F.max(F.size("o") + F.size("s")).alias("held"))
    # The names of the references that are written: ids of best matches only.
    ids = best.where("best is not null").select("doc_id", F.explode(F.array_distinct(F.concat(F.array("best.ref"), "best.o", "best.s"))).alias("id"))
    names = ids.join(synsets.groupBy("id").agg(F.max("name").alias("name")), "id").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("id", "name"))).alias("names"))
    out = docs.join(best, "doc_id", "left").join(names, "doc_id", "left")
    total = F.col("rels") + F.size("objs")
    text = F.concat(F.lit("<"), named(F.col("best.o"), F.col("names")), F.lit(","), F.coalesce(F.try_element_at("names", F.col("best.ref")), F.lit("null")), F.lit(","), named(F.col("best.s"), F.col("names")), F.lit(">"))
    return out.select(
        "doc_id", F.when(F.col("best").isNotNull(), HIGH).when(F.col("held") > 0, SECOND).when(total > 1, THIRD).otherwise(NORMAL).alias("priority"), F.when(F.col("best").isNotNull(), text).otherwise("").alias("matches")
    )


def score_v2(refs: DataFrame, triples: DataFrame, synsets: DataFrame) -> DataFrame:
    """doc_id and priority: 3 if the document holds a relation and both ends of one of its triples, 2 if it holds a relation and one end; others are dropped.
    triples: rel, o, s in both orders (triple_index)."""
    k = known_refs(refs, synsets, triples)
    rels, objs = k.where("is_rel").select("doc_id", F.col("ref").alias("rel")).distinct(), k.where("not is_rel").select("doc_id", "ref").distinct()
    # A triple matters to a document only if the document holds one end, and each stands in both orders: so the first end is looked up, then the second.
    ends = objs.withColumnRenamed("ref", "o").join(rels, "doc_id").join(triples.select("rel", "o", "s").distinct(), ["rel", "o"])
    both = ends.join(objs.withColumnRenamed("ref", "s").withColumn("both", F.lit(True)), ["doc_id", "s"], "left")
    return both.groupBy("doc_id").agg(F.max(F.when(F.col("both"), HIGH).otherwise(SECOND)).alias("priority"))


def term_refs(terms: DataFrame) -> DataFrame:
    """refs of terms with one synset each (doc_id, idx, synset)."""
    return terms.where("synset is not null").select("doc_id", F.struct(F.col("idx"), F.lit(0).alias("n")).alias("place"), F.col("synset").alias("ref"))


def document_refs(docs: DataFrame) -> DataFrame:
    """refs of annotated documents, all references of all terms."""
    t = docs.select("doc_id", F.posexplode("terms").alias("idx", "t"))
    return t.select("doc_id", "idx", F.posexplode("t.refs").alias("n", "r")).select("doc_id", F.struct("idx", "n").alias("place"), F.col("r.reference").alias("ref")).where("ref is not null")
