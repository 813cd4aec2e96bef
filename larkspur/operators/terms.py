"""Term streams: terms of annotated documents, clean-up of numbers, and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The part of speech of numbers, the signs that may stand in them, the token that stands for them, and the form of a synset's id.
NUMBER, SIGNS, TOKEN = "CD", (":", ",", "."), "<nmb>"
SYNSET = r"^[0-9]{8}-[a-z]\z"


def is_synset(c: Column) -> Column:
    return c.rlike(SYNSET)


def simple_terms(terms: Column) -> Column:
    """array<TERM> of a document's terms: the form, its part of speech, and the first reference that is a synset's id."""
    return F.transform(
        terms, lambda t: F.struct(t["form"].alias("lemma"), t["morphofeat"].alias("pos"), F.get(F.filter(F.transform(t["refs"], lambda r: r["reference"]), is_synset), F.lit(0)).alias("synset"))
    )


def exploded(docs: DataFrame) -> DataFrame:
    """doc_id, idx, lemma, pos, synset of documents with the column terms."""
    return docs.select("doc_id", F.posexplode(simple_terms(F.col("terms"))).alias("idx", "t")).select("doc_id", "idx", "t.lemma", "t.pos", "t.synset")


def term_string(lemma: Column, pos: Column, synset: Column) -> Column:
    """lemma@pos or lemma@pos@synset; a null part of speech is the word null."""
    return F.concat_ws("@", F.coalesce(lemma, F.lit("null")), F.coalesce(pos, F.lit("null")), synset)


def parse_term(c: Column) -> Column:
    """TERM of such a string, null with fewer than two parts. A lemma with @ in it doesn't come back."""
    parts = F.split(c, "@")
    return F.when(F.size(parts) >= 2, F.struct(parts[0].alias("lemma"), parts[1].alias("pos"), F.get(parts, F.lit(2)).alias("synset")))


def clean_terms(terms: DataFrame, mode: str = "reference", doc: str = "doc_id", idx: str = "idx") -> DataFrame:
    """doc_id, idx, sub, lemma, pos, synset with runs of numbers as one token, in the order (idx, sub).

    A number is held back, as is a sign after it. mode "reference": what is held back is never let go, so every later term, until the next number, is preceded by the token for a number,
    and by the sign if there was one; at the end of a document it is lost. mode "fixed": it comes out once, before the next term or at the end.

    Windows over a document's terms only: no state in Python. Ties in idx are ordered by lemma, pos and synset.
    """
    order = Window.partitionBy(doc).orderBy(idx, "lemma", "pos", "synset")
    t = terms.select(F.col(doc).alias("doc_id"), F.col(idx).alias("idx"), "lemma", "pos", "synset")
    t = t.withColumn("row", F.row_number().over(order)).withColumn("run", F.count_if(F.coalesce(F.col("pos") == NUMBER, F.lit(False))).over(order))
    run = Window.partitionBy("doc_id", "run")
    sign = F.coalesce(F.col("pos").isin(*SIGNS), F.lit(False)) & (F.col("run") > 0)
    number = F.coalesce(F.col("pos") == NUMBER, F.lit(False))
    term = F.struct("lemma", "pos", "synset")
    held = F.struct(F.lit(TOKEN).alias("lemma"), F.lit(NUMBER).alias("pos"), F.lit(None).cast("string").alias("synset"))
    none, own = F.array().cast("array<struct<lemma:string,pos:string,synset:string>>"), F.array(term)
    if mode == "reference":
        t = t.withColumn("first", F.min(F.when(sign, F.struct("row", "lemma", "pos", "synset"))).over(run))
        first = F.struct(F.col("first.lemma").alias("lemma"), F.col("first.pos").alias("pos"), F.col("first.synset").alias("synset"))
        out = (
            F.when(number, none).when(F.col("run") == 0, own).when(F.col("first").isNull() | (F.col("row") < F.col("first.row")), F.array(held, term))
            .when(F.col("row") == F.col("first.row"), none).otherwise(F.array(held, first, term))
        )
        t = t.withColumn("out", out)
    elif mode == "fixed":
        # Held back: a number, and a sign right after one. A number right after either goes on with the run.
        before = F.lag(F.struct("lemma", "pos", "synset")).over(order)
        t = t.withColumn("before", before).withColumn("b_number", F.coalesce(F.lag(number).over(order), F.lit(False)))
        t = t.withColumn("held", number | (F.coalesce(F.col("pos").isin(*SIGNS), F.lit(False)) & F.col("b_number")))
        t = t.withColumn("b_held", F.coalesce(F.lag("held").over(order), F.lit(False))).withColumn("last", F.lead("row").over(order).isNull())
        sign_before = F.when(F.col("b_held") & ~F.col("b_number"), F.array("before")).otherwise(none)
        gone = F.when(F.col("b_held"), F.concat(F.array(held), sign_before)).otherwise(none)
        end = F.when(F.col("last"), F.when(number, F.array(held)).otherwise(F.concat(F.array(held), own))).otherwise(none)
        t = t.withColumn("out", F.when(F.col("held"), end).otherwise(F.concat(gone, own)))
    else:
        raise ValueError(f"no such mode: {mode}")
    return t.select("doc_id", "idx", F.posexplode("out").alias("sub", "o")).select("doc_id", "idx", "sub", "o.lemma", "o.pos", "o.synset")


def ordered(terms: DataFrame) -> Column:
    """An aggregate: a document's terms as array<struct<idx, sub, lemma, pos, synset>> in order."""
    sub = F.col("sub") if "sub" in terms.columns else F.lit(0)
    return F.array_sort(F.collect_list(F.struct(F.col("idx"), sub.alias("sub"), "lemma", "pos", "synset")))


def annotated_text(terms: DataFrame) -> DataFrame:
    """doc_id and the document's terms as strings with blanks between."""
    return terms.groupBy("doc_id").agg(ordered(terms).alias("a")).select("doc_id", F.array_join(F.transform("a", lambda t: term_string(t["lemma"], t["pos"], t["synset"])), " ").alias("text"))


def count_terms(terms: DataFrame, key: str, min_exclusive: int | None = None) -> DataFrame:
    """key and n; only keys with more than min_exclusive occurrences, if given. Counts are combined on the map side."""
    out = terms.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return out if min_exclusive is None else out.where(F.col("n") > min_exclusive)


def count_strings(counts: DataFrame, key: str) -> DataFrame:
    """value: counts in the form (key,n)."""
    return counts.select(F.format_string("(%s,%d)", F.col(key), F.col("n")).alias("value"))
