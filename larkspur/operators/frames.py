"""Frames as sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.functions.text import role_value


def clause(role: Column) -> Column:
    """'value' is the 'role name'."""
    return F.concat(F.lit("'"), role_value(F.coalesce(role["str"], F.lit(""))), F.lit("' is the '"), F.substring_index(role["framenet"], "@", -1), F.lit("'"))


def frame_sentences(docs: DataFrame, priority: str = "priority") -> DataFrame:
    """doc_id, place, sentence, priority: one row for each predicate with a frame, in the document's order; roles whose frame has no @ are left out, and a predicate without roles still has a sentence, ending in a blank.

    docs: doc_id, predicates and the priority. Null arrays, predicates and roles have no sentence or clause.
    """
    p = docs.select("doc_id", F.col(priority).alias("priority"), F.posexplode("predicates").alias("place", "p")).where("p.framenet is not null")
    roles = F.filter(F.coalesce(F.col("p.roles"), F.array().cast("array<struct<framenet:string,str:string>>")), lambda r: F.coalesce(F.contains(r["framenet"], F.lit("@")), F.lit(False)))
    text = F.format_string("In frame (%d) %s %s", F.col("priority"), F.upper("p.framenet"), F.array_join(F.transform(roles, clause), " and "))
    return p.select("doc_id", "place", text.alias("sentence"), "priority")
