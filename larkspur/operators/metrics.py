"""Counters: what a job did, as observations that come with its own run, or as tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def null_counter_name(path: str) -> str:
    return "null-counter-" + re.sub(r"[^a-zA-Z]+", "-", path)


def any_null(df: DataFrame, cols: list[str] | None = None):
    c = F.lit(False)
    for x in cols or df.columns:
        c = c | F.col(f"`{x}`").isNull()
    return c


def observe_nulls(df: DataFrame, path: str) -> tuple[DataFrame, Observation]:
    """df, and an observation that after df's next action holds the number of rows with a null."""
    o = Observation(null_counter_name(path))
    return df.observe(o, F.count_if(any_null(df)).alias("rows_with_null"), F.count(F.lit(1)).alias("rows")), o


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df and an observation of its rows."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows")), o


def scoring_counters(docs: DataFrame, scored: DataFrame, errors: int = 0, priority: str = "priority") -> dict[str, int]:
    """A scoring job's counters: ERROR, ANNOTATED_SENTENCES, FILTER_OUT (annotated, but without any match) and PRIORITY_n. Both tables are read, so they should be kept."""
    by = {r["counter"]: r["n"] for r in priority_counts(scored, priority).collect()}  # a row a priority
    annotated = docs.count()
    return {"ERROR": errors, "ANNOTATED_SENTENCES": annotated, "FILTER_OUT": annotated - sum(by.values()), **by}


def priority_counts(df: DataFrame, priority: str = "priority") -> DataFrame:
    """counter (PRIORITY_n) and n."""
    return df.groupBy(F.concat(F.lit("PRIORITY_"), F.col(priority).cast("string")).alias("counter")).agg(F.count(F.lit(1)).alias("n"))
