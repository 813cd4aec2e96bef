"""Bounded samples for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def bounded(df: DataFrame, by: list[str], most: int, among: Column | None = None) -> list[Row]:
    """At most `most` rows of df, those with the smallest hash of the columns in `by`; the same rows in any partitioning.

    So that no task sends more than its share, rows over a hash bound are left out first; the bound is set by the number of rows to let three times the
    wanted number pass. For training only: what a model is applied to is never sampled.
    """
    h = F.xxhash64(*by)
    n = df.count()
    if n > 4 * most:
        df = df.where(F.pmod(h, F.lit(1_000_000)) < F.lit(max(1, round(3_000_000 * most / n))))
    if among is not None:
        df = df.where(among)
    return df.orderBy(F.pmod(h, F.lit(1_000_000)), h, *by).limit(most).collect()
