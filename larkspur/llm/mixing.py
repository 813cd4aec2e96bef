"""Problem 9: a mixture of sources with target shares of the tokens, by Pareto order sampling.

A document's expected copies fall with a power of its length (DAMPING), so that a few very long texts don't fill a source's share, and are cut at the source's max_repeats; their level
is set so that the expected tokens are the source's share of the total. The whole part of a document's expected copies is certain; for its fraction p documents are ranked by random odds
over inclusion odds, u/(1-u) / (p/(1-p)), with u from a hash of the key, and the first ones are taken until the rest of the source's tokens is full: a sample of fixed size with
unequal probabilities. A document that doesn't fit any more is passed over and the selection goes on behind it among those that may, until less than TOLERANCE of the source's tokens
is free or none fits.

The place in the ranking where to stop is found by radix selection: token sums by ever finer ranges of the rank, some thousand sums per source however many documents there
are; no source is sorted or gathered. What the driver collects is bounded by the number of target rows times those ranges.

By default the total is the largest at which every source with documents can have its share with its max_repeats; shares of sources without documents go to the others in proportion.

Defined cases: documents without source, of a source without target, or without tokens take no part; null shares and repeats count as 0 and 1; a source named twice in targets has the sum of its shares and
the most repeats; documents of equal rank fit together or not at all; repeated keys are documents of their own, of equal rank; without any usable source the mixture is empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut

#: Expected copies go with tokens ** -DAMPING.
DAMPING = 0.25
#: The share of a source's tokens that may stay free.
TOLERANCE = 0.001
#: Steps of length per doubling in which the expected copies are set, and of rank per doubling at each level of the selection.
STEPS, LEVELS = 16, (64, 64 * 4096, 64 * 4096 * 4096)


def level(buckets: list[tuple[int, int, int]], budget: float, most: int) -> float:
    """c such that the documents' expected tokens, with min(c * weight, most) copies each, are the budget. buckets: (step of length, documents, tokens)."""
    lo, hi = 0.0, most * max(2.0 ** (DAMPING * b / STEPS) for b, _, _ in buckets)
    for _ in range(200):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if sum(t * min(c * 2.0 ** (-DAMPING * b / STEPS), most) for b, _, t in buckets) < budget else (lo, c)
    return hi


def mixture(docs: DataFrame, targets: DataFrame, key: str, source: str, tokens: str, total: float | None = None, seed: int = 1) -> DataFrame:
    """key, source, tokens and copies of the documents that are taken. targets: source, target_share, max_repeats (a table for people to fill in, one row a source)."""
    spark = docs.sparkSession
    wanted = {
        r["source"]: (float(r["share"] or 0), int(r["most"] or 1))
        for r in targets.where("source is not null").groupBy("source").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("most")).collect()
    }
    d = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), F.col(f"`{tokens}`").cast("bigint").alias("tokens")).where((F.col("tokens") > 0) & F.col("source").isin(list(wanted)))
    d = cut(d.withColumn("step", F.floor(F.log2("tokens") * STEPS).cast("int")))
    by: dict[str, list[tuple[int, int, int]]] = {}
    for r in d.groupBy("source", "step").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).collect():  # sources times the steps of a length
        by.setdefault(r["source"], []).append((r["step"], r["n"], r["t"]))
    usable = {s: wanted[s] for s in by if wanted[s][0] > 0 and wanted[s][1] > 0}
    schema = "source string, step int, copies int, fraction double, rest double"
    plan, shares = [], sum(share for share, _ in usable.values())
    if usable:
        largest = min(most * sum(t for _, _, t in by[s]) / (share / shares) for s, (share, most) in usable.items())
        size = largest if total is None else total
    for s, (share, most) in usable.items():
        budget = 1.0 * min(size * share / shares, most * sum(t for _, _, t in by[s]))
        c = level(by[s], budget, most)
        rows = []
        for b, _, t in by[s]:
            e = min(c * 2.0 ** (-DAMPING * b / STEPS), most)
            whole = math.floor(e + 1e-9)
            rows.append((s, b, whole, max(0.0, e - whole), float(t * whole)))
        rest = budget - sum(r[4] for r in rows)
        plan += [(s, b, w, f, rest) for s, b, w, f, _ in rows]
    plan_df = F.broadcast(spark.createDataFrame(plan, schema))  # sources times the steps of a length
    u = (F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(2**52)) + 0.5) / float(2**52)
    odds = F.col("fraction") / (1 - F.col("fraction"))
    ranked = d.join(plan_df, ["source", "step"]).withColumn("rank", F.when(F.col("fraction") > 1e-9, F.log2(u / (1 - u)) - F.log2(odds)))
    out = ranked.withColumn("place", F.floor((F.col("rank") + 128) * LEVELS[-1]))
    spans = selected(out.where("place is not null").select("source", "tokens", "place"), {s: r for s, _, _, _, r in plan}, {s: TOLERANCE * size * usable[s][0] / shares for s in usable})
    spans_df = spark.createDataFrame([(s, v) for s, v in spans.items()], "source string, spans array<struct<after:bigint,upto:bigint,most:double>>")
    r = out.join(F.broadcast(spans_df), "source", "left")  # a few spans a source
    taken = F.exists("spans", lambda x: (F.col("place") > x["after"]) & (F.col("place") < x["upto"]) & (F.col("tokens") <= x["most"]))
    r = r.withColumn("copies", F.col("copies") + F.coalesce(taken, F.lit(False)).cast("int"))
    return r.where("copies > 0").select("key", "source", "tokens", "copies")


def selected(d: DataFrame, left: dict[str, float], enough: dict[str, float]) -> dict[str, list[tuple[int, int, float]]]:
    """Of documents (source, tokens, place in the ranking), which are taken so that each source's tokens fill what is left: spans (after, upto, most), a document being taken
    whose place is between after and upto, both excluded, and which has at most so many tokens. enough: what may stay free.

    Each round finds, by radix selection, the place where the rest is full, and goes on behind it among the documents that still may fit."""
    last = 2**62
    left, after, most, spans = dict(left), dict.fromkeys(left, -1), dict.fromkeys(left, float(last)), {s: [] for s in left}
    going = {s for s in left if left[s] > 0}
    while going:
        state = F.create_map(*[F.lit(x) for s in sorted(going) for x in (s, F.struct(F.lit(after[s]).cast("bigint").alias("after"), F.lit(most[s]).alias("most")))])
        here = d.where(F.col("source").isin(sorted(going)))
        of = F.try_element_at(state, F.col("source"))
        here = here.where((F.col("place") > of["after"]) & (F.col("tokens") <= of["most"]))
        above: dict[str, int] = {}
        for depth, fine in enumerate(LEVELS):
            at = lambda f: F.floor(F.col("place") / (LEVELS[-1] // f)).cast("bigint")
            inside = here
            if depth:
                if not above:
                    break
                inside = here.where(at(LEVELS[depth - 1]) == F.try_element_at(F.create_map(*[F.lit(x) for s, v in above.items() for x in (s, v)]), F.col("source")))
            sums: dict[str, list[tuple[int, int]]] = {}
            for r in inside.groupBy("source", at(fine).alias("at")).agg(F.sum("tokens").alias("t")).collect():  # sources times some thousand ranges
                sums.setdefault(r["source"], []).append((r["at"], r["t"]))
            for s in [*above] if depth else sorted(going):
                above.pop(s, None)
                for a, t in sorted(sums.get(s, [])):
                    if t > left[s]:
                        above[s] = a
                        break
                    left[s] -= t
        for s in sorted(going):
            spans[s].append((after[s], above.get(s, last), most[s]))
            after[s], most[s] = above.get(s, last), left[s]
        going = {s for s in above if left[s] > enough[s] and left[s] >= 1}
    return spans


def reached(mixed: DataFrame, docs: DataFrame, targets: DataFrame, source: str, tokens: str) -> DataFrame:
    """Every target's source with its share wanted and reached: source, target_share, max_repeats, documents, tokens_available, tokens_mixed, actual_share."""
    have = docs.where(F.col(tokens) > 0).groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum(tokens).alias("tokens_available"))
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_mixed"), F.max("copies").alias("most_copies"))
    out = targets.where("source is not null").join(have, "source", "left").join(got, "source", "left").fillna(0, ["documents", "tokens_available", "tokens_mixed", "most_copies"])
    every = got.agg(F.sum("tokens_mixed").alias("every"))
    share = F.coalesce(F.col("tokens_mixed") / every.scalar(), F.lit(0.0)).alias("actual_share")
    return out.select("source", "target_share", "max_repeats", "documents", "tokens_available", "tokens_mixed", "most_copies", share)
