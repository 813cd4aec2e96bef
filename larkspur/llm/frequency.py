"""Problem 7: how often every distinct term occurs, and in how many records, by recursive radix spilling.

Terms are counted inside each Arrow partition first (DuckDB), so that a term moves once per PARTIAL counts of a task, however common it is. The shuffle splits the
counts by hash bits; a task writes its share to disk in FAN buckets by further bits, splits buckets that are still too large by the bits after
those, and aggregates each bucket out-of-core in DuckDB. Shares of up to AT_ONCE counts need no disk. Every term and every record is counted.

Defined cases: null texts are no records; texts without letters are records without terms; null values are no terms; an empty table gives an
empty result, and no term is common or rare in it; very long texts are split up whole.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.duck import connection

COUNTS = "term string, h bigint, occurrences bigint, records bigint"
#: Buckets per split (6 bits of the hash), and the counts up to which a bucket is aggregated at once.
BITS, AT_ONCE = 6, 32_768
#: The counts that a task collects before it adds up and sends on what it has.
PARTIAL = 1_000_000
FAN = 1 << BITS


def count_words(texts: DataFrame, text: str = "text", partial: int = PARTIAL) -> DataFrame:
    """Partial counts (term, h, occurrences, records) of the longest runs of letters in the lower-cased texts; each row is a record."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with connection() as (con, _):

            def sent() -> Iterator:
                yield from con.sql("select term, sum(n)::bigint as n, sum(r)::bigint as r from part group by term").to_arrow_table().to_batches(max_chunksize=10_000)
                con.execute("truncate part")

            con.execute("create table part (term varchar, n bigint, r bigint)")
            for b in batches:
                con.register("batch", pa.Table.from_batches([b]))
                con.execute(
                    "insert into part select term, sum(n), count(*) from (select i, term, count(*) as n from (select row_number() over () as i, unnest(regexp_extract_all(lower(text), '\\p{L}+')) as term from batch) group by i, term) group by term"
                )
                con.unregister("batch")
                if con.execute("select count(*) from part").fetchall()[0][0] > partial:
                    yield from sent()
            yield from sent()

    d = texts.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("text"))
    return d.mapInArrow(run, "term string, occurrences bigint, records bigint").select("term", F.xxhash64("term").alias("h"), "occurrences", "records")


def count_values(df: DataFrame, record: str, value: str) -> DataFrame:
    """Partial counts of the values as they stand; rows with the same record are one record."""
    one = df.where(F.col(f"`{value}`").isNotNull()).groupBy(F.col(f"`{record}`").alias("record"), F.col(f"`{value}`").cast("string").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    return one.groupBy("term").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("records")).select("term", F.xxhash64("term").alias("h"), "occurrences", "records")


def radix_sum(parts: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """Exact totals (term, occurrences, records) of partial counts."""

    def run(batches: Iterator) -> Iterator:
        import os

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        with connection() as (con, tmp):
            made = 0

            def total(t: pa.Table) -> Iterator:
                con.register("share", t)
                out = con.sql("select term, sum(occurrences)::bigint as occurrences, sum(records)::bigint as records from share group by term").to_arrow_table()
                con.unregister("share")
                yield from out.to_batches(max_chunksize=10_000)

            def split(source: Iterator, level: int) -> list[tuple[str, int]]:
                """The rows of source in FAN files by the hash's next bits."""
                nonlocal made
                files, rows, writers = [], [0] * FAN, []
                for _ in range(FAN):
                    made += 1
                    files.append(os.path.join(tmp, f"share-{made}"))
                    writers.append(None)
                for b in source:
                    bucket = (b.column(b.schema.get_field_index("h")).to_numpy(zero_copy_only=False).astype(np.uint64) >> np.uint64(BITS * level)) & np.uint64(FAN - 1)
                    order = np.argsort(bucket, kind="stable")
                    ends = np.searchsorted(bucket[order], np.arange(FAN + 1))
                    b = b.take(pa.array(order))
                    for k in range(FAN):
                        if n := int(ends[k + 1] - ends[k]):
                            writers[k] = writers[k] or pa.ipc.new_file(files[k], b.schema)
                            writers[k].write_batch(b.slice(int(ends[k]), n))
                            rows[k] += n
                for w in writers:
                    if w:
                        w.close()
                return [(f, n) for f, n in zip(files, rows, strict=True) if n]

            def pieces(file: str) -> Iterator:
                with pa.memory_map(file) as m:
                    r = pa.ipc.open_file(m)
                    for k in range(r.num_record_batches):
                        yield r.get_batch(k)

            def buckets(files: list[tuple[str, int]], level: int) -> Iterator:
                for f, n in files:
                    same = n > at_once and level * BITS < 60 and pc.count_distinct(pa.chunked_array([b.column(1) for b in pieces(f)])).as_py() == 1
                    if n > at_once and level * BITS < 60 and not same:
                        inner = split(pieces(f), level)
                        os.remove(f)
                        yield from buckets(inner, level + 1)
                    else:
                        with pa.memory_map(f) as m:
                            yield from total(pa.ipc.open_file(m).read_all())
                        os.remove(f)

            held, n, rest = [], 0, iter(batches)
            for b in rest:
                held.append(b)
                n += b.num_rows
                if n > at_once:
                    break
            else:
                if held:
                    yield from total(pa.Table.from_batches(held))
                return

            def all_of() -> Iterator:
                while held:
                    yield held.pop(0)
                yield from rest

            yield from buckets(split(all_of(), 0), 1)

    return parts.repartition("term").mapInArrow(run, "term string, occurrences bigint, records bigint")


def marked(totals: DataFrame, all_records: DataFrame, rare_below: int = 3, common_over: float = 0.2) -> DataFrame:
    """totals with a mark: rare in fewer than rare_below records, common in more than that share of all (one row, column all_records), else null.
    A term that is both, as may be in a tiny table, is rare."""
    return totals.withColumn("all_records", all_records.scalar()).withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(F.col("records") > common_over * F.col("all_records"), "common"))
