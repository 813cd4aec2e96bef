"""DuckDB as a vectorised engine inside Spark tasks.

A task gets Arrow batches from Spark, hands each to an in-memory DuckDB as a table without copying, and returns the result of one SQL text as
Arrow batches. One thread and a memory limit per task keep it inside the executor's share; what doesn't fit spills to the executor's own
local disk, which belongs to the task and is gone with it.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from larkspur.session import scratch_dir

#: MB of memory for one task's DuckDB.
MEMORY_MB = 256


@contextmanager
def connection(memory_mb: int = MEMORY_MB):
    """A DuckDB for one task, and the folder it may spill to."""
    import duckdb

    at = scratch_dir()
    os.makedirs(at, exist_ok=True)
    tmp = tempfile.mkdtemp(prefix="duck-", dir=at)
    con = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": f"{memory_mb}MB", "temp_directory": tmp, "preserve_insertion_order": "false"})
    try:
        yield con, tmp
    finally:
        con.close()
        shutil.rmtree(tmp, ignore_errors=True)


def map_sql(df: DataFrame, sql: str, schema: str, memory_mb: int = MEMORY_MB) -> DataFrame:
    """df through a SQL text over the table "batch", batch by batch: for SQL that treats each row by itself. The order of SQL's columns is schema's."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with connection(memory_mb) as (con, _):
            for b in batches:
                if b.num_rows:
                    con.register("batch", pa.Table.from_batches([b]))
                    yield from con.sql(sql).to_arrow_table().to_batches(max_chunksize=10_000)
                    con.unregister("batch")

    return df.mapInArrow(run, schema)
