"""The data source "named-text": files with given names, rolled by number of rows.

A task's first file is prefix[-task-tasks]suffix, its next ones have -1, -2 ... before the suffix; the task's part is there only if there are several tasks. A file is full with exactly so many rows as the limit, and the
next is opened at once, so a whole multiple leaves an empty last file. In mode text rows have a line end between them and none at the end; in mode raw bytes stand one after the other. Files that exist
already are an error. With limited naming, files are task-part, tasks counted from 1, each row has its line end, and the first file is one row short of the limit.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from larkspur.config import StorageConfig
from larkspur.functions.text import base_name, human_size


def local_path(uri: str) -> str:
    """The path of a file: URI or a plain path: a folder all executors share."""
    u = urlparse(uri)
    if u.scheme not in ("", "file"):
        raise ValueError(f"named outputs need a mounted folder, not {u.scheme}:")
    return unquote(u.path) if u.scheme else uri


def part_name(prefix: str, suffix: str, part: int, task: int = 0, tasks: int = 1) -> str:
    return prefix + (f"-{task}-{tasks}" if tasks > 1 else "") + (f"-{part}" if part else "") + suffix


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class NamedWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.folder, self.prefix = local_path(options["path"]), options.get("prefix", "output")
        self.gzip = options.get("compress", "false").lower() == "true"
        self.suffix = options.get("suffix", ".gz" if self.gzip else ".txt")
        self.rows, self.raw, self.tasks = int(options.get("rowsperpart", 1_000_000)), options.get("kind", "text") == "raw", int(options.get("tasks", 1))
        self.limited = options.get("kind") == "limited"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        task, stage = TaskContext.get().partitionId(), os.path.join(self.folder, f"_stage-{uuid.uuid4().hex}")
        os.makedirs(stage, exist_ok=True)
        files, part, n, out = [], 0, 0, None

        def start():
            name = f"{task + 1}-{part}" if self.limited else part_name(self.prefix, self.suffix, part, task, self.tasks)
            at = os.path.join(stage, name)
            files.append((at, os.path.join(self.folder, name)))
            return gzip.open(at, "wb") if self.gzip else open(at, "wb")

        out = start()
        if self.limited:
            for row in iterator:
                n += 1
                if n % self.rows == 0:
                    out.close()
                    part = n // self.rows
                    out = start()
                out.write(str(row[0]).encode() + b"\r\n")
            out.close()
            return Written(files)
        for row in iterator:
            data = row[0] if isinstance(row[0], (bytes, bytearray)) else str(row[0]).encode()
            out.write((b"" if self.raw or n == 0 else b"\n") + bytes(data))
            n += 1
            if self.rows and n == self.rows:
                out.close()
                part, n = part + 1, 0
                out = start()
        out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        """Only what the tasks that counted have written gets its name, all or nothing."""
        files = [f for m in messages if m for f in m.files]
        there = [to for _, to in files if os.path.exists(to)]
        if there:
            self.abort(messages)
            raise FileExistsError(there[0])
        for at, to in files:
            os.rename(at, to)
        self._clear(files)

    def abort(self, messages: list) -> None:
        files = [f for m in messages if m for f in m.files]
        for at, _ in files:
            if os.path.exists(at):
                os.remove(at)
        self._clear(files)

    @staticmethod
    def _clear(files: list) -> None:
        for d in {os.path.dirname(at) for at, _ in files}:
            if os.path.isdir(d) and not os.listdir(d):
                os.rmdir(d)


class NamedText(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named-text"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options)


def write_named(df: DataFrame, config: StorageConfig, kind: str = "text", tasks: int = 1, ordered: bool = False) -> None:
    """The one column of df as the configuration's named files; tasks writers. What comes before the writers keeps its own tasks.

    ordered: df is sorted, and one writer takes its parts in their order."""
    spark = df.sparkSession
    spark.dataSource.register(NamedText)
    os.makedirs(local_path(config.folder), exist_ok=True)
    out = df.coalesce(1) if ordered else df.repartition(tasks)
    w = out.write.format("named-text").mode("append").option("path", config.folder).option("prefix", config.prefix).option("suffix", config.suffix).option("kind", kind)
    w.option("rowsPerPart", str(config.rows_per_part)).option("compress", str(config.compress).lower()).option("tasks", str(tasks)).save()


def found(spark: SparkSession, config: StorageConfig) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{config.folder}/{config.prefix}*")
    return list(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or [])


def output_exists(spark: SparkSession, config: StorageConfig) -> bool:
    """Whether any file's name begins with the prefix: word.dict is there if word.dict-1 is."""
    return bool(found(spark, config))


def tuple_string(*cols) -> F.Column:
    """Columns as (a,b)."""
    return F.concat(F.lit("("), F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols]), F.lit(")"))


def chunk_sizes(files: DataFrame, name: str = "name", size: str = "length") -> DataFrame:
    """base, chunks, bytes and size (written out) of files by the name without numbers and ending."""
    g = files.groupBy(base_name(F.col(name)).alias("base")).agg(F.count(F.lit(1)).alias("chunks"), F.sum(size).alias("bytes"))
    return g.withColumn("size", human_size(F.col("bytes")))


def list_chunks(spark: SparkSession, config: StorageConfig) -> DataFrame:
    """chunk_sizes of the configuration's files with its prefix."""
    # Listed by the file system: Spark's own sources leave empty files out.
    rows = [(f.getPath().getName(), f.getLen()) for f in found(spark, config) if f.isFile()]
    files = spark.createDataFrame(rows, "name string, length bigint")
    return chunk_sizes(files)


def assemble(spark: SparkSession, config: StorageConfig, out: str) -> None:
    """The lines of the configuration's files with its prefix as one gzip file in the folder out, in the order of the names and lines.

    Files are read in splits and sorted by name and place; only the last writing is one task."""
    lines = spark.read.option("lineSep", "\n").text(f"{config.folder}/{config.prefix}*")
    lines = lines.select("value", F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines.orderBy("name", "block", "at").select("value").coalesce(1).write.option("compression", "gzip").text(out)
