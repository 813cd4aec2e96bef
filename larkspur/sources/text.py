"""Text sources."""

from __future__ import annotations

import glob
import gzip
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from larkspur.config import StorageConfig
from larkspur.sources.named import found, local_path


def read_lines(spark: SparkSession, path: str, delimiter: str = "\n", charset: str = "UTF-8", recursive: bool = True, max_length: int | None = None, tolerate_cut: bool = True) -> DataFrame:
    """value: a row per record of the files below a path.

    Files are split among tasks at record boundaries; a last record without delimiter counts. With the delimiter \\n one carriage return at a record's end is cut off, and a lone one inside does not split.
    Compressed files are read by their ending; of one that is cut off, the readable part is kept (tolerate_cut). Records over max_length are an error.
    """
    r = spark.read.option("lineSep", delimiter).option("encoding", charset).option("recursiveFileLookup", str(recursive).lower()).option("ignoreCorruptFiles", str(tolerate_cut).lower())
    df = r.text(path) if charset.upper() in ("UTF-8", "UTF8") else _decoded(spark, path, delimiter, charset, recursive)
    if max_length is not None:
        df = df.select(F.when(F.octet_length("value") > max_length, F.raise_error(F.lit(f"a record is longer than {max_length} bytes"))).otherwise(F.col("value")).alias("value"))
    return df.select(F.regexp_replace("value", r"\r\z", "").alias("value")) if delimiter == "\n" else df


def _decoded(spark: SparkSession, path: str, delimiter: str, charset: str, recursive: bool) -> DataFrame:
    """Files in another charset, whole (Spark splits text files in UTF-8 only)."""
    "".encode(charset)  # an unknown charset is an error here
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    parts = F.split(F.decode("content", charset), "\\Q" + delimiter + "\\E")
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return files.select(F.explode(parts).alias("value"))


def read_blobs(spark: SparkSession, config: StorageConfig) -> DataFrame:
    """value: the lines of the configuration's files whose names begin with its prefix; \\n, \\r and \\r\\n all end a line.

    Compressed files are known by their ending; where one of another ending is compressed (by its first two bytes), all are read by their content."""
    if packed(spark, config):
        spark.dataSource.register(PackedLines)
        return spark.read.format("packed-lines").load(f"{config.folder}/{config.prefix}*")
    return spark.read.option("ignoreCorruptFiles", "true").text(f"{config.folder}/{config.prefix}*")


def packed(spark: SparkSession, config: StorageConfig) -> bool:
    """Whether a file with the configuration's prefix is compressed without its name saying so."""
    files = [f.getPath() for f in found(spark, config) if f.isFile() and f.getLen() > 1 and not f.getPath().getName().endswith((".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst"))]
    for p in files:
        s = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
        head = (s.read(), s.read())
        s.close()
        if head == (0x1F, 0x8B):
            return True
    return False


class PackedFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PackedReader(DataSourceReader):
    def __init__(self, pattern: str):
        self.pattern = local_path(pattern)

    def partitions(self) -> list[PackedFile]:
        return [PackedFile(f) for f in sorted(glob.glob(self.pattern)) if os.path.isfile(f)] or [PackedFile("")]

    def read(self, partition: PackedFile) -> Iterator:
        """Line by line: a file needn't fit in memory. Of one that is cut off, the readable part counts."""
        if not partition.path:
            return
        with open(partition.path, "rb") as f:
            zipped = f.read(2) == b"\x1f\x8b"
        with (gzip.open if zipped else open)(partition.path, "rt", encoding="utf-8", errors="replace", newline=None) as lines:
            try:
                for line in lines:
                    yield (line.removesuffix("\n"),)
            except EOFError:
                return


class PackedLines(DataSource):
    """The data source "packed-lines": lines of plain and gzip files of a mounted folder, told apart by their first bytes."""

    @classmethod
    def name(cls) -> str:
        return "packed-lines"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options["path"])


def open_text(spark: SparkSession, source: str) -> DataFrame:
    """A path ending in .json is a storage configuration, any other a folder or file of text."""
    return read_blobs(spark, StorageConfig.load(source)) if source.endswith(".json") else read_lines(spark, source)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """name, line, value: the lines of each file of a folder in order, those without text after the last one left out; folders in it aren't read."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    w = Window.partitionBy("path").orderBy("block", "at")
    lines = lines.withColumn("line", F.row_number().over(w) - 1)
    last = F.max(F.when(F.col("value") != "", F.col("line"))).over(Window.partitionBy("path"))
    return lines.withColumn("last", last).where("line <= last").select(F.element_at(F.split("path", "/"), -1).alias("name"), "line", "value")


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of files as they come into a folder; what was read is remembered by the query's checkpoint."""
    s = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return s.select(F.regexp_replace("value", r"\r\z", "").alias("value"))
