"""Tab-separated files: lexicons and dictionaries in, robust rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.config import StorageConfig
from larkspur.functions.text import robust_field
from larkspur.operators.lexicon import last_wins, member_list
from larkspur.session import numbered
from larkspur.sources import named


def read_tsv(spark: SparkSession, path: str, columns: list[str], quote: str = '"') -> DataFrame:
    """String columns of a tab-separated file without head; blanks around values don't count, blank lines are skipped. quote "" reads quotation marks as they stand."""
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.csv(path, sep="\t", schema=schema, quote=quote, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """n, value: the lines of a file that aren't empty, numbered from 0 in their order."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r\z", "")).where("value <> ''")
    return numbered(lines, ["path", "block", "at"], "n").select("n", "value")


def _columns(lines: DataFrame, *names: str) -> DataFrame:
    p = F.split("value", "\t")
    return lines.select("n", *[F.trim(F.get(p, F.lit(k))).alias(x) for k, x in enumerate(names)])


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    """predicate, rel, objects, subjects; of lines with one relation the last counts."""
    r = last_wins(_columns(numbered_lines(spark, path), "predicate", "rel", "o", "s"), "rel", "n")
    return r.select("predicate", "rel", member_list(F.coalesce("o", F.lit(""))).alias("objects"), member_list(F.coalesce("s", F.lit(""))).alias("subjects"))


def read_synsets(spark: SparkSession, path: str) -> DataFrame:
    """id, name; of lines with one id the last counts."""
    return last_wins(_columns(numbered_lines(spark, path), "id", "name"), "id", "n").drop("n")


def read_raw_relations(spark: SparkSession, path: str) -> DataFrame:
    """rel, obj, subj."""
    return read_tsv(spark, path, ["rel", "obj", "subj"])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """token, id: the first column of each line, numbered in the file's order from 0; quotation marks are part of tokens."""
    return numbered_lines(spark, path).select(F.split("value", "\t")[0].alias("token"), F.col("n").cast("int").alias("id"))


def robust_rows(df: DataFrame) -> DataFrame:
    """value: df's columns as one tab-separated field each, see robust_field."""
    return df.select(F.concat_ws("\t", *[robust_field(F.col(f"`{c}`")) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, gzip: bool = False, limit: int | None = None, files: int | None = 1, mode: str = "errorifexists") -> None:
    """df as tab-separated text with CRLF after each row; in files with up to limit rows, if given. What comes before the writers keeps its own tasks."""
    out = robust_rows(df)
    w = (out.repartition(files) if files else out).write.mode(mode).option("lineSep", "\r\n").option("compression", "gzip" if gzip else "none")
    (w.option("maxRecordsPerFile", limit) if limit else w).text(path)


def write_tsv_limited(df: DataFrame, folder: str, limit: int = 1000, gzip: bool = False, tasks: int = 1) -> None:
    """df as robust rows in a mounted folder, in files task-part: each task's first file holds limit - 1 rows, its later ones limit."""
    named.write_named(robust_rows(df), StorageConfig(folder, "", "", "", limit, compress=gzip), "limited", tasks)


def limited_files(df: DataFrame, order: list[str], limit: int = 1000) -> DataFrame:
    """df with file: which of the rolled files a row goes to, in one order of all rows. The first holds limit - 1 rows, later ones limit."""
    return numbered(df, order, "_row").withColumn("file", F.floor((F.col("_row") + 1) / limit).cast("int")).drop("_row")


def write_dictionary(words: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """token and n by id, one file, the id being the line's number."""
    words.orderBy("id").select(F.concat_ws("\t", "token", F.col("n").cast("string")).alias("value")).coalesce(1).write.mode(mode).text(path)
