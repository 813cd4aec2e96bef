"""Sessions and table access."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table (file or folder of parts) of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, for checkpoints and written intermediate tables.

    The cluster names it in spark.checkpoint.dir. Where that is unset on one machine (tests), a temporary folder is made and set; on a cluster, whose nodes would
    each have their own, it is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="larkspur-")
        spark.conf.set("spark.checkpoint.dir", at)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


def scratch_dir() -> str:
    """Inside a task: the disk Spark gives its executor for spills (SPARK_LOCAL_DIRS, or LOCAL_DIRS of a YARN container), nothing that must outlive the task."""
    return (os.environ.get("SPARK_LOCAL_DIRS") or os.environ.get("LOCAL_DIRS") or tempfile.gettempdir()).split(",")[0]


def cut(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder (a reliable checkpoint): for results that several branches read. Survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """df with each row's number in one order of all rows, from 0, as column name; rows equal in the order's columns are numbered in any order.

    No task sees all rows: they are split by ranges of the order and kept so (a checkpoint, as range bounds are drawn from a sample), and each part's numbers begin
    after the sum of the parts before it."""
    parts = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row a part.
    begins = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).alias("_begin"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn("_own", own).join(begins, "_part").withColumn(name, F.col("_begin") + F.col("_own")).drop("_part", "_own", "_begin")
