"""Staged tables: what several branches of a plan read is written once, in storage that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """The URI of a new folder below spark.checkpoint.dir.

    Only where that setting is absent on one machine, as in tests, a temporary folder is set; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written below spark.checkpoint.dir and read again: plans stay small, and a lost executor loses nothing."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt out by columns in tasks for all cores: a small file of rows that each cost much would be one task's.

    The number is given, so that Spark does not put the few bytes together again.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *by)


def sorted_side(df: DataFrame) -> DataFrame:
    """df as a side of a join by keys that grows with the input, as the other does: both are dealt by key and sorted.

    Spark would go by the bytes of files, in which keys are packed: broadcast, they are many times that, all through the driver.
    """
    return df.hint("merge")


#: Bytes of input files for a task of sized().
TASK_BYTES = 4 << 20


def task_count(*dfs: DataFrame) -> int:
    """spark.sql.shuffle.partitions, or more where the files that the plans read are large."""
    total = 0
    for df in dfs:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total = max(total, sum(s for s in sizes if s < 1 << 50))  # what Spark has no size of says 2 ** 63
    return max(int(dfs[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))


def sized(df: DataFrame, *by: str) -> DataFrame:
    """df dealt out by columns in as many tasks as its input asks for, so that what one of them sorts does not grow with it."""
    return df.repartition(task_count(df), *by)
