"""What leaves the engine: JSON by document, failures, summaries, image files' rows, tables by JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, folder: str, name: str) -> None:
    """One JSON line for each row of a stage (raw, tables, schema, unmapped), keyed by path, so equal names do not meet."""
    df.write.mode("overwrite").option("ignoreNullFields", True).json(f"{folder}/{name}")


def failures_report(failures: DataFrame, total: int) -> DataFrame:
    """A row for each failure (file_name, stage, kind, message), and one with total and failed, where these are null.

    Failures stay where they are: nothing gathers them in one task, so a report may hold any number of them.
    """
    none = F.lit(None).cast("long")
    each = failures.select(none.alias("total"), none.alias("failed"), "file_name", "stage", "kind", "message")
    counted = failures.agg(F.count(F.lit(1)).alias("failed")).select(F.lit(total).cast("long").alias("total"), "failed", *[F.lit(None).cast(failures.schema[c].dataType).alias(c) for c in ("file_name", "stage", "kind", "message")])
    return counted.unionByName(each)


def failure_row(stage: str):
    """Columns of a failure out of read rows (atch_file_path, file_extn_nm, error, message)."""
    return [F.col("atch_file_path").alias("file"), F.col("file_extn_nm").alias("ext"), F.lit(stage).alias("stage"), F.col("error").alias("exception"), F.col("message").alias("message")]


def bind_paths(images: DataFrame, saved: DataFrame) -> DataFrame:
    """images(doc, pos, ..) with the path of the saved file (doc, img_no, path) of the same number; the shorter side decides."""
    return images.join(saved.select("doc", F.col("img_no").alias("pos"), "path"), ["doc", "pos"])


def summary_text(totals: DataFrame) -> DataFrame:
    """A line of text for each number of a one-row table, as a console shows it."""
    cols = totals.columns
    return totals.select(F.explode(F.array(*[F.concat_ws(": ", F.lit(c), F.col(c).cast("string")) for c in cols])).alias("line"))


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 1000, connections: int = 5, **options: str) -> None:
    """Appends to a database's table over at most so many connections at once."""
    df.coalesce(connections).write.format("jdbc").options(url=url, dbtable=table, batchsize=batch, **options).mode("append").save()


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, parts: int = 5, **options: str) -> DataFrame:
    """A database's table in parts by ranges of a number column, over one connection a part; its least and greatest are asked first."""
    read = lambda **how: spark.read.format("jdbc").options(url=url, **options, **how).load()
    ends = read(query=f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}").first()
    if ends[0] is None:
        return read(dbtable=table)
    return read(dbtable=table, partitionColumn=key, lowerBound=int(ends[0]), upperBound=int(ends[1]) + 1, numPartitions=parts)
