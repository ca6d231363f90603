"""Loads that run day by day: what arrived since the last run, once each, whatever was cut short in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import text as T
from tidemark.operators.store import BUCKETS, Store


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the files that arrive in a folder: path, modificationTime, length, content."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(folder)


def available_now(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands what is there to load in micro-batches and ends. load may see a batch again, so it replaces by key."""
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replace_by_key(table: str, by: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A load that leaves the last batch's rows for each key in a table at a path, twice the same as once.

    Versions are numbered by the store, not by the batch: a batch that comes again, or a new checkpoint's first, is a
    version of its own that replaces the same keys. Only the buckets of its keys are written.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        Store(batch.sparkSession, table, {"rows": by}, buckets).commit({"rows": (batch, None)})

    return load


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The table as the last finished load left it; null before the first."""
    return Store(spark, table, {}).tables().get("rows")


def once_by_source(posts: DataFrame, late: str | None = None, at: str = "ts") -> DataFrame:
    """posts with src_key_hash of src_key, one row for each; a stream forgets keys that are later than its watermark."""
    keyed = posts.withColumn("src_key_hash", T.key_hash("src_key"))
    return keyed.withWatermark(at, late).dropDuplicatesWithinWatermark(["src_key_hash"]) if late else keyed.dropDuplicates(["src_key_hash"])


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type and tumbling window: n and total. Works on tables and, with its watermark, on streams."""
    marked = events.withWatermark("ts", late)
    return marked.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of users: start, end and n of events without a pause of gap."""
    marked = events.withWatermark("ts", late)
    return marked.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
