"""What the corpus operators share: column picking, cutting lineage in shared storage, Arrow maps, bounded caches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python operator handles at a time; bounds a worker's memory whatever the batch size.
SLICE_BYTES = 2_000_000


def pick(df: DataFrame, **want: str) -> DataFrame:
    """The wanted columns only, cast, found by exact name first, then without case; others may carry any name.

    A column that is absent comes as null, so that a caller needs no special case for it.
    """
    return _placed(df).select(*_wanted(df, want))


def place(columns: list[str], name: str) -> int | None:
    """Where the column is: the first of exactly this name, else the first that differs in case only."""
    at = [i for i, c in enumerate(columns) if c == name] or [i for i, c in enumerate(columns) if c.lower() == name.lower()]
    return at[0] if at else None


def _placed(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def _wanted(df: DataFrame, want: dict[str, str]) -> list:
    found = {name: place(df.columns, name) for name in want}
    return [(F.lit(None) if found[name] is None else F.col(f"_c{found[name]}")).cast(kind).alias(name) for name, kind in want.items()]


def carried(df: DataFrame, **want: str) -> DataFrame:
    """row, a struct of all columns by place, beside the wanted ones as pick() gives them: names may clash in any way."""
    return _placed(df).select(F.struct(*[f"_c{i}" for i in range(len(df.columns))]).alias("row"), *_wanted(df, want))


def restored(df: DataFrame, columns: list[str], **new) -> DataFrame:
    """The columns that carried() put into row, under their own names, those that pick() would find for new replaced by it."""
    own = {place(columns, name): value for name, value in new.items()}
    return df.select(*[(own[i] if i in own else F.col(f"row._c{i}")).alias(c) for i, c in enumerate(columns)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's URI in the storage that driver and executors share (spark.checkpoint.dir).

    Only where the setting is absent on one machine, as in tests, a temporary folder is set; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """df written to shared storage and read again: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Deletes the files of a table made by cut() that no later step reads."""
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()[:1]}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow with dicts of lists on both sides; batches reach fn in slices of about SLICE_BYTES of text."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        def slices():
            for b in batches:
                step = max(1, int(b.num_rows * SLICE_BYTES / max(b.nbytes, 1)))
                for i in range(0, b.num_rows, step):
                    yield b.slice(i, step).to_pydict()

        for out in fn(slices()):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


class Bounded(dict):
    """A cache of two generations: when the young one is full it becomes the old one, so memory stays bounded."""

    def __init__(self, cap: int) -> None:
        super().__init__()
        self.cap, self.old = cap, {}

    def __missing__(self, key):
        hit = self.old.get(key)
        if hit is not None:
            self[key] = hit
        return hit

    def trim(self) -> None:
        """Between slices only: entries of the slice at hand must stay."""
        if len(self) > self.cap:
            self.old = dict(self)
            self.clear()


def partitions(spark: SparkSession, rows: int = 0, per: int = 200_000) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per))
