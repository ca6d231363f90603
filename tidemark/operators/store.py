"""A set of tables that changes as one: loads replace rows by key, readers see one version or the next.

Rows lie in buckets by the hash of a table's key; a load writes the buckets anew that it touches, beside those that are
there, and then one manifest that names the files of every table. Manifests are numbered: the last one is the set. The files of
the last two are kept, so that who reads while a load ends is not cut off. A load that dies leaves no manifest, hence nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.staging import sorted_side, staged

#: Buckets of a table, unless the store was made with other numbers; more for larger tables, so that a load touches less.
BUCKETS = 64
#: Versions whose files are kept.
KEPT = 2


class Store:
    """keys: of each table the columns that rows are replaced by."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, list[str]], buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        """The numbers of the manifests, ascending."""
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return sorted(int(n[9:21]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _manifest(self, number: int | None) -> dict:
        if number is None:
            return {"buckets": self.buckets, "tables": {}}
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.root}/manifest-{number:012d}.json").first()[0])

    def _read(self, manifest: dict, table: str, buckets: list[str] | None = None) -> DataFrame | None:
        entry = manifest["tables"].get(table)
        if entry is None:
            return None
        paths = [p for b, p in entry["parts"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(entry["schema"]).parquet(*paths) if paths else self.spark.createDataFrame([], entry["schema"])

    def tables(self) -> dict[str, DataFrame]:
        """The tables as the last load that finished left them."""
        numbers = self._numbers()
        manifest = self._manifest(numbers[-1] if numbers else None)
        return {t: self._read(manifest, t) for t in manifest["tables"]}

    def commit(self, changes: dict[str, tuple[DataFrame, DataFrame | None]]) -> int:
        """Replaces rows in all tables of changes (table: rows, and keys that go though no row has them) at once; the new version's number.

        A key's old rows go, whatever their number. Loading the same rows again gives the same tables.
        """
        numbers = self._numbers()
        manifest = self._manifest(numbers[-1] if numbers else None)
        number, folder = (numbers[-1] + 1 if numbers else 0), f"{self.root}/data/{uuid.uuid4().hex}"
        n = manifest["buckets"]
        for table, (rows, gone) in changes.items():
            by = self.keys[table]
            bucket = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in by]), F.lit(n)).cast("int").alias("bucket")
            rows = staged(rows, table)
            lost = (rows.select(*by) if gone is None else rows.select(*by).unionByName(gone.select(*by))).distinct()
            touched = [str(r[0]) for r in lost.select(bucket).distinct().collect()]  # n at most
            old = self._read(manifest, table, touched)
            new = rows if old is None else old.join(sorted_side(lost), by, "left_anti").unionByName(rows, allowMissingColumns=True)
            entry = manifest["tables"].setdefault(table, {"parts": {}, "schema": ""})
            entry["schema"] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema)
            spread = F.pmod(F.xxhash64(*new.columns), F.lit(16))
            new.select("*", bucket).repartition("bucket", spread).write.partitionBy("bucket").parquet(f"{folder}/{table}")
            for b in touched:
                path = f"{folder}/{table}/bucket={b}"
                entry["parts"].pop(b, None)
                if self._fs.exists(self._path(path)):
                    entry["parts"][b] = path
        self._publish(number, manifest)
        self._sweep()
        return number

    def _publish(self, number: int, manifest: dict) -> None:
        target, beside = self._path(f"{self.root}/manifest-{number:012d}.json"), self._path(f"{self.root}/.manifest-{uuid.uuid4().hex}")
        out = self._fs.create(beside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(beside, target):
            raise RuntimeError(f"another load has made version {number}")

    def _sweep(self) -> None:
        """Deletes what no kept version names."""
        numbers = self._numbers()
        named = {p.split("/data/")[1].split("/")[0] for k in numbers[-KEPT:] for t in self._manifest(k)["tables"].values() for p in t["parts"].values()}
        for k in numbers[:-KEPT]:
            self._fs.delete(self._path(f"{self.root}/manifest-{k:012d}.json"), False)
        for status in self._fs.listStatus(self._path(f"{self.root}/data")):
            if status.getPath().getName() not in named:
                self._fs.delete(status.getPath(), True)
