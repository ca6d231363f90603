"""Token ids in flat binary files (operator 3).

A shard is three files: <name>.bin (little-endian unsigned ids, 16 bits where the vocabulary allows, else 32), <name>.off
(64-bit offsets, one more than documents) and <name>.doc (64-bit doc_ids). Shards hold ascending, disjoint ranges of
doc_id. The first id of a shard in the whole sequence is the prefix sum of the shards before it, kept in the manifest.
Writers put a shard under a name of the attempt and rename it, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._common import arrow_map, partitions, pick, scratch
from tidemark.llm.bpe import Encoder, default_tokenizer, opened

#: Stands for a null doc_id in the files; such rows come first, and the manifest has their number.
NO_ID = np.iinfo(np.int64).min


def doc_bounds(docs: DataFrame, parts: int) -> list[int]:
    """At most parts - 1 ascending doc_ids that split the rows about evenly, from a scan of that column only."""
    if parts < 2:
        return []
    got = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], max(10_000, 4 * parts))).first()[0]
    return sorted(set(got or []))


def encode_ids(docs: DataFrame, bounds: list[int], tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, shard, ids as bytes with the end id; rows without a doc_id are in the first shard."""

    def run(parts):
        enc, cuts = opened(Encoder, tokenizer), np.array(bounds, np.int64)
        end = np.array([end_id], enc.dtype).tobytes()
        for p in parts:
            ids = [b + end for b in enc.encode_bytes([(t or "").encode() for t in p["text"]])]
            keys = np.array([NO_ID if d is None else d for d in p["doc_id"]], np.int64)
            yield {"doc_id": p["doc_id"], "shard": np.searchsorted(cuts, keys).tolist(), "ids": ids}

    return arrow_map(docs, run, "doc_id bigint, shard int, ids binary")


def settle(store, tmp: str, name: str) -> None:
    """Renames tmp; where an earlier attempt of the task has put the same file there, and the store won't replace it, that one stays."""
    try:
        store.move(tmp, name)
    except OSError:
        if store.get_file_info(name).type != fs.FileType.File:
            raise
        store.delete_file(tmp)


def write_shards(encoded: DataFrame, parts: int, folder: str, width: int) -> DataFrame:
    """Writes the shards; a row for each: shard, n_docs, n_null (rows without a doc_id, its first ones), n_tokens."""

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        now = files = None
        docs, ends, total = [], [0], 0

        def close():
            for f in files:
                f.close()
            ids = np.array([NO_ID if d is None else d for d in docs], "<i8")
            for kind, data in (("doc", ids), ("off", np.array(ends, "<i8"))):
                with store.open_output_stream(f"{tmp}.{kind}") as out:
                    out.write(data.tobytes())
            for kind in ("bin", "doc", "off"):
                settle(store, f"{tmp}.{kind}", f"{root}/{now:06d}.{kind}")
            row = (now, len(docs), docs.count(None), total)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["shard", "n_docs", "n_null", "n_tokens"])

        for b in batches:
            for doc, shard, ids in zip(b.column(0), b.column(1), b.column(2)):
                if shard.as_py() != now:
                    if files:
                        yield close()
                    now, docs, ends, total = shard.as_py(), [], [0], 0
                    tmp = f"{root}/.{now:06d}-{uuid.uuid4().hex[:8]}"
                    files = [store.open_output_stream(f"{tmp}.bin")]
                data = ids.as_buffer()
                files[0].write(data)
                total += data.size // width
                docs.append(doc.as_py())
                ends.append(total)
        if files:
            yield close()

    # shard i is partition i: no task has two of them while another has none
    ordered = encoded.repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    return ordered.mapInArrow(run, "shard int, n_docs bigint, n_null bigint, n_tokens bigint")


class Numbers:
    """A file of integers: memory-mapped where the store is a local folder, else read where it is asked for."""

    def __init__(self, folder: str, name: str, dtype: str) -> None:
        store, root = fs.FileSystem.from_uri(folder)
        path, self.dtype, self.mapped = f"{root}/{name}", np.dtype(dtype), None
        if isinstance(store, fs.LocalFileSystem):
            self.n = os.path.getsize(path) // self.dtype.itemsize
            self.mapped = np.memmap(path, dtype, "r") if self.n else np.zeros(0, dtype)
        else:
            self.file = store.open_input_file(path)
            self.n = self.file.size() // self.dtype.itemsize

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at: slice) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[at]
        lo, hi, _ = at.indices(self.n)
        return np.frombuffer(self.file.read_at(max(0, hi - lo) * self.dtype.itemsize, lo * self.dtype.itemsize), self.dtype)


#: Documents that are read from a shard's files at a time.
READ = 5_000


def read_shards(spark: SparkSession, manifest: list[dict], folder: str, dtype: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""

    def run(parts):
        for p in parts:
            for shard, base, nulls in zip(p["shard"], p["base"], p["n_null"]):
                ids, ends, docs = (Numbers(folder, f"{shard:06d}.{kind}", t) for kind, t in (("bin", dtype), ("off", "<i8"), ("doc", "<i8")))
                for i in range(0, len(docs), READ):
                    e = ends[i : i + READ + 1].tolist()
                    own = [None if i + j < nulls else d for j, d in enumerate(docs[i : i + READ].tolist())]
                    yield {"doc_id": own, "start": [base + x for x in e[:-1]], "n_tokens": [y - x for x, y in zip(e, e[1:])], "ids_crc32": [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(e, e[1:])]}

    rows = [(m["shard"], m["base"], m["n_null"]) for m in manifest]
    shards = spark.createDataFrame(rows, "shard int, base bigint, n_null bigint").repartition(max(1, len(rows)), "shard")
    return arrow_map(shards, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, folder: str | None = None) -> tuple[str, list[dict], str]:
    """Encodes docs and writes the files; gives the folder, the manifest (shard, n_docs, n_null, n_tokens, base) and the ids' type."""
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    docs = pick(docs, doc_id="bigint", text="string")
    folder = folder or scratch(spark, "tokens")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    dtype = Encoder(path).dtype
    parts = partitions(spark, docs.count(), 100_000)
    bounds = doc_bounds(docs, parts)
    made = write_shards(encode_ids(docs, bounds, path, end_id), parts, folder, int(dtype[-1])).collect()  # a row for each shard
    base, manifest = 0, []
    for m in sorted(made, key=lambda m: m["shard"]):
        manifest.append(m.asDict() | {"base": base})
        base += m["n_tokens"]
    return folder, manifest, dtype


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """One row for each row of docs, read back from the files: doc_id, start, n_tokens (with the end id), ids_crc32.

    Null texts count as empty and hold the end id alone. Rows with a null doc_id come first, repeated doc_ids stand
    together ordered by their ids. Other columns are ignored; no rows give no shards and no rows.
    """
    folder, manifest, dtype = write_token_files(docs, tokenizer, end_id, folder)
    return read_shards(docs.sparkSession, manifest, folder, dtype)
