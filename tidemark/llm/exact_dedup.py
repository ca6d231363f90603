"""Exact duplicates by an exchange of Golomb-coded fingerprints (operator 4).

1. Each task of the scan hashes its normalised texts to 64 bits, sorts the distinct hashes, splits them by owner (the high
   bits; there are as many owners as the rows ask for) and sends each owner a Golomb-Rice coded message with a bitmap of those that the task itself holds twice.
2. An owner decodes the messages and answers each with a bitmap of the hashes that occur more than once.
3. The scan runs again: rows whose hash is a suspect bring their normalised text along (once for each text and task)
   for comparison byte by byte under their SHA-256; all others are alone. A row whose hash its task never sent counts as a suspect, so
   a scan that is split otherwise the second time costs work but no truth.

Only suspects' texts leave their task. Groups fold before the shuffle, so a text that a third of the rows share comes
as one text for each task.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import arrow_map, cut, partitions, pick, scratch

BLANKS = b" \t\n\v\f\r"
#: Hashes that an owner judges, at most about; there are as many owners as that takes.
OWNED = 2_000_000
#: Bytes of texts that a task of step 3 remembers to compare with later copies.
SEEN_BYTES = 32_000_000


def golomb_encode(values: np.ndarray, k: int) -> bytes:
    """Ascending unsigned integers as Golomb-Rice coded gaps: all quotients in unary, then, from a new byte on, k low bits each."""
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 0
    low = (gaps[:, None] >> np.arange(k - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(low.astype(np.uint8).ravel()).tobytes()


def golomb_decode(data: bytes, n: int, k: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    stops = np.flatnonzero(bits == 0)[:n]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        first = -(-(int(stops[-1]) + 1) // 8) * 8
        low = bits[first : first + n * k].reshape(n, k).astype(np.uint64)
        gaps |= (low << np.arange(k - 1, -1, -1, dtype=np.uint64)).sum(1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values the ascending ones hold."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ascending, values)
    return ascending[np.minimum(at, len(ascending) - 1)] == values


def rice_parameter(n: int, span: int) -> int:
    """About log2 of the mean gap."""
    return max(0, (span // max(n, 1)).bit_length() - 1)


def normalise(text: str | None) -> bytes:
    return (text or "").encode().translate(None, BLANKS)


def messages(docs: DataFrame, owner_bits: int) -> DataFrame:
    """owner, sender, n, k, hashes (coded, without the owner's bits), twice: a bitmap of those held more than once."""
    low = 64 - owner_bits

    def run(parts):
        found = [np.array([xxhash.xxh3_64_intdigest(normalise(t)) for t in p["text"]], np.uint64) for p in parts]
        hashes, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        owners = (hashes >> np.uint64(low)).astype(np.int64) if owner_bits else np.zeros(len(hashes), np.int64)
        out = defaultdict(list)
        for owner in np.unique(owners).tolist():
            own = owners == owner
            rest = hashes[own] & np.uint64((1 << low) - 1) if owner_bits else hashes[own]
            k = rice_parameter(len(rest), 1 << low)
            for name, v in zip(("owner", "sender", "n", "k", "hashes", "twice"), (owner, TaskContext.get().partitionId(), len(rest), k, golomb_encode(rest, k), np.packbits(counts[own] > 1).tobytes())):
                out[name].append(v)
        yield {c: out[c] for c in ("owner", "sender", "n", "k", "hashes", "twice")}

    return arrow_map(docs.select("text"), run, "owner int, sender int, n int, k int, hashes binary, twice binary")


def answers(sent: DataFrame) -> DataFrame:
    """sender, owner, n, k, hashes, bitmap: the messages with a compressed bitmap of the hashes that more than one row has."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lists = [golomb_decode(r["hashes"], r["n"], r["k"]) for r in rows]
        every, counts = np.unique(np.concatenate(lists), return_counts=True)
        shared = every[counts > 1]
        maps = [np.packbits(among(x, shared) | np.unpackbits(np.frombuffer(r["twice"], np.uint8))[: r["n"]].astype(bool)) for x, r in zip(lists, rows)]
        return pa.table({c: table.column(c) for c in ("sender", "owner", "n", "k", "hashes")} | {"bitmap": pa.array([zlib.compress(m.tobytes()) for m in maps], pa.binary())}).cast(SCHEMA)

    return sent.groupBy("owner").applyInArrow(run, "sender int, owner int, n int, k int, hashes binary, bitmap binary")


SCHEMA = pa.schema([("sender", pa.int32()), ("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("hashes", pa.binary()), ("bitmap", pa.binary())])


def deliver(answered: DataFrame, folder: str, low: int) -> None:
    """Puts a sender's answers into its file in shared storage: the sorted suspect hashes that it holds, and all it sent."""

    def run(table: pa.Table) -> pa.Table:
        store, root = fs.FileSystem.from_uri(folder)
        sender, all_, bad = table.column("sender")[0].as_py(), [], []
        for r in sorted(table.to_pylist(), key=lambda r: r["owner"]):
            h = golomb_decode(r["hashes"], r["n"], r["k"]) | np.uint64(r["owner"] << low if low < 64 else 0)
            all_.append(h)
            bad.append(h[np.unpackbits(np.frombuffer(zlib.decompress(r["bitmap"]), np.uint8))[: r["n"]].astype(bool)])
        bad, all_ = np.concatenate(bad), np.concatenate(all_)
        with store.open_output_stream(tmp := f"{root}/.{sender}-{TaskContext.get().taskAttemptId()}") as out:
            out.write(json.dumps({"suspects": len(bad)}).encode().ljust(64) + bad.astype("<u8").tobytes() + all_.astype("<u8").tobytes())
        store.move(tmp, f"{root}/{sender}")
        return pa.table({"sender": pa.array([sender], pa.int32())})

    answered.groupBy("sender").applyInArrow(run, "sender int").write.format("noop").mode("overwrite").save()


def judged(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_chars, sha, suspect, body: suspects' normalised text, once for each text and task."""

    def run(parts):
        store, root = fs.FileSystem.from_uri(folder)
        bad = sent = None
        seen, room = {}, SEEN_BYTES
        for p in parts:
            if bad is None:
                name = f"{root}/{TaskContext.get().partitionId()}"
                if store.get_file_info(name).type == fs.FileType.File:
                    with store.open_input_file(name) as f:
                        n = json.loads(f.read(64))["suspects"]
                        both = np.frombuffer(f.read(), "<u8")
                    bad, sent = both[:n], both[n:]
                else:
                    bad, sent = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            texts = [normalise(t) for t in p["text"]]
            h = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64)
            suspect = (among(h, bad) | ~among(h, sent)).tolist()
            shas, bodies = [hashlib.sha256(t).hexdigest() for t in texts], []
            for t, s, sha in zip(texts, suspect, shas):
                if not s or seen.get(sha) == t:
                    bodies.append(None)
                    continue
                bodies.append(t)
                if sha not in seen and len(t) <= room:
                    seen[sha] = t
                    room -= len(t)
            yield {"doc_id": p["doc_id"], "n_chars": [len(t or "") for t in p["text"]], "sha": shas, "suspect": suspect, "body": bodies}

    return arrow_map(docs, run, "doc_id bigint, n_chars bigint, sha string, suspect boolean, body binary")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting white space; null counts as empty. Of a group stays the row with the
    most code points, then the smallest doc_id (a null doc_id comes last). Rows that repeat a doc_id count one by one
    and share its fate. Other columns are ignored; no rows give none. Different texts of one SHA-256 raise an error.
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id="bigint", text="string")
    owner_bits = (partitions(spark, docs.count(), OWNED) - 1).bit_length()
    folder = scratch(spark, "answers")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    deliver(answers(messages(docs, owner_bits)), folder, 64 - owner_bits)
    rows = cut(judged(docs, folder), "judged")
    suspects = rows.where("suspect")
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc")))
    groups = suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    bytes_ = suspects.where("body is not null").groupBy("sha").agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
    proven = bytes_.select("sha", F.when(F.col("lo") == F.col("hi"), True).otherwise(F.raise_error(F.lit("different texts have one SHA-256"))).alias("same"))
    # cut, so that the join below has a shuffle on both sides and Spark can split a group that most rows are in
    groups = cut(groups.join(proven, "sha").where("same").select("sha", "group_size", F.col("best.doc").alias("keep_id")), "groups")
    alone = rows.where("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    together = suspects.select("doc_id", "sha").join(groups, "sha").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.unionByName(together)
