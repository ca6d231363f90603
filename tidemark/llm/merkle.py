"""Document fingerprints: Merkle trees over sections, paragraphs and pieces (operator 5).

A paragraph is a line; a section is a run of paragraphs that ends where a paragraph's hash says so; a piece is a run of
words inside a paragraph that ends where the bytes before a space say so. All cuts depend on content alone, so an
edit changes the nodes above it and no others. A node's hash is that of its children's. Equal roots mean equal texts;
otherwise the comparison goes down the branches that differ: at each level what stands in the same order on both sides
is matched, and only the gaps between matches are opened. What is left at the bottom is where the edits are.

The fingerprint is the root in 32 hex digits and codes of 48 bits (8 characters) of the nodes below it: sections are
parted by "/", paragraphs by ",", each as its own code and those of its pieces. Short paragraphs of texts with many, and
paragraphs of one piece, have their own code only.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import arrow_map, partitions, pick
from tidemark.llm.token_files import doc_bounds

_ODD = np.uint32(2654435761)
#: Pieces end at one space of 2**FINE in paragraphs of at most SHORT bytes, of 2**COARSE in longer ones; sections end at
#: one paragraph of 2**SECTION.
SHORT, FINE, COARSE, SECTION = 256, 1, 3, 2
#: Texts of so many paragraphs or more list no pieces of short ones.
MANY = 32
#: Characters of a code.
CODE = 8


def pieces(data: bytes) -> list[bytes]:
    """data cut behind content-defined spaces and behind every line feed; joined they give data again."""
    b = np.frombuffer(data, np.uint8)
    feeds = np.flatnonzero(b == 10)
    at = np.flatnonzero(b == 32)
    if len(at):
        edges = np.r_[-1, feeds, len(b)]
        short = np.diff(edges)[np.searchsorted(feeds, at)] <= SHORT
        led = np.concatenate([np.zeros(4, np.uint8), b]).astype(np.uint32)  # led[i] to led[i + 3] stand before b[i]
        before = led[at] << 24 | led[at + 1] << 16 | led[at + 2] << 8 | led[at + 3]
        at = at[(before * _ODD) >> np.where(short, np.uint32(32 - FINE), np.uint32(32 - COARSE)) == 0]
    cuts = np.union1d(at, feeds) + 1
    cuts = cuts[cuts < len(data)].tolist()
    return [data[i:j] for i, j in zip([0, *cuts], [*cuts, len(data)])] if data else []


def _codes(digests: bytes) -> str:
    """The codes of hashes of 16 bytes, one after another."""
    return base64.urlsafe_b64encode(np.frombuffer(digests, np.uint8).reshape(-1, 16)[:, :6].tobytes()).decode()


def fingerprint(text: str) -> str:
    h = xxhash.xxh3_128_digest
    parts = pieces(text.encode())
    leaves = b"".join(map(h, parts))
    ends = [i + 1 for i, p in enumerate(parts) if p[-1] == 10]
    if parts and (not ends or ends[-1] < len(parts)):
        ends.append(len(parts))
    starts = [0, *ends[:-1]]
    paragraphs = [h(b"P" + leaves[16 * i : 16 * j]) for i, j in zip(starts, ends)]
    last = [i + 1 for i, p in enumerate(paragraphs) if p[0] < 256 >> SECTION or i + 1 == len(paragraphs)]
    sections = [b"".join(paragraphs[i:j]) for i, j in zip([0, *last[:-1]], last)]
    root = h(b"R" + b"".join([h(b"S" + s) for s in sections]))
    own, below = _codes(b"".join(paragraphs)), _codes(leaves)
    listed = []
    for k, (i, j) in enumerate(zip(starts, ends)):
        bare = j - i == 1 or len(ends) >= MANY and sum(map(len, parts[i:j])) <= SHORT
        listed.append(own[CODE * k : CODE * k + CODE] + ("" if bare else below[CODE * i : CODE * j]))
    return root.hex() + ":" + "/".join([",".join(listed[i:j]) for i, j in zip([0, *last[:-1]], last)])


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Ascending places (i, j) with a[i] == b[j]: equal ends, and between them the longest ascending run of matches, where
    the first of equal items in a goes with the first in b, the second with the second, and so on."""
    most = min(len(a), len(b))
    head = next((i for i in range(most) if a[i] != b[i]), most)
    tail = next((i for i in range(most - head) if a[-1 - i] != b[-1 - i]), most - head)
    places: dict[str, list[int]] = {}
    for j in range(len(b) - tail - 1, head - 1, -1):
        places.setdefault(b[j], []).append(j)
    ends, chains = [], []
    for i in range(head, len(a) - tail):
        if places.get(a[i]):
            j = places[a[i]].pop()
            at = bisect_left(ends, j)
            ends[at : at + 1] = [j]
            chains[at : at + 1] = [(i, j, chains[at - 1] if at else None)]
    middle, chain = [], chains[-1] if chains else None
    while chain:
        middle.append(chain[:2])
        chain = chain[2]
    return [(i, i) for i in range(head)] + middle[::-1] + [(len(a) - i, len(b) - i) for i in range(tail, 0, -1)]


def _gaps(pairs: list[tuple[int, int]], n: int, m: int):
    """(from, to, from, to) of what stands on either side between matches."""
    i = j = 0
    for x, y in [*pairs, (n, m)]:
        if x > i or y > j:
            yield i, x, j, y
        i, j = x + 1, y + 1


def _leaves(paragraph: str) -> list[str]:
    return [paragraph[i : i + CODE] for i in range(CODE, len(paragraph), CODE)] or [paragraph]


def _size(paragraph: str) -> int:
    return max(1, len(paragraph) // CODE - 1)


def compared(a: str, b: str) -> tuple[float, list[tuple[int, int, int, int, int]]]:
    """How alike two fingerprints are, and the edits that lead from a to b.

    Likeness is twice the leaves that match in order over all leaves; 1 for equal roots and for no others. An edit is
    (section, paragraph, piece, gone, come): from that piece of a on, so many leaves have gone and so many have come.
    """
    if a[:32] == b[:32]:
        return 1.0, []
    left, right = ([s.split(",") for s in x[33:].split("/")] if x[33:] else [] for x in (a, b))
    total = sum(_size(p) for side in (left, right) for s in side for p in s)
    changed, edits = 0, []
    for i0, i1, j0, j1 in _gaps(aligned([",".join(s) for s in left], [",".join(s) for s in right]), len(left), len(right)):
        mine = [(i, k, p) for i in range(i0, i1) for k, p in enumerate(left[i])]
        theirs = [p for s in right[j0:j1] for p in s]
        for p0, p1, q0, q1 in _gaps(aligned([p for _, _, p in mine], theirs), len(mine), len(theirs)):
            own = [(i, k, n, x) for i, k, p in mine[p0:p1] for n, x in enumerate(_leaves(p))]
            new = [x for p in theirs[q0:q1] for x in _leaves(p)]
            behind = (*mine[p1][:2], 0) if p1 < len(mine) else (i1, 0, 0)
            for x0, x1, y0, y1 in _gaps(aligned([x for *_, x in own], new), len(own), len(new)):
                edits.append((*(own[x0][:3] if x0 < len(own) else behind), x1 - x0, y1 - y0))
                changed += x1 - x0 + y1 - y0
    return min(1 - changed / total, 1 - 1 / (total + 1)) if total else 0.0, edits


def likeness(a: str, b: str) -> float:
    return compared(a, b)[0]


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of each row of docs; null counts as empty."""

    def run(parts):
        for p in parts:
            yield {"doc_id": p["doc_id"], "n_chars": [len(t or "") for t in p["text"]], "fingerprint": [fingerprint(t or "") for t in p["text"]]}

    return arrow_map(pick(docs, doc_id="bigint", text="string"), run, "doc_id bigint, n_chars bigint, fingerprint string")


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, shard, lent: rows dealt to ranges of doc_id, a partition each; a range also gets, marked lent, the row that follows its last.

    Order is by descending doc_id. Bounds come from the doc_ids alone; only one text for each range travels twice.
    Driver and workers hold a number or two for each range.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id")
    parts = partitions(spark, ids.count(), 50_000)
    # range r holds bounds[r - 1] < doc_id <= bounds[r]; what follows the last row of range r is the largest of range r - 1
    bounds = np.array(doc_bounds(ids, parts), np.int64)

    def ranges(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy()
        return values, known, np.where(known, np.searchsorted(bounds, values), 0)

    def highest(batches):
        best: dict[int, int | None] = {}
        for b in batches:
            values, known, shard = ranges(b.column(0))
            for s in np.unique(shard).tolist():
                own = values[(shard == s) & known]
                best[s] = max([x for x in (best.get(s), int(own.max()) if len(own) else None) if x is not None], default=None)
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array(list(best.values()), pa.int64())], ["shard", "top"])

    tops = ids.mapInArrow(highest, "shard int, top bigint").groupBy("shard").agg(F.max("top").alias("top")).orderBy("shard").collect()  # a row for each range
    shards = np.array([r["shard"] for r in tops], np.int64)
    known_top, top = np.array([r["top"] is not None for r in tops], bool), np.array([r["top"] or 0 for r in tops], np.int64)

    def deal(batches):
        for b in batches:
            values, known, shard = ranges(b.column(0))
            at = np.searchsorted(shards, shard)
            lent = np.flatnonzero((known == known_top[at]) & (~known | (values == top[at])))
            for rows, to, mark in ((b, shard, False), (b.take(pa.array(lent)), shards[(at[lent] + 1) % max(1, len(shards))], True)):
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(to, pa.int32()), pa.array(np.full(rows.num_rows, mark))], ["doc_id", "text", "shard", "lent"])

    return docs.select("doc_id", "text").mapInArrow(deal, "doc_id bigint, text string, shard int, lent boolean").repartitionById(parts, F.col("shard"))


def edited(text: str, following: str) -> str:
    """text with its last third replaced by as much of the beginning of the following one (or all of it)."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edits.

    edits are the places where the edited text's tree differs: section, paragraph and piece of the text, the leaves that
    have gone from there and those that have come.

    The next document is that with the next smaller doc_id, after the smallest the largest; a null doc_id is below all.
    Rows that repeat a doc_id follow one another in the order of their texts. A single document is its own next. Null
    texts count as empty. Other columns are ignored; no rows give none.
    """
    rows = pick(docs, doc_id="bigint", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    near = neighbours(rows).sortWithinPartitions("shard", "lent", F.col("doc_id").desc_nulls_last(), F.col("text"))

    def run(batches):
        hold = None  # (shard, doc_id, text, fingerprint)

        def pair(now, text, fp):
            new = edited(now[2], text)
            efp = fingerprint(new)
            near, edits = compared(now[3], efp)
            places = [dict(zip(("section", "paragraph", "piece", "gone", "come"), e)) for e in edits]
            return now[1], len(now[2]), hashlib.sha256(new.encode()).hexdigest(), now[3], efp, near, likeness(now[3], fp), places

        for b in batches:
            out = []
            for doc, text, shard, lent in zip(*(b.column(i).to_pylist() for i in range(4))):
                fp = fingerprint(text)
                if hold is not None and hold[0] == shard:
                    out.append(pair(hold, text, fp))
                hold = None if lent else (shard, doc, text, fp)
                if len(out) >= 500:
                    yield batch(out)
                    out = []
            yield batch(out)

    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits")
    place = pa.struct([(x, pa.int32()) for x in ("section", "paragraph", "piece", "gone", "come")])
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(place)))))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return near.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edits array<struct<section:int,paragraph:int,piece:int,gone:int,come:int>>")
