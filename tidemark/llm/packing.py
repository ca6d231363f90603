"""Packing into length buckets of least padding (operator 6).

Texts become items of at most max_len tokens (longer ones are cut into several, none is dropped). A histogram of all
items' lengths, each by itself, goes to the driver; its size is bounded by max_len whatever the corpus. Dynamic programming over it finds the bucket boundaries with the least padding. Inside a bucket items stand in
an order by hash, and every run of budget / boundary of them is a batch: its padded size keeps to the token budget.

A bucket may hold most of the corpus, so its items are numbered in chunks: each numbers its own, and the prefix sums
of the chunks' counts are added.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm._common import arrow_map, cut, pick
from tidemark.llm.bpe import Encoder, default_tokenizer, opened

MAX_LEN, BUDGET, BUCKETS = 2048, 65_536, 16
#: Items that a chunk of a bucket has about.
CHUNK = 10_000


def encoded(docs: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, int]:
    """doc_id, n_tokens, ids (little-endian unsigned integers) of each row, and the bytes of an id; null counts as empty."""
    path = tokenizer or default_tokenizer()
    width = int(Encoder(path).dtype[-1])

    def run(parts):
        enc = opened(Encoder, path)
        for p in parts:
            ids = enc.encode_bytes([(t or "").encode() for t in p["text"]])
            yield {"doc_id": p["doc_id"], "n_tokens": [len(b) // width for b in ids], "ids": ids}

    return arrow_map(pick(docs, doc_id="bigint", text="string"), run, "doc_id bigint, n_tokens bigint, ids binary"), width


def best_boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Ascending boundaries (tokens) of at most so many buckets with the least padding; counts[i] items have i tokens."""
    counts = np.r_[0, counts[0] + counts[1] if len(counts) > 1 else counts[0], counts[2:]]  # no boundary below 1
    tops = np.flatnonzero(counts)
    if not len(tops):
        return []
    n, s = np.r_[0, np.cumsum(counts[tops])], np.r_[0, np.cumsum(counts[tops] * tops)]
    # a bucket of the lengths i..j - 1 pads to that of j - 1
    pad = np.where(np.tri(len(tops), dtype=bool).T, tops[None, :] * (n[None, 1:] - n[:-1, None]) - (s[None, 1:] - s[:-1, None]), np.inf)
    # cost[j]: the least padding of the first j lengths in so many buckets, each of which holds something
    cost, choices, finals = np.r_[0.0, np.full(len(tops), np.inf)], [], []
    for _ in range(min(buckets, len(tops))):
        total = cost[:-1, None] + pad
        choices.append(total.argmin(0))
        cost = np.r_[np.inf, total.min(0)]
        finals.append(cost[-1])
    out, j = [], len(tops)
    for choice in choices[int(np.argmin(finals)) :: -1]:
        out.append(int(tops[j - 1]))
        j = int(choice[j - 1])
    return out[::-1]


def pack_lengths(lengths: DataFrame, max_len: int = MAX_LEN, budget: int = BUDGET, buckets: int = BUCKETS, width: int = 2) -> DataFrame:
    """doc_id, n_tokens, ids -> doc_id, part, first, n_tokens, bucket, padding, batch_id, slot, ids: a row for each item.

    part and first (a token's place) tell a text's items apart; batch_id is unique over all buckets; slot is the place
    in the batch, padding what the item lacks of its bucket's length; ids are the item's own. Items without tokens are
    packed like others, into the first bucket. Items that repeat stand side by side, ordered by their ids.
    """
    parts = F.expr(f"sequence(0, cast(greatest(0, ceil(n_tokens / {float(max_len)}D) - 1) as int))")
    each = lengths.select("doc_id", "ids", F.col("n_tokens").alias("all"), F.explode(parts).alias("part"))
    own = each.select("doc_id", "part", (F.col("part") * F.lit(max_len)).cast("bigint").alias("first"), F.expr(f"least({max_len}L, all - part * {max_len}L)").alias("n_tokens"), "ids")
    items = own.withColumn("ids", F.expr(f"substring(ids, cast(first * {width} + 1 as int), cast(n_tokens * {width} as int))"))
    chunk_of = F.expr("xxhash64(doc_id, part)")
    histogram = own.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most max_len + 1 rows
    counts = np.zeros(max_len + 1, np.int64)
    for r in histogram:
        counts[r["n_tokens"]] = r["n"]
    tops = best_boundaries(counts, buckets) or [max_len]
    bucket = F.expr("CASE " + " ".join(f"WHEN n_tokens <= {t} THEN {i}" for i, t in enumerate(tops)) + " END")
    chunks = max(1, -(-int(counts.sum()) // CHUNK))
    of_chunk = F.pmod(chunk_of, F.lit(chunks)).alias("chunk")
    placed = items.select("*", bucket.alias("bucket"), of_chunk)
    before = Window.partitionBy("bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.select(bucket.alias("bucket"), of_chunk).groupBy("bucket", "chunk").agg(F.count(F.lit(1)).alias("n")).select("bucket", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("bucket", "chunk").orderBy(chunk_of, "doc_id", "part", "ids")
    numbered = placed.withColumn("nth", F.row_number().over(within)).join(starts, ["bucket", "chunk"]).withColumn("nth", F.col("start") + F.col("nth") - 1)
    sizes = [max(1, budget // t) for t in tops]
    held = np.diff([0, *np.cumsum(counts)[tops]])
    bases = np.r_[0, np.cumsum(-(-held // np.array(sizes)))]

    def by_bucket(values):
        return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("bucket") + 1)

    size = by_bucket(sizes)
    return numbered.select(
        "doc_id", "part", "first", "n_tokens", by_bucket(tops).cast("bigint").alias("bucket"), (by_bucket(tops) - F.col("n_tokens")).cast("bigint").alias("padding"),
        (by_bucket(bases[:-1]) + F.floor(F.col("nth") / size)).cast("bigint").alias("batch_id"), (F.col("nth") % size).cast("int").alias("slot"), "ids",
    )


def pack(docs: DataFrame, max_len: int = MAX_LEN, budget: int = BUDGET, buckets: int = BUCKETS, tokenizer: str | None = None) -> DataFrame:
    """One row for each item of each row of docs: doc_id, part, first, n_tokens, bucket (its padded length), padding, batch_id, slot, ids.

    Null and empty texts are one item without tokens; texts over max_len are several; rows that repeat are items that
    repeat; a null doc_id is like any other. Other columns are ignored; no rows give none.
    """
    made, width = encoded(docs, tokenizer)
    return pack_lengths(cut(made, "ids"), max_len, budget, buckets, width)
