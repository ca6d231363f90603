"""SimHash near-duplicates by pigeonhole blocks (operator 2), and near copies verified by their shingles on top of them.

Rows with equal fingerprints fold into one first. The 64 bits are split into blocks; fingerprints that differ in at
most max_bits bits agree on at least blocks - max_bits of them, so each fingerprint goes to a bucket for every choice
of so many blocks, and what is linked shares a bucket. A bucket gives no pairs: a search over its members, each
visited one taking its neighbours out of those not yet reached, leaves at most members - 1 links, and their closure is
the same. Buckets above BUCKET members are dealt to tasks by pairs of slices, so that none has to fit a task. The
links go to connected components by rounds of smallest neighbours, each round cut in shared storage. What a hot key
is joined with is cut too: with a shuffle of its own on either side, Spark splits the key's rows over tasks.

Of pairs alike to 0.8 in shingles of five words only few have fingerprints within 4 bits, so near copies also become
candidates by bands of their MinHash sketches; the shingles themselves decide.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import arrow_map, carried, cut, partitions, pick, remove, restored

#: ASCII capitals only; other letters stay as they are.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Members of a bucket that a task searches at a time.
BUCKET = 4096
#: Rows of buckets that a task searches, about.
SEARCHED = 1_000_000
#: Shingles whose bits are counted at a time.
STEP = 65_536
#: Values of a sketch, one byte each, and the least part of them that two texts must share to be compared by their shingles.
SKETCH, AGREE = 64, 0.6
#: Values of a sketch that a band takes together; texts that agree on a band are candidates. Of pairs alike to 0.8, with
#: 16 bands of 4, one in 4,600 agrees on none.
BAND = 4
#: The least Jaccard similarity of near copies, and the texts and bytes of shingles that are compared with one another at a time.
ALIKE, GROUP, GROUP_BYTES = 0.8, 2048, 16_000_000


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 with seed 42 of each shingle of size words, repeats included; of all words where there are fewer."""
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(size, len(words))
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[i:j], 42) for i, j in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)


def fingerprint(text: str, size: int = 4) -> int:
    """Bit i is 1 where more than half the shingles' hashes have it; 0 without words."""
    return majority(shingle_hashes(text, size))


def majority(h: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), STEP):
        counts += np.unpackbits(h[i : i + STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id and fp, the 64 bits as a signed long, of each row."""

    def run(parts):
        for p in parts:
            fps = np.array([fingerprint(t or "", size) for t in p["text"]], np.uint64)
            yield {"doc_id": p["doc_id"], "fp": fps.view(np.int64).tolist()}

    return arrow_map(pick(docs, doc_id="bigint", text="string"), run, "doc_id bigint, fp bigint")


def _masks(blocks: int, same: int) -> list[int]:
    """A mask of bits for each choice of so many blocks; blocks are as even as 64 bits allow."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(own, same)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(fps: np.ndarray, max_bits: int, marks: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links (places in fps) with the closure of all links within max_bits; with marks, a sketch a row, only where these agree."""
    left = np.arange(1, len(fps))
    a, b, todo = [], [], [0] if len(fps) else []
    while todo or len(left):
        if not todo:
            todo, left = [int(left[0])], left[1:]
        i = todo.pop()
        near = np.bitwise_count(fps[left] ^ fps[i]) <= max_bits
        if marks is not None and near.any():
            near[near] = (marks[left[near]] == marks[i]).mean(1) >= AGREE
        got = left[near].tolist()
        if got:
            a += [i] * len(got)
            b += got
            todo += got
            left = left[~near]
    return a, b


#: Fingerprints that tell which buckets are large: one of so many. It decides how buckets are dealt, never what is found.
TOLD = 64


def bucketed(nodes: DataFrame, max_bits: int, blocks: int, beside: list[str]) -> DataFrame:
    """choice, key, pair, fp and the columns beside: each row of nodes(fp, ..) in the bucket of every choice of blocks.

    Large buckets come in slices of about BUCKET rows, a pair for every two of them.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in _masks(blocks, blocks - max_bits)])

    def keyed(rows: DataFrame) -> DataFrame:
        each = rows.select("fp", *beside, F.posexplode(masks).alias("choice", "mask"))
        return each.select(F.col("choice").cast("short"), F.expr("fp & mask").alias("key"), "fp", *beside)

    some = keyed(nodes.where(f"pmod(xxhash64(fp), {TOLD}) = 0")).groupBy("choice", "key").agg((F.count(F.lit(1)) * TOLD).alias("n"))
    large = cut(some.where(F.col("n") > BUCKET).select("choice", "key", F.ceil(F.col("n") / BUCKET).cast("int").alias("slices")), "large")
    dealt = keyed(nodes).join(large, ["choice", "key"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    return (
        dealt.withColumn("slice", F.expr(f"cast(pmod(xxhash64({', '.join(['fp', *beside])}), slices) as int)"))
        .withColumn("pair", F.explode(F.expr("transform(sequence(0, slices - 1), s -> least(s, slice) * slices + greatest(s, slice))")))
        .select("choice", "key", "pair", "fp", *beside)
    )


def search_buckets(dealt: DataFrame, max_bits: int, parts: int, name: str = "fp") -> DataFrame:
    """a, b: links between the names of rows of one bucket, spanning all within max_bits (whose sketches agree, if there are any).

    Buckets lie one after another in sorted partitions and are searched as they stream by: those of two rows, nearly all
    of them, in one step for a whole batch. What is held over to the next batch is one slice of a bucket at most.
    """
    sketched = "sketch" in dealt.columns
    where = ["choice", "key", "pair"]

    def alike(marks, i, j):
        return (marks[i] == marks[j]).mean(-1) >= AGREE

    def run(batches):
        rest = None
        for last, batch in _with_end(batches):
            table = None if batch is None else pa.Table.from_batches([batch])
            table = table if rest is None else rest if table is None else pa.concat_tables([rest, table])
            if table is None or not table.num_rows:
                continue
            keys = [table.column(c).to_numpy() for c in where]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            starts = np.r_[0, new]
            if not last:  # the last bucket may go on
                rest, stop = table.slice(starts[-1]), starts[-1]
                starts = starts[:-1]
            else:
                rest, stop = None, table.num_rows
            if not len(starts):
                continue
            fps, names = table.column("fp").to_numpy().view(np.uint64), table.column(name).to_numpy()
            marks = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH) if sketched else None
            sizes = np.diff(np.r_[starts, stop])
            twos = starts[sizes == 2]
            near = np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= max_bits
            twos = twos[near]
            if sketched:
                twos = twos[alike(marks, twos, twos + 1)]
            a, b = [twos], [twos + 1]
            for at, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                i, j = spanning_links(fps[at : at + n], max_bits, marks[at : at + n] if sketched else None)
                if i:
                    a.append(np.array(i) + at)
                    b.append(np.array(j) + at)
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(names[a], pa.int64()), pa.array(names[b], pa.int64())], ["a", "b"])

    return dealt.repartition(parts, *where).sortWithinPartitions(*where).mapInArrow(run, "a bigint, b bigint").distinct()


def _with_end(batches):
    """(False, batch) of each, then (True, None)."""
    for b in batches:
        yield False, b
    yield True, None


def links(distinct: DataFrame, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """a, b: links between different fingerprints (fp of distinct) whose closure is that of all links within max_bits."""
    parts = partitions(distinct.sparkSession, distinct.count() * comb(blocks, max_bits), SEARCHED)
    return search_buckets(bucketed(distinct.select("fp"), max_bits, blocks, []), max_bits, parts)


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of edges (a, b) reaches, where it is another; by large-star and small-star rounds."""
    spark = edges.sparkSession
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        # a node may have a third of all others as neighbours: its edges are split over tasks, as what they meet is cut
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        # large star: neighbours above a go to the least neighbour; the least neighbours themselves come by small star
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        down = cut(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "down")
        least = cut(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        after = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        state = after.agg(F.count(F.lit(1)), F.sum(F.expr("cast(xxhash64(a, b) as decimal(38,0))"))).first()
        for done in (now, low, down, least):
            remove(spark, done)
        now = after
        if state == before:
            return now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = state


def simhash_near_dedup(docs: DataFrame, size: int = 4, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id reachable by links.

    Null and wordless texts have fingerprint zero and link like any other. Rows that repeat stay; a null doc_id is
    in its component but never names it, unless all there are null. Other columns are ignored; no rows give none.
    """
    fps = cut(fingerprints(docs, size), "fingerprints")
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    nodes = cut(components(links(distinct.select("fp"), max_bits, blocks)), "roots")
    rooted = distinct.join(nodes, distinct.fp == nodes.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # cut, so that roots and fingerprints that most rows share are split over tasks in the joins
    smallest = cut(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = cut(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_MULTIPLIERS = (np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def sketched(h: np.ndarray) -> tuple[bytes, list[int]]:
    """MinHash of distinct shingle hashes: a byte of each value, the part of equal ones tells about the Jaccard
    similarity of two texts, and a key of each band of BAND whole values."""
    if not len(h):
        return bytes(SKETCH), []
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), STEP // 16):
        mixed = h[i : i + STEP // 16, None] * _MULTIPLIERS[None, :]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(0))
    data, width = least.astype("<u8").tobytes(), 8 * BAND
    keys = np.array([xxhash.xxh64_intdigest(data[i : i + width], i) for i in range(0, len(data), width)], np.uint64)
    return ((least * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(56)).astype(np.uint8).tobytes(), keys.view(np.int64).tolist()


def verified_links(nodes: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """a, b of nodes(node, fp, sketch): links within max_bits whose sketches agree too; the same closure as all of these."""
    parts = partitions(nodes.sparkSession, nodes.count() * comb(blocks, max_bits), SEARCHED)
    return search_buckets(bucketed(nodes, max_bits, blocks, ["node", "sketch"]), max_bits, parts, "node")


def banded_links(nodes: DataFrame) -> DataFrame:
    """a, b of nodes(node, sketch, keys): links between nodes with a key in common whose sketches agree; the same closure as all of these.

    Keys of one node only go first; only the others carry sketches. Keys of very many nodes are dealt by pairs of slices.
    """
    each = nodes.select("node", F.explode("keys").alias("key"))
    shared = cut(each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / BUCKET).cast("int").alias("slices")), "shared")
    met = cut(each.join(shared, "key"), "met")
    dealt = met.join(nodes.select("node", "sketch"), "node").withColumn("slice", F.expr("cast(pmod(xxhash64(node), slices) as int)"))
    paired = dealt.withColumn("pair", F.explode(F.expr("transform(sequence(0, slices - 1), s -> least(s, slice) * slices + greatest(s, slice))")))
    rows = paired.select(F.lit(0).cast("short").alias("choice"), "key", "pair", F.lit(0).cast("long").alias("fp"), "node", "sketch")
    return search_buckets(rows, 64, partitions(nodes.sparkSession, met.count(), SEARCHED), "node")


def exact_links(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """Links (places in sets, each of distinct hashes) with the closure of all pairs whose Jaccard similarity is at least ALIKE."""
    sizes = np.array([len(x) for x in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.r_[0, np.cumsum(sizes)]
    owner = np.repeat(np.arange(len(sets)), sizes)
    at, of = ids, owner
    left = np.ones(len(sets), bool)
    a, b, todo = [], [], []
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first], todo = False, [first]
        while todo and left.any():
            i = todo.pop()
            mark = np.zeros(len(ids) and int(ids.max()) + 1, bool)
            mark[ids[starts[i] : starts[i + 1]]] = True
            shared = np.bincount(of[mark[at]], minlength=len(sets))
            union = sizes + sizes[i] - shared
            # in whole numbers, so that 0.8 itself counts
            got = np.flatnonzero(left & (shared * 1000 >= round(ALIKE * 1000) * union)).tolist()
            a += [i] * len(got)
            b += got
            todo += got
            left[got] = False
            if 2 * left[of].sum() < len(of):
                stays = left[of]
                at, of = at[stays], of[stays]
    return a, b


def alike_links(sets: DataFrame) -> DataFrame:
    """a, b of sets(root, node, shingles): links between nodes of a root alike to ALIKE or more; the same closure as all of these.

    Roots with many nodes, or long ones, are dealt to tasks by pairs of slices.
    """
    sizes = sets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    slices = F.expr(f"cast(greatest(ceil(n / {GROUP}), ceil(bytes / {GROUP_BYTES})) as int)")
    large = cut(sizes.select("root", slices.alias("slices")).where("slices > 1"), "large")
    dealt = sets.join(large, "root", "left").withColumn("slices", F.coalesce("slices", F.lit(1))).withColumn("slice", F.expr("cast(pmod(xxhash64(node), slices) as int)"))
    dealt = dealt.withColumn("pair", F.explode(F.expr("transform(sequence(0, slices - 1), s -> least(s, slice) * slices + greatest(s, slice))"))).select("root", "pair", "node", "shingles")

    def found(group):
        i, j = exact_links([np.frombuffer(x, np.uint64) for _, x in group]) if len(group) > 1 else ([], [])
        return [(group[x][0], group[y][0]) for x, y in zip(i, j)]

    def run(batches):
        now, group = None, []
        for batch in batches:
            out = []
            for root, pair, node, shingles in zip(*[c.to_pylist() for c in batch.columns]):
                if (root, pair) != now:
                    out += found(group)
                    now, group = (root, pair), []
                group.append((node, shingles))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found(group)], pa.int64()) for k in (0, 1)], ["a", "b"])

    parts = partitions(sets.sparkSession, sets.count(), GROUP * 4)
    return dealt.repartition(parts, "root", "pair").sortWithinPartitions("root", "pair").mapInArrow(run, "a bigint, b bigint").distinct()


def near_copies(docs: DataFrame, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """doc_id, keep_id of the rows of docs: the smallest doc_id of the texts that verified links reach.

    Candidates are texts whose fingerprints over five words are within max_bits, or whose sketches agree on a band, and
    whose sketches agree loosely in all; these make families, and in a family the shingles of five words themselves tell
    which texts are alike to ALIKE. Texts of the same shingles are one node from the start. Only candidates that
    share a bucket with another carry a sketch, only families carry shingles. Null and wordless texts are alike.
    """
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")]

    def run(parts):
        for p in parts:
            every = [shingle_hashes(t or "", 5) for t in p["text"]]
            fps = np.array([majority(h) for h in every], np.uint64)
            sets = [np.unique(h) for h in every]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in sets], np.uint64)
            sketches, keys = zip(*map(sketched, sets)) if sets else ((), ())
            yield {"doc_id": p["doc_id"], "doc": p["doc"], "th": p["th"], "node": nodes.view(np.int64).tolist(), "fp": fps.view(np.int64).tolist(), "sketch": list(sketches), "keys": list(keys)}

    def shingled(parts):
        for p in parts:
            yield {"root": p["root"], "node": p["node"], "shingles": [np.unique(shingle_hashes(t or "", 5)).tobytes() for t in p["text"]]}

    texts = pick(docs, doc_id="bigint", text="string").select("doc_id", "text", *key)
    rows = cut(arrow_map(texts, run, "doc_id bigint, doc string, th bigint, node bigint, fp bigint, sketch binary, keys array<bigint>"), "sketches")
    nodes = cut(rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc", "th")).alias("of")), "nodes")
    prints = rows.select("node", "fp", "sketch").distinct()
    near = cut(links(prints.select("fp").distinct(), max_bits, blocks), "near")
    among = near.select(F.col("a").alias("fp")).union(near.select("b")).distinct()
    twins = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    some = cut(prints.join(among.union(twins).distinct(), "fp", "left_semi").select("node", "fp", "sketch"), "some")
    sets = rows.select("node", "sketch", "keys").dropDuplicates(["node"])
    family = cut(components(verified_links(some, max_bits, blocks).union(banded_links(sets))), "family")
    member = family.union(family.select("root", "root")).distinct()
    wanted = nodes.join(member, "node").select("root", "node", "of.doc", "of.th")
    full = cut(arrow_map(texts.join(wanted, ["doc", "th"]).dropDuplicates(["node"]).select("root", "node", "text"), shingled, "root bigint, node bigint, shingles binary"), "shingles")
    reached = cut(components(alike_links(full)), "reached")
    rooted = nodes.join(reached, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    keep = cut(rooted.groupBy("root").agg(F.min("first").alias("keep_id")), "keep")
    named = cut(rooted.join(keep, "root").select("node", "keep_id"), "named")
    return rows.select("doc_id", "node").join(named, "node").select("doc_id", "keep_id")


def drop_near_copies(docs: DataFrame, max_bits: int = 4, blocks: int = 7) -> DataFrame:
    """docs with one row of each group of near copies, that with the smallest doc_id (of rows repeated with that doc_id: one).

    All columns of docs stay. Rows without a doc_id stay, as nothing can name them.
    """
    dense = carried(docs, doc_id="bigint")
    gone = near_copies(docs, max_bits, blocks).where("doc_id <> keep_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = dense.join(gone, dense.doc_id == gone.gone, "left_anti").select("row", "doc_id")
    once = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
    return restored(once, docs.columns)
