"""The corpus operators on a small table with every awkward row, each held against a plain version."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tidemark.llm import bpe, exact_dedup, langid, licenses, line_dedup, merkle, packing, pii, simhash, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, `TEXT2` string, fingerprint int"
WORDS = {"en": "the of and thing with over light house seven river".split(), "de": "der und nicht straße über haus licht fluß sieben wege".split(), "fr": "le été où forêt maison lumière sept rivière avec sur".split()}


def rows():
    rnd = random.Random(7)
    out = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        text = "\n".join(" ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(1, 14))) + "." for _ in range(rnd.randint(1, 6)))
        if i < 24:
            text += "\n  Shared LINE here\t"
        out.append([i, text, lang])
    out += [[100, None, "en"], [101, "", None], [102, " \t\n ", "de"], [103, "12 34 !!", "en"], [104, out[3][1], "en"], [105, out[3][1].replace(" ", "  "), "de"], [106, " ".join(["long", "Wörter", "été", "don't"] * 9000), "en"], [107, "<|endoftext|> x <|startoftext|> é́", "fr"]]
    out += [[5, out[5][1], "en"], [5, "another text under a known id", "en"], [None, "no id here", "en"], [None, None, None], [108, out[3][1] + " more", "fr"], [109, "日本語 текст ελληνικά 한국어", None]]
    return [tuple(r) + ("s", len(r[1] or ""), "clash", "x", 1) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return (r[0] is not None, r[0] or 0, repr(r))


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def test_bpe(docs, empty, tok):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    same(bpe.bpe_encode_decode(docs).drop("n_chunks").collect(), want)
    same(bpe.bpe_encode_decode(docs, cut_bits=3).drop("n_chunks").collect(), want)
    assert bpe.bpe_encode_decode(empty).count() == 0
    first = bpe.bpe_encode_decode(docs.where("doc_id = 1"), texts=True).first()
    assert first.ids == tok.encode(rows()[1][1], add_special_tokens=False).ids


def test_shared_chunks_are_encoded_once(spark, tmp_path, monkeypatch):
    """Every chunk that two tasks have is encoded by one of them, whatever the number of tasks that have it."""
    rnd = random.Random(6)
    passage = lambda n: " ".join(rnd.choice(WORDS["en"]) + str(rnd.randrange(99)) for _ in range(n))
    common = [passage(900) for _ in range(3)]
    data = [(i, f"{passage(300)} {common[i % 3]} {passage(300)}") for i in range(24)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6).cache()
    docs.count()
    path = bpe.default_tokenizer()
    folder = bpe.shared_chunks(docs, path, 8)
    given = spark.read.parquet(folder)
    enc = bpe.ChunkEncoder(path, cut_bits=8)
    tasks = {}
    for r in docs.selectExpr("spark_partition_id() AS task", "text").collect():
        for c in enc.cut(r.text.encode()):
            tasks.setdefault(bpe.chunk_key(c), set()).add(r.task)
    shared = {(t, k) for k, ts in tasks.items() if len(ts) > 1 for t in ts}
    assert len(shared) > 50 and {(r.task, bytes(r.key)) for r in given.collect()} == shared
    by_key = {}
    for r in given.collect():
        by_key.setdefault(bytes(r.key), set()).add(bytes(r.ids))
    assert all(len(v) == 1 for v in by_key.values())
    docs.unpersist()


def test_joints_widen_chunk_by_chunk(tok, monkeypatch):
    """Where joints are said to disagree, windows of chunks take their place, at the latest the whole text; the ids stay the library's."""
    rnd = random.Random(4)
    text = " ".join(rnd.choice(WORDS["fr"] + ["don't", "x.y", "3.5"]) for _ in range(600))
    want = tok.encode(text, add_special_tokens=False).ids
    enc = bpe.ChunkEncoder(bpe.default_tokenizer(), cut_bits=5)
    asked = []
    real = enc.ids
    for stubborn in (0, 3, 10_000):
        calls = [0]

        def ids(texts, calls=calls, stubborn=stubborn):
            got = real(texts)
            calls[0] += 1
            if calls[0] == 1:  # the joints' windows: three of them come out wrong
                return [g + [1] if i in (4, 5, 20) else g for i, g in enumerate(got)]
            if len(texts) == 4 and calls[0] <= 1 + stubborn:
                return [*got[:3], got[3] + [1]]
            asked.append(len(texts))
            return got

        monkeypatch.setattr(enc, "ids", ids)
        enc.learn(text.encode().split())
        calls[0] = 0
        (done,) = enc.encode([text.encode()])
        assert [int(i) for i in done[1].split()] == want and done[0] == len(want) and done[2] == tok.decode(want, skip_special_tokens=False)
        assert (1 in asked) == (stubborn == 10_000)
        asked.clear()


def test_chunks_meet_again():
    text = " ".join(random.Random(1).choice(WORDS["en"]) for _ in range(4000)).encode()
    assert b"".join(bpe.chunks(text, 6)) == text
    moved = bpe.chunks(b"something else first, " + text, 6)
    assert len(set(moved) & set(bpe.chunks(text, 6))) >= len(set(moved)) - 3


def test_other_tokenizers_go_whole():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello  world, don't\n stop", "été", ""]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    enc = bpe.ChunkEncoder(path)
    assert [[int(i) for i in e[1].split()] for e in enc.encode([t.encode() for t in texts])] == want


def test_token_files(docs, empty, tok):
    got = token_files.token_files(docs).collect()
    tokens = {}
    for r in rows():
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        tokens.setdefault(r[0], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((r[0] for r in rows()), key=lambda d: (d is not None, d or 0))
    start = 0
    for r in order:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in tokens[r.doc_id]
        start += r.n_tokens
    assert token_files.token_files(empty).count() == 0


def test_token_files_with_the_least_doc_id(spark):
    data = [(None, "no id"), (-(1 << 63), "the least id"), (None, ""), (3, "three")]
    got = sorted(token_files.token_files(spark.createDataFrame(data, "doc_id long, text string")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), 3]


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def test_simhash(docs, empty):
    data = rows()
    fps = [plain_fingerprint(r[1]) for r in data]
    root = list(range(len(fps)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    same(simhash.simhash_near_dedup(docs).collect(), [(r[0], f"{fps[i]:016x}", least.get(find(i))) for i, r in enumerate(data)])
    assert simhash.simhash_near_dedup(empty).count() == 0
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 104").isEmpty() and kept.where("doc_id IS NULL").count() == 2


def test_near_copies(spark):
    """Texts alike to 0.8 in shingles of five words fall together, others stay, for every pair of a plain comparison."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    texts = []
    for _ in range(40):
        base = [rnd.choice(words) for _ in range(rnd.randint(150, 400))]
        texts.append(base)
        for edits in (1, 2, 3, 5, 30):
            t = base[:]
            for _ in range(edits):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            texts.append(t)
    texts += [["short", "one"], ["short", "two"], []]
    sets = [{tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    got = {r.doc_id: r.keep_id for r in simhash.near_copies(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert got == {i: root.index(x) for i, x in enumerate(root)}


def test_near_copies_at_the_threshold(spark, monkeypatch):
    """Pairs alike to 0.8 itself fall together, whatever their fingerprints; pairs just below (0.796) stay apart."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    data, want = [], {}
    for shingles, alike in ((180, True), (176, False)):  # four edits far apart change 20 shingles: 160 of 200, 156 of 196
        for _ in range(100):
            base = [word() for _ in range(shingles + 4)]
            other = base[:]
            for at in (20, 60, 100, 140):
                other[at] = word()
            want[len(data)] = alike
            data += [(len(data), " ".join(base)), (len(data) + 1, " ".join(other))]
    for small in (False, True):
        if small:
            monkeypatch.setattr(simhash, "GROUP", 1)
            monkeypatch.setattr(simhash, "BUCKET", 1)
        got = {r.doc_id: r.keep_id for r in simhash.near_copies(spark.createDataFrame(data, "doc_id long, text string")).collect()}
        assert {i: got[i] == got[i + 1] for i in want} == want


def test_exact_links_have_the_closure_of_all_pairs():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        pool = rnd.integers(1 << 62, size=60, dtype=np.uint64)
        sets = [np.unique(rnd.choice(pool, rnd.integers(40, 60), replace=False)) for _ in range(25)] + [np.zeros(0, np.uint64)]

        def roots(pairs):
            root = list(range(len(sets)))
            for i, j in pairs:
                root = [root[i] if x == root[j] else x for x in root]
            return [root.index(x) for x in root]

        plain = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])) > 0]
        assert roots(zip(*simhash.exact_links(sets))) == roots(plain)


def test_simhash_chains_and_large_buckets(spark, monkeypatch):
    rnd = np.random.default_rng(3)
    base = int(rnd.integers(1 << 62))
    chain = [base]
    for i in range(300):  # each within 4 bits of the one before, the ends far apart
        x = chain[-1]
        for b in rnd.choice(64, 4, replace=False):
            x ^= 1 << int(b)
        chain.append(x)
    far = [int(x) for x in rnd.integers(1 << 62, size=500)]
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in chain + far})
    monkeypatch.setattr(simhash, "BUCKET", 40)
    monkeypatch.setattr(simhash, "TOLD", 2)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    u = np.array(fps, np.int64).view(np.uint64)
    root = {x: x for x in fps}
    find = lambda x: x if root[x] == x else find(root[x])
    for i, j in zip(*np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4)):
        x, y = find(fps[i]), find(fps[j])
        root[max(x, y)] = min(x, y)
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {i: 1000 for i in (1001, 1002)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup(docs, empty):
    groups = {}
    for r in rows():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    want = []
    for body, rs in groups.items():
        keep = min(rs, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        want += [(r[0], keep, len(rs), r[0] == keep, hashlib.sha256(body.encode()).hexdigest()) for r in rs]
    same(exact_dedup.exact_dedup(docs).collect(), want)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_golomb():
    rnd = np.random.default_rng(0)
    for n, span in ((0, 64), (1, 64), (1000, 64), (1000, 20), (5, 3)):
        values = np.unique(rnd.integers(0, 1 << span, n, dtype=np.uint64, endpoint=False)) if span < 64 else np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * 2)
        k = exact_dedup.rice_parameter(len(values), 1 << span)
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, k), len(values), k) == values).all()


def plain_tree(text):
    """The fingerprint by a walk over the text's words, without arrays."""
    data, h, code = text.encode(), xxhash.xxh3_128_digest, lambda d: base64.urlsafe_b64encode(d[:6]).decode()
    paragraphs = []
    for line in re.findall(rb"[^\n]*\n|[^\n]+", data):
        n, at, leaves = len(line), data.index(line) if len(paragraphs) == 0 else paragraphs[-1][2], []
        end = at + n
        bits, start = (1 if n <= 256 else 3), at
        for i in range(at, end):
            led = int.from_bytes((b"\0\0\0\0" + data)[i : i + 4], "big")
            if i + 1 == end or data[i] == 32 and (led * 2654435761 & 0xFFFFFFFF) >> (32 - bits) == 0:
                leaves.append(h(data[start : i + 1]))
                start = i + 1
        paragraphs.append((h(b"P" + b"".join(leaves)), leaves, end, n))
    sections, now = [], []
    for p in paragraphs:
        now.append(p)
        if p[0][0] < 64:
            sections.append(now)
            now = []
    sections += [now] if now else []
    root = h(b"R" + b"".join(h(b"S" + b"".join(p[0] for p in s)) for s in sections))
    shown = lambda p: code(p[0]) + ("" if len(p[1]) == 1 or len(paragraphs) >= 32 and p[3] <= 256 else "".join(map(code, p[1])))
    return root.hex() + ":" + "/".join(",".join(map(shown, s)) for s in sections)


def plain_leaves(fp):
    return [p[i : i + 8] for s in fp[33:].split("/") for p in s.split(",") for i in (range(8, len(p), 8) if len(p) > 8 else [0])] if fp[33:] else []


def common(a, b):
    """Length of the longest common subsequence."""
    last = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(last[j] + 1 if x == y else max(last[j + 1], now[-1]))
        last = now
    return last[-1]


def test_merkle(docs, empty, spark):
    got = merkle.fingerprint_edits(docs)
    assert got.count() == len(rows()) and merkle.fingerprint_edits(empty).count() == 0
    data = [r for r in rows() if r[0] is not None and r[0] != 5]
    some = spark.createDataFrame(data, SCHEMA)
    texts = {r[0]: r[1] or "" for r in data}
    ids = sorted(texts, reverse=True)
    by = {r.doc_id: r for r in merkle.fingerprint_edits(some).collect()}
    for a, b in zip(ids, ids[1:] + ids[:1]):
        k = len(texts[a]) // 3
        new = texts[a][: len(texts[a]) - k] + texts[b][:k]
        fa, fb, fe = map(plain_tree, (texts[a], texts[b], new))
        assert (by[a].edited_sha256, by[a].n_chars, by[a].fingerprint, by[a].edited_fingerprint) == (hashlib.sha256(new.encode()).hexdigest(), len(texts[a]), fa, fe)
        for near, x, y, same_text in ((by[a].near_edited, fa, fe, texts[a] == new), (by[a].near_next, fa, fb, texts[a] == texts[b])):
            u, v = plain_leaves(x), plain_leaves(y)
            most = 2 * common(u, v) / (len(u) + len(v)) if len(u) + len(v) < 2000 and u + v else 1.0
            assert (near == 1.0) == same_text and 0 <= near <= most + 1e-9
        assert bool(by[a].edits) == (texts[a] != new)
        u, v = plain_leaves(fa), plain_leaves(fe)
        assert len(u) - sum(e.gone for e in by[a].edits) == len(v) - sum(e.come for e in by[a].edits)
    alone = merkle.fingerprint_edits(some.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_merkle_over_many_ranges(spark, monkeypatch):
    """Every range gets the row behind its last, also with repeated and null doc_ids."""
    monkeypatch.setattr(merkle, "partitions", lambda spark, rows, per: 7)
    texts = {i * 3: f"text of {i} " * (i % 9 + 1) for i in range(200)}
    data = [*texts.items(), (None, "without an id")]
    got = {r.doc_id: r for r in merkle.fingerprint_edits(spark.createDataFrame(data, "doc_id long, text string").repartition(5)).collect()}
    order = sorted(texts, reverse=True)
    for a, b in zip([*order, None], [*order[1:], None, order[0]]):
        x, y = dict(data)[a], dict(data)[b]
        k = len(x) // 3
        assert got[a].edited_sha256 == hashlib.sha256((x[: len(x) - k] + y[:k]).encode()).hexdigest()


def test_merkle_tells_where():
    lines = [f"paragraph {i} has some words of its own number {i * 7}" for i in range(40)]
    fp = lambda ls: merkle.fingerprint("\n".join(ls) + "\n")
    at = lambda n: (lambda ns: [(s, k) for s, x in enumerate(ns) for k in range(len(x))][n])([x.split(",") for x in fp(lines)[33:].split("/")])
    changed = lines[:10] + ["paragraph 10 is another one"] + lines[11:]
    assert [(e[:2], e[3:]) for e in merkle.compared(fp(lines), fp(changed))[1]] == [(at(10), (1, 1))]
    moved = lines[:5] + lines[6:30] + [lines[5]] + lines[30:]
    assert [(e[:2], e[3:]) for e in merkle.compared(fp(lines), fp(moved))[1]] == [(at(5), (1, 0)), (at(30), (0, 1))]
    twice = lines[:20] + [lines[19]] + lines[20:]
    assert [e[3:] for e in merkle.compared(fp(lines), fp(twice))[1]] == [(0, 1)] and [e[3:] for e in merkle.compared(fp(twice), fp(lines))[1]] == [(1, 0)]
    assert merkle.likeness(fp(lines), fp(lines)) == 1.0 and 0.9 < merkle.likeness(fp(lines), fp(changed)) < 1.0
    assert merkle.likeness(fp(lines), fp(lines[::-1])) < 0.2
    text = " ".join(lines)
    assert merkle.compared(merkle.fingerprint(text), merkle.fingerprint(text.replace("number 70", "number seventy")))[1][0][3] <= 2
    assert b"".join(merkle.pieces(text.encode())) == text.encode()
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1.0 and merkle.likeness(merkle.fingerprint(""), fp(lines)) == 0.0
    rnd = random.Random(2)
    words = lambda: " ".join(str(rnd.randrange(10**12)) for _ in range(20_000))
    assert merkle.likeness(merkle.fingerprint(words()), merkle.fingerprint(words())) == 0.0


def test_packing(docs, empty, tok):
    got = packing.pack(docs, max_len=64, budget=256, buckets=5).collect()
    want = sorted((r[0] is not None, r[0] or 0, i, tuple(ids[i : i + 64])) for r in rows() for ids in [tok.encode(r[1] or "", add_special_tokens=False).ids] for i in range(0, max(1, len(ids)), 64))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.first, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in got) == want
    lengths = [len(w[3]) for w in want]
    tops = sorted({r.bucket for r in got})
    assert all(len(r.ids) == 2 * r.n_tokens and r.padding == r.bucket - r.n_tokens and r.bucket == min(t for t in tops if t >= r.n_tokens) for r in got)
    pad = lambda bs: sum(min(b for b in bs if b >= x) - x for x in lengths)
    assert sum(r.padding for r in got) == min(pad((*c, max(lengths))) for k in range(4) for c in combinations(sorted(set(lengths) - {0, max(lengths)}), k)) or len(tops) == 5
    batches = {}
    for r in got:
        batches.setdefault(r.batch_id, []).append(r)
    for b in batches.values():
        assert len({r.bucket for r in b}) == 1 and len(b) * b[0].bucket <= 256 and sorted(r.slot for r in b) == list(range(len(b)))
    assert sorted(batches) == list(range(len(batches)))
    full = [b for b in batches.values() if len(b) == 256 // b[0].bucket]
    assert len(batches) - len(full) <= len(tops)
    assert packing.pack(empty).count() == 0


def test_boundaries_are_best():
    rnd = np.random.default_rng(1)
    for _ in range(40):
        counts = rnd.integers(0, 9, 14) * rnd.integers(0, 2, 14)
        lengths = np.repeat(np.arange(14), counts)
        if not len(lengths):
            assert packing.best_boundaries(counts, 3) == []
            continue
        pad = lambda bs: sum(min(b for b in bs if b >= x) - x for x in lengths)
        top = max(1, int(lengths.max()))
        best = min(pad((*c, top)) for k in range(3) for c in combinations(range(1, top), k))
        found = packing.best_boundaries(counts, 3)
        assert len(found) <= 3 and pad(found) == best


def test_language(docs, empty, spark):
    got = {(r.doc_id, r.held_out): r for r in langid.language_id(docs).collect()}
    by = {r[0]: r for r in rows()}
    right = [got[(i, zlib.crc32(str(i).encode()) % 5 == 0)].lang_pred == by[i][2] for i in range(60) if i != 5]
    assert sum(right) >= 0.9 * len(right)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got.values() if r.doc_id in (100, 101, 102, 103))
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.language_id(empty).count() == 0
    nothing = langid.language_id(spark.createDataFrame([(1, "words here", None)], "doc_id long, text string, lang string")).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    letters = {r[0] for r in rows() if r[0] not in (100, 101, 102, 103)}
    assert not letters <= {r.doc_id for r in langid.keep_languages(docs, least_score=0.9).collect()}
    kept = langid.keep_languages(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows()} - {100, 101, 102, 103}


def plain_language(labelled, texts, penalty=langid.PENALTY):
    """(language, score) of each text: trigrams counted in dictionaries, and the best path word by word."""

    def words(text):
        return re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode())

    def grams(w):
        padded = b" " + w + b" "
        return [((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 2654435761 & 0xFFFFFFFF) >> 14 for i in range(len(w))]

    def script(c):
        if ord(c) < 128:
            return "latin" if c.isalpha() else ""
        return next((name for at, name in reversed(langid.RANGES) if at <= ord(c)), "")

    langs = sorted({lang for _, lang in labelled})
    counts, letters = {x: Counter() for x in langs}, {x: Counter() for x in langs}
    for text, lang in labelled:
        for w in words(text):
            counts[lang].update(grams(w))
        letters[lang].update(s for s in map(script, text) if s)
    seen = set().union(*counts.values())
    weights = {}
    for g in seen:
        logs = [np.log(counts[x][g] + 0.1) - np.log(counts[x].total() + 0.1 * len(seen)) for x in langs]
        weights[g] = [float(np.float16(np.float32(v - sum(logs) / len(logs)))) for v in logs]
    out = []
    for text in texts:
        ws = words(text)
        if not text or not any(c.isalpha() for c in text) or not ws or not langs:
            out.append(("und", 0.0))
            continue
        found = {s for s in map(script, text) if s}
        own = [i for i, x in enumerate(langs) if any(letters[x][s] >= langid.SCRIPT_SHARE * max(letters[x].total(), 1) for s in found)] or list(range(len(langs)))
        scores = [[sum(weights[g][i] for g in grams(w) if g in weights) for i in own] for w in ws]
        paths, now = [[i] for i in range(len(own))], scores[0]
        for row in scores[1:]:
            top = max(range(len(own)), key=lambda i: now[i])
            kept = [i if now[i] >= now[top] - penalty else top for i in range(len(own))]
            paths = [paths[k] + [i] for i, k in enumerate(kept)]
            now = [(now[i] if k == i else now[top] - penalty) + row[i] for i, k in enumerate(kept)]
        path = paths[max(range(len(own)), key=lambda i: now[i])]
        share = Counter()
        for i, w in zip(path, ws):
            share[i] += len(w)
        best = max(range(len(own)), key=lambda i: share[i])
        total = [sum(row[i] for row in scores) for i in range(len(own))]
        sure = 1 / sum(np.exp(np.clip((t - total[best]) / max(1.0, len(ws) ** 0.5), -50, 50)) for t in total)
        out.append((langs[own[best]], share[best] / share.total() * min(1.0, sure)))
    return out


def test_language_equals_a_plain_version(docs):
    data = rows()
    labelled = [(r[1], r[2]) for r in data if r[0] is not None and r[1] is not None and r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    want = plain_language(labelled, [r[1] for r in data])
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.lang_pred, round(r.score, 4)) for r in langid.language_id(docs).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in sorted((r[0] is not None, r[0] or 0, x, round(s, 4)) for r, (x, s) in zip(data, want))]
    by = {(r.doc_id, r.lang_pred): r.score for r in langid.language_id(docs).collect() if r.doc_id is not None and r.doc_id != 5}
    assert all(by[(r[0], x)] == pytest.approx(s, abs=1e-3) for r, (x, s) in zip(data, want) if r[0] is not None and r[0] != 5)


def test_mixed_text_has_spans(spark):
    rnd = random.Random(3)
    say = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) for _ in range(n))
    labelled = spark.createDataFrame([(i, say(lang, 30), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)], "doc_id long, text string, lang string")
    model = langid.fit(labelled)
    pred, score, spans = langid.label(say("en", 40) + " " + say("de", 25), model)
    assert pred == "en" and [s[2] for s in spans] == ["en", "de"] and abs(spans[1][0] - 40) <= 2 and score < 0.9


def test_viterbi_is_exact():
    from itertools import product

    rnd = np.random.default_rng(5)
    for _ in range(60):
        s = rnd.normal(size=(6, 3)) * rnd.choice([0.3, 3])
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731,B023
        assert value(langid.viterbi(s, 1.5)) == pytest.approx(max(map(value, product(range(3), repeat=6))))


def plain_lines(data, least):
    norm = lambda x: x.strip(" \t\n\v\f\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    seen = {}
    for r in {(r[0], r[1] or "") for r in data}:
        for k in {norm(x) for x in r[1].split("\n")}:
            seen.setdefault(k, set()).add((r[0], r[1]))
    out = []
    for r in data:
        ls = (r[1] or "").split("\n")
        kept = [x for x in ls if not (len(norm(x)) >= 1 and len(seen[norm(x)]) >= least)]
        out.append((r[0], len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup(docs, empty):
    same(line_dedup.line_dedup(docs).drop("drop_words").collect(), plain_lines(rows(), 10))
    assert line_dedup.line_dedup(empty).count() == 0
    kept = line_dedup.drop_frequent_lines(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() and kept.where("doc_id < 24 AND text LIKE '%Shared LINE%'").isEmpty()
    assert kept.where("doc_id = 100 AND text IS NULL").count() == 1
    assert kept.where("doc_id < 24 AND n_chars <> length(text)").isEmpty()


def test_many_lines(spark):
    texts = [(i, "\n".join(f"own {i} {j}" if j % 3 else "same" for j in range(200 + i))) for i in range(12)]
    same(line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id long, text string")).drop("drop_words").collect(), plain_lines(texts, 10))


def plain_notices(text, templates, t=0.8):
    """Of all windows and templates those that reach t, each start with its best end; the most shared of overlapping ones stay."""
    ws = re.findall(r"[^\W_]+", (text or "").lower())
    bs = list(zip(ws, ws[1:]))
    found = []
    for name, wanted in ((name, x) for name, texts in templates.items() for x in texts):
        own = re.findall(r"[^\W_]+", wanted.lower())
        bag = Counter(zip(own, own[1:]))
        n = bag.total()
        for i in range(len(bs)):
            best, now, shared = (0, 0, 0), Counter(), 0
            for j in range(i, len(bs)):
                now[bs[j]] += 1
                shared += now[bs[j]] <= bag[bs[j]]
                dice = 2 * shared / (j - i + 1 + n)
                if dice > best[0]:
                    best = (dice, j - i + 1, shared)
            if best[0] >= t - 1e-12:
                found.append((t * (n + best[1]) - 2 * best[2], i, name, best[1] + 1, best[0]))
    kept = []
    for w in sorted(found):
        if all(w[1] >= k[1] + k[3] or k[1] >= w[1] + w[3] for k in kept):
            kept.append(w)
    return sorted((at, n, name, dice) for _, at, name, n, dice in kept)


def test_licences(spark, docs, empty):
    mit = licenses.TEMPLATES["MIT"][2]
    wrapped = "\n".join(mit[i : i + 70] for i in range(0, len(mit), 70))
    data = [(1, "text\nLicensed under the Apache License, Version 2.0.\nmore"), (2, "released UNDER  the mit license!!"), (3, "nothing to see"), (4, None), (5, ""), (6, f"head\n\n{mit}\n\ntail"), (7, "Copyright (c) 2019 Example Corp. All rights reserved."), (8, "Licensed under CC BY-NC 4.0."), (9, f"head\n\n{wrapped}\n\ntail")]
    got = {r.doc_id: r for r in licenses.licence_scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {i: r.licence for i, r in got.items() if r.n_notices} == {1: "Apache-2.0", 2: "MIT", 6: "MIT", 7: "Proprietary", 8: "CC-BY-NC-4.0", 9: "MIT"}
    for i, text in data:
        want = plain_notices(text, licenses.TEMPLATES)
        assert [tuple(n) for n in got[i].notices] == [(*w[:3], pytest.approx(w[3])) for w in want]
    assert licenses.licence_scan(docs).count() == len(rows()) and licenses.licence_scan(empty).count() == 0


def test_licences_of_every_template_are_told_apart(spark):
    data = [(i, f"some words before {text} and some behind", name) for i, (name, text) in enumerate((n, x) for n, xs in licenses.TEMPLATES.items() for x in xs)]
    got = licenses.licence_scan(spark.createDataFrame([d[:2] for d in data], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.licence, r.dice, r.n_notices) for r in got} == {i: (name, 1.0, 1) for i, _, name in data}


def test_licences_equal_a_plain_search(spark):
    """Texts of parts of templates, repeated, shortened and with words changed, against all windows of all templates."""
    rnd = random.Random(8)
    templates = {"A": ["the one two the one two three", "all of it"], "B": ["one two three four five six seven eight nine ten", "the one two"], "C": ["nine ten nine ten nine ten"]}
    words = "the one two three four five six seven eight nine ten all of it other".split()
    data = []
    for i in range(150):
        ws = []
        for _ in range(rnd.randint(0, 5)):
            part = rnd.choice([x for xs in templates.values() for x in xs]).split()
            part = [rnd.choice(words) if rnd.random() < 0.08 else w for w in part if rnd.random() > 0.05]
            ws += part + [rnd.choice(words) for _ in range(rnd.randint(0, 4))]
        data.append((i, " ".join(ws)))
    got = {r.doc_id: r for r in licenses.licence_scan(spark.createDataFrame(data, "doc_id long, text string"), templates=templates).collect()}
    for i, text in data:
        assert [tuple(n) for n in got[i].notices] == [(*w[:3], pytest.approx(w[3])) for w in plain_notices(text, templates)]


def test_pii(spark, docs, empty):
    text = 'Dear Mrs. Anna Schmidt, Mr. Schmidt met Dr Иванов. a.b@x.com or A.B@X.COM, +1 (988) 555-2485, card 4111 1111 1111 1111 and 4111-1111-1111-1111, 123-45-6789, password=hunter2hunter2 token = "deadbeefdeadbeef" 10.1.2.3'
    data = [(1, text), (2, "a.b@x.com again"), (3, None), (4, ""), (5, "1. 2.5 and 12:30, plain"), (6, "x.y@x.com"), (2, "a.b@x.com again")]
    got = pii.surrogate_pii(spark.createDataFrame(data, "doc_id long, text string"))
    by = {r.doc_id: r for r in got.collect()}
    new = by[1].text
    for secret in ("Anna", "Schmidt", "Иванов", "a.b@x.com", "A.B@X.COM", "988", "4111 1111", "4111-1111", "123-45-6789", "hunter2", "deadbeef", "10.1.2.3"):
        assert secret not in new
    emails = re.findall(r"[\w.]+@[\w.]+\w", new)
    assert emails[0].upper() == emails[1] and emails[0] in by[2].text and emails[0] != by[6].text and emails[0].split("@")[1] == by[6].text.split("@")[1]
    spaced, dashed = re.search(r"card (\d{4} \d{4} \d{4} \d{4}) and ([\d-]{19})", new).groups()
    assert spaced.replace(" ", "") == dashed.replace("-", "")
    digits = [int(c) for c in spaced if c != " "]
    assert (sum(digits[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-2::-2])) % 10 == 0
    first, last, again = re.search(r"Mrs\. (\S+) (\S+), Mr\. (\S+) met", new).groups()
    assert last == again and first in pii.FIRST["latin"][0].split() and re.search(r"Dr [А-Яа-я]+\.", new)
    assert by[5].text == data[4][1] and by[3].text is None and by[4].n_entities == 0 and got.count() == len(data)
    assert pii.surrogate_pii(docs).count() == len(rows()) and pii.surrogate_pii(empty).count() == 0
    kept = pii.replace_pii(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_surrogates_stay_distinct(spark):
    """More surnames than one attempt can name: collisions draw again until all differ."""
    names = [f"{a}{b}{c}" for a in "ABCDEFGHIJ" for b in "aeiou" for c in (x + y for x in "klmnprst" for y in "aeiou")]
    data = [(i, f"Mr. {n} called") for i, n in enumerate(names)]
    texts = [r.text for r in pii.surrogate_pii(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    assert len(set(texts)) == len(names) and not {f"Mr. {n} called" for n in names} & set(texts)


def test_surrogate_names_are_nobodys(spark):
    """Real first names are all that a first attempt can draw, of all genders."""
    pools = [p.split() for p in pii.FIRST["latin"]]
    data = [(f"{title} {n} Bermonen left", n) for title, pool in zip(("Mrs.", "Mr.", "Dr."), pools) for n in pool]
    real = {n for _, n in data} | {"Bermonen"}
    got = pii.surrogate_pii(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(data)], "doc_id long, text string")).collect()
    names = [re.fullmatch(r"\S+ (\S+) (\S+) left", r.text).groups() for r in got]
    assert not real & {n for pair in names for n in pair} and len({a for a, _ in names}) == len(data)


def test_names_go_without_their_title_too(spark):
    data = [
        (1, "Mrs. Anna Schmidt came. Later Schmidt said so; Anna Schmidt wrote SCHMIDT's name, Schmidtberg stays. Mail Schmidt@x.com"),
        (2, "Mr. Juan Carlos Garcia left"),
        (3, "Dr. J. Smith and Prof. J.R. Meyer met. Smith and Meyer won't"),
        (4, "Schmidt and Anna are nobody here"),
        (5, "Mr. Schmidt's house and Schmidt"),
    ]
    by = {r.doc_id: r for r in pii.surrogate_pii(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    first, last, mail = re.fullmatch(r"Mrs\. (\w+) (\w+) came\. Later \2 said so; \1 \2 wrote [A-Z]+'s name, Schmidtberg stays\. Mail (\S+)", by[1].text).groups()
    assert f" {last.upper()}'s" in by[1].text and not {"Anna", "Schmidt"} & {first, last} and "chmidt" not in mail
    assert by[1].kinds == ["first", "last", "last", "first", "last", "last", "email"]
    names = re.fullmatch(r"Mr\. (\w+) (\w+) (\w+) left", by[2].text).groups()
    assert not {"Juan", "Carlos", "Garcia"} & set(names) and by[2].kinds == ["first", "first", "last"]
    a, smith, b, c, meyer = re.fullmatch(r"Dr\. ([A-Z])\. (\w+) and Prof\. ([A-Z])\.([A-Z])\. (\w+) met\. \2 and \5 won't", by[3].text).groups()
    assert (a, smith, meyer) != ("J", "Smith", "Meyer") and a == b != "J" and c != "R"
    assert by[4].text == data[3][1] and by[5].text == f"Mr. {last}'s house and {last}"


def test_packing_pads_least_of_all_boundaries(spark):
    """A third of the items has 17 tokens; any lengths may be boundaries."""
    rnd = random.Random(4)
    lengths = [17] * 20 + [rnd.randint(0, 30) for _ in range(40)]
    got = packing.pack_lengths(spark.createDataFrame([(i, n, bytes(2 * n)) for i, n in enumerate(lengths)], "doc_id long, n_tokens long, ids binary"), 32, 256, 3).collect()
    pad = lambda bs: sum(min(b for b in bs if b >= x) - x for x in lengths)
    best = min(pad((*c, max(lengths))) for k in range(3) for c in combinations(range(1, max(lengths)), k))
    assert sum(r.padding for r in got) == best and len({r.bucket for r in got}) <= 3


def test_licences_inside_longer_texts(spark):
    mit, apache = licenses.TEMPLATES["MIT"][2], licenses.TEMPLATES["Apache-2.0"][1]
    parts = mit.replace("conditions: The above", "conditions:\n\nThe above").replace("Software. THE", "Software.\n\nTHE")
    header = apache.replace("License. You may obtain", "License.\nYou may obtain").replace("at http", "at\n\n  http").replace("2.0 Unless", "2.0\n\nUnless")
    prose = "seven lamps over the river and a house "
    data = [(1, prose * 40 + "\n\n" + parts + "\n\n" + prose * 40), (2, prose + "\n" + header + "\n" + prose * 9), (3, "Licensed under the MIT License. See LICENSE for details."), (4, (prose + "Released under CC0 1.0. ") * 3 + prose), (5, prose * 30 + "rights of the software")]
    got = {r.doc_id: r for r in licenses.licence_scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert {i: (r.n_notices, r.licence, r.dice) for i, r in got.items()} == {1: (1, "MIT", 1.0), 2: (1, "Apache-2.0", 1.0), 3: (1, "MIT", 1.0), 4: (3, "CC0-1.0", 1.0), 5: (0, None, None)}
    assert (got[1].notices[0].at, got[1].notices[0].words) == (40 * 8, len(licenses.words(mit)))


def test_surrogates_of_made_texts(spark):
    """Texts put together of plain parts and entities: the plain parts stay, and entities map one to one, in type and form."""
    rnd = random.Random(9)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))

    def luhn(d):
        return (sum(int(c) for c in d[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in d[-2::-2])) % 10 == 0

    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if luhn(d + c))

    surnames = [a + b for a in ("Schmidt", "Muller", "Novak", "Rossi", "Garcia", "Lopez") for b in ("", "sen", "ova", "ez")]
    pools = {"Mrs.": pii.FIRST["latin"][0].split(), "Mr.": pii.FIRST["latin"][1].split(), "Dr.": ["Tatum", "Rene"], "My name is": ["Anna", "John", "Wei"]}
    made = {
        "email": lambda: f"u{digits(4)}.x@mail{rnd.randrange(5)}.org", "ip": lambda: ".".join(str(rnd.randrange(1, 240)) for _ in range(4)), "ssn": lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
        "phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}", "card": card, "secret": lambda: "zq" + digits(10), "hex": lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(38)) + "a1",
    }
    pool = {k: [f() for _ in range(25)] for k, f in made.items()}
    shape = {"email": r"[a-z]\d{4}\.[a-z]@[a-z0-9]+\.example", "ip": r"(\d{1,3}\.){3}\d{1,3}", "ssn": r"\d{3}-\d\d-\d{4}", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}", "card": r"\d{16}", "secret": r"[a-z]{2}\d{10}", "hex": r"[0-9a-f]{40}"}
    data, parts = [], {}
    for i in range(400):
        own = []
        for _ in range(rnd.randint(0, 6)):
            own.append((None, rnd.choice(["plain words with 12 and 3.5, ", "version 1.2.3 of it; ", "at 10:30 they left. ", "number 1234567890123 is no card. ", "999.300.1.2 is no address. "])))
            kind = rnd.choice([*made, "name"])
            if kind == "name":
                title = rnd.choice(list(pools))
                first, last = rnd.choice(pools[title]), rnd.choice(surnames)
                own += [(None, title + " "), (f"first/{title}", first), (None, " "), ("last", last), (None, " was here and "), ("last", last), (None, " left. ")]
            else:
                own += [(None, "token = " if kind == "secret" else ""), (kind, rnd.choice(pool[kind])), (None, " then ")]
        parts[i] = own
        data.append((i, "".join(x for _, x in own)))
    got = {r.doc_id: r for r in pii.surrogate_pii(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    names = {}
    for i, own in parts.items():
        found = re.fullmatch("".join(re.escape(x) if k is None else "([^\\s]+(?: \\(\\d+\\) [\\d-]+)?)" for k, x in own), got[i].text)
        assert found and got[i].n_entities == sum(k is not None for k, _ in own)
        for (kind, real), new in zip([x for x in own if x[0]], found.groups()):
            assert names.setdefault((kind.replace("My name is", "Dr."), real), new) == new != real
            if kind in shape:
                assert re.fullmatch(shape[kind], new) and len(new) == len(real) or kind in ("email", "ip")
            assert kind != "card" or luhn(new)
            assert kind not in ("first/Mrs.", "first/Mr.") or all(x in pii.FIRST["latin"][kind == "first/Mr."].split() for x in new.split("-"))
    for kind in {k.split("/")[0] for k, _ in names}:
        own = [v for (k, _), v in names.items() if k.split("/")[0] == kind]
        assert len(own) == len(set(own)) and not {r.lower() for _, r in names} & {x.lower() for x in own}


def test_stages_with_clashing_names(spark):
    """Columns that differ in case only, in names and in kind: the stages take the exact ones and keep all."""
    data = [(r[0], r[1], r[2], r[4], "other text", "not a number", b"x") for r in rows()]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, n_chars long, TEXT string, Doc_ID string, N_CHARS binary")
    for stage in (langid.keep_languages, line_dedup.drop_frequent_lines, simhash.drop_near_copies, pii.replace_pii):
        kept = stage(docs)
        out = kept.toDF(*[f"c{i}" for i in range(7)]).collect()
        assert kept.columns == docs.columns and len(out) > 40 and {(r.c4, r.c5, bytes(r.c6)) for r in out} == {("other text", "not a number", b"x")}
    other = spark.createDataFrame([(1, "Mr. Smith\n12"), (2, None)], "DOC_ID int, Text string")
    for stage in (line_dedup.drop_frequent_lines, simhash.drop_near_copies, pii.replace_pii):
        assert stage(other).count() == 2 and stage(other).columns == ["DOC_ID", "Text"]


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemark.llm import _common

    away = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://head:7077"))
    with pytest.raises(ValueError):
        _common.scratch(away, "x")
