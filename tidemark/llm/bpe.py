"""BPE encoding and decoding with reuse of content-defined chunks (operator 1).

Texts are cut where a rolling hash of the last bytes says so, hence copies and shared passages give the same chunks
wherever they stand. A chunk is encoded once for the whole corpus:

1. Each task of the scan sends the 128-bit hashes of its distinct chunks, no bytes; those that two tasks have are shared.
2. The first task that has a shared chunk encodes it; its ids are put into a file for each task that has the chunk.
3. The scan runs again: a task takes shared chunks from its file, and encodes the others, which are its own, once.

A task that finds no file, or not the chunk, encodes it itself: a scan that is split otherwise the second time costs
work but no truth. What stands across the joint of two chunks is encoded anew, with one whole word on either side as a
witness: the window's ids must equal the left witness's, the joint's and the right witness's. Where they don't, the window
takes in the chunks on both sides, then their neighbours, until it agrees with the words around it, at the latest
when it is the whole text; so the ids are always those of encoding the text in one go.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from functools import partial
from itertools import chain, compress, islice
from operator import is_

import numpy as np
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import Bounded, arrow_map, cut, pick, scratch

#: A cut where this many high bits of the hash of 8 bytes are zero: chunks of about 2**10 bytes.
CUT_BITS = 10
_ODD = np.uint64(0x9E3779B97F4A7C15)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def chunks(data: bytes, bits: int = CUT_BITS) -> list[bytes]:
    """data cut at content-defined places, never inside a UTF-8 character; joined they give data again."""
    n = len(data)
    if n < 16:
        return [data]
    b = np.frombuffer(data, np.uint8)
    windows = np.ndarray((n - 7,), "<u8", data, 0, (1,))  # the 8 bytes from each place on
    at = np.flatnonzero((windows * _ODD) >> np.uint64(64 - bits) == 0) + 8
    at = at[at < n]
    at = at[(b[at] & 0xC0) != 0x80].tolist()
    return [data[i:j] for i, j in zip([0, *at], [*at, n])]


#: Words that go to the model as they are: small letters whose bytes are all that normalising and splitting look at.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_BYTE_CHARS = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
_BYTE_CHARS |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _BYTE_CHARS)}
none = partial(is_, None)
_OPENED: dict[tuple, Encoder] = {}


def opened(kind: type[Encoder], path: str, **how) -> Encoder:
    """The worker process's own encoder: its caches serve all the tasks that the process runs."""
    key = (kind, path, *sorted(how.items()))
    if key not in _OPENED:
        _OPENED[key] = kind(path, **how)
    return _OPENED[key]


class Encoder:
    """The tokenizers library behind a bounded cache of words; white space always separates words here.

    What it may rely on is probed: words_apart, that words between ASCII white space are encoded on their own; plain,
    that plain words reach the model unchanged but for their bytes' characters and capitals; stops, that a full stop or comma
    behind a letter begins a piece of its own. Where words_apart fails every text goes to the library whole.
    """

    def __init__(self, path: str, cap: int = 200_000, strings: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.strings, self.words = strings, Bounded(cap)
        n = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if n <= 1 << 16 else "<u4"
        # arrays of the standard library are made faster than numpy's; their bytes are right on little-endian machines
        self.code = {"<u2": "H", "<u4": "I"}[self.dtype] if sys.byteorder == "little" else None
        self.names = [self.tok.id_to_token(i) or "" for i in range(n)]
        self.plain_join = self.tok.decoder is None
        probe = ["it's", "No.", "x", "don't!", "7up", "ﬁ"]
        self.words_apart = self.ids([" ".join(probe), "\n" + "\t".join(probe) + " "]) == [sum(self.ids(probe), [])] * 2
        probe = ["a", "the", "straße", "çàñÿ", "reading", "zzyzx", "übermäßig", "in", "éclair" * 9]
        self.plain = self.ids(probe + [w.capitalize() for w in probe]) == [self.model_ids(w) for w in probe] * 2
        self.stops = all(self.ids([w + c]) == [self.ids([w])[0] + self.ids([c])[0]] for w in ("x", "word", "é") for c in ".,")

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def model_ids(self, word: str) -> list[int]:
        chars = word if word.isascii() else "".join([_BYTE_CHARS[b] for b in word.encode()])
        return [t.id for t in self.tok.model.tokenize(chars)]

    def entry(self, ids: list[int]):
        """What is kept of encoded text: the ids' bytes, or (count, ids as decimals, decoded)."""
        if not self.strings:
            return np.array(ids, self.dtype).tobytes() if self.code is None else array(self.code, ids).tobytes()
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        if self.plain_join:
            return " ".join([self.names[i] for i in ids])
        return self.tok.decode(ids, skip_special_tokens=False)

    def joined(self, a, b):
        """The entry of two pieces that stand together."""
        return a + b if not self.strings else (a[0] + b[0], f"{a[1]} {b[1]}", f"{a[2]} {b[2]}")

    def learn(self, words) -> None:
        """Puts the words that the cache lacks into it."""
        cache, odd = self.words, []
        for w in words:
            if cache[w] is not None:
                continue
            stop = w[-1:] if self.stops and self.plain and w[-1:] in (b".", b",") else b""
            stem = w[: len(w) - len(stop)]
            word = stem.decode().lower() if self.plain else ""
            if not (word.isascii() and word.isalpha() or _PLAIN.fullmatch(word)):
                odd.append(w)
                continue
            key = word.encode()
            known = cache[key]
            if known is None:
                known = cache[key] = self.entry(self.model_ids(word))
            if stop:
                end = cache[stop]
                if end is None:
                    end = cache[stop] = self.entry(self.ids([stop.decode()])[0])
                known = self.joined(known, end)
            if w != key:
                cache[w] = known
        for i in range(0, len(odd), 20_000):
            part = odd[i : i + 20_000]
            for w, ids in zip(part, self.ids([w.decode() for w in part])):
                cache[w] = self.entry(ids)

    def fold(self, text: bytes) -> bytes:
        """text with ASCII capitals folded where that is sure to change nothing: no special token can then appear."""
        return text.lower() if self.plain and b"<|" not in text else text

    def entries(self, words: list[bytes]) -> list:
        """The words' entries, in one walk through the cache; what it lacks is learned."""
        get = self.words.__getitem__
        found = list(map(get, words))
        lacking = list(compress(range(len(found)), map(none, found)))
        self.learn({words[i] for i in lacking})
        for i in lacking:
            found[i] = get(words[i])
        return found

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each whole text, as bytes of little-endian unsigned integers."""
        if not self.words_apart:
            return [self.entry(x) for x in self.ids([t.decode() for t in texts])]
        self.words.trim()
        split = [self.fold(t).split() for t in texts]
        found = iter(self.entries(list(chain.from_iterable(split))))
        return [b"".join(islice(found, len(ws))) for ws in split]


def _merge(entries: list) -> tuple[int, str, str]:
    if not entries:
        return 0, "", ""
    counts, ids, decoded = zip(*entries)
    if 0 in counts:
        return _merge([e for e in entries if e[0]])
    return sum(counts), " ".join(ids), " ".join(decoded)


class ChunkEncoder(Encoder):
    """Encodes and decodes whole texts chunk by chunk; given: ids of the insides of chunks, by hash, that others have encoded."""

    def __init__(self, path: str, chunk_cap: int = 12_000, cut_bits: int = CUT_BITS) -> None:
        super().__init__(path, cap=120_000, strings=True)
        self.cache, self.bits, self.given = Bounded(chunk_cap), cut_bits, {}
        self.chunkwise = self.words_apart and self.plain_join
        self.numbers = [str(i) for i in range(len(self.names))]

    def cut(self, text: bytes) -> list[bytes]:
        return chunks(self.fold(text), self.bits)

    def _parts(self, chunk: bytes):
        """(head, words, tail, left window, right window): words are whole, head and tail go on in the neighbours."""
        words = chunk.split()
        if not words:
            return (b"", [], b"", b"", b"") if chunk else None
        head = b"" if chunk[:1].isspace() else words[0]
        if head and len(head) == len(chunk):
            return None  # no white space at all
        tail = b"" if chunk[-1:].isspace() else words[-1]
        core = words[bool(head) : len(words) - bool(tail)]
        if not core:  # no witness here: what stands between head and tail is white space
            return head, core, tail, head, tail
        first = chunk.index(core[0], len(head)) + len(core[0])
        last = chunk.rindex(core[-1], 0, len(chunk) - len(tail))
        return head, core, tail, chunk[:first], chunk[last:]

    def told(self, data: bytes) -> tuple[int, str, str]:
        """The entry of ids that were given as bytes."""
        ids = np.frombuffer(data, self.dtype).tolist()
        return len(ids), " ".join([self.numbers[i] for i in ids]), " ".join([self.names[i] for i in ids])

    def learn_chunks(self, new) -> None:
        """Puts what the cache lacks of the chunks into it: what was given, and else what the words give."""
        parts = {c: self._parts(c) for c in new if self.cache[c] is None}
        own = {c for c, p in parts.items() if p and p[1] and not (self.given and chunk_key(c) in self.given)}
        found = iter(self.entries([w for c, p in parts.items() if c in own for w in p[1]]))
        for c, p in parts.items():
            if p is None:
                self.cache[c] = ("solid",)
                continue
            inside = _merge(list(islice(found, len(p[1])))) if c in own else self.told(self.given[chunk_key(c)]) if p[1] else (0, "", "")
            self.cache[c] = (p[0], inside, p[2], p[3], p[4], p[1][:1], p[1][-1:])

    def inside_ids(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of the chunks' insides as bytes, for others."""
        self.words.trim()
        self.cache.trim()
        self.learn_chunks(wanted)
        return [b"" if self.cache[c][0] == "solid" else np.array(self.cache[c][1][1].split(), self.dtype).tobytes() for c in wanted]

    def encode(self, texts: list[bytes]) -> list[tuple[int, str, str, int]]:
        """(tokens, ids as decimals, decoded text, chunks) of each text."""
        if not self.chunkwise:
            return [(*self.entry(x), 1) for x in self.ids([t.decode() for t in texts])]
        self.words.trim()
        self.cache.trim()
        cut_texts = [self.cut(t) for t in texts]
        self.learn_chunks(dict.fromkeys(c for cs in cut_texts for c in cs))
        word = self.words
        # the joints: (word across it, window, witness on the left, on the right); spans: where the chunks' insides lie
        plans, joints = [], []
        for cs in cut_texts:
            plan, spans, at, word_now, window, left = [], [], 0, b"", b"", []
            for c in cs:
                e = self.cache[c]
                if e[0] == "solid":
                    word_now += c
                    window += c
                else:
                    plan += [len(joints), e[1]]
                    spans.append((at + len(e[0]), at + len(c) - len(e[2])))
                    joints.append((word_now + e[0], window + e[3], left, e[5]))
                    word_now, window, left = e[2], e[4], e[6]
                at += len(c)
            plan.append(len(joints))
            joints.append((word_now, window, left, []))
            plans.append((plan, spans))
        self.learn({w for j in joints for w in (*j[2], j[0], *j[3]) if w})
        agree = [
            _merge([word[w] for w in (*j[2], j[0], *j[3]) if w])[1] == " ".join([self.numbers[i] for i in ids]) for j, ids in zip(joints, self.ids([j[1].decode() for j in joints]))
        ]
        out = []
        for t, (plan, spans), cs in zip(texts, plans, cut_texts):
            entries = [(word[joints[p][0]] if joints[p][0] else (0, "", "")) if isinstance(p, int) else p for p in plan]
            wrong = [k for k, p in enumerate(plan[::2]) if not agree[p]]
            out.append((*(self.repaired(self.fold(t), entries, spans, wrong) if wrong else _merge(entries)), len(cs)))
        return out

    def repaired(self, text: bytes, entries: list, spans: list[tuple[int, int]], wrong: list[int]) -> tuple[int, str, str]:
        """The entry of a text some of whose joints disagree: joint k stands before inside k; entries are joints and insides in turn.

        A window begins with the insides on both sides of a joint. It stands where encoding it together with the words on its
        two ends gives just these words' ids around its own; else it takes in one more inside on either side.
        """
        n, windows = len(spans), []
        for k in wrong:
            if windows and windows[-1][0] < k < windows[-1][1]:
                continue
            s, e = max(0, k - 1), min(n, k + 1)
            while True:
                while windows and windows[-1][1] > s:
                    s = min(s, windows.pop()[0])
                if s == 0 and e == n:
                    return self.entry(self.ids([text.decode()])[0])
                lo, hi = spans[s][0], spans[e - 1][1]
                before, after = (spans[s - 1][1] if s else 0), (spans[e][0] if e < n else len(text))
                left, own, right, whole = self.ids([text[i:j].decode() for i, j in ((before, lo), (lo, hi), (hi, after), (before, after))])
                if left + own + right == whole and left == self.numbered(entries[2 * s]) and right == self.numbered(entries[2 * e]):
                    windows.append((s, e, self.entry(own)))
                    break
                s, e = max(0, s - 1), min(n, e + 1)
        out, at = [], 0
        for s, e, entry in windows:
            out += [*entries[at : 2 * s + 1], entry]
            at = 2 * e
        return _merge(out + entries[at:])

    def numbered(self, entry: tuple[int, str, str]) -> list[int]:
        return [int(i) for i in entry[1].split()]


def chunk_key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def shared_chunks(docs: DataFrame, path: str, cut_bits: int) -> str | None:
    """A folder with a file of (key, ids) for each task that has chunks which others have too; null where nothing is shared."""

    def hold(parts):
        enc, seen = opened(ChunkEncoder, path, cut_bits=cut_bits), set()
        if not enc.chunkwise:
            return
        for p in parts:
            new = {chunk_key(c) for c in {c for t in p["text"] for c in enc.cut((t or "").encode())}} - seen
            seen |= new
            yield {"task": [TaskContext.get().partitionId()] * len(new), "key": list(new)}

    texts = docs.select("text")
    held = cut(arrow_map(texts, hold, "task int, key binary"), "held")
    shared = held.groupBy("key").agg(F.min("task").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "owner")
    wanted = cut(held.join(shared, "key"), "shared")  # a row for each task that has the chunk
    top = wanted.agg(F.max("task")).first()[0]
    if top is None:
        return None
    owned = _by_task(wanted.where("task = owner").select("task", "key"), top, "owned")

    def encode(parts):
        enc, mine, batch = opened(ChunkEncoder, path, cut_bits=cut_bits), None, {}
        for p in parts:
            if mine is None:
                mine = {k for k, in _of_task(owned, ["key"])}
            found = {k: c for k, c in ((chunk_key(c), c) for c in {c for t in p["text"] for c in enc.cut((t or "").encode())}) if k in mine}
            mine -= found.keys()
            batch = list(found.values())
            for i in range(0, len(batch), 500):
                yield {"key": list(found)[i : i + 500], "ids": enc.inside_ids(batch[i : i + 500])}

    done = cut(arrow_map(texts, encode, "key binary, ids binary"), "encoded")
    return _by_task(wanted.join(done, "key").select("task", "key", "ids"), top, "given")


def _by_task(rows: DataFrame, top: int, label: str) -> str:
    """Puts rows into a folder of its own for each task; gives the folder above."""
    folder = scratch(rows.sparkSession, label)
    rows.repartitionById(top + 1, F.col("task")).write.partitionBy("task").parquet(folder)
    return folder


def _of_task(folder: str, columns: list[str]):
    """The rows that are there for the task at hand."""
    store, root = fs.FileSystem.from_uri(folder)
    own = f"{root}/task={TaskContext.get().partitionId()}"
    if store.get_file_info(own).type != fs.FileType.Directory:
        return
    for info in store.get_file_info(fs.FileSelector(own)):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(columns=columns):
                    yield from zip(*(batch.column(c).to_pylist() for c in columns))


def bpe_encode_decode(docs: DataFrame, tokenizer: str | None = None, cut_bits: int = CUT_BITS, texts: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, n_chunks, and with texts also ids and decoded.

    Null texts count as empty: no ids, and the digests of nothing. Rows that repeat give rows that repeat; a null
    doc_id stays null; texts of any length are handled whole; other columns of docs are ignored; no rows give none.
    """
    path = tokenizer or default_tokenizer()
    extra = ", ids array<int>, decoded string" if texts else ""
    docs = pick(docs, doc_id="bigint", text="string")
    folder = shared_chunks(docs, path, cut_bits)

    def run(parts):
        enc = opened(ChunkEncoder, path, cut_bits=cut_bits)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        given = None
        for p in parts:
            if given is None:  # the file's ids stay as bytes until a chunk is met
                given = dict(_of_task(folder, ["key", "ids"])) if folder else {}
            enc.given = given
            done = enc.encode([(t or "").encode() for t in p["text"]])
            out = {"doc_id": p["doc_id"], "n_tokens": [d[0] for d in done], "ids_sha256": [sha(d[1]) for d in done], "decoded_sha256": [sha(d[2]) for d in done], "n_chunks": [d[3] for d in done]}
            if texts:
                out |= {"ids": [[int(i) for i in d[1].split()] for d in done], "decoded": [d[2] for d in done]}
            yield out

    return arrow_map(docs, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_chunks int" + extra)
