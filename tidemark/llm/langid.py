"""Language of texts, and of the spans of mixed ones (operator 7).

A model of byte trigrams inside words is fitted on a bounded sample of labelled rows. For a text, the scripts of its
letters narrow the candidates (a language is one where a fair part of its own letters is of that script); each word
gets a score for every candidate, and the Viterbi path over words, with a penalty for a switch, labels the spans. The
language with most letters on the path is the text's.

Where no stretch of words speaks for another language by more than the penalty, the path that never switches is the best
one; running sums show that for a whole text at once, and only the other texts take the path step by step.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm._common import arrow_map, pick, place

#: Labelled rows that the model is fitted on, for each language, about; chosen by a hash of doc_id.
SAMPLE = 1_500
#: Languages that are learned, those with the most labelled rows; bounds the model that goes to driver and workers.
LANGUAGES = 64
#: Below this score a text's language counts as not told. Held-out texts of one language score far higher.
LEAST_SCORE = 0.2
#: Log-probability that a change of language costs.
PENALTY = 12.0
#: Trigrams are hashed to so many cells.
CELLS = 1 << 18
#: A language is a candidate in a script that at least this share of its own letters has.
SCRIPT_SHARE = 0.02

#: First code points of ranges, and the script that begins there ("" where letters are of none of these).
RANGES = [(0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, ""), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, ""), (0xB80, "tamil"), (0xC00, ""), (0xE00, "thai"), (0xE80, ""), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, ""), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, ""), (0x3400, "han"), (0xA000, ""), (0xAC00, "hangul"), (0xD7B0, ""), (0xF900, "han"), (0xFB00, ""), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, ""), (0x20000, "han"), (0x32000, "")]
_STARTS = np.array([r[0] for r in RANGES])
SCRIPTS = sorted({r[1] for r in RANGES})
_SCRIPT = np.array([SCRIPTS.index("")] + [SCRIPTS.index(r[1]) for r in RANGES])


def scripts(text: str) -> np.ndarray:
    """The script of each code point, as a place in SCRIPTS; only letters count."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    own = _SCRIPT[np.searchsorted(_STARTS, code, "right")]
    ascii_ = code < 0x80
    letter = ((code | 32) >= 97) & ((code | 32) <= 122)
    return np.where(ascii_ & ~letter, SCRIPTS.index(""), own)


def has_letter(text: str) -> bool:
    return text.isalpha() or any(map(str.isalpha, text))


def cells(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of letters in lower case: cells of the trigrams of " word ", places where words begin, their lengths in bytes.

    Digits and signs separate words like white space.
    """
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    joined = np.where(letter, data, 32).astype(np.uint32)
    keep = letter | np.r_[True, letter[:-1]]  # of separators in a row, the first
    joined = joined[keep]
    if len(joined) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]) * np.uint32(2654435761)
    cell = (code >> np.uint32(32 - 18)).astype(np.int64)
    middle = joined[1:-1]
    begins = np.flatnonzero((joined[:-2] == 32) & (middle != 32))
    ends = np.flatnonzero((middle != 32) & (joined[2:] == 32)) + 1
    return cell, begins, ends - begins


@dataclass
class Model:
    """langs; weights[cell, lang], log-probabilities less their mean over languages; allowed[script, lang]."""

    langs: list[str]
    weights: np.ndarray
    allowed: np.ndarray


def sample_rate(labelled: DataFrame, size: int) -> DataFrame:
    """labelled with only about size rows of each of the LANGUAGES most frequent languages, by a hash of doc_id."""
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    unit = F.expr("pmod(xxhash64(doc_id), 1000003) / 1000003D")
    rates = {r["lang"]: size / r["n"] for r in counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    rate = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(float(x))) for lang, x in rates.items()], F.lit(0.0))
    return labelled.where(unit < rate)


def fit(labelled: DataFrame, size: int = SAMPLE) -> Model:
    """A model from rows (doc_id, text, lang) with a label, on a sample of about size whole texts of each language."""

    def count(parts):
        grams, letters = {}, {}
        for p in parts:
            for text, lang in zip(p["text"], p["lang"]):
                c, begins, lengths = cells(text or "")
                inside = np.repeat(begins, lengths) + (np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths))
                grams[lang] = grams.get(lang, 0) + np.bincount(c[inside], minlength=CELLS)
                letters[lang] = letters.get(lang, 0) + np.bincount(scripts(text or ""), minlength=len(SCRIPTS))
        for lang, g in grams.items():
            at = np.flatnonzero(g)
            yield {"lang": [lang] * len(at), "cell": at.tolist(), "n": g[at].tolist()}
            yield {"lang": [lang] * len(SCRIPTS), "cell": [-1 - i for i in range(len(SCRIPTS))], "n": letters[lang].tolist()}

    counts = arrow_map(sample_rate(labelled, size), count, "lang string, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most CELLS rows for each of LANGUAGES
    langs = sorted(set(table.column("lang").to_pylist()))
    at = np.array([langs.index(x) for x in table.column("lang").to_pylist()], np.int64)
    cell, n = table.column("cell").to_numpy().astype(np.int64), table.column("n").to_numpy()
    grams, letters = np.zeros((CELLS, len(langs))), np.zeros((len(SCRIPTS), len(langs)))
    grams[cell[cell >= 0], at[cell >= 0]] = n[cell >= 0]
    letters[-1 - cell[cell < 0], at[cell < 0]] = n[cell < 0]
    seen = max(1, int((grams.sum(1) > 0).sum()))
    logs = np.log(grams + 0.1) - np.log(grams.sum(0) + 0.1 * seen)
    weights = logs - logs.mean(1, keepdims=True) if langs else logs
    weights[grams.sum(1) == 0] = 0  # nothing is known of these
    letters[SCRIPTS.index("")] = 0
    allowed = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    return Model(langs, weights.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word, where a change costs the penalty."""
    total = scores.sum(0)
    best = int(total.argmax())
    gain = scores - scores[:, best : best + 1]
    sums = np.vstack([np.zeros(scores.shape[1]), np.cumsum(gain, 0)])
    if (sums - np.minimum.accumulate(sums, 0)).max() <= penalty:
        return np.full(len(scores), best)
    back, now = np.empty(scores.shape, np.int32), scores[0]
    stay = np.arange(scores.shape[1])
    for i in range(1, len(scores)):
        top = int(now.argmax())
        switch = now[top] - penalty
        move = switch > now
        back[i] = np.where(move, top, stay)
        now = np.where(move, switch, now) + scores[i]
    path = np.empty(len(scores), np.int64)
    path[-1] = int(now.argmax())
    for i in range(len(scores) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def label(text: str, model: Model, penalty: float = PENALTY) -> tuple[str, float, list[tuple[int, int, str]]]:
    """(language, score, spans): the language with most letters on the path, its part of all the letters weighed with how
    sure the text's words are of it; spans are (first word, words, language)."""
    if not model.langs or not has_letter(text):
        return "und", 0.0, []
    cell, begins, lengths = cells(text)
    if not len(begins):
        return "und", 0.0, []
    found = np.bincount(scripts(text), minlength=len(SCRIPTS))
    found[SCRIPTS.index("")] = 0
    mask = model.allowed[found > 0].any(0) if found.any() else np.ones(len(model.langs), bool)
    if not mask.any():
        mask[:] = True  # a script that no language was learned with: all stay candidates
    own = np.flatnonzero(mask)
    running = np.vstack([np.zeros(len(own)), np.cumsum(model.weights[cell][:, own], 0, dtype=np.float64)])
    scores = running[begins + lengths] - running[begins]
    path = viterbi(scores, penalty)
    letters = np.bincount(path, lengths, minlength=len(own))
    best = int(letters.argmax())
    mean = scores.sum(0)
    sure = 1 / np.exp(np.clip((mean - mean[best]) / max(1.0, len(scores) ** 0.5), -50, 50)).sum()
    cuts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
    spans = [(int(a), int(b - a), model.langs[own[path[a]]]) for a, b in zip(cuts, np.r_[cuts[1:], len(path)])]
    return model.langs[own[best]], float(letters[best] / letters.sum() * min(1.0, sure)), spans


def sent(spark: SparkSession, model: Model):
    """Gives a function that a worker calls for the model: a broadcast of at most LANGUAGES x CELLS x 2 bytes."""
    packed = (json.dumps(model.langs), model.weights.astype(np.float16).tobytes(), model.allowed.tobytes())
    shared = spark.sparkContext.broadcast(packed)

    def received() -> Model:
        langs, weights, allowed = shared.value
        langs = json.loads(langs)
        return Model(langs, np.frombuffer(weights, np.float16).reshape(CELLS, len(langs)).astype(np.float32), np.frombuffer(allowed, bool).reshape(len(SCRIPTS), len(langs)))

    return received


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score, n_spans, spans of each row of docs."""
    received = sent(docs.sparkSession, model)

    def run(parts):
        own = received()
        for p in parts:
            done = [label(t or "", own, penalty) for t in p["text"]]
            yield {"doc_id": p["doc_id"], "lang_pred": [d[0] for d in done], "score": [d[1] for d in done], "n_spans": [len(d[2]) for d in done], "spans": [[{"first": a, "words": n, "lang": x} for a, n, x in d[2]] for d in done]}

    return arrow_map(docs, run, "doc_id bigint, lang_pred string, score double, n_spans int, spans array<struct<first:int,words:int,lang:string>>")


def held_out() -> F.Column:
    """True for the rows that nothing is learned from: crc32 of doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame, size: int = SAMPLE, penalty: float = PENALTY) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, lang_pred, score, n_spans, spans.

    Learned from rows with a label and a doc_id that are not held out. `und` with score 0 where a text is null, empty
    or without a letter, or where nothing could be learned. Rows that repeat give the same; a null doc_id is not held
    out and never learned from. Very long texts are labelled whole. Other columns are ignored; no rows give none.
    """
    rows = pick(docs, doc_id="bigint", text="string", lang="string")
    labelled = rows.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    out = predict(rows.select("doc_id", "text"), fit(labelled, size), penalty)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_spans", "spans")


def keep_languages(docs: DataFrame, least_score: float = LEAST_SCORE, size: int = SAMPLE, penalty: float = PENALTY) -> DataFrame:
    """docs without the rows whose language is und or has a score under least_score; all columns stay."""
    rows = pick(docs, doc_id="bigint", text="string", lang="string")
    labelled = rows.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    received = sent(docs.sparkSession, fit(labelled, size))
    at = place(docs.columns, "text")

    def run(batches):
        own = received()
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                done = [label(t or "", own, penalty) for t in part.column(at).cast(pa.string()).to_pylist()]
                yield part.filter(pa.array([x != "und" and s >= least_score for x, s, _ in done], pa.bool_()))

    plain = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
