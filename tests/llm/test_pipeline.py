"""The pipeline's stages one after another, and its queries' SQL."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import WORDS, plain_language
from tidemark.llm import bpe, langid, packing
from tidemark.llm import queries as Q


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, sf)
        assert after.dtypes == docs.dtypes
        now = corpus_pipeline.cut(after, name)
        assert 0 < now.count() <= n
        n = now.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert packed.select("doc_id").distinct().count() == n
    assert now.where(r"text rlike r'[\w.]+@mail\d\.example\.com'").isEmpty()
    again = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, packed.collect()))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_equal_a_plain_version(spark, tmp_path):
    """run() on made documents against loops: language, lines, all pairs of near copies, and the library's ids in batches of least padding."""
    rnd = random.Random(12)
    say = lambda n: " ".join(rnd.choice(WORDS["en"]) + rnd.choice("abcdefgh") for _ in range(n))
    data = []
    for i in range(60):
        text = "\n".join(say(rnd.randint(5, 40)) for _ in range(rnd.randint(1, 5)))
        data.append([i, text + ("\nCookie  policy" if i % 3 == 0 else "") + (f"\nwrite to u{i}@mail.org now" if i % 10 == 4 else "")])
    for i, k in enumerate((1, 1, 7, 20, 33)):  # copies with a word more
        data.append([100 + i, data[k][1] + " more"])
    data += [[200, None], [201, ""], [202, "12 34 !!"], [203, "Cookie policy"], [204, "cookie POLICY"]]
    docs = [(i, t, "en" if i % 2 else "de" if i > 300 else "en", "s", len(t or "")) for i, t in data]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labelled = [(t, lang) for i, t, lang, _, _ in docs if t is not None and zlib.crc32(str(i).encode()) % 5]
    now = [(i, t) for (i, t), (x, s) in zip(data, plain_language(labelled, [t for _, t in data])) if x != "und" and s >= langid.LEAST_SCORE]
    assert {i for i, _ in data} - {i for i, _ in now} == {200, 201, 202}
    norm = lambda x: x.strip(" \t\n\v\f\r").lower()  # noqa: E731  the texts are ASCII
    seen = Counter(k for _, t in now for k in {norm(x) for x in t.split("\n")})
    now = [(i, "\n".join(x for x in t.split("\n") if not norm(x) or seen[norm(x)] < 10)) for i, t in now]
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for i, t in now}
    root = {i: i for i, _ in now}
    for i in root:
        for j in root:
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    now = [(i, t) for i, t in now if root[i] == i]
    assert {100, 101, 204} & {i for i, _ in now} == set() and 203 in root
    tok = Tokenizer.from_file(bpe.default_tokenizer())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, {})[r.first] = np.frombuffer(r.ids, "<u2").tolist()
    assert set(by) == {i for i, _ in now}
    for i, t in now:
        ids = [x for k in sorted(by[i]) for x in by[i][k]]
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids == want if "@" not in t else ids != want
    lengths = [r.n_tokens for r in got]
    tops = sorted({r.bucket for r in got})
    assert len(tops) <= packing.BUCKETS and all(r.bucket == min(x for x in tops if x >= r.n_tokens) for r in got)
    cost = {0: 0}  # the least padding of the shortest k items, by the number of buckets
    order, best = sorted(max(1, n) for n in lengths), None
    ends = [k for k in range(1, len(order) + 1) if k == len(order) or order[k] != order[k - 1]]
    for _ in range(packing.BUCKETS):
        cost = {k: min(c + order[k - 1] * (k - j) - sum(order[j:k]) for j, c in cost.items() if j < k) for k in ends if any(j < k for j in cost)}
        if len(order) in cost:
            best = cost[len(order)] if best is None else min(best, cost[len(order)])
    assert sum(r.bucket - max(1, r.n_tokens) for r in got) == best


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = Q.queries()[name](spark, sf)
    want = con.sql(Q.oracle_sql()[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())
