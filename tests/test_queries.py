"""Every query with SQL gives what DuckDB gives on the same files."""

import decimal
import re

import duckdb
import pytest

from tidemark.plans import document_queries, staging  # noqa: F401
from tidemark.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, decimal.Decimal)) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got, "an empty result proves nothing"
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == cols
    assert got == sorted((tuple(plain(r[want.columns.index(c)]) for c in cols) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["replace_attachment", "span_owner", "consecutive_dedupe", "disposition_pairs"])
def test_tasks_grow_in_number_not_in_size(spark, sf, monkeypatch, name):
    monkeypatch.setattr(staging, "TASK_BYTES", 4000)
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    found = [int(n) for n in re.findall(r"RepartitionByExpression .*, (\d+)", plan)]
    assert found and min(found) > 8  # 4 shuffle partitions held all that a larger table has
