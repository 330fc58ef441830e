"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from quarry_test_helpers import SF_SMALL

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _canon(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    tables = (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
        "labels conversations"
    ).split()
    for t in tables:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["movie_id", "title", "avg_rating", "n_ratings"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(got) > 0
        return
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


LARGE_PATH_QUERIES = ["seller_ranking", "movie_gender_wide", "movie_gender_long", "movie_age_long",
                      "biggest_gender_gap", "orders_by_country", "revenue_by_category", "remove_stopwords"]


@pytest.mark.parametrize("name", LARGE_PATH_QUERIES)
def test_without_broadcasts_matches_oracle(spark, con, name):
    """The joins that large inputs take: no side is broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = QUERIES[name](spark, SF_SMALL)
        got = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert _canon(df.columns, got) == _canon(cols, cur.fetchall())
