from __future__ import annotations

import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from quarry_test_helpers import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session

    session = get_session(
        "local[4]",
        "quarry-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-test-ckpt-")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "lineitem", "documents", "labels", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
