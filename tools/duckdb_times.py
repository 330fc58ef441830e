"""Time each oracle SQL on DuckDB (single node) as a yardstick for bench.py.

    python tools/duckdb_times.py [sf_dir]   -> one JSON line {name: seconds}
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quarry.plans.registry import ORACLE

    con = duckdb.connect()
    con.execute("SET enable_progress_bar = false")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    con.execute(ORACLE["topic_counts"]).fetchall()  # warm-up
    out = {}
    for name, sql in sorted(ORACLE.items()):
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        out[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
