"""A user holding a third of all ratings: the shuffled join is split by
adaptive skew handling (thresholds lowered to test size), results stay whole."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime

from quarry_test_helpers import rows
from pyspark.sql import functions as F

from quarry.plans import ratings as R

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@contextlib.contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_user_join_is_split_and_complete(spark):
    n = 30_000
    data = [(0 if i % 3 == 0 else 1 + i % 997, i % 50, float(1 + i % 5), datetime(2020, 1, 1)) for i in range(n)]
    ratings = spark.createDataFrame(data, "user_id bigint, movie_id bigint, rating double, rated_at timestamp_ntz")
    users = spark.createDataFrame(
        [(u, "MF"[u % 2], 20 + u % 40, u % 9) for u in range(0, 998)],
        "user_id bigint, gender string, age int, occupation_id int",
    )
    movies = spark.createDataFrame([(m, f"m{m}", "A") for m in range(50)], "movie_id bigint, title string, genres string")
    with conf(spark, SKEW_CONF):
        out = R.movie_gender_long(ratings, users, movies)
        got = rows(out)
        plan = final_plan(out)
    assert "skew=true" in plan
    # whole result: every rating counted once
    assert sum(r[4] for r in got) == n
    joined = ratings.join(users, "user_id").groupBy("movie_id", "gender").agg(F.count(F.lit(1)).alias("n"))
    assert sorted((r[0], r[2], r[4]) for r in got) == sorted(tuple(r) for r in joined.collect())
