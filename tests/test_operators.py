"""Lookups, aggregates and ranking on hand-made rows."""

from __future__ import annotations

import random

from quarry_test_helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import agg as A
from quarry.operators import lookup as L
from quarry.operators import rank as K


def test_attach_drop_and_default(spark):
    facts = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "k int, v double")
    look = spark.createDataFrame([(1, "one"), (2, None)], "k int, name string")
    assert rows(L.attach(facts, look, "k", "drop")) == [(1, 10.0, "one"), (2, 20.0, None)]
    got = rows(L.attach(facts, look, "k", "default", {"name": "?"}))
    # a matched null stays null (dict.get semantics); only the miss gets the default
    assert got == [(1, 10.0, "one"), (2, 20.0, None), (3, 30.0, "?")]
    expr_default = L.attach(facts, look, "k", "default", {"name": F.concat(F.lit("id:"), F.col("k"))})
    assert ("id:3",) in rows(expr_default, "name")


def test_unique_lookup_last_wins(spark):
    look = spark.createDataFrame(
        [(1, "old", 1), (1, "new", 2), (2, "only", 5), (3, "b", 1), (3, "a", 1)], "k int, name string, seq int"
    )
    assert rows(L.unique_lookup(look.select("k", "name", "seq"), "k", order="seq")) == [
        (1, "new", 2), (2, "only", 5), (3, "b", 1),
    ]
    # without an order the greatest row wins: deterministic
    assert rows(L.unique_lookup(look.select("k", "name"), "k")) == [(1, "old"), (2, "only"), (3, "b")]


def test_exclude_terms_keeps_nulls_and_ignores_duplicate_terms(spark):
    tokens = spark.createDataFrame([("the",), ("cat",), (None,), ("cat",), ("of",)], "word string")
    terms = spark.createDataFrame([("the",), ("the",), ("of",)], "term string")
    got = rows(L.exclude_terms(tokens, terms, "word", "term"))
    assert got == [("cat",), ("cat",), (None,)]


def test_mean_count_and_null_values(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 5.0), ("a", None), ("b", None)], "k string, v double")
    got = rows(A.mean_count(df, "k", "v"))
    assert got == [("a", 4.5, 2), ("b", None, 0)]


def test_mean_count_wide_fill_and_other_categories(spark):
    df = spark.createDataFrame(
        [(1, "M", 4.0), (1, "F", 2.0), (1, "F", 3.0), (2, "X", 5.0), (3, "M", 1.0)], "k int, g string, v double"
    )
    wide = A.mean_count_wide(df, "k", "g", "v", {"male": "M", "female": "F"})
    assert rows(wide, "k", "avg_male", "n_male", "avg_female", "n_female") == [
        (1, 4.0, 1, 2.5, 2), (2, 0.0, 0, 0.0, 0), (3, 1.0, 1, 0.0, 0),
    ]
    nofill = A.mean_count_wide(df, "k", "g", "v", {"male": "M"}, fill=None, with_counts=False)
    assert rows(nofill) == [(1, 4.0), (2, None), (3, 1.0)]


def test_count_by_first_field_rule(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, None), (3, None)], "id int, t string")
    assert rows(A.count_by(df, "t", count_col="id")) == [("a", 1), (None, 2)]
    assert rows(A.count_by(df, "t")) == [("a", 2), (None, 2)]


def test_best_of_ties_and_min_count(spark):
    df = spark.createDataFrame([(3, 4.25, 2), (1, 4.25, 9), (2, 5.0, 1)], "k int, avg double, n int")
    assert rows(A.best_of(df, "avg", tie="k")) == [(2, 5.0, 1)]
    assert rows(A.best_of(df, "avg", tie="k", min_count=2, count_col="n")) == [(1, 4.25, 9)]
    assert A.best_of(df.filter("n > 100"), "avg", tie="k").count() == 0  # empty input: no row


def test_biggest_gap_needs_both_sides(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1, 0.0, 0), (2, 4.0, 1, 1.5, 2), (3, 1.0, 3, 3.5, 1), (4, 3.0, 1, 0.5, 1)],
        "k int, a double, na int, b double, nb int",
    )
    got = A.biggest_gap(df, "a", "b", "na", "nb", tie="k").collect()
    assert [(r.k, r.gap) for r in got] == [(2, 2.5)]  # 2.5 ties with k=3 and k=4; smallest key wins


def test_count_distinct_with_null_counts_null_once(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",), (None,), ("x",)], "c string")
    got = df.agg(A.count_distinct_with_null("c").alias("a"), F.count_distinct("c").alias("b")).first()
    assert (got.a, got.b) == (3, 2)
    assert df.select("c").distinct().count() == got.a
    assert df.filter("c = 'none'").agg(A.count_distinct_with_null("c")).first()[0] == 0


def test_metrics_table_and_summary_row(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    m = A.metrics_table(df, {"rows": F.count(F.lit(1)), "distinct": F.count_distinct("v")})
    assert rows(m) == [("distinct", 2), ("rows", 3)]
    detail = spark.createDataFrame([("a", 1)], "key string, n int")
    best = spark.createDataFrame([("*** BEST ***",)], "key string")
    assert rows(A.with_summary_row(detail, best)) == [("*** BEST ***", None), ("a", 1)]


def test_top_k_per_group_ties(spark):
    df = spark.createDataFrame(
        [("t", "b", 3), ("t", "a", 3), ("t", "c", 5), ("t", "d", 1), ("u", "z", 1), (None, "n", 2)],
        "g string, w string, n int",
    )
    top = K.top_k_per_group(df, "g", "n", 2, tie="w")
    assert rows(top, "g", "w") == [("t", "a"), ("t", "c"), ("u", "z"), (None, "n")]
    bag = K.collect_top_k(df, "g", "n", 3, ["w", "n"], tie="w", out="top")
    got = {r.g: [(x.w, x.n) for x in r.top] for r in bag.collect()}
    assert got["t"] == [("c", 5), ("a", 3), ("b", 3)]


def _spark_dense_rank(df, by, ascending):
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.withColumn("expected", F.dense_rank().over(Window.orderBy(order)))


def test_dense_rank_equals_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None] + list(range(40)))) for i in range(600)]
    df = spark.createDataFrame(data, "id int, v int")
    for ascending in (False, True):
        want = rows(_spark_dense_rank(df, "v", ascending), "id", "expected")
        for parts in (7, None):
            ranks = K.dense_rank_table(df, "v", "r", ascending=ascending, num_partitions=parts)
            assert rows(K.attach_rank(df, "v", ranks), "id", "r") == want


def test_dense_rank_all_equal_and_single_row(spark):
    df = spark.createDataFrame([(i, 5) for i in range(20)], "id int, v int")
    ranks = K.dense_rank_table(df, "v", "r", num_partitions=4)
    assert {r.r for r in K.attach_rank(df, "v", ranks).collect()} == {1}
    one = spark.createDataFrame([(1, 2.5)], "id int, v double")
    assert K.attach_rank(one, "v", K.dense_rank_table(one, "v", "r")).first().r == 1


def test_dense_rank_has_no_single_partition_window_over_rows(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 37)
    ranks = K.dense_rank_table(df, "v", "r", num_partitions=8)
    ranked = K.attach_rank(df, "v", ranks)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    # the only un-partitioned window runs over the per-partition counts
    assert "SinglePartition" not in plan or plan.count("Window") <= 1
    assert ranked.count() == 1000


def test_default_takes_the_type_of_the_column(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    look = spark.createDataFrame([(1, "07"), (2, "7"), (3, "K1")], "k int, code string")
    got = L.attach(facts, look, "k", "default", {"code": 0})
    assert rows(got, "k", "code") == [(1, "07"), (2, "7"), (3, "K1"), (4, "0")]


def test_nan_is_never_best(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, 1.0), (2, 5.0, 2.0), (3, 4.0, nan)], "k int, v double, w double")
    assert A.best_of(df, "v", tie="k").first().k == 2
    assert A.best_of(df, "v", tie="k", ascending=True).first().k == 3
    gaps = df.selectExpr("k", "v", "w", "1 AS nv", "1 AS nw")
    assert A.biggest_gap(gaps, "v", "w", "nv", "nw", tie="k").first().k == 2


def test_best_of_n_and_ascending(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 2.0), (4, 1.0)], "k int, v double")
    assert rows(A.best_of(df, "v", tie="k", n=2)) == [(1, 3.0), (3, 2.0)]
    assert rows(A.best_of(df, "v", tie="k", ascending=True)) == [(2, 1.0)]


def test_top_k_ascending_and_raw_mean(spark):
    df = spark.createDataFrame([("g", "a", 3), ("g", "b", 1), ("g", "c", 2)], "g string, w string, n int")
    assert rows(K.top_k_per_group(df, "g", "n", 2, tie="w", ascending=True), "w") == [("b",), ("c",)]
    means = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("x", 2.0)], "k string, v double")
    raw = A.mean_count(means, "k", "v", digits=None).first()
    assert abs(raw.avg_rating - 5.0 / 3.0) < 1e-12 and raw.n_ratings == 3
