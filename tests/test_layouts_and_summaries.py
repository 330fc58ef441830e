"""Join layouts, partitioned stages, summaries, distinct states, observed
reports: results as without them, and the plans they are for."""

from __future__ import annotations

import contextlib
import random
from collections import Counter
from datetime import datetime

import pytest
from quarry_test_helpers import SF_SMALL, rows

from quarry.operators import heavy
from quarry.operators.agg import count_of_distinct_state, distinct_state, merge_distinct
from quarry.operators.lookup import stage_for_join
from quarry.plans import commerce, ratings
from quarry.roles import role
from quarry.session import scratch_scope


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_ratings(spark, n=30_000):
    data = [(0 if i % 3 == 0 else 1 + i % 997, i % 50, float(1 + i % 5), datetime(2020, 1, 1)) for i in range(n)]
    made = spark.createDataFrame(data, "user_id bigint, movie_id bigint, rating double, rated_at timestamp_ntz")
    users = spark.createDataFrame(
        [(u, "MF"[u % 2], 20 + u % 40, u % 9) for u in range(0, 900)] + [(5, "F", 99, 1)],
        "user_id bigint, gender string, age int, occupation_id int",
    )
    movies = spark.createDataFrame([(m, f"m{m}", "A") for m in range(50)], "movie_id bigint, title string, genres string")
    return made, users, movies


def test_layout_joins_without_a_shuffle(spark):
    rated, users, _ = hot_ratings(spark)
    with conf(spark, **NO_BROADCAST), scratch_scope():
        layout = ratings.stage_ratings_with_users(rated, users, buckets=6)
        joined = layout.attach({"gender": layout.lookup["gender"]})
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        assert "Bucketed: true" in joined._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert joined.count() == rated.where("user_id < 900").count()
        assert layout.attach({"gender": layout.lookup["gender"]}, "default", {"gender": "?"}).count() == rated.count()


def test_layout_gives_both_analyses_and_spreads_a_hot_user(spark):
    rated, users, movies = hot_ratings(spark)
    once = users.where("not (user_id = 5 and age = 99)").unionAll(users.where("user_id = 5 and age = 99").limit(0))
    with conf(spark, **NO_BROADCAST), scratch_scope():
        layout = ratings.stage_ratings_with_users(rated, once, buckets=8, salts=8)
        assert rows(ratings.movie_gender_wide(None, None, movies, layout=layout)) == rows(
            ratings.movie_gender_wide(rated, once, movies)
        )
        for closed in ("right", "left"):
            assert rows(ratings.movie_age_wide(None, None, movies, closed=closed, layout=layout)) == rows(
                ratings.movie_age_wide(rated, once, movies, closed=closed)
            )
        sizes = [len(p) for p in layout.facts.where("user_id = 0").select("user_id").rdd.glom().collect()]
        assert sum(sizes) == 10_000 and max(sizes) < 6_000  # a third of all rows, in several buckets


def test_layout_counts_repeated_facts_and_lookups_once(spark):
    facts = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z"), (3, "w")], "k int, v string")
    look = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, name string")
    with scratch_scope():
        layout = stage_for_join(facts, look, "k", buckets=3, salts=2)
        got = layout.attach({"name": layout.lookup["name"]}, "default", {"name": "-"})
        assert rows(got, "k", "v", "name") == sorted(
            [(1, "x", "b"), (1, "x", "b"), (2, "y", "c"), (None, "z", "-"), (3, "w", "-")], key=repr
        )
        assert got.columns == ["k", "v", "name"]


def test_only_the_years_of_the_range_are_read(spark):
    orders, items, products = (role(spark, SF_SMALL, r) for r in ("shop_orders", "shop_items", "shop_products"))
    lines = commerce.stage_lines_by_year(orders, items)
    out = commerce.revenue_by_category_between(orders, lines, products, "1996-07-01", "1997-04-15")
    plan = out._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()
    whole = commerce.revenue_by_category_between(orders, lines, products, "1998-01-01", "1999-01-01")
    assert rows(whole) == rows(commerce.revenue_by_category(orders, items, products, 1998))
    assert rows(commerce.revenue_by_category_between(orders, lines, products, "1900-01-01", "1900-02-01")) == []


def zipf(rng, n, size, flat=False):
    weights = [1.0 if flat else 1 / (1 + i) for i in range(size)]
    return [(rng.choice(["g", "h", None]), f"w{i}") for i in rng.choices(range(size), weights, k=n)]


@pytest.mark.parametrize("flat", [False, True])
@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_frequent_items_equal_full_counts(spark, flat, buckets):
    data = zipf(random.Random(2), 6000, 800, flat) + [("few", "a"), ("few", "b"), ("few", "b"), ("h", None)]
    df = spark.createDataFrame(data, "topic string, word string").repartition(4)
    words = Counter(w for _, w in data)
    for threshold in (0, 20, 10**6):
        got = rows(heavy.frequent_over(df, "word", threshold, buckets=buckets))
        assert got == sorted(((w, n) for w, n in words.items() if n > threshold), key=repr)
    got = rows(heavy.frequent_top_k(df, "topic", "word", 3, buckets=buckets), "topic", "word", "n", "rank")
    want = []
    for topic in {t for t, _ in data}:
        counts = Counter(w for t, w in data if t == topic)
        best = sorted(counts.items(), key=lambda c: (-c[1], c[0] is None, c[0] or ""))[:3]
        want += [(topic, w, n, i + 1) for i, (w, n) in enumerate(best)]
    assert got == sorted(want, key=repr)


def test_the_tail_is_not_counted(spark):
    data = zipf(random.Random(3), 20_000, 9000)
    df = spark.createDataFrame(data, "topic string, word string")
    heavy_buckets = heavy.bucket_sums(df, "word").where("n > 200")
    left = heavy.candidates(df, "word", heavy_buckets).select("word").distinct().count()
    assert left < 0.05 * df.select("word").distinct().count()


def test_summaries_of_parts_add_up(spark):
    data = zipf(random.Random(4), 3000, 300)
    whole = spark.createDataFrame(data, "topic string, word string")
    halves = [spark.createDataFrame(half, whole.schema) for half in (data[:1500], data[1500:])]
    parts = [heavy.bucket_sums(h, "word", "topic", 64) for h in halves]
    merged = parts[0].unionAll(parts[1]).groupBy("topic", "__bucket").agg({"n": "sum"})
    assert rows(merged) == rows(heavy.bucket_sums(whole, "word", "topic", 64))


def test_distinct_states_merge_exactly(spark):
    rng = random.Random(5)
    ids = [0, 1, 32767, 32768, 32769, 65536, 10**12, 10**12 + 1, -1, -32768, -32769, 7]
    data = [(rng.choice(["a", "b", None]), rng.choice([*ids, None])) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, v bigint")
    state = distinct_state(df, "k", "v")
    want = {k: len({v for x, v in data if x == k and v is not None}) for k in ("a", "b", None)}
    assert dict(rows(count_of_distinct_state(state, "k"))) == want
    total = len({v for _, v in data if v is not None})
    assert rows(count_of_distinct_state(merge_distinct(state))) == [(total,)]
    # states of two days, merged
    days = [distinct_state(spark.createDataFrame(d, df.schema), "k", "v") for d in (data[:200], data[200:])]
    merged = merge_distinct(days[0].unionAll(days[1]), "k")
    assert dict(rows(count_of_distinct_state(merged, "k"))) == want
    assert rows(count_of_distinct_state(distinct_state(df.limit(0), "k", "v"))) == [(0,)]


def test_distinct_state_of_scattered_ids_is_no_larger_than_its_pairs(spark):
    rng = random.Random(6)
    edges = [0, 62, 63, 64, -1, -63, -64, -65, 2**63 - 1, -(2**63)]
    pairs = {(rng.randrange(40), rng.randrange(-(2**62), 2**62)) for _ in range(2000)} | {(1, v) for v in edges}
    df = spark.createDataFrame([*pairs, *list(pairs)[:500]], "k int, v bigint")
    state = distinct_state(df, "k", "v")
    assert state.toArrow().nbytes < 40 * len(pairs)
    assert merge_distinct(state).toArrow().nbytes < 40 * len(pairs)
    assert "SortAggregate" not in plan_of(merge_distinct(state))  # words are combined in place, nothing is sorted first
    assert dict(rows(count_of_distinct_state(state, "k"))) == Counter(k for k, _ in pairs)
    assert rows(count_of_distinct_state(merge_distinct(state))) == [(len({v for _, v in pairs}),)]


def test_distinct_state_packs_ids_that_lie_close(spark):
    hot = spark.range(0, 64_000, 1, 3).selectExpr("'hot' AS k", "id AS v")
    state = distinct_state(hot.unionAll(hot), "k", "v")
    assert state.count() == 1000 and rows(count_of_distinct_state(state, "k")) == [("hot", 64_000)]


def test_distinct_orders_of_scattered_sellers(spark):
    rng = random.Random(7)
    lines = [(rng.choice([None, *range(300)]), rng.choice([None, *range(0, 10**9, 10**6)])) for _ in range(4000)]
    with scratch_scope():
        got = rows(commerce.distinct_orders(spark.createDataFrame([*lines, *lines[:900]], "seller_id bigint, order_id bigint")))
    per_seller = Counter(s for s, o in {x for x in lines if None not in x})
    assert got == sorted([*per_seller.items(), (None, len({o for _, o in lines} - {None}))], key=repr)


def test_observed_report_reads_its_rows_once(spark):
    rated, _, movies = hot_ratings(spark, 3000)
    report, seen = ratings.movie_report_observed(rated, movies)
    assert rows(report) == rows(ratings.movie_report_with_best(rated, movies))
    assert (seen.n_movies, seen.n_ratings) == (50, 3000)
    best = ratings.best_movie(rated, movies).first()
    assert seen.best.movie_id == best.movie_id
    report, seen = ratings.movie_report_observed(rated.limit(0), movies)
    assert rows(report) == [] and seen.best is None
    _, seen = ratings.movie_report_observed(rated, movies, min_count=10**6)
    assert seen.best is None and seen.n_movies == 50
