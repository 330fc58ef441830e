"""Later lines win by their place in the text; rounding as Python rounds."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F
from quarry_test_helpers import rows

from quarry.functions.scalar import round_python, rounded
from quarry.operators.agg import mean_count
from quarry.operators.lookup import LINE_ORDER, unique_lookup
from quarry.plans import ratings as R
from quarry.sources import read_delimited, read_lines, sort_out
from quarry.sources.formats import read_movies, read_ratings, read_users


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_later_line_wins_though_it_is_smaller(spark, tmp_path):
    path = write(tmp_path / "movies.txt", ["1,Zebra,Z|Y", "2,Only,A", "1,Apple,B", "3,x,C", "3,w,D", "3,v,E"])
    movies = read_movies(spark, path, with_order=True)
    kept = unique_lookup(movies, "movie_id")
    assert rows(kept) == [("1", "Apple", "B"), ("2", "Only", "A"), ("3", "v", "E")]
    # without places the greatest value decides, and each column for itself
    assert rows(unique_lookup(read_movies(spark, path).select("movie_id", "title"), "movie_id"))[0] == ("1", "Zebra")


def test_places_follow_the_lines_over_many_blocks_and_files(spark, tmp_path):
    n = 4000
    first = write(tmp_path / "a.txt", [f"{i % 50},a{i}" for i in range(n)])
    second = write(tmp_path / "b.txt", [f"{i % 40},b{i}" for i in range(n)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        # the paths' order counts, not their names'
        lines = read_delimited(spark, [second, first], [("k", "int"), ("v", "string")], with_order=True)
        assert lines.rdd.getNumPartitions() > 10
        got = dict(rows(unique_lookup(lines, "k")))
        places = [r.value for r in read_lines(spark, [second, first], True).orderBy(LINE_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {k: f"a{max(i for i in range(n) if i % 50 == k)}" for k in range(50)}
    assert places == [f"{i % 40},b{i}" for i in range(n)] + [f"{i % 50},a{i}" for i in range(n)]


def test_analyses_take_the_later_line(spark, tmp_path):
    ratings = read_ratings(spark, write(tmp_path / "r.txt", ["u1,1,4,10", "u2,1,2,10", "u1,2,5,10"]))
    movies = read_movies(spark, write(tmp_path / "m.txt", ["1,Zz,Old", "2,B,X", "1,Aa,New"]), with_order=True)
    users = read_users(spark, write(tmp_path / "u.txt", ["u1,M,60,1", "u2,F,30,1", "u1,F,20,1"]), with_order=True)
    assert rows(R.movie_rating_stats(ratings, movies)) == [("1", "Aa", 3.0, 2), ("2", "B", 5.0, 1)]
    assert rows(R.genre_rating(ratings, movies)) == [("New", 3.0, 2), ("X", 5.0, 1)]
    wide = rows(R.movie_gender_wide(ratings, users, movies))
    assert wide == [("1", "Aa", 0.0, 0, 3.0, 2), ("2", "B", 0.0, 0, 5.0, 1)]
    assert rows(R.movie_age_wide(ratings, users, movies), "movie_id", "avg_18_35") == [("1", 3.0), ("2", 5.0)]
    assert rows(R.movie_rating_with_genres(ratings, movies), "title", "genres") == [("Aa", "New"), ("B", "X")]


def test_lookup_is_a_top_one_window(spark, tmp_path):
    movies = read_movies(spark, write(tmp_path / "m.txt", ["1,A,B"]), with_order=True)
    plan = unique_lookup(movies, "movie_id")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "SortAggregate" not in plan


def test_blank_lines_skipped_or_bad(spark, tmp_path):
    path = write(tmp_path / "x.txt", ["1,2", "", "  ", "3,4"])
    schema = [("a", "int"), ("b", "int")]
    assert rows(read_delimited(spark, path, schema)) == [(1, 2), (3, 4)]
    assert rows(read_delimited(spark, path, schema, skip_blank=False)) == [(1, 2), (3, 4)]
    kept = read_delimited(spark, path, schema, on_bad="null", skip_blank=False)
    assert rows(kept).count((None, None)) == 2
    assert len(read_delimited(spark, path, schema, on_bad="fail").collect()) == 2
    with pytest.raises(Exception, match="too few fields"):
        read_delimited(spark, path, schema, on_bad="fail", skip_blank=False).collect()


def test_one_parse_sorts_rows_and_rejects(spark, tmp_path):
    path = write(tmp_path / "x.txt", ["1,2.5", "x,1", "7", "", "2,NaN", "3,4,5", "y,z"])
    schema = [("a", "int"), ("b", "double")]
    good, bad, counts = sort_out(spark, path, schema)
    assert rows(good) == rows(read_delimited(spark, path, schema)) == [(1, 2.5), (3, 4.0)]
    assert rows(bad) == [("2,NaN", "unparsable b"), ("7", "too few fields"), ("x,1", "unparsable a"), ("y,z", "unparsable a")]
    assert rows(counts) == [("too few fields", 1), ("unparsable a", 2), ("unparsable b", 1)]
    assert "verdict=good" in good.inputFiles()[0] or good.inputFiles()
    plan = good._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan and "regexp" not in plan.lower()


def test_one_parse_of_clean_and_of_empty_text(spark, tmp_path):
    schema = [("a", "int"), ("b", "string")]
    good, bad, counts = sort_out(spark, write(tmp_path / "c.txt", ["1,x"]), schema)
    assert (rows(good), rows(bad), rows(counts)) == ([(1, "x")], [], [])
    (tmp_path / "e.txt").write_text("")
    good, bad, counts = sort_out(spark, str(tmp_path / "e.txt"), schema)
    assert (rows(good), rows(bad), rows(counts)) == ([], [], [])


def odd_doubles():
    rng = random.Random(11)
    values = [rng.randint(0, 5 * n) / n for n in (rng.randint(1, 4000) for _ in range(60_000))]
    values += [rng.randint(0, 2000) / 8 for _ in range(3000)]  # many exact ties
    values += [rng.randint(-(10**6), 10**6) / 200 for _ in range(10_000)]  # near ties
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 17) for _ in range(27_000)]
    for e in range(-12, 48):  # both sides of every power of two
        values += [2.0**e, math.nextafter(2.0**e, 0), math.nextafter(2.0**e, math.inf), -(2.0**e)]
    values += [0.125, 0.375, 2.675, 1.005, 0.005, 0.015, 0.0, -0.0, -0.001, 1e300, 5e-324, 0.0049999999999999999]
    return values


def test_python_rounding_of_100_000_doubles(spark):
    values = odd_doubles()
    assert len(values) > 100_000
    df = spark.createDataFrame([(v,) for v in values], "x double")
    bits = lambda v: struct.pack("d", v)
    for digits in (0, 1, 2):
        got = df.select("x", round_python("x", digits).alias("r")).collect()
        wrong = [(r.x, r.r, round(r.x, digits)) for r in got if bits(r.r) != bits(float(round(r.x, digits)))]
        assert not wrong, (digits, len(wrong), wrong[:5])


def test_python_rounding_of_no_numbers(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    got = [r[0] for r in df.select(round_python("x")).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [float("inf"), float("-inf")]
    with pytest.raises(ValueError):
        round_python("x", 3)
    with pytest.raises(ValueError):
        rounded("x", 2, "up")


def test_rounding_is_a_parameter_of_the_means(spark):
    df = spark.createDataFrame([("a", v) for v in (0, 0, 0, 0, 0, 0, 0, 1)] + [("b", 1), ("b", 2)], "k string, v int")
    assert rows(mean_count(df, "k", "v")) == [("a", 0.13, 8), ("b", 1.5, 2)]
    assert rows(mean_count(df, "k", "v", rounding="python")) == [("a", 0.12, 8), ("b", 1.5, 2)]
    assert "ArrowEvalPython" not in df.select(round_python(F.col("v")))._jdf.queryExecution().toString()
