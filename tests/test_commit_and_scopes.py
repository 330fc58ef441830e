"""Results replaced without loss; written folders that go with their scope."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from quarry_test_helpers import SF_SMALL, rows

import __spark_entry__ as entry
from quarry.session import checkpoint_dir, scratch_scope
from quarry.sources import read_delimited, recover_folder, replace_folder, write_csv, write_delimited

SCHEMA = [("k", "string"), ("n", "bigint")]


def read(spark, path):
    return read_delimited(spark, path, SCHEMA, "\t", on_bad="fail")


def table(spark, n, k="a"):
    return spark.createDataFrame([(f"{k}{i}", i) for i in range(n)], "k string, n bigint")


def failing(spark):
    """Rows of which some are written before the job fails."""
    return spark.range(0, 1000, 1, 8).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") == 990, F.raise_error(F.lit("half-way")).cast("bigint")).otherwise(F.col("id")).alias("n"),
    )


def test_old_result_stays_when_the_job_fails(spark, tmp_path):
    path = str(tmp_path / "report")
    write_delimited(table(spark, 5), path, commit="rename")
    with pytest.raises(Exception, match="half-way"):
        write_delimited(failing(spark), path, commit="rename")
    assert rows(read(spark, path)) == rows(table(spark, 5))
    assert os.listdir(tmp_path) == ["report"]  # nothing unfinished lies beside it
    write_delimited(table(spark, 3, "b"), path, commit="rename")
    assert rows(read(spark, path)) == rows(table(spark, 3, "b"))
    assert os.listdir(tmp_path) == ["report"]


def test_plain_overwrite_loses_it(spark, tmp_path):
    """What the rename is for."""
    path = str(tmp_path / "report")
    write_delimited(table(spark, 5), path)
    with pytest.raises(Exception, match="half-way"):
        write_delimited(failing(spark), path)
    assert not os.path.exists(path) or rows(read(spark, path)) != rows(table(spark, 5))


def test_a_result_may_be_computed_from_the_one_it_replaces(spark, tmp_path):
    path = str(tmp_path / "report")
    write_delimited(table(spark, 4), path, commit="rename")
    for _ in range(2):
        write_delimited(read(spark, path).withColumn("n", F.col("n") + 10), path, commit="rename")
    assert rows(read(spark, path), "n") == [(20,), (21,), (22,), (23,)]


def test_interrupted_replacement_is_recovered(spark, tmp_path):
    path = tmp_path / "report"
    write_csv(table(spark, 4), str(path), commit="rename")
    before = rows(spark.read.option("header", True).csv(str(path)))
    os.rename(path, f"{path}.old-cut")  # the process died between the two renames
    os.makedirs(f"{path}.new-cut")
    assert recover_folder(spark, str(path))
    assert rows(spark.read.option("header", True).csv(str(path))) == before
    assert os.listdir(tmp_path) == ["report"]
    assert not recover_folder(spark, str(path))


def test_commit_is_checked_before_anything_is_written(spark, tmp_path):
    with pytest.raises(ValueError):
        write_delimited(table(spark, 1), str(tmp_path / "x"), commit="maybe")
    assert os.listdir(tmp_path) == []
    with pytest.raises(RuntimeError):
        replace_folder(spark, str(tmp_path / "x"), lambda folder: (_ for _ in ()).throw(RuntimeError("no")))
    assert os.listdir(tmp_path) == []


def folders(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return {x for x in os.listdir(base) if x.startswith("quarry-")}


@pytest.mark.parametrize("name", ["seller_ranking", "gender_and_age_from_layout", "movie_gender_wide", "distinct_orders"])
def test_written_folders_go_with_their_scope(spark, name):
    before, tables = folders(spark), {t.name for t in spark.catalog.listTables()}
    with scratch_scope():
        got = rows(entry.queries()[name](spark, SF_SMALL))
        assert folders(spark) > before
    assert folders(spark) == before and {t.name for t in spark.catalog.listTables()} == tables
    # without a scope they stay, and so does the lazy result
    left = entry.queries()[name](spark, SF_SMALL)
    assert rows(left) == got and folders(spark) > before


def test_scopes_nest_and_survive_errors(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), scratch_scope():
        entry.queries()["seller_ranking"](spark, SF_SMALL)
        outer = folders(spark) - before
        with scratch_scope():
            entry.queries()["seller_ranking"](spark, SF_SMALL)
        assert folders(spark) - before == outer
        raise ZeroDivisionError
    assert folders(spark) == before


def test_shipped_package_is_found_by_the_workers(tmp_path):
    """From another folder, without PYTHONPATH, as on a cluster's nodes."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from quarry.session import get_session, ship_package
spark = get_session("local[1]", "ship", 1, {{"spark.checkpoint.dir": {str(tmp_path)!r}}})
work = lambda _: __import__("quarry.functions.scalar").__name__
try:
    spark.range(1).rdd.map(work).collect()
    print("found before")
except Exception:
    pass
ship_package(spark)
print(spark.range(1).rdd.map(work).collect())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert done.stdout.strip().splitlines()[-1] == "['quarry']", done.stderr[-2000:]
