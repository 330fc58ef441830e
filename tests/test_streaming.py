"""Incremental per-movie stats: state carries across runs as files arrive."""

from __future__ import annotations

import os
import tempfile

from quarry_test_helpers import rows

from quarry.plans.files import RATINGS_SCHEMA
from quarry.streaming import movie_state_stream, read_movie_stats, run_movie_stats, text_stream
from quarry.streaming.incremental import compact_batches


def test_state_carries_across_runs(spark):
    base = tempfile.mkdtemp(prefix="quarry-stream-")
    src, out, ckpt = (os.path.join(base, n) for n in ("src", "out", "ckpt"))
    os.makedirs(src)
    movies = spark.createDataFrame([(10, "Ten"), (11, "Eleven")], "movie_id bigint, title string")

    def run():
        stream = text_stream(spark, src, RATINGS_SCHEMA)
        run_movie_stats(movie_state_stream(stream), out, checkpoint=ckpt).awaitTermination()
        return rows(read_movie_stats(spark, out, movies))

    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("1,10,4.0,0\n2,10,2.0,0\nbad,line\n")
    assert run() == [(10, "Ten", 3.0, 2)]
    with open(os.path.join(src, "b.txt"), "w") as fh:
        fh.write("3,10,5.0,0\n4,11,1.0,0\n5,99,1.0,0\n")
    assert run() == [(10, "Ten", 3.67, 3), (11, "Eleven", 1.0, 1)]
    # the second batch wrote only the movies it touched
    second = spark.read.parquet(out).filter("batch_id = 1")
    assert sorted(r.movie_id for r in second.collect()) == [10, 11, 99]


def test_compaction_keeps_the_latest_states(spark, tmp_path):
    src, out, ckpt = (tmp_path / n for n in ("src", "out", "ckpt"))
    src.mkdir()
    movies = spark.createDataFrame([(m, f"m{m}") for m in range(5)], "movie_id bigint, title string")
    for n in range(7):
        (src / f"{n}.txt").write_text(f"1,{n % 5},{n + 1}.0,0\n2,0,1.0,0\n")
        stream = text_stream(spark, str(src), RATINGS_SCHEMA)
        run_movie_stats(movie_state_stream(stream), str(out), checkpoint=str(ckpt), compact_every=3).awaitTermination()
    left = sorted(x for x in os.listdir(out) if x.startswith("batch_id="))
    assert left == ["batch_id=5", "batch_id=6"]  # batches 0 to 2 and then 2 to 5 became one
    got = rows(read_movie_stats(spark, str(out), movies))
    assert got == [(0, "m0", 1.56, 9), (1, "m1", 4.5, 2), (2, "m2", 3.0, 1), (3, "m3", 4.0, 1), (4, "m4", 5.0, 1)]
    compact_batches(spark, str(out), 6)
    assert rows(read_movie_stats(spark, str(out), movies)) == got
    assert [x for x in os.listdir(out) if x.startswith("batch_id=")] == ["batch_id=6"]
