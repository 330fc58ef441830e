"""Incremental runs of the batch analyses over a folder that keeps receiving
text files (the reference's input form), with Structured Streaming.

The reference has no streaming operator; this module only lets the same
reader and the same mean/count aggregate run incrementally:

  text_stream        file-source stream of positional lines, parsed by the
                     same `split_fields` as the batch reader;
  movie_state_stream per-movie (sum, count) as a streaming aggregate: the
                     state store keeps one row per movie, every micro-batch
                     is partially aggregated before its shuffle;
  run_movie_stats    update mode: after each micro-batch only the movies whose
                     state changed are written, one folder per batch
                     (overwritten on replay); progress and state live in the
                     shared checkpoint folder;
  read_movie_stats   the latest state per movie, titled: the report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.agg import finish_mean, sum_count
from quarry.operators.lookup import attach, unique_lookup
from quarry.session import file_system, scratch_path
from quarry.sources.delimited import split_fields
from quarry.sources.sinks import replace_folder


def text_stream(
    spark: SparkSession,
    folder: str,
    schema: Sequence[tuple[str, str]],
    sep: str = ",",
    on_bad: str = "drop",
    trim: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A streaming DataFrame of the typed fields of every new line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return split_fields(reader.load(folder), schema, sep, on_bad, trim)


def movie_state_stream(ratings: DataFrame) -> DataFrame:
    """Running (movie_id, rating_sum, n_ratings) of a ratings stream."""
    return sum_count(ratings, "movie_id", "rating", "rating_sum", "n_ratings")


def run_movie_stats(
    state: DataFrame,
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    compact_every: int = 100,
):
    """Start the incremental per-movie state; returns the StreamingQuery.

    Update mode: each micro-batch emits only the movies whose running
    (sum, count) changed, written to `out_path/batch_id=<n>` (overwrite, so
    a replayed batch rewrites the same folder). Work per batch grows with
    the keys touched, not with all keys seen so far. `read_movie_stats`
    turns the folders into the report. Every `compact_every` batches the
    folders of committed batches become one (see `compact_batches`), so the
    report reads each movie at most `compact_every` times, however long the
    query has been running. With `available_now` the query
    processes every file present and stops (a catch-up run); otherwise it
    keeps running on new files."""
    spark = state.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            compact_batches(batch.sparkSession, out_path, batch_id - 1)
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def compact_batches(spark: SparkSession, out_path: str, up_to: int) -> None:
    """Replace the folders of batches up to `up_to`, all committed, by one that
    holds the latest state of each movie under that number. The new folder takes
    its place by a rename and the older ones are removed after it; should that
    be cut short, their states are older than the new one's and change nothing."""
    fs, base = file_system(spark, f"{out_path}/batch_id=*")
    folders = {int(s.getPath().getName().split("=")[1]): s.getPath() for s in fs.globStatus(base) or []}
    older = sorted(n for n in folders if n <= up_to)
    if len(older) < 2:
        return
    changes = spark.read.option("basePath", out_path).parquet(*[folders[n].toString() for n in older])
    latest = unique_lookup(changes, "movie_id", order="batch_id").drop("batch_id")
    replace_folder(spark, f"{out_path}/batch_id={older[-1]}", lambda folder: latest.write.parquet(folder))
    for n in older[:-1]:
        fs.delete(folders[n], True)


def read_movie_stats(spark: SparkSession, out_path: str, movies: DataFrame, digits: int = 2) -> DataFrame:
    """The per-movie report from the batch folders: the latest state of each
    movie (highest batch id), titled (movies without a title dropped)."""
    changes = spark.read.parquet(out_path)
    latest = unique_lookup(changes, "movie_id", order="batch_id").drop("batch_id")
    titles = unique_lookup(movies.select("movie_id", "title"), "movie_id")
    named = attach(latest.filter(F.col("n_ratings") > 0), titles, "movie_id", "drop")
    report = finish_mean(named, "rating_sum", "n_ratings", digits)
    return report.select("movie_id", "title", "avg_rating", "n_ratings")
