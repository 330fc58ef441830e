"""Frequent items found from a small summary, then counted exactly.

Counting every item of a long-tailed column sends one row per distinct item
and map task through the shuffle, though a report keeps a handful. Here a
first pass counts items only by hash bucket, a fixed number of buckets per
group. Bucket sums are a mergeable summary (two parts add up) with a rigorous
bound: no item occurs more often than its bucket. Only items of buckets that
reach the threshold are then counted exactly; the tail never leaves its task.

Results are always those of counting everything. Where the bounds do not
separate (a flat distribution, all buckets alike) more items, in the worst
case all, are counted exactly; nothing is estimated.

The input is read two or three times, so these forms pay where the shuffle of
the tail costs more than reading again; write the tokens first (`stage`) where
making them is expensive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.rank import top_k_per_group
from quarry.session import scratch_path

BUCKETS = 4096
_BUCKET = "__bucket"


def _cols(keys: str | Sequence[str] | None) -> list[str]:
    return [] if keys is None else [keys] if isinstance(keys, str) else list(keys)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(item: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(item)), F.lit(buckets)).cast("int")


def bucket_sums(df: DataFrame, item: str, keys: str | Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The summary: rows per key and hash bucket of the item (`n`), at most
    `buckets` rows per key. Summaries of parts of a table are added by key and
    bucket."""
    return df.groupBy(*_cols(keys), bucket_of(item, buckets).alias(_BUCKET)).agg(F.count(F.lit(1)).alias("n"))


def _matched(df: DataFrame, chosen: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key, a null one included, is in `chosen`."""
    renamed = chosen.select(*[F.col(c).alias(f"__{c}") for c in on])
    same = [df[c].eqNullSafe(renamed[f"__{c}"]) for c in on]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return df.join(renamed, condition, "left_semi")


def candidates(
    df: DataFrame, item: str, chosen: DataFrame, keys: str | Sequence[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Rows whose item falls in one of the chosen (key, bucket) pairs. There are
    at most `buckets` pairs per key; Spark broadcasts them where they are small."""
    rows = df.withColumn(_BUCKET, bucket_of(item, buckets))
    return _matched(rows, chosen, [*_cols(keys), _BUCKET]).drop(_BUCKET)


def frequent_over(df: DataFrame, item: str, threshold: int, name: str = "n", buckets: int = BUCKETS) -> DataFrame:
    """Items that occur in more than `threshold` rows, with their exact count."""
    heavy = _written(bucket_sums(df, item, None, buckets).where(F.col("n") > threshold), "heavy-buckets")
    counted = candidates(df, item, heavy, None, buckets).groupBy(item).agg(F.count(F.lit(1)).alias(name))
    return counted.where(F.col(name) > threshold)


def frequent_top_k(
    df: DataFrame,
    keys: str | Sequence[str],
    item: str,
    k: int,
    name: str = "n",
    buckets: int = BUCKETS,
    first: int | None = None,
) -> DataFrame:
    """Per key the `k` items with the most rows (ties: the smaller item), with
    their exact counts and `rank`.

    The items of the `first` (default 4 * k) fullest buckets of a key are counted
    first. Their k-th count is a lower bound of the true k-th count, so only
    items in buckets of at least that sum can still be among the k; those are
    counted too. A key with fewer than k items in its fullest buckets has no
    bound, and all its items are counted."""
    kept = _cols(keys)
    if not kept:
        raise ValueError("frequent_top_k needs a key; for one ranking over all rows use frequent_over")
    first = first or 4 * k
    sums = _written(bucket_sums(df, item, kept, buckets), "bucket-sums")
    by_sum = Window.partitionBy(*kept).orderBy(F.desc("n"), _BUCKET)
    fullest = sums.withColumn("__nth", F.row_number().over(by_sum)).where(F.col("__nth") <= first)
    fullest = _written(fullest.select(*kept, _BUCKET), "fullest-buckets")
    some = candidates(df, item, fullest, kept, buckets).groupBy(*kept, item).agg(F.count(F.lit(1)).alias(name))
    some = _written(some, "first-counts")
    bound = top_k_per_group(some, kept, name, k, tie=item).where(F.col("rank") == k)
    bound = bound.select(*[F.col(c).alias(f"__{c}") for c in kept], F.col(name).alias("__least"))
    same = F.lit(True)
    for c in kept:
        same = same & sums[c].eqNullSafe(F.col(f"__{c}"))
    reaching = sums.join(bound, same, "left").where(F.col("n") >= F.coalesce("__least", F.lit(0)))
    more = _written(reaching.select(*kept, _BUCKET).exceptAll(fullest), "reaching-buckets")
    rest = candidates(df, item, more, kept, buckets).groupBy(*kept, item).agg(F.count(F.lit(1)).alias(name))
    return top_k_per_group(some.unionByName(rest), kept, name, k, tie=item)
