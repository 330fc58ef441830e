"""Ranking: top-k per group and a dense rank over a whole relation.

`top_k_per_group` is a `row_number()` window followed by `rank <= k`; Spark
turns the pair into a `WindowGroupLimit` that already keeps only k rows per
group inside each map partition, so a group with millions of candidates
shuffles at most k rows per partition.

`dense_rank_table` avoids Spark's un-partitioned window (which moves every
row to a single task): the distinct values are range-partitioned and
sorted, each value's position is its partition's offset plus its position
inside the partition, and the offsets come from one count per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row


def _order(c: str, ascending: bool) -> Column:
    # Same null placement as Spark's defaults for asc / desc window orders.
    return F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last()


def _cols(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def top_k_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    by: str,
    k: int,
    tie: str | Sequence[str] | None = None,
    ascending: bool = False,
    rank_name: str = "rank",
) -> DataFrame:
    """The first k rows of every group by `by` (ties by `tie`, ascending)."""
    w = Window.partitionBy(*_cols(group)).orderBy(
        _order(by, ascending), *[F.col(t).asc_nulls_last() for t in _cols(tie)]
    )
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)


def collect_top_k(
    df: DataFrame,
    group: str | Sequence[str],
    by: str,
    k: int,
    fields: Sequence[str],
    tie: str | Sequence[str] | None = None,
    ascending: bool = False,
    out: str = "top",
) -> DataFrame:
    """Per group, the first k rows as an ordered array of structs (a bag of
    at most k tuples: bounded, whatever the group size)."""
    ranked = top_k_per_group(df, group, by, k, tie, ascending, "__rn")
    items = F.struct(F.col("__rn"), *[F.col(f) for f in fields])
    grouped = ranked.groupBy(*_cols(group)).agg(F.array_sort(F.collect_list(items)).alias(out))
    return grouped.withColumn(
        out, F.transform(out, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    )


def dense_rank_table(
    df: DataFrame,
    by: str,
    out: str,
    ascending: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """(`__v`, out): the dense rank of every distinct value of `by`, as
    `dense_rank() OVER (ORDER BY by)` gives it, by one plan at every size:

    1. distinct values of `by` (shuffle by value, partial aggregation);
    2. range partitioning on the value + sort inside each partition (adaptive
       execution chooses the number of partitions unless `num_partitions` is
       given); each row gets partition index and position from
       `monotonically_increasing_id`; the ranged values are written as a
       parquet table in the shared checkpoint folder (one job; lineage cut,
       survives executor loss) so both uses below read the same partition ids;
    3. one count per written partition -> running offsets, by a window over as
       many rows as there are partitions (values never pass through it);
    4. rank = offset + position + 1.
    """
    spark = df.sparkSession
    order = _order("__v", ascending)
    values = df.select(F.col(by).alias("__v")).distinct()
    ranged = values.repartitionByRange(*([num_partitions] if num_partitions else []), order)
    path = scratch_path(spark, f"rank-{out}")
    ranged.sortWithinPartitions(order).withColumn("__mid", F.monotonically_increasing_id()).write.parquet(path)
    ranged = spark.read.parquet(path).select(
        "__v",
        F.shiftright(F.col("__mid"), 33).alias("__pid"),
        F.col("__mid").bitwiseAND(F.lit(_LOW_BITS)).alias("__pos"),
    )
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__pid")
        .agg(F.count(F.lit(1)).alias("__cnt"))
        .withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
        .select("__pid", "__off")
    )
    return ranged.join(offsets, "__pid").select("__v", (F.col("__off") + F.col("__pos") + 1).alias(out))


def attach_rank(df: DataFrame, by: str, ranks: DataFrame) -> DataFrame:
    """Join a `dense_rank_table` back to the rows on the value (null-safe,
    so a null value gets the rank Spark gives nulls)."""
    return df.join(ranks, df[by].eqNullSafe(ranks["__v"]), "left").drop("__v")
