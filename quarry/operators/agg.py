"""Aggregates: mean and count per key (long or wide), group counts, best-of,
largest gap, distinct counts, summary rows and metric tables.

Every grouping here is a plain `groupBy().agg()`, so Spark plans a partial
(map-side) aggregate before the shuffle: a key holding a third of all rows
costs one partial row per input partition, not one task holding the group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import rounded


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def sum_count(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    sum_name: str = "value_sum",
    count_name: str = "n",
) -> DataFrame:
    """Partial state of a mean: sum and count of non-null values per key."""
    return df.groupBy(*_cols(keys)).agg(
        F.sum(value).alias(sum_name), F.count(value).alias(count_name)
    )


def merge_sum_count(
    df: DataFrame,
    keys: str | Sequence[str],
    sum_name: str = "value_sum",
    count_name: str = "n",
) -> DataFrame:
    """Regroup partial (sum, count) pairs on coarser keys."""
    return df.groupBy(*_cols(keys)).agg(
        F.sum(sum_name).alias(sum_name), F.sum(count_name).alias(count_name)
    )


def mean_of(sum_col: str, count_col: str) -> Column:
    """Raw mean from a (sum, count) pair; null when the count is zero."""
    return F.try_divide(F.col(sum_col), F.col(count_col))


def mean_count(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    digits: int | None = 2,
    avg_name: str = "avg_rating",
    count_name: str = "n_ratings",
    raw_name: str | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean (rounded to `digits`, or raw when None) and count per key;
    `rounding` is 'half_up' or 'python' (see `functions.rounded`)."""
    state = sum_count(df, keys, value, "__s", count_name)
    out = finish_mean(state, "__s", count_name, digits, avg_name, raw_name, rounding)
    return out.select(*_cols(keys), avg_name, count_name, *([raw_name] if raw_name else []))


def finish_mean(
    df: DataFrame,
    sum_col: str,
    count_col: str,
    digits: int | None = 2,
    avg_name: str = "avg_rating",
    raw_name: str | None = None,
    rounding: str = "half_up",
) -> DataFrame:
    raw = mean_of(sum_col, count_col)
    out = {avg_name: raw if digits is None else rounded(raw, digits, rounding)}
    if raw_name:
        out[raw_name] = raw
    return df.withColumns(out)


def mean_count_wide(
    df: DataFrame,
    key: str | Sequence[str],
    category: Column | str,
    value: str,
    categories: Mapping[str, object],
    digits: int | None = 2,
    fill: float | None = 0.0,
    with_counts: bool = True,
    raw: bool = False,
    rounding: str = "half_up",
) -> DataFrame:
    """Mean and count per key with one column pair per category (a pivot
    with a fixed value list, computed as conditional aggregates in one pass).

    `categories` maps an output suffix to the category value. Rows whose
    category is in none of them still make their key appear. An empty cell
    gets `fill` (None keeps null)."""
    cat = F.col(category) if isinstance(category, str) else category
    aggs = []
    for suffix, match in categories.items():
        hit = cat == F.lit(match)
        aggs.append(F.sum(F.when(hit, F.col(value))).alias(f"__s_{suffix}"))
        aggs.append(F.count(F.when(hit, F.col(value))).alias(f"n_{suffix}"))
    wide = df.groupBy(*_cols(key)).agg(*aggs)
    out = {}
    for suffix in categories:
        m = mean_of(f"__s_{suffix}", f"n_{suffix}")
        if raw:
            out[f"raw_avg_{suffix}"] = m
        m = m if digits is None else rounded(m, digits, rounding)
        out[f"avg_{suffix}"] = F.coalesce(m, F.lit(fill)) if fill is not None else m
    wide = wide.withColumns(out).drop(*[f"__s_{s}" for s in categories])
    if not with_counts:
        wide = wide.drop(*[f"n_{s}" for s in categories])
    return wide


def count_by(
    df: DataFrame,
    keys: str | Sequence[str],
    count_col: str | None = None,
    name: str = "n",
) -> DataFrame:
    """Rows per group. With `count_col`, rows whose `count_col` is null are
    not counted (a bag COUNT skips tuples with a null first field)."""
    counter = F.count(count_col) if count_col else F.count(F.lit(1))
    return df.groupBy(*_cols(keys)).agg(counter.alias(name))


def best_of(
    df: DataFrame,
    by: str,
    tie: str | Sequence[str] | None = None,
    min_count: int | None = None,
    count_col: str | None = None,
    ascending: bool = False,
    n: int = 1,
) -> DataFrame:
    """The best `n` rows by `by` (optionally among rows with
    `count_col >= min_count`); ties go to the smallest `tie` key. Planned as
    a top-n (`TakeOrderedAndProject`): each partition keeps n rows. A NaN is
    compared like a missing value: never better than a number."""
    if min_count is not None:
        df = df.filter(F.col(count_col) >= min_count)
    value = F.col(by)
    if df.schema[by].dataType.typeName() in ("double", "float"):
        value = F.nanvl(value, F.lit(None).cast("double"))
    primary = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    ties = [F.col(t).asc_nulls_last() for t in _cols(tie or [])]
    return df.orderBy(primary, *ties).limit(n)


def biggest_gap(
    wide: DataFrame,
    a: str,
    b: str,
    count_a: str,
    count_b: str,
    tie: str | Sequence[str] | None = None,
    out: str = "gap",
) -> DataFrame:
    """Row with the largest |a - b| among rows where both sides have data."""
    both = wide.filter((F.col(count_a) > 0) & (F.col(count_b) > 0))
    gapped = both.withColumn(out, F.abs(F.col(a) - F.col(b)))
    return best_of(gapped, out, tie=tie)


def count_distinct_with_null(c: str) -> Column:
    """Exact number of distinct values, a null counted as one more value
    (what `select(c).distinct().count()` reports), in the same aggregate."""
    has_null = F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0))
    return (F.count_distinct(F.col(c)) + has_null).cast("bigint")


def distinct_state(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """Mergeable exact state of count(distinct value) per key, for whole-number
    ids: one 64-bit word per key and range of 64 ids (key columns, `bucket`,
    `bitmap`). Nulls are not counted. Ids that lie close together share a word;
    of scattered ids each costs one, so a state has never more rows than there
    are distinct pairs of key and id. Words are built before the shuffle, so a
    key that holds a third of all rows sends one word per task and range."""
    ids = F.col(value).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), ids.bitwiseAND(63).cast("int"))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*[F.col(k) for k in _cols(keys)], F.shiftright(ids, 6).alias("bucket"))
        .agg(F.bit_or(bit).alias("bitmap"))
    )


def merge_distinct(state: DataFrame, keys: str | Sequence[str] = ()) -> DataFrame:
    """The state of coarser keys (or, without any, of all rows) from a finer
    one, or of the union of several days' states."""
    kept = _cols(keys)
    return state.groupBy(*kept, "bucket").agg(F.bit_or("bitmap").alias("bitmap"))


def count_of_distinct_state(state: DataFrame, keys: str | Sequence[str] = (), name: str = "n") -> DataFrame:
    """The exact distinct counts that a state (one row per key and bucket) stands
    for; one row in all without keys."""
    counted = F.coalesce(F.sum(F.bit_count("bitmap")), F.lit(0)).alias(name)
    kept = _cols(keys)
    return state.groupBy(*kept).agg(counted) if kept else state.agg(counted)


def with_summary_row(detail: DataFrame, summary: DataFrame) -> DataFrame:
    """Detail rows followed by summary rows in one relation (UNION ALL)."""
    return detail.unionByName(summary, allowMissingColumns=True)


def metrics_table(df: DataFrame, metrics: Mapping[str, Column], value_type: str = "bigint") -> DataFrame:
    """One aggregate over `df` turned into (metric, value) rows, with no
    driver round trip: aggregate once, then unpivot."""
    row = df.agg(*[expr.cast(value_type).alias(f"m{i}") for i, expr in enumerate(metrics.values())])
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")) for i, name in enumerate(metrics)]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.metric", "p.value")
