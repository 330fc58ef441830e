"""Lookup joins: attach with drop/default semantics, de-duplicated lookups,
anti joins for term lists.

Broadcast policy: no operator asks for a broadcast. The planner broadcasts a
side only when its estimated size is under
`spark.sql.autoBroadcastJoinThreshold` and, under adaptive execution, re-checks
the measured shuffle size against
`spark.sql.adaptive.autoBroadcastJoinThreshold`; above either bound the join is
a shuffled sort-merge join, split by skew handling when one key is hot.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import on_release, scratch_path

# Column in which the text readers carry a line's place in its input
# (`with_order=True`): file, start of the block, line in the block.
LINE_ORDER = "line_order"

_HIT = "__quarry_hit"


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    missing: str = "drop",
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add the lookup's columns to every row of `df` by key.

    missing='drop'    -> rows without a lookup match disappear (inner join).
    missing='default' -> they stay; the looked-up columns named in `defaults`
                         get the default (a literal or a Column over `df`),
                         cast to the looked-up column's type (a number as
                         default leaves text ids as they are).
                         A matched row keeps its value even when it is null,
                         as a dictionary `get(key, default)` would.
    """
    keys = _keys(on)
    if missing == "drop":
        return df.join(lookup, keys, "inner")
    if missing != "default":
        raise ValueError("missing must be 'drop' or 'default'")
    marked = lookup.withColumn(_HIT, F.lit(True))
    joined = df.join(marked, keys, "left")
    fills = {}
    for name, value in (defaults or {}).items():
        fill = value if isinstance(value, Column) else F.lit(value)
        fill = fill.cast(lookup.schema[name].dataType)
        fills[name] = F.when(F.col(_HIT).isNull(), fill).otherwise(F.col(name))
    return joined.withColumns(fills).drop(_HIT) if fills else joined.drop(_HIT)


def unique_lookup(
    lookup: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the row with the greatest `order` wins ("a later
    duplicate overwrites an earlier one"). A lookup that carries its lines'
    places (`LINE_ORDER`) is ordered by them, and the places are dropped.
    Rows tied on `order` (or all rows, without one) are decided by their own
    values, greatest first, so the result never depends on task timing.

    Planned as a top-1 window: `WindowGroupLimit` leaves one row per key and
    map task before the shuffle, so a hot key does not land whole in one task."""
    keys = _keys(key)
    placed = LINE_ORDER in lookup.columns and LINE_ORDER not in keys
    values = [c for c in lookup.columns if c not in keys and c != LINE_ORDER]
    order_cols = _keys(order) if order is not None else [LINE_ORDER] if placed else []
    ranks = [F.col(c).desc_nulls_last() for c in order_cols + values]
    if not ranks:
        return lookup.select(*keys).distinct()
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranks))
    return lookup.withColumn("__nth", nth).where(F.col("__nth") == 1).select(*keys, *values)


def place_of(lookup: DataFrame) -> list[str]:
    """The column of the lines' places, where the lookup has it; to be selected
    beside the columns that an analysis needs."""
    return [LINE_ORDER] if LINE_ORDER in lookup.columns else []


def exclude_terms(
    df: DataFrame,
    terms: DataFrame,
    column: str,
    term_column: str | None = None,
) -> DataFrame:
    """Rows of `df` whose `column` is not in the term list (anti join).

    Null values are kept (they match no term) and duplicate terms do not
    multiply rows, as with `LEFT OUTER` + `IS NULL` on a term list."""
    term_column = term_column or column
    right = terms.select(F.col(term_column).alias(column))
    return df.join(right, column, "left_anti")


def skew_safe_lookup(lookup: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """A de-duplicated lookup for a join whose fact side may hold a hot key
    (one key with a large share of all facts).

    The lookup is written to the shared checkpoint folder and read back. Read
    back it carries no partitioning, so the join gets a plain shuffle on both
    sides, the shape in which adaptive execution splits a hot key's partition
    into several tasks. (Joined straight onto the de-duplicating aggregate, the
    lookup side would not be a plain shuffle and the hot partition would stay
    whole.) Its size on disk is known, so the planner broadcasts it while it is
    under the broadcast threshold, and then the facts are not shuffled at all."""
    unique = unique_lookup(lookup, key)
    path = scratch_path(lookup.sparkSession, "lookup")
    unique.write.parquet(path)
    return lookup.sparkSession.read.schema(unique.schema).parquet(path)


@dataclass(frozen=True)
class JoinLayout:
    """Facts and a lookup written as two tables bucketed and sorted alike, so
    that they join bucket by bucket without a shuffle, any number of times."""

    facts: DataFrame
    lookup: DataFrame
    on: tuple[str, ...]

    def attach(
        self, values: Mapping[str, Column], missing: str = "drop", defaults: Mapping[str, object] | None = None
    ) -> DataFrame:
        """The facts with columns made from the lookup's (see `attach`)."""
        lookup = self.lookup.select(*self.on, *[c.alias(name) for name, c in values.items()])
        return attach(self.facts, lookup, self.on, missing, defaults).drop(_SALT)


_SALT = "__salt"


def stage_for_join(
    facts: DataFrame, lookup: DataFrame, key: str | Sequence[str], buckets: int | None = None, salts: int = 8
) -> JoinLayout:
    """Write both sides once in one layout for all joins on `key` that follow.

    The lookup is reduced to one row per key (`unique_lookup`). A key is spread
    over `salts` buckets: each fact has a salt made from its own values, the
    lookup's rows stand once under every salt, so a key that holds a third of
    all facts is read by `salts` tasks. `buckets` (default: the session's shuffle
    partitions) should make a bucket of the facts about 128 MB. Facts are shuffled
    once, here; joins of the layout have no exchange on either side, or broadcast
    the lookup where Spark finds it small.

    The tables are registered in the session's catalog under fresh names; their
    files lie in the shared checkpoint folder (see `scratch_scope`)."""
    spark = facts.sparkSession
    keys = _keys(key)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    on = [*keys, _SALT]
    own = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    sides = {
        "facts": facts.withColumn(_SALT, own),
        "lookup": unique_lookup(lookup, keys).withColumn(_SALT, every),
    }
    tables = {}
    for name, side in sides.items():
        table = f"quarry_{name}_{os.urandom(6).hex()}"
        path = scratch_path(spark, f"bucketed-{name}")
        # dealt out as the buckets are, so each bucket is one file
        dealt = side.repartition(buckets, *on)
        dealt.write.bucketBy(buckets, *on).sortBy(*on).option("path", path).saveAsTable(table, format="parquet")
        on_release(lambda t=table: spark.sql(f"DROP TABLE IF EXISTS {t}"))
        tables[name] = spark.table(table)
    return JoinLayout(tables["facts"], tables["lookup"], tuple(on))
