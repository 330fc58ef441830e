"""Exact duplicates: group by a 128-bit content hash, compare the bytes inside
each group, keep one row of each group.

Plan of `mark_copies`. (1) One aggregate keyed by (hash, normalised text): rows meet by their
128-bit hash, and the aggregate's key comparison is the byte comparison, so
two texts that collide in the hash form two groups. It is combined before the
shuffle: of a group that holds a third of all rows each task sends one row.
Only groups with copies are written, without their text. (2) The rows are
joined to those groups on both digests; the groups are a plain file scan, so
a hot group's rows are split by adaptive execution. Nothing is collected.
`drop_copies` takes the kept rows out of that aggregate itself.

Defined cases: a null text is empty; empty texts are equal to each other; a
null id sorts after all ids; rows that repeat id and text are one document and
get the same mark, as nothing tells them apart, but `drop_copies` keeps one
row only. Other columns are never read by `mark_copies` and pass through
`drop_copies` under any names (but `__tie`).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE_CLASS, staged, text_or_empty

_LAST_ID = 9223372036854775807
_ID_SPAN = Decimal(2**65)  # code points weigh more than any id


def normalised(column: str) -> Column:
    """The text without its white space; null is empty."""
    return F.regexp_replace(text_or_empty(column), SPACE_CLASS + "+", "")


def content_hash(body: Column) -> Column:
    return F.unhex(F.md5(body))


def _digests(df: DataFrame, id_col: str, text_col: str, *kept: Column) -> DataFrame:
    return df.select(
        *kept,
        F.col(id_col).cast("long").alias("id"),
        F.char_length(text_or_empty(text_col)).alias("points"),
        normalised(text_col).alias("body"),
    ).select(
        *[F.col(c) for c in ("row",)[: len(kept)]],
        "id",
        "points",
        "body",
        content_hash(F.col("body")).alias("hash"),
    )


def _order() -> Column:
    """The row with the most code points first, then the smallest id; no id last."""
    points = F.col("points").cast("decimal(11,0)") * F.lit(_ID_SPAN).cast("decimal(20,0)")
    return points - F.coalesce(F.col("id"), F.lit(_LAST_ID)).cast("decimal(20,0)")


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """hash, sha, keep_id, group_size of every group of two rows or more."""
    groups = (
        _digests(df, id_col, text_col)
        .groupBy("hash", "body")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max_by("id", _order()).alias("keep_id"))
        .where(F.col("group_size") > 1)
        .select("hash", F.sha2("body", 256).alias("sha"), "keep_id", "group_size")
    )
    return staged(groups, "copy-groups")


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, keep_id, group_size, kept, text_sha256.
    Of equal normalised texts the row with the most code points stays, then
    the one with the smallest id."""
    groups = copy_groups(df, id_col, text_col)
    rows = _digests(df, id_col, text_col).select("id", "hash", F.sha2("body", 256).alias("sha"))
    in_group = F.col("group_size").isNotNull()
    keep = F.when(in_group, F.col("keep_id")).otherwise(F.col("id"))
    return rows.join(groups, ["hash", "sha"], "left").select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal normalised texts, with all its columns: the
    one with the most code points, then the one with the smallest id. Of rows
    that repeat both (a file read in twice) one stays, chosen by a hash of its
    columns.

    The rows are the value of one aggregate keyed by (hash, normalised text), so
    the comparison of its key is the byte comparison. Each task sends one row of a
    group, however many it holds."""
    hashable = [F.col(name) for name, kind in df.dtypes if "map<" not in kind]
    rows = _digests(df, id_col, text_col, F.struct("*", F.xxhash64(*hashable).alias("__tie")).alias("row"))
    order = F.struct(_order(), F.col("row.__tie"))
    kept = rows.groupBy("hash", "body").agg(F.max_by("row", order).alias("row"))
    return kept.select(*[F.col(f"row.`{c}`") for c in df.columns])
