"""Helpers shared by the operators: written intermediates, row keys, folds.

A written intermediate lives in the folder that `spark.checkpoint.dir` names,
so every executor reads the same copy and a lost executor costs a re-read, not
a recomputation of everything before it. A table read back from there is also
a plain file scan: a join on it gets a plain shuffle on both sides, which
adaptive execution can split when one key is hot, and Spark broadcasts it only
when its real size on disk is under `spark.sql.autoBroadcastJoinThreshold`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

# The six white-space characters [\x20\x09-\x0D] that separate words.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

FOLDS = 5
BATCH_BYTES = 8 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a fresh folder of the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """`df`, a table that grows with the corpus, as the side of a join with
    texts: joined by the same shuffle at every size, small inputs included."""
    return df.hint("merge")


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of at most BATCH_BYTES."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits that name a row by its id and its whole text, as two longs in
    a struct. Rows that repeat id and text share it, and every operator gives
    such rows the same result."""
    text = text_or_empty(text_col)
    return F.struct(
        F.xxhash64(F.col(id_col), text).alias("a"),
        F.xxhash64(text, F.col(id_col), F.lit(1)).alias("b"),
    )


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0: rows whose labels are never
    learned from. A null id has no label and counts as not held out."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def label_sample(
    labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id"
) -> DataFrame:
    """At most `per_class` labelled ids of each class outside the held-out
    fold: those with the smallest hash of the id, the same ones on any
    cluster. An id with contradicting labels counts in both classes; null ids
    and labels are left out. The result is bounded by 2 * per_class rows."""
    rows = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
        .where(~held_out("id"))
        .distinct()
    )
    parts = [
        rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)
    ]
    return parts[0].unionByName(parts[1])
