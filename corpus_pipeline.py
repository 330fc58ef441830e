"""The corpus pipeline: five stages from `documents` to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept; `run` writes each stage's result as Parquet to the shared checkpoint
folder and reads it back as the next stage's docs. All stages but the last
return the columns of documents.

Defined cases, of every stage: a null text is empty; an empty or blank one is
scored like any text, is one exact group, has no near copies, holds no benchmark
item and packs as its end token alone. Rows that repeat an id and a text (a file
read in twice) become one row in `exact_dedup`. A null id sorts after all ids and
is packed like any other. Very long texts are read whole. Columns beyond those
of documents pass through all stages but the last, under any name; `packing`
returns its own. Empty tables give an empty result; without labels of both
classes every document has the same score, and without benchmark items none
is dropped. Tables that a stage needs besides its docs (labels, benchmark) are
read from sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontamination, exact_dedup, jaccard_join, quality
from quarry.llm.common import staged
from quarry.llm.queries import packed_digests, table

# A document is rejected when its quality score is below this.
LEAST_QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), quality.quality_score(model, F.col("text")).alias("score"))
    return rows.where(F.col("score") >= LEAST_QUALITY).select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays."""
    return jaccard_join.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences."""
    return packed_digests(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

# No SQL: the classifier and the packing plan are not expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
