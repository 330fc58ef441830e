"""Quality classifier by compression.

Two zstandard dictionaries are built from passages of good and of bad labelled
text. A text is compressed in blocks with each dictionary; the difference of
the compressed sizes, normalised by the sizes and by the length, becomes a
score by a logistic calibration, together with the plain compression ratio and
the better of the two ratios (junk that repeats itself compresses well with
either dictionary, and only the ratios tell it).

Fitting reads a bounded sample: at most `per_class` labelled documents of each
class (those with the smallest hash of the id) and, of their distinct
passages, `passages` of each class for the dictionaries. Dictionaries and
calibration use different folds of the documents, none the held-out fold.
Scoring is a map over all whole texts without a shuffle; its memory is one
batch of rows.

Defined cases: a null text is empty, and an empty text has the score of its
features (all zero sizes) like any other; without labels of both classes the
score is the constant share of label 1 (0.5 without labels); a null id is
never held out; repeated rows each get their (equal) score; contradicting
labels of an id count in both classes. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import FOLDS, bounded_batches, label_sample, staged, text_or_empty
from quarry.llm.scoring import Logistic, fit_logistic

BLOCK = 2048
PASSAGE = 1024
DICTIONARY = 112640  # bytes, the size that zstandard's own trainer defaults to
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    bad: bytes
    good: bytes
    calibration: Logistic


def build_dictionary(passages: list[bytes]) -> bytes:
    """A trained dictionary, or the passages themselves where there are too
    few for the trainer."""
    try:
        return zstandard.train_dictionary(DICTIONARY, passages).as_bytes()
    except zstandard.ZstdError:
        return b"".join(passages)[-DICTIONARY:]


class Sizes:
    """Compressed sizes of texts with both dictionaries and without one."""

    def __init__(self, bad: bytes, good: bytes):
        self.sides = []
        for content in (bad, good):
            dictionary = None
            if len(content) >= 8:
                dictionary = zstandard.ZstdCompressionDict(content)
                dictionary.precompute_compress(level=LEVEL)
            self.sides.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
                )
            )
        self.plain = zstandard.ZstdCompressor(level=1, write_content_size=False)

    def features(self, text: bytes) -> tuple[float, float, float, float]:
        bad = good = 0
        for at in range(0, max(len(text), 1), BLOCK):
            block = text[at : at + BLOCK]
            bad += len(self.sides[0].compress(block))
            good += len(self.sides[1].compress(block))
        length = len(text) + 20
        return (
            (bad - good) / (bad + good),
            (bad - good) / length,
            len(self.plain.compress(text)) / length,
            min(bad, good) / length,
        )


def _features(bad: bytes, good: bytes):
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = Sizes(bad, good)
        for batch in batches:
            rows = [sizes.features((x.as_py() or "").encode()) for x in batch]
            yield pa.array([list(r) for r in rows], pa.list_(pa.float64()))

    return features


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = 3000,
    passages: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    bounded_batches(docs.sparkSession)
    sample = label_sample(labels, label, per_class, id_col)
    # at most 2 * per_class rows; written, as both dictionaries and the features read them
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body"))
    chosen = staged(rows.join(F.broadcast(sample), "id"), "quality-sample")
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS
    starts = F.sequence(F.lit(0), F.greatest(F.char_length("body") - 1, F.lit(0)), F.lit(PASSAGE))
    pieces = (
        chosen.where(fold.isin(1, 2))
        .select("y", "body", F.explode(starts).alias("at"))
        .select("y", F.expr(f"substring(body, at + 1, {PASSAGE})").alias("piece"))
        .where("piece <> ''")
        .distinct()
    )
    dictionaries = []
    for y in (0, 1):
        rows = pieces.where(F.col("y") == y).orderBy(F.xxhash64("piece"), "piece").limit(passages).collect()
        dictionaries.append(build_dictionary([r.piece.encode() for r in rows]))
    measured = (
        chosen.where(fold.isin(3, 4))
        .select("y", _features(*dictionaries)(F.col("body")).alias("x"))
        .distinct()  # many copies of one text count once
        .collect()
    )
    x = np.array([r.x for r in measured], dtype=float).reshape(len(measured), 4)
    y = np.array([r.y for r in measured], dtype=float)
    order = np.lexsort([*x.T, y])  # the sums do not depend on the order of arrival
    return QualityModel(*dictionaries, fit_logistic(x[order], y[order]))


def quality_score(model: QualityModel, text: Column) -> Column:
    """Score from 0 to 1 of a text; higher: label 1 is likelier."""
    bad, good, calibration = model.bad, model.good, model.calibration

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = Sizes(bad, good)
        for batch in batches:
            rows = [sizes.features((x.as_py() or "").encode()) for x in batch]
            yield pa.array(calibration(np.array(rows, dtype=float).reshape(len(rows), 4)))

    return score(F.coalesce(text, F.lit("")))
