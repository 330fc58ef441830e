"""Language identification with hyperdimensional profiles.

Every letter has a random vector of `dims` entries +1 and -1, made from its
code point alone, so every task has the same one. A letter with its two
neighbours (a word's edge counts as a neighbour of its own) is bound into one
vector, the entrywise product of the three letters' vectors, the first shifted
by two places, the second by one. A text's vector is the sum (bundle) of its
trigrams' vectors, a language's prototype that of the texts it is learned from.
A text gets the language whose prototype is nearest by cosine, after the mean
of the unit prototypes, which is what all languages share, has been taken off
both sides.

Plan. Learning: about `per_language` distinct texts of each of the (at most
`most_languages`) languages with the most documents, those whose hash lies below
the share that gives this number; languages with fewer texts give all. Copies
of one text, however many, count once, and the choice is the same on any
cluster. Nothing but counts is shuffled to choose, and then the chosen texts
(bounded); these are bundled in tasks, one long vector per task and language,
added by Spark.
The model is `most_languages` * `dims` numbers at most. Predicting is a map
over all whole texts without a shuffle: a batch's distinct trigrams are found
once, and the texts' vectors are the product of their count matrix with the
trigrams' vectors. Texts are read in pieces of `_PIECE` bytes, so a very long
one needs no more memory than a batch.

Defined cases: letters are Unicode letters, lower-cased one by one; all else
separates words. A null text, an empty one and one without a letter are `und`
with score 0, and so is every text where nothing was learned. The score is
the cosine, 0 where it is negative. Equal cosines go to the language whose name
comes first. Null languages are not learned from; an empty name is a language.
Repeated rows each get their (equal) prediction. A null id is not held out.
Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import bounded_batches
from quarry.llm.words import _mix, release, text_buffer

UNKNOWN = "und"
FOLDS = 3
HELD_OUT_FOLD = 1
_PIECE = 1 << 18  # bytes of text bundled at a time
_ROWS = 1 << 10  # texts bundled at a time
_GRAMS = 1 << 12  # trigrams whose vectors are held at a time
_BITS = np.uint64(21)
_POINT = np.uint64((1 << 21) - 1)


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3, is 1: rows never learned from."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point of the lower-case letter by code point; 0 for what is no letter."""
    out = np.zeros(0x110000, dtype=np.uint64)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            out[i] = ord(low) if len(low := c.lower()) == 1 else i
    return out


def letter_vectors(points: np.ndarray, dims: int) -> np.ndarray:
    """Random vectors of +1 and -1 by code point, one row each."""
    words = np.arange(1, dims // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = _mix(_mix(points.astype(np.uint64) + np.uint64(1))[:, None] + words)
    ones = np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1)
    return ones.astype(np.int8) * np.int8(2) - np.int8(1)


def gram_vectors(grams: np.ndarray, dims: int) -> np.ndarray:
    """The bound vectors of trigrams (three code points in one number)."""
    parts = np.stack([grams >> (_BITS + _BITS), (grams >> _BITS) & _POINT, grams & _POINT])
    points, at = np.unique(parts, return_inverse=True)
    base = letter_vectors(points, dims)
    first, second, third = at.reshape(parts.shape)
    return np.roll(base, 2, 1)[first] * np.roll(base, 1, 1)[second] * base[third]


def trigrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, trigram) for every letter of the column, in pieces."""
    data, at = text_buffer(column)
    begins = (data & 0xC0) != 0x80
    low = 0
    while low < len(data):
        row = int(np.searchsorted(at, low, "right")) - 1
        high = min(low + _PIECE, int(at[min(row + _ROWS, len(at) - 1)]))
        while high < len(data) and not begins[high]:
            high += 1
        left, right = low, high
        if left:
            left -= 1
            while not begins[left]:
                left -= 1
        if right < len(data):
            right += 1
            while right < len(data) and not begins[right]:
                right += 1
        points = np.frombuffer(data[left:right].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        places = np.flatnonzero(begins[left:right]) + left
        rows = np.searchsorted(at, places, "right") - 1
        codes = _letters()[points]
        same = rows[1:] == rows[:-1]
        before, after = np.zeros_like(codes), np.zeros_like(codes)
        before[1:] = codes[:-1] * same
        after[:-1] = codes[1:] * same
        here = np.flatnonzero((codes > 0) & (places >= low) & (places < high))
        yield rows[here], (before[here] << (_BITS + _BITS)) | (codes[here] << _BITS) | after[here]
        low = high


def bundles(column: pa.Array, groups: np.ndarray, n: int, dims: int) -> np.ndarray:
    """The sum of the trigram vectors of each of n groups of rows."""
    out = np.zeros((n, dims))
    for rows, grams in trigrams(column):
        if not len(rows):
            continue
        group = groups[rows]
        low = int(group.min())
        span = int(group.max()) - low + 1
        coded = pa.array(grams).dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        for a in range(0, len(distinct), _GRAMS):
            some = distinct[a : a + _GRAMS]
            inside = slice(None) if len(distinct) <= _GRAMS else (which >= a) & (which < a + _GRAMS)
            cells = (group[inside] - low) * len(some) + (which[inside] - a)
            counts = np.bincount(cells, minlength=span * len(some)).reshape(span, len(some))
            # at most 2**18 trigrams in a piece: whole numbers in single precision
            out[low : low + span] += counts.astype(np.float32) @ gram_vectors(some, dims).astype(np.float32)
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]  # ascending
    prototypes: np.ndarray  # one row per language, length 1, the mean taken off
    mean: np.ndarray
    dims: int


def make_model(languages: list[str], sums: np.ndarray, dims: int) -> LanguageModel:
    order = sorted(range(len(languages)), key=lambda i: languages[i].encode())
    units = _unit(sums[order])
    mean = units.mean(0) if len(order) > 1 else np.zeros(dims)
    return LanguageModel(tuple(languages[i] for i in order), _unit(units - mean), mean, dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-300)


def fit_languages(
    docs: DataFrame,
    dims: int = 1024,
    per_language: int = 2000,
    most_languages: int = 500,
    lang_col: str = "lang",
    text_col: str = "text",
) -> LanguageModel:
    """Prototypes of the languages of `docs` (the rows to learn from)."""
    if dims % 64 or dims < 64:
        raise ValueError("dims must be a multiple of 64")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("body")).where(
        "lang is not null and body is not null"
    )
    hashed = rows.withColumn("h", F.xxhash64("body"))
    known = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h", 0.02).alias("texts"))
    # at most most_languages rows
    names = known.orderBy(F.desc("n"), "lang").limit(most_languages).select("lang", (per_language / F.col("texts")).alias("share"))
    place = F.col("h") / F.lit(2.0**64) + F.lit(0.5)  # from 0 to 1, by the text alone
    chosen = hashed.join(F.broadcast(names), "lang").where(place < F.col("share"))
    # about most_languages * per_language rows at most
    sample = chosen.select("lang", "h", "body").dropDuplicates(["lang", "h", "body"])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            names = coded.dictionary.to_pylist()
            sums = bundles(batch.column(1), coded.indices.to_numpy(), len(names), dims)
            for name, vector in zip(names, sums, strict=True):
                total[name] = total.get(name, 0) + vector
        release()
        for name, vector in total.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([name]), "v": pa.array([vector.astype(np.int64)], pa.list_(pa.int64()))}
            )

    parts = sample.select("lang", "body").mapInArrow(bundle, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("j", "v")).groupBy("lang", "j").agg(F.sum("v").alias("v"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("v")).collect()
    matrix = np.array([[x.v for x in r.v] for r in found], dtype=float).reshape(len(found), dims)
    some = (matrix != 0).any(1)  # a language without a letter has no direction
    return make_model([r.lang for r, ok in zip(found, some, strict=True) if ok], matrix[some], dims)


def nearest(model: LanguageModel, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest language (-1: none) and the cosine, 0 at least."""
    known = vectors.any(1)
    if not model.languages:
        return np.full(len(vectors), -1), np.zeros(len(vectors))
    cosines = _unit(_unit(vectors) - model.mean) @ model.prototypes.T
    best = cosines.argmax(1)
    score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
    return np.where(known, best, -1), np.where(known, score, 0.0)


def predict_language(model: LanguageModel, text: Column) -> Column:
    """Struct of `lang` and `score` of a text."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for column in batches:
            vectors = bundles(column, np.arange(len(column)), len(column), model.dims)
            best, score = nearest(model, vectors)
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], names=["lang", "score"])
            release()

    return predict(F.coalesce(text, F.lit("")))
