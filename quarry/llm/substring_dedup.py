"""Repeated passages: every word inside a window of `size` consecutive words
whose word sequence also starts in a document with a smaller id is removed.

Windows are told apart by Rabin-Karp hashes of their words. Two
independent ones, 128 bits together, name a window or a run of words; the
chance that two different ones among 10^12 share a name is below 10^-14. Most
windows occur once, so the windows are first met in runs, by content:

1. Each window has an anchor, the smallest hash of the ANCHOR-word sequences
   inside it; equal windows have equal anchors. A block is a run of windows of
   a document with one anchor; it is one row with the hash of its words, about
   one row per 18 words. Anchors that only one document holds are dropped.
2. Blocks of equal words are equal window by window, so in all documents but
   the one with the smallest id they are repeated whole.
3. Of the remaining blocks (one of each content, where its anchor has several
   contents) every window is hashed, the smallest id of each hash is found,
   and windows that a smaller id holds are repeated.
4. The repeated windows of a document merge into maximal removal intervals,
   which are joined to its text.

Scale: every step is an aggregate that is combined before its shuffle or a join
against a written table, which adaptive execution splits when a passage stands
in a third of all documents. Text is shuffled twice, compressed. What is
collected for one document is bounded by its own length.

Defined cases: a null text has no words; a null id sorts after all ids, and
documents without an id do not repeat each other; rows that repeat an id are
not repeats of each other (no smaller id), and each row gets a result; texts
shorter than `size` words keep everything. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, staged, text_or_empty
from quarry.llm.words import Words, _mix, _powers, portions, rolling

SIZE = 50
ANCHOR = 16
_LAST_ID = 9223372036854775807


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(words: Words, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, its anchor, its text) of every whole window of the batch."""
    lowest = sliding_minimum(rolling(words.hashes, anchor), size - anchor + 1)
    lengths = np.diff(words.docs)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    start = np.arange(len(doc))
    start = start[start + size <= words.docs[1:][doc]] if len(doc) else start
    return start, lowest[start] if len(start) else lowest[:0], doc[start] if len(doc) else doc


def _spans_hash(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of the words a to b - 1, from running sums."""
    up, down = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return _mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))


def _blocks(size: int, anchor: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 2):
                words = Words(part.column(2))
                start, value, doc = anchors(words, size, anchor)
                first = np.ones(len(start), dtype=bool)
                first[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(first)
                count = np.diff(np.append(head, len(start)))
                s, rows = start[head], doc[head]
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": value[head].view(np.int64),
                        "content": _spans_hash(words.hashes, s, s + count + size - 1).view(np.int64),
                        "check": _spans_hash(words.second, s, s + count + size - 1).view(np.int64),
                        "id": part.column(0).take(pa.array(rows)),
                        "key": part.column(1).take(pa.array(rows)),
                        "start": (s - words.docs[rows]).astype(np.int32),
                        "count": count.astype(np.int32),
                    }
                )

    return blocks


_SPAN = pa.struct([("start", pa.int32()), ("count", pa.int32())])


def _windows(size: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for doc_id, key, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = Words(pa.array([reader.decompress(packed).decode()]))
                hashes, checks = rolling(words.hashes, size), rolling(words.second, size)
                at = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["count"]) for s in spans]))
                n = len(at)
                yield pa.RecordBatch.from_pydict(
                    {
                        "window": hashes[at].view(np.int64),
                        "check": checks[at].view(np.int64),
                        "id": np.full(n, doc_id, np.int64),
                        "key": np.full(n, key, np.int64),
                        "start": at.astype(np.int32),
                    }
                )

    return windows


def removal_intervals(starts: np.ndarray, counts: np.ndarray, size: int, n_words: int) -> list[tuple[int, int]]:
    """Maximal intervals [a, b) of the words that the given runs of windows cover."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + counts + size - 1, n_words), -1)
    covered = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def _cleaned(size: int):
    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, packed, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = reader.decompress(packed).split()  # at the six ASCII spaces
                n, cuts = len(words), []
                if spans:
                    starts = np.array([s["start"] for s in spans])
                    counts = np.array([s["count"] for s in spans])
                    cuts = removal_intervals(starts, counts, size, n)
                    for a, b in reversed(cuts):
                        del words[a:b]
                spans_out = [{"start": a, "stop": b} for a, b in cuts]
                rows.append((doc_id, n, n - len(words), spans_out, b" ".join(words)))
            columns = zip(*rows, strict=True) if rows else ([] for _ in _RESULT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, _RESULT, strict=True)], schema=_RESULT
            )

    return cleaned


def _compressed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    writer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.array([writer.compress(x.as_py().encode()) for x in batch], pa.binary())


def remove_repeats(
    docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, removed (intervals of word positions, the
    stop excluded) and kept (UTF-8, words joined by one space) per row."""
    bounded_batches(docs.sparkSession)
    body = text_or_empty(text_col)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.xxhash64(F.col(id_col), body).alias("key"),
        body.alias("body"),
        F.col(id_col).cast("long").alias("doc_id"),
    )
    blocks = staged(
        rows.select("id", "key", "body").mapInArrow(
            _blocks(size, anchor), "anchor long, content long, check long, id long, key long, start int, count int"
        ),
        "blocks",
    )
    shared = staged(
        blocks.groupBy("anchor")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("anchor"),
        "shared-anchors",
    )
    met = staged(blocks.join(shared, "anchor"), "shared-blocks")
    # Written, so that the joins on the anchor are joins of plain scans, which
    # adaptive execution splits: the blocks of a passage that a third of all
    # documents hold share one anchor.
    firsts = staged(met.groupBy("anchor", "content", "check").agg(F.min("id").alias("first")), "first-contents")
    differ = (F.min("content") < F.max("content")) | (F.min("check") < F.max("check"))
    several = staged(firsts.groupBy("anchor").agg(differ.alias("several")), "anchors-of-several")
    told = staged(firsts.join(several, "anchor"), "first-blocks")
    labelled = staged(
        met.join(told, ["anchor", "content", "check"])
        .where((F.col("id") > F.col("first")) | F.col("several"))
        .select("id", "key", "start", "count", (F.col("id") > F.col("first")).alias("whole")),
        "repeated-blocks",
    )
    span = F.struct("start", "count")
    packed = rows.select("id", "key", F.arrow_udf(_compressed, "binary")("body").alias("packed"), "doc_id")
    open_blocks = labelled.where(~F.col("whole")).groupBy("id", "key").agg(F.collect_set(span).alias("spans"))
    windows = staged(
        packed.join(staged(open_blocks, "open-blocks"), ["id", "key"])
        .select("id", "key", "packed", "spans")
        .mapInArrow(_windows(size), "window long, check long, id long, key long, start int"),
        "windows",
    )
    smallest = (
        windows.groupBy("window", "check")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .drop("high")
    )
    repeated = windows.join(staged(smallest, "first-windows"), ["window", "check"]).where("id > low")
    cuts = (
        labelled.where("whole")
        .select("id", "key", "start", "count")
        .unionByName(repeated.select("id", "key", "start", F.lit(1).alias("count")))
        .groupBy("id", "key")
        .agg(F.collect_set(span).alias("spans"))
    )
    return (
        packed.join(staged(cuts, "cuts"), ["id", "key"], "left")
        .select("doc_id", "packed", "spans")
        .mapInArrow(
            _cleaned(size),
            "doc_id long, n_words long, n_removed long, removed array<struct<start: long, stop: long>>, kept binary",
        )
    )
