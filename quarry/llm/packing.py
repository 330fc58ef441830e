"""Sequence packing by non-negative least squares over a length histogram.

1. `cut_documents` tokenizes whole texts, appends the end id and cuts every
   document into full windows and one remainder shorter than the window.
2. The remainders' lengths are counted by class: exact up to SMALL tokens,
   above that rounded up to a multiple of STEP. The histogram has a few hundred
   rows at any input size, and only it goes to the driver.
3. `packing_plan` enumerates the ways to fill a window exactly with up to
   `depth` of the large classes, solves the repeat counts by
   non-negative least squares against the histogram (active set, rows weighed
   by the classes' counts), rounds them down to what the histogram
   holds, and packs the residual and all small classes greedily, longest
   first, into the smallest gap that takes them. It is never worse than packing
   everything greedily, which is planned too.
4. `pack` numbers the pieces of each class without a global sort (count per
   class and chunk of the input, running sums of these counts, position within
   the chunk) and reads each piece's sequence from the plan by its number.
   Offsets are running sums inside one sequence, which the window bounds.

A class may hold a third of all pieces: numbering is a combined count, and the
pieces of a class spread over as many sequences as they fill.

Defined cases: a null text is empty and gives one piece with the end id alone;
a null id stays null; rows that repeat are packed each; very long texts give
many full windows; empty input gives no rows. Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, staged, text_or_empty
from quarry.llm.words import Generations, Words, distinct_words, portions

WINDOW = 4096
SMALL = 256
STEP = 16

_WORDS_KEPT = 1_200_000  # tokenized words that a worker process remembers
_IDS_KEPT = 6_000_000  # and their ids
_STEMS_KEPT = 150_000  # of each of two generations
_AT_ONCE = 20_000  # runs of letters tokenized in one call

# On a line of its own: a run of letters that lower case and Unicode composition
# leave in place one by one, then ASCII punctuation without the apostrophe of
# contractions; or any other word.
_PLAIN = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([!-&(-/:-@\[-`{-~]{0,16})|.*)$", re.M)


class Store:
    """Ids by the hash of their word, in sorted arrays: 20 bytes a word and 4
    an id. A full store starts anew."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size in the pool of each word's ids, and whether it is known."""
        if not len(self.hashes):
            n = len(hashes)
            return np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(n, bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.begins[at], self.sizes[at], self.hashes[at] == hashes

    def add(self, hashes: np.ndarray, ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of each of the new words' ids."""
        data = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = (np.fromiter(map(len, ids), np.int64, len(ids)) // 4).astype(np.int32)
        begins = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        if self.used + len(data) > len(self.pool):
            grown = np.zeros(max(2 * len(self.pool), self.used + len(data)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + len(data)] = data
        self.used += len(data)
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.begins = np.concatenate([self.begins, begins])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]
        return begins, sizes

    @property
    def full(self) -> bool:
        return len(self.hashes) > _WORDS_KEPT or self.used > _IDS_KEPT


class WordTokens:
    """Token ids of texts by a tokenizer whose tokens never reach across white
    space and whose words end in tokens of their own: the distinct words of a
    batch are looked up by their hash, new ones are tokenized once, and the ids
    of the texts are put together by array operations."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words = Store()
        self.stems = Generations(_STEMS_KEPT)
        self.tails = {"": b""}

    def ids(self, text: str) -> bytes:
        """Of one text by the tokenizer itself, little-endian unsigned 32-bit."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _stem_ids(self, stems: list[str]) -> dict[str, bytes]:
        """Ids of runs of letters, tokenized as one text and cut at the tokens
        that end a word."""
        found = dict(zip(stems, self.stems.find(stems), strict=True))
        unknown = [s for s, ids in found.items() if ids is None]
        for at in range(0, len(unknown), _AT_ONCE):
            new = unknown[at : at + _AT_ONCE]
            encoding = self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(new):
                raise ValueError("a run of letters is not one word of this tokenizer")
            data, stops = ids.tobytes(), stops.tolist()
            learned = [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
            self.stems.add(new, learned)
            found.update(zip(new, learned, strict=True))
        return found

    def _learn(self, words: list[str]) -> list[bytes]:
        parts = _PLAIN.findall("\n".join(words))
        stems = "\n".join([s for s, _ in parts]).lower().split("\n")
        known = self._stem_ids(list(dict.fromkeys(s for s in stems if s)))
        tails = self.tails
        if len(tails) > _STEMS_KEPT:
            tails = self.tails = {"": b""}
        for tail in {t for _, t in parts}:
            if tail not in tails:
                tails[tail] = self.ids(tail)
        return [
            known[stem] + tails[tail] if stem else self.ids(word)
            for stem, (_, tail), word in zip(stems, parts, words, strict=True)
        ]

    def many(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 positions in them where each begins."""
        words = Words(column)
        hashes, which, first = distinct_words(words)
        if self.words.full:
            self.words = Store()
        begins, sizes, known = self.words.find(hashes)
        new = np.flatnonzero(~known)
        if len(new):
            begins[new], sizes[new] = self.words.add(hashes[new], self._learn(words.strings(first[new])))
        size = sizes[which]
        stops = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = np.repeat(begins[which] - stops[:-1], size) + np.arange(stops[-1])
        return self.words.pool[at], stops[words.docs]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """Kept for all tasks that a worker process runs."""
    return WordTokens(path)


def cut_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit)
    of each piece, and the place it was cut at: chunk, at (a number within the
    chunk and length class)."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
         ("ids", pa.binary()), ("chunk", pa.int32()), ("class", pa.int32()), ("at", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, chunk = word_tokens(tokenizer_path), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            for part in portions(batch, 1, 4 << 20):
                rows = []
                found, stops = tokens.many(part.column(1))
                data, stops = found.tobytes(), stops.tolist()
                for doc_id, a, b in zip(part.column(0).to_pylist(), stops[:-1], stops[1:], strict=True):
                    ids = data[4 * a : 4 * b] + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        length = len(piece) // 4
                        kind = length_class(length, window)
                        rows.append((doc_id, start, length, total, piece, chunk, kind, int(seen[kind])))
                        seen[kind] += 1
                columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("body")).mapInArrow(
        cut,
        "doc_id long, start long, length long, doc_tokens long, ids binary, chunk int, class int, at long",
    )


def length_class(length: int, window: int = WINDOW) -> int:
    """The length that a piece counts as: its own up to SMALL, else the next
    multiple of STEP."""
    return length if length <= SMALL else min(-(-length // STEP) * STEP, window)


def fillings(window: int, depth: int) -> list[tuple[int, ...]]:
    """Every descending combination of at most `depth` large classes, none the
    window itself, that fills the window exactly."""
    sizes = range(SMALL + STEP, window, STEP)
    found: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < depth:
            least = -(-left // (depth - len(chosen)))
            for size in sizes:
                if least <= size <= min(left, chosen[-1] if chosen else window) or size == left:
                    if not chosen or size <= chosen[-1]:
                        extend((*chosen, size), left - size)

    extend((), window)
    return sorted(set(found))


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, entering: int = 8) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method: the variables
    that would lower the residual most (`entering` at a time) join the free ones,
    the free ones are solved for, and those that would turn negative leave at
    the first point where one reaches 0. It ends where no variable gains."""
    m, n = a.shape
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    limit = 1e-9 * max(float(np.abs(a.T @ b).max(initial=0)), 1e-300)
    before = np.inf
    for _ in range(3 * m + 10):
        residual = b - a @ x
        gain = np.where(free, -np.inf, a.T @ residual)
        best = np.argsort(-gain, kind="stable")[: min(entering, n)]
        best = best[gain[best] > limit]
        norm = float(residual @ residual)
        if not len(best) or norm >= before * (1 - 1e-12):
            break
        before = norm
        free[best] = True
        while free.any():
            at = np.flatnonzero(free)
            some = a[:, at]
            gram = some.T @ some
            gram[np.diag_indices_from(gram)] *= 1 + 1e-12  # equal columns
            solved = np.linalg.solve(gram, some.T @ b)
            if (solved > 0).all():
                x[at] = solved
                break
            falling = solved <= 0
            ratio = x[at][falling] / np.maximum(x[at][falling] - solved[falling], 1e-300)
            x[at] += float(ratio.min(initial=1.0)) * (solved - x[at])
            out = at[falling & (x[at] <= 1e-12 * max(float(x.max(initial=0)), 1e-300))]
            x[out], free[out] = 0.0, False
    return x


@dataclass(frozen=True)
class Plan:
    """Rows (class, slot, first, count, sequence): the pieces numbered `first`
    to `first + count - 1` of a class go to the sequences from `sequence` on,
    `per` of them to each, ordered there from `slot` on."""

    rows: list[tuple[int, int, int, int, int, int]]
    sequences: int


def packing_plan(histogram: dict[int, int], window: int = WINDOW, depth: int = 3) -> Plan:
    """The plan with the solved repeats of fillings and the rest packed greedily, or
    the greedy plan alone where that takes fewer sequences."""
    solved, greedy = (_plan(histogram, window, d) for d in (depth, 0))
    return solved if solved.sequences <= greedy.sequences else greedy


def _plan(histogram: dict[int, int], window: int, depth: int) -> Plan:
    left = {c: n for c, n in histogram.items() if n > 0}
    used: dict[int, int] = {}
    rows: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def place(kind: int, slot: int, per: int, first_sequence: int, copies: int) -> None:
        first = used.get(kind, 0)
        rows.append((kind, slot, first, per * copies, first_sequence, per))
        used[kind] = first + per * copies
        left[kind] -= per * copies

    if left.get(window):
        n = left[window]
        place(window, 0, 1, sequences, n)
        sequences += n
    large = [c for c in left if SMALL < c < window and left[c]]
    if large and depth:
        ways = [w for w in fillings(window, depth) if all(left.get(c) for c in w)]
        if ways:
            index = {c: i for i, c in enumerate(sorted(large))}
            a = np.zeros((len(index), len(ways)))
            for k, way in enumerate(ways):
                for c in way:
                    a[index[c], k] += 1
            b = np.array([left[c] for c in index], dtype=float)
            # every class counts by its share left over, not the common ones alone
            weight = 1.0 / np.sqrt(b)
            repeats = non_negative_least_squares(a * weight[:, None], b * weight)
            for k in np.argsort(-repeats, kind="stable"):
                counts = {c: ways[k].count(c) for c in ways[k]}
                n = min(int(repeats[k]), *(left[c] // m for c, m in counts.items()))
                if n > 0:
                    for slot, (c, m) in enumerate(counts.items()):
                        place(c, slot, m, sequences, n)
                    sequences += n
    # Residual: open gaps as (gap, slot, first sequence, copies), longest pieces first.
    gaps: list[tuple[int, int, int, int]] = []
    for kind in sorted((c for c in left if left[c]), reverse=True):
        while left[kind]:
            fitting = min((g for g in gaps if g[0] >= kind), default=None)
            if fitting is None:
                per = window // kind
                copies = left[kind] // per
                if not copies:
                    per, copies = left[kind], 1
                place(kind, 0, per, sequences, copies)
                gaps.append((window - per * kind, 1, sequences, copies))
                sequences += copies
                continue
            gaps.remove(fitting)
            gap, slot, first, copies = fitting
            per = min(gap // kind, left[kind])
            filled = min(copies, left[kind] // per)
            place(kind, slot, per, first, filled)
            gaps.append((gap - per * kind, slot + 1, first, filled))
            if filled < copies:
                gaps.append((gap, slot, first + filled, copies - filled))
        gaps = [g for g in gaps if g[0]]
    return Plan(rows, sequences)


def pack(pieces: DataFrame, window: int = WINDOW, depth: int = 3) -> DataFrame:
    """`pieces` (chunk, class, at, length and any other columns; a table whose
    rows do not change between reads) with sequence_id and offset added.
    chunk, class and at are dropped."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("chunk", "class").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts, "class-counts")
    # one row per length class: at most a few hundred
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    plan = packing_plan(histogram, window, depth)
    order = Window.partitionBy("class").orderBy("chunk")
    bases = counts.withColumn("base", F.sum("n").over(order) - F.col("n")).drop("n")
    starts: dict[int, list[tuple[int, int, int, int]]] = {}
    for kind, slot, first, _, sequence, per in plan.rows:
        starts.setdefault(kind, []).append((first, slot, sequence, per))
    tables = {kind: np.array(sorted(rows), dtype=np.int64).T for kind, rows in starts.items()}

    @F.arrow_udf("struct<sequence_id: long, slot: long>")
    def placed(kinds: pa.Array, numbers: pa.Array) -> pa.Array:
        kind, number = kinds.to_numpy(), numbers.to_numpy()
        sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        for k in np.unique(kind):
            rows = np.flatnonzero(kind == k)
            first, slots, sequences, per = tables[int(k)]
            at = np.searchsorted(first, number[rows], "right") - 1
            nth = number[rows] - first[at]
            sequence[rows] = sequences[at] + nth // per[at]
            slot[rows] = slots[at] * (window + 1) + nth % per[at]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(slot)], ["sequence_id", "slot"])

    others = [c for c in pieces.columns if c not in ("chunk", "class", "at")]
    numbered = pieces.join(staged(bases, "class-bases"), ["chunk", "class"]).select(
        *others, placed(F.col("class"), F.col("base") + F.col("at")).alias("place")
    )
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        numbered.select(*others, "place.sequence_id", "place.slot")
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .drop("slot")
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids, starts: each sequence's ids joined in order
    of offset, from packed pieces that still carry their ids."""
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids"))).alias("p"))
        .select(
            "sequence_id",
            F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("hex"),
            F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
            F.transform("p", lambda x: x["start"]).alias("starts"),
        )
        .select("sequence_id", F.unhex("hex").alias("ids"), "doc_ids", "starts")
    )
