"""Words and word shingles of Arrow text columns as 64-bit hashes, in numpy.

A batch's text is one UTF-8 buffer; words are found and hashed by array
operations over that buffer, without a Python string per word. The hash of a
word is a polynomial over a random 64-bit value per byte, modulo 2**64, then
mixed; equal words have equal hashes in every task and on every machine. Two
different words or shingles share a hash with a chance of about 2**-58.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

_PIECE = 1 << 18  # bytes hashed at a time


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public SplitMix64 generator."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(step + np.uint64(seed))


_BASE = np.uint64(0x9E3779B97F4A7C13)  # odd: it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_EXACT = _stream(256, 11)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]  # A-Z as a-z
_EXACT_2, _FOLDED_2 = _stream(256, 57), _stream(256, 57)
_FOLDED_2[65:91] = _EXACT_2[97:123]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_POWERS.get("up", ()))
    if have < n:
        n = max(n, _PIECE + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(n, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the column, and the n + 1 offsets of its values. A null
    value is empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if not n or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """The words of a batch of texts: `hashes`, their byte spans `starts` to
    `ends`, and `docs`, the n + 1 positions in these where each text begins."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, at = text_buffer(column)
        self.data = data
        word = ~_SPACE[data]
        begins = np.empty(len(data) + 1, dtype=bool)
        begins[0] = True
        np.logical_not(word, out=begins[1:])  # after a space a word may begin
        begins[at] = True
        begin = begins[:-1] & word
        ends = begins[1:] & word  # before a space or another text a word ends
        ends[:-1] |= word[:-1] & ~word[1:]
        ends[-1:] |= word[-1:]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(ends) + 1
        self.docs = np.searchsorted(self.starts, at)
        self.lower = lower
        self.hashes = self._hash(_FOLDED if lower else _EXACT)

    def _hash(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        first = 0
        while first < len(out):
            low = self.starts[first]
            last = max(int(np.searchsorted(self.ends, low + _PIECE, "right")), first + 1)
            high = self.ends[last - 1]
            up, down = _powers(int(high - low) + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(values[self.data[low:high]] * up[: high - low], out=sums[1:])
            s, e = self.starts[first:last] - low, self.ends[first:last] - low
            out[first:last] = (sums[e] - sums[s]) * down[s]
            first = last
        return _mix(out)

    @cached_property
    def second(self) -> np.ndarray:
        """Hashes of the words by another table, independent of `hashes`: both
        together are a 128-bit name."""
        return self._hash(_FOLDED_2 if self.lower else _EXACT_2)

    def text(self, a: int, b: int) -> bytes:
        """Words a to b - 1 joined by one space."""
        data, starts, ends = self.data, self.starts, self.ends
        return b" ".join([data[starts[i] : ends[i]].tobytes() for i in range(a, b)])

    @cached_property
    def _bytes(self) -> bytes:
        return self.data.tobytes()

    def strings(self, at: np.ndarray) -> list[str]:
        """The words at the given positions."""
        data = self._bytes
        spans = zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)
        return [data[a:b].decode() for a, b in spans]


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of a batch's words, for each word the index of its
    hash among them, and for each of them the position of its first word."""
    coded = pa.array(words.hashes).dictionary_encode()
    which = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), dtype=np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    return coded.dictionary.to_numpy(), which, first


class Generations:
    """Remembered values in bounded memory: when `most` are held they become
    the old generation, and those still asked for are taken over from there."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def find(self, keys: list) -> list:
        """The value of each key, None where it is not known."""
        found = list(map(self.young.get, keys))
        if self.old:
            for i, value in enumerate(found):
                if value is None and (value := self.old.get(keys[i])) is not None:
                    found[i] = self.young[keys[i]] = value
        return found

    def add(self, keys, values) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young.update(zip(keys, values, strict=True))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive words, by position of the first; the
    last size - 1 positions have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = _stream(size, 23) | np.uint64(1)
    out = hashes[:n] * factors[0]
    for k in range(1, size):
        out += hashes[k : k + n] * factors[k]
    return _mix(out)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of every `size` consecutive words: a polynomial in a
    fixed odd base modulo 2**64, each from running sums in constant time."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return _mix((sums[size:] - sums[:-size]) * down[:n])


def shingle_sets(words: Words, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text. A text of fewer than `size`
    words has its whole sequence as one shingle; one without words has none."""
    all_of_them = windows(words.hashes, size)
    out = []
    for a, b in zip(words.docs[:-1], words.docs[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(all_of_them[a : b - size + 1]))
        elif b > a:
            whole = windows(words.hashes[a:b], int(b - a))
            out.append(_mix(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def parts(column: pa.Array, most: int) -> list[tuple[int, int]]:
    """Row ranges of the column with about `most` bytes of text each; a longer
    text is a range of its own."""
    _, at = text_buffer(column)
    cuts = [0]
    while cuts[-1] < len(column):
        stop = int(np.searchsorted(at, at[cuts[-1]] + most, "right")) - 1
        cuts.append(min(max(stop, cuts[-1] + 1), len(column)))
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def release() -> None:
    """Hand the freed memory of this worker process back to the system, which
    the allocators otherwise keep for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def portions(batch: pa.RecordBatch, text_index: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut into such ranges of rows, so that the arrays made from one
    stay small."""
    for a, b in parts(batch.column(text_index), most):
        yield batch.slice(a, b - a)
    release()
