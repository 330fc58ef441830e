"""Toxicity by a misspelling-tolerant lexicon and the context of its hits.

The lexicon is learned from labelled documents: whole terms, and stems whose
many endings together mark toxic text. It is a trie, and a word is looked up by
the intersection of the trie with the word's Levenshtein automaton: the states
are sets of (trie node, edits so far), made as words need them and remembered,
so a word costs one step per letter until no term can be near it. Terms of 5
letters or more allow one edit, of 9 or more two; shorter ones must match. The
first letter is edited like any other; hits whose first letter is not the
term's, which chance gives more often, have a weight of their own. A word is
looked up without its outer punctuation, so a digit or sign inside it (id1ot,
st*pid) is an edit, and each run of letters in it is looked up on its own too.

Each hit is weighed by a window of words around it: a hit between quotation
marks, or near words that report speech, counts as quotation and less than
abuse. Sums of weights of exact and of both kinds of misspelled hits, overall and
per word, become a score by logistic calibration.

Fitting reads at most `per_class` labelled documents of each class (smallest
hash of the id, held-out fold excluded), leaves out near copies among them, and
keeps at most `most_terms` entries, chosen from the 20 * `most_terms` that stand
in most toxic documents of the sample. Terms of more than LONGEST_TERM (40)
letters are not learned. All three bounds concern fitting alone.
Scoring is a map over all whole texts; its memory is one portion of a batch.

Defined cases: a null text is empty; a text without words has no hits and the
score of none; without labels of both classes the score is the constant share
of label 1 (0.5 without labels); a null id is never held out; repeated rows
each get their (equal) score; contradicting labels of an id count in both
classes. Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, label_sample, staged, text_or_empty
from quarry.llm.scoring import Logistic, fit_logistic
from quarry.llm.words import Generations, Words, _stream, distinct_words, parts, portions, release, shingle_sets

CONTEXT = 6  # words on each side
QUOTED = 0.25  # weight of a hit that is quoted or reported
# Quotation marks, and words that report speech.
MARKS = "\"'“”„‟«»‹›‘’`"
REPORTS = frozenset(
    "said says say called calls wrote writes quoted quote quotes word words term terms slur phrase "
    "sagte sagt nannte wort begriff dijo dice llamó palabra término dit disait appelé mot terme".split()
)

_LETTERS = re.compile(r"[^\W\d_]+")
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_STATES_KEPT = 50_000
_NODES_KEPT = 1_000_000  # in all states
_ODD = _stream(8, 5) | np.uint64(1)
_WORDS_KEPT = 300_000
LONGEST_TERM = 40


@dataclass(frozen=True)
class Lexicon:
    terms: tuple[str, ...]
    stems: tuple[str, ...]


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """Lexicon trie with bounded edits; `distance` runs a word through it. With
    `first_stands`, words whose first letter is not the term's are no hits."""

    def __init__(self, lexicon: Lexicon, first_stands: bool = True):
        self.first_stands = first_stands
        self.children: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]  # edits that a term ending here allows
        self.stem: list[int] = [-1]
        self.most: list[int] = [-1]  # edits that any entry below allows
        for entries, ends, allowed in (
            (lexicon.terms, self.term, edits_allowed),
            (lexicon.stems, self.stem, lambda s: 0 if len(s) < 8 else 1),
        ):
            for entry in entries:
                node, k = 0, allowed(entry)
                self.most[0] = max(self.most[0], k)
                for letter in entry:
                    if letter not in self.children[node]:
                        self.children[node][letter] = len(self.children)
                        self.children.append({})
                        for marks in (self.term, self.stem, self.most):
                            marks.append(-1)
                    node = self.children[node][letter]
                    self.most[node] = max(self.most[node], k)
                ends[node] = max(ends[node], k)
        self._forget()

    def _forget(self) -> None:
        self.names: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.held = 0
        self.start = self._name(self._closed({0: 0}))

    def _closed(self, least: dict[int, int]) -> frozenset:
        """Adds the nodes that skipping letters of a term reaches."""
        todo = [node for node in least if node or not self.first_stands]
        while todo:
            node = todo.pop()
            edits = least[node] + 1
            for child in self.children[node].values():
                if edits <= self.most[child] and edits < least.get(child, 99):
                    least[child] = edits
                    todo.append(child)
        return frozenset(least.items())

    def _name(self, state: frozenset) -> int:
        if state not in self.names:
            self.names[state] = len(self.sets)
            self.sets.append(state)
            self.steps.append({})
            self.held += len(state)
        return self.names[state]

    def _step(self, name: int, letter: str) -> int:
        least: dict[int, int] = {}
        for node, edits in self.sets[name]:
            if not node and self.first_stands:
                if letter in self.children[0]:
                    least[self.children[0][letter]] = 0
                continue
            if edits < self.most[node] and edits + 1 < least.get(node, 99):
                least[node] = edits + 1  # a letter too many
            for other, child in self.children[node].items():
                cost = edits + (other != letter)
                if cost <= self.most[child] and cost < least.get(child, 99):
                    least[child] = cost
        following = self.steps[name][letter] = self._name(self._closed(least))
        return following

    def distance(self, word: str) -> int:
        """The least edits to a term, or to a stem that the word begins with;
        -1 if no entry is near enough."""
        if len(self.sets) > _STATES_KEPT or self.held > _NODES_KEPT:
            self._forget()
        state, best = self.start, 99
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            found = self.sets[state]
            if not found:
                break
            for node, edits in found:
                if edits <= self.stem[node]:
                    best = min(best, edits)
        else:
            for node, edits in self.sets[state]:
                if edits <= self.term[node]:
                    best = min(best, edits)
        return -1 if best == 99 else best


def context_weight(before: list[str], hit: str, after: list[str]) -> float:
    """Weight of a hit by the words of its window: QUOTED between quotation
    marks or near a word that reports speech, else 1."""
    if any(m.lower() in REPORTS for w in before + after for m in _LETTERS.findall(w)):
        return QUOTED
    opened = hit[:1] in MARKS or sum(w[:1] in MARKS for w in before) > sum(w[-1:] in MARKS for w in before)
    closed = hit.rstrip(".,;:!?")[-1:] in MARKS or any(w.rstrip(".,;:!?")[-1:] in MARKS for w in after)
    return QUOTED if opened and closed else 1.0


class Hits:
    """Features of the texts of a batch."""

    def __init__(self, lexicon: Lexicon):
        self.automaton = Automaton(lexicon, first_stands=False)
        self.standing = Automaton(lexicon)
        self.known = Generations(_WORDS_KEPT)  # hash of a word -> its kind

    def _kind(self, word: str) -> int:
        """-1: no hit, 0: exact, 1: misspelled, 2: misspelled in the first letter."""
        word = _OUTER.sub("", word.lower())
        runs = {word, *_LETTERS.findall(word)} - {""}
        edits = min((d for run in runs if (d := self.automaton.distance(run)) >= 0), default=-1)
        if edits <= 0:
            return edits
        return 1 if any(self.standing.distance(run) >= 0 for run in runs) else 2

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: log of the weights of exact hits, of misspelled ones and of
        those misspelled in the first letter, and the share of hits among its
        words."""
        words = Words(column)
        hashes, which, first = distinct_words(words)
        hashes = hashes.tolist()
        near = self.known.find(hashes)
        new = [i for i, x in enumerate(near) if x is None]
        if new:
            for i, word in zip(new, words.strings(first[new]), strict=True):
                near[i] = self._kind(word)
            self.known.add([hashes[i] for i in new], [near[i] for i in new])
        kinds = np.array(near, dtype=np.int64)[which] if len(which) else np.zeros(0, np.int64)
        at = np.flatnonzero(kinds >= 0)
        doc = np.searchsorted(words.docs, at, "right") - 1
        sums = np.zeros((len(column), 3))
        for i, d in zip(at.tolist(), doc.tolist(), strict=True):
            a, b = max(int(words.docs[d]), i - CONTEXT), min(int(words.docs[d + 1]), i + CONTEXT + 1)
            window = words.strings(np.arange(a, b))
            weight = context_weight(window[: i - a], window[i - a], window[i - a + 1 :])
            sums[d, kinds[i]] += weight
        share = sums.sum(1) / np.maximum(np.diff(words.docs), 1)
        return np.c_[np.log1p(sums), np.minimum(share, 0.2)]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, y): the distinct words of each text and their first 4 to 8
    letters; a word ends in a space."""
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            entries = set()
            for word in set(_LETTERS.findall(text.lower())):
                if 3 <= len(word) <= LONGEST_TERM:
                    entries.add(word + " ")
                entries.update(word[:k] for k in range(4, min(len(word), 9)))
            yield pa.RecordBatch.from_pydict(
                {"entry": pa.array(list(entries), pa.string()), "y": pa.array([y] * len(entries), pa.int32())}
            )


BANDS = 3


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """y, body and MinHash values of the body's word shingles."""
    for batch in batches:
        for part in portions(batch, 1):
            sets = shingle_sets(Words(part.column(1), lower=True))
            marks = [[int(s[0] if k == 0 else (s * _ODD[k]).min()) >> 1 if len(s) else 0 for s in sets] for k in range(BANDS)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(m, pa.int64()) for m in marks)],
                ["y", "body", *(f"m{k}" for k in range(BANDS))],
            )


def _without_near_copies(rows: DataFrame) -> DataFrame:
    """(y, body): of texts of one class that share a MinHash value, one stays,
    so that the odd words of one text copied with small changes do not look
    like words of many toxic texts."""
    names = [f"m{k}" for k in range(BANDS)]
    thin = rows.mapInArrow(_marks, "y int, body string, " + ", ".join(f"{m} long" for m in names))
    for m in names:
        one = F.min(F.struct(F.xxhash64("body").alias("h"), "body", *names)).alias("one")
        thin = thin.groupBy("y", F.col(m).alias("by")).agg(one).select("y", "one.body", *[f"one.{x}" for x in names])
    return thin.select("y", "body")


def choose_entries(counts: list[tuple[str, int]], most_terms: int) -> Lexicon:
    """Terms and stems from (entry, toxic texts that hold it): a stem counts
    only if no single word explains it, the longest of equal ones is taken, and
    what a chosen stem covers is left out."""
    words = {e[:-1]: n for e, n in counts if e.endswith(" ")}
    stems: dict[str, int] = {}
    prefixes = sorted(((e, n) for e, n in counts if not e.endswith(" ")), key=lambda x: (-len(x[0]), x[0]))
    for stem, n in prefixes:
        explained = max((m for w, m in words.items() if w.startswith(stem)), default=0)
        longer = max((m for s, m in stems.items() if s.startswith(stem)), default=0)
        if explained < 0.8 * n and longer < 0.9 * n:
            stems = {s: m for s, m in stems.items() if not s.startswith(stem)}
            stems[stem] = n
    terms = {w: n for w, n in words.items() if not any(w.startswith(s) for s in stems)}
    best = sorted([*((n, w, 0) for w, n in terms.items()), *((n, s, 1) for s, n in stems.items())], reverse=True)
    best = best[:most_terms]
    return Lexicon(
        tuple(sorted(e for _, e, kind in best if kind == 0)), tuple(sorted(e for _, e, kind in best if kind == 1))
    )


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    calibration: Logistic


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    per_class: int = 3000,
    most_terms: int = 500,
    least_share: float = 0.01,
    precision: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    bounded_batches(docs.sparkSession)
    sample = label_sample(labels, label, per_class, id_col)
    # at most 2 * per_class rows
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).join(F.broadcast(sample), "id")
    chosen = staged(_without_near_copies(rows.select("y", "body")), "toxicity-sample")
    n_toxic = chosen.where("y = 1").count()
    least = max(5, int(least_share * n_toxic))
    counts = (
        chosen.mapInArrow(_entries, "entry string, y int")
        .groupBy("entry")
        .agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
        .where((F.col("toxic") >= least) & (F.col("toxic") >= precision * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "entry")
        .limit(20 * most_terms)
        .collect()
    )
    lexicon = choose_entries([(r.entry, r.toxic) for r in counts], most_terms)
    measured = chosen.select("y", _features(lexicon)("body").alias("x")).collect()
    x = np.array([r.x for r in measured], dtype=float).reshape(len(measured), 4)
    y = np.array([r.y for r in measured], dtype=float)
    order = np.lexsort([*x.T, y])  # the sums do not depend on the order of arrival
    x, y = x[order], y[order]
    # A hit never speaks for a text: what would is left out of the calibration.
    while min((calibration := fit_logistic(x, y)).weights[1:]) < 0:
        x[:, int(np.argmin(calibration.weights[1:]))] = 0.0
    return ToxicityModel(lexicon, calibration)


def row_parts(column: pa.Array) -> Iterator[pa.Array]:
    for a, b in parts(column, 4 << 20):
        yield column.slice(a, b - a)
    release()


def _features(lexicon: Lexicon):
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hits = Hits(lexicon)
        for batch in batches:
            rows = [r for part in row_parts(batch) for r in hits.features(part).tolist()]
            yield pa.array(rows, pa.list_(pa.float64()))

    return features


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score from 0 to 1 of a text; higher: label 1 is likelier."""
    lexicon, calibration = model.lexicon, model.calibration

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hits = Hits(lexicon)
        for batch in batches:
            rows = [calibration(hits.features(part)) for part in row_parts(batch)]
            yield pa.array(np.concatenate(rows) if rows else np.zeros(0))

    return score(F.coalesce(text, F.lit("")))
