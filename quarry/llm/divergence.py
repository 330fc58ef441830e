"""Source divergence audit: how far the word use of each source of a language
lies from every other source of it, and which terms mark a source.

Every (lang, source) group and every language as a whole has a smoothed
frequency p of each kept term, in parts of `SCALE`; two frequencies differ by
f(p, q) = floor((p - q)^2 / (p + q)). All arithmetic is on whole numbers.

Method: duplicate-text collapse. Equal texts of a language are one row with
its number of copies in each source; that row is tokenized once, and each of
its terms adds to the document frequency and to the counts with these
multiplicities. Then pairs of sources are evaluated sparsely: with b(s) the
frequency of a term that s does not hold (one number per source),

    sum of f(p_a, p_b) over all V terms
      =  sum over a's terms of f(p_a, b_b)  +  sum over b's terms of f(b_a, p_b)
       + (V - |a| - |b|) f(b_a, b_b)
       + sum over shared terms of f(p_a, p_b) - f(p_a, b_b) - f(b_a, p_b) + f(b_a, b_b)

so only terms that both hold are met pairwise. The first two sums depend on a
term's count alone and run over the histogram of counts, not over terms.

Plan. (1) Copies per (lang, SHA-256 of the text, source), without texts; one
text per (lang, SHA-256): the only shuffle of texts, compressed and combined
before it, so a text that a third of all rows share is one row per task. The two
meet on the partitioning they have. (2) `mapInArrow` tokenizes a batch in numpy over
its UTF-8 buffer and sends one row per term and source of the batch; Spark sums
them. (3) Kept terms are one row with the list of sources that hold it (no
longer than a language has sources); its pairs of sources are evaluated in
numpy in blocks of `_PAIRS` and added up there, so no row per term and pair is
ever made. Everything is keyed by language and term; nothing is collected.

Defined cases: null text, lang and source are ''. A group whose documents hold
no kept term has every term at the frequency of an unseen one; without kept
terms a pair's value is 0. A language with one source has no pairs. Without
rows the result is empty. Repeated rows are documents of their own. Ids and
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, staged, text_or_empty
from quarry.llm.words import release, text_buffer

SCALE = 1_000_000_000
LEAST_DOCS = 10
TOP_TERMS = 10
SALTS = 32
_PAIRS = 1 << 18  # pairs evaluated at a time
_PIECE = 1 << 21  # bytes of text split at a time
_TEXTS = 8 << 20  # bytes of text counted at a time

# Bytes of a term: ASCII letters and all bytes of other characters; A-Z as a-z.
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (N + 2 V)); whole numbers of up to 38 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(2)).cast("decimal(20,0)")
    below = (total + F.lit(2) * terms).cast("decimal(20,0)")
    return F.lit(1) + _div(above, below)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    """f = floor((p - q)^2 / (p + q)); below 10^18 before the division."""
    return _div((p - q) * (p - q), p + q)


def _name(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def collapsed(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per language and text: lang, packed (the text, compressed), and
    `copies`, its number of documents in each source."""
    rows = docs.select(
        _name(lang_col).alias("lang"),
        _name(source_col).alias("source"),
        text_or_empty(text_col).alias("body"),
    ).withColumn("sha", F.unhex(F.sha2("body", 256)))
    per_source = rows.groupBy("lang", "sha", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = per_source.groupBy("lang", "sha").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.select("lang", "sha", F.arrow_udf(_packed, "binary")("body").alias("packed"))
    texts = texts.groupBy("lang", "sha").agg(F.first("packed").alias("packed"))
    return texts.join(copies.hint("merge"), ["lang", "sha"]).select("lang", "packed", "copies")


def _packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    writer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.array([writer.compress(x.as_py().encode()) for x in batch], pa.binary())


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """The batch in portions of about `_TEXTS` bytes of text, with their texts."""
    reader, texts, size, first = zstandard.ZstdDecompressor(), [], 0, 0
    for row, data in enumerate(batch.column(1)):
        texts.append(reader.decompress(data.as_py()))
        size += len(texts[-1])
        if size >= _TEXTS:
            yield batch.slice(first, len(texts)), pa.array(texts, pa.binary()).cast(pa.large_string())
            texts, size, first = [], 0, row + 1
    if texts:
        yield batch.slice(first, len(texts)), pa.array(texts, pa.binary()).cast(pa.large_string())


def _pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about `_PIECE` bytes that cut no term."""
    low, n = 0, len(data)
    while low < n:
        high = min(low + _PIECE, n)
        # forward to the next byte outside a term, or to the next text
        step = 1 << 12
        while high < n and _TERM[data[high - 1]] and _TERM[data[high]]:
            stop = int(at[np.searchsorted(at, high, "left")])
            outside = np.flatnonzero(~_TERM[data[high : min(high + step, stop)]])
            if len(outside):
                high += int(outside[0])
            else:
                high = min(high + step, stop)
                if high == stop:
                    break
        yield low, high
        low = high


def terms_of(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(row, term) of every term of the column, in pieces."""
    data, at = text_buffer(column)
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    for low, high in _pieces(data, at):
        starts = np.flatnonzero(begin[low:high]) + low
        ends = np.flatnonzero(end[low:high]) + low + 1
        if not len(starts):
            continue
        kept = np.zeros(high - low + 1, dtype=np.int64)
        np.cumsum(inside[low:high], out=kept[1:])
        offsets = np.concatenate([kept[starts - low], kept[ends[-1:] - low]]).astype(np.int32)
        letters = _FOLD[data[low:high][inside[low:high]]]
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        yield np.searchsorted(at, starts, "right") - 1, words


def _counted(rows: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Distinct (row, word): rows, the dictionary, word indices, occurrences."""
    coded = words.dictionary_encode()
    key = rows.astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy()
    key, n = np.unique(key, return_counts=True)
    return key // len(coded.dictionary), coded.dictionary, key % len(coded.dictionary), n


def count_terms(texts: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it)
    of the table `collapsed` makes."""
    bounded_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body in (part for whole in batches for part in _unpacked(whole)):
            langs = batch.column(0).dictionary_encode()
            lists = batch.column(2)
            sources = lists.flatten().field("source").dictionary_encode()
            copies = lists.flatten().field("n").to_numpy()
            list_at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            lang_of, source_of = langs.indices.to_numpy(), sources.indices.to_numpy()
            n_sources = max(len(sources.dictionary), 1)
            # a long text comes in several pieces; it is one document of each of its terms
            pending: list[pa.Table] = []
            for rows, words in terms_of(body):
                row, dictionary, word, n = _counted(rows, words)
                pending.append(pa.table({"row": row, "term": dictionary.take(pa.array(word)), "n": n}))
            if not pending:
                continue
            found = pa.concat_tables(pending).group_by(["row", "term"]).aggregate([("n", "sum")])
            row = found.column("row").to_numpy()
            term = found.column("term").combine_chunks().dictionary_encode()
            n = found.column("n_sum").to_numpy()
            sizes = list_at[row + 1] - list_at[row]
            which = np.repeat(np.arange(len(row)), sizes)
            first = np.cumsum(sizes) - sizes
            place = list_at[row][which] + np.arange(len(which)) - first[which]
            group = lang_of[row[which]].astype(np.int64) * n_sources + source_of[place]
            key = group * len(term.dictionary) + term.indices.to_numpy()[which]
            key, at = np.unique(key, return_inverse=True)
            docs, total = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            np.add.at(docs, at, copies[place])
            np.add.at(total, at, copies[place] * n[which])
            group, word = np.divmod(key, len(term.dictionary))
            out = pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(group // n_sources)),
                    sources.dictionary.take(pa.array(group % n_sources)),
                    term.dictionary.take(pa.array(word)),
                    pa.array(total),
                    pa.array(docs),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
            for a in range(0, len(key), 1 << 16):
                yield out.slice(a, 1 << 16)
        release()

    kind = "lang string, source string, term string, n long, docs long"
    parts = texts.select("lang", "packed", "copies").mapInArrow(count, kind)
    return parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(counts: DataFrame, least_docs: int) -> DataFrame:
    """Terms in at least `least_docs` documents of their language: lang, term,
    lang_n, and `held`, the (source, n) that hold it."""
    whole = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("held")
    )
    return whole.where(F.col("docs") >= least_docs).select("lang", "term", "lang_n", "held")


def _shared_terms(held: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources, a < b), and the sum over terms that both
    hold of f(p_a, p_b) - f(p_a, b_b) - f(b_a, p_b) + f(b_a, b_b)."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def pairs(k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs i < j below k, about `_PAIRS` at a time."""
        low = 0
        while low < k - 1:
            high = min(k - 1, low + max(1, _PAIRS // k))
            i, j = np.nonzero(np.arange(low, high)[:, None] < np.arange(k))
            yield i + low, j
            low = high

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            entries = lists.flatten()
            source, p, base = (entries.field(x).to_numpy().astype(np.int64) for x in ("s", "p", "base"))
            lang_of = langs.indices.to_numpy()
            for k in np.unique(sizes):
                if k < 2:
                    continue
                terms = np.flatnonzero(sizes == k)
                for i, j in pairs(int(k)):
                    step = max(1, _PAIRS // len(i))
                    for t in range(0, len(terms), step):
                        some = terms[t : t + step]
                        at = (ends[some] - k)[:, None]
                        x, y = (at + i).ravel(), (at + j).ravel()
                        x, y = np.where(source[x] < source[y], x, y), np.where(source[x] < source[y], y, x)
                        value = f(p[x], p[y]) - f(p[x], base[y]) - f(base[x], p[y]) + f(base[x], base[y])
                        lang = np.repeat(lang_of[some], len(i))
                        order = np.lexsort([source[y], source[x], lang])
                        lang, a, b, value = lang[order], source[x][order], source[y][order], value[order]
                        new = np.flatnonzero(
                            np.r_[True, (lang[1:] != lang[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
                        )
                        yield pa.RecordBatch.from_arrays(
                            [
                                langs.dictionary.take(pa.array(lang[new])),
                                pa.array(a[new]),
                                pa.array(b[new]),
                                pa.array(np.add.reduceat(value, new)),
                            ],
                            names=["lang", "a", "b", "value"],
                        )
        release()

    parts = held.mapInArrow(add, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("shared"))


def audit_sources(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank: the distance of
    each source to each other source of its language, and the `top_terms` terms
    that mark it against the whole language."""
    texts = collapsed(docs, lang_col, source_col, text_col)
    kept = staged(kept_counts(count_terms(texts), least_docs), "kept-terms")
    entries = kept.select("lang", "term", "lang_n", F.explode("held").alias("h")).select(
        "lang", "term", "lang_n", "h.source", "h.n"
    )
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = (
        docs.select(_name(lang_col).alias("lang"), _name(source_col).alias("source"))
        .distinct()
        .join(entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "v", "lang_total"])
        # a row per source of a language, no more than its pairs have
        .withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
        .withColumn("base", F.when(F.col("v") > 0, frequency(F.lit(0), F.col("total"), F.col("v"))))
    )
    groups = staged(groups, "groups")
    rows = entries.join(groups, ["lang", "source"])
    p = frequency(F.col("n"), F.col("total"), F.col("v"))
    q = frequency(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    rows = rows.select("lang", "source", "s", "term", "n", "base", p.alias("p"), q.alias("q"))

    marks = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    marks = marks.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_terms)

    # f(p_a, b_b) over a's terms: one row per count that occurs, against each
    # source. Languages are few, so their keys are salted.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    counted = rows.groupBy("lang", "s", "p").agg(F.count(F.lit(1)).alias("times"))
    counted = counted.withColumn("salt", F.pmod(F.hash("s", "p"), F.lit(SALTS)))
    others = groups.where("v > 0").select("lang", F.col("s").alias("o"), F.col("base").alias("other"), salts)
    alone = staged(
        counted.join(others, ["lang", "salt"])
        .where("s <> o")
        .groupBy("lang", "s", "o")
        .agg(F.sum(distance(F.col("p"), F.col("other")) * F.col("times")).alias("value")),
        "one-sided",
    )
    from_a = alone.select("lang", F.col("s").alias("a"), F.col("o").alias("b"), F.col("value").alias("from_a"))
    from_b = alone.select("lang", F.col("o").alias("a"), F.col("s").alias("b"), F.col("value").alias("from_b"))

    held = rows.groupBy("lang", "term").agg(F.collect_list(F.struct("s", "p", "base")).alias("held"))
    shared = _shared_terms(held.where(F.size("held") > 1).select("lang", "held"))
    one = groups.select(
        "lang", F.col("s").alias("a"), F.col("source").alias("x"), F.col("terms").alias("n_a"), F.col("base").alias("b_a"), "v",
        F.pmod("s", F.lit(SALTS)).cast("int").alias("salt"),
    )
    two = groups.select(
        "lang", F.col("s").alias("b"), F.col("source").alias("y"), F.col("terms").alias("n_b"), F.col("base").alias("b_b"), salts
    )
    pairs = (
        one.join(two, ["lang", "salt"])
        .where("a < b")
        .withColumn("unseen", F.coalesce(distance(F.col("b_a"), F.col("b_b")), F.lit(0)))
        .join(shared, ["lang", "a", "b"], "left")
        .join(from_a, ["lang", "a", "b"], "left")
        .join(from_b, ["lang", "a", "b"], "left")
        .na.fill(0, ["shared", "from_a", "from_b"])
        .withColumn("value", F.expr("shared + from_a + from_b + (v - n_a - n_b) * unseen"))
    )
    x, y = F.col("x"), F.col("y")
    both = F.array(F.struct(x.alias("source"), y.alias("item")), F.struct(y.alias("source"), x.alias("item")))
    pairs = pairs.select("lang", F.explode(both).alias("p"), "value").select("lang", "p.source", "p.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair"))
        .select(columns)
        .unionByName(marks.withColumn("part", F.lit("term")).select(columns))
    )
