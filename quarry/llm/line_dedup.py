"""Line dedup by content-defined chunks.

A chunk is a run of lines between two boundaries, and boundaries are chosen by
rolling hashes over the line hashes: the window slides over two consecutive
lines (blank lines are passed over), and a boundary lies between two lines whose
window's value occurs nowhere else in the corpus. What is left between two
boundaries is a passage that recurs, from its first line to its last, wherever
it stands: a boundary depends on the lines beside it alone, so text inserted
before a passage shifts nothing. In a recurring chunk every line goes that a
window covers which, compared byte by byte, occurs before (in a document of a
smaller id, or on an earlier line); its first occurrence stays. Blank lines go
with the lines around them. A single line that recurs between other lines is no
chunk and stays.

(Boundaries where a rolling value is 0 modulo a divisor, the rule this one
replaced, cut every passage's first and last lines off, as these share a chunk
with what stands around it, and missed most short passages whole.)

Plan, DataFrame functions only. (1) Windows are counted by 128-bit rolling
values, without text, combined before the shuffle: a line pair that a third of
all texts hold is a row per task. (2) Windows that recur are named per text
(bounded by its own length), joined to the text, and their bytes written. (3)
One aggregate keyed by (SHA-256, bytes) finds each window's first occurrence: the
comparison of the key is the byte comparison. (4) Later occurrences are marked
and joined to the texts. Joins meet written tables, so adaptive execution splits
a hot window's rows. Work per text grows linearly with its lines.

Defined cases: a null or empty text has no lines; lines of white space alone are
blank; a null id sorts after all ids; rows that repeat an id are one document,
and what is first in one of them is first in all of them; ties within a
document are decided by the line number; texts of one long line keep it. Columns
other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, by_shuffle, row_key, staged, text_or_empty

_LAST_ID = 9223372036854775807
_SPAN = "array<struct<a: int, b: int>>"


def lines(column: str) -> Column:
    text = text_or_empty(column)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))


def windows(lines_col: str) -> Column:
    """a, b (numbers of two lines that follow one another, blank ones passed
    over), h1 and h2 (their 128-bit rolling value) of every window of the lines."""
    marked = F.transform(
        lines_col,
        lambda x, i: F.struct(
            i.alias("i"), (F.btrim(x, F.lit(SPACES)) == "").alias("blank"), F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit(1)).alias("h2")
        ),
    )
    full = F.filter(marked, lambda x: ~x["blank"])
    following = F.slice(full, F.lit(2), F.greatest(F.size(full) - 1, F.lit(0)))
    leading = F.slice(full, F.lit(1), F.greatest(F.size(full) - 1, F.lit(0)))
    return F.zip_with(
        leading,
        following,
        lambda x, y: F.struct(
            x["i"].alias("a"), y["i"].alias("b"), F.xxhash64(x["h1"], y["h1"]).alias("h1"), F.xxhash64(x["h2"], y["h2"]).alias("h2")
        ),
    )


def _place(line: str) -> Column:
    """Order of occurrence: document id, then line."""
    wide = F.coalesce("id", F.lit(_LAST_ID)).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)")
    return wide + F.col(line).cast("decimal(11,0)")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key (of the row), id, a, b, sha of every window whose value recurs, and
    `body`, its two lines."""
    rows = docs.select(
        row_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), lines(text_col).alias("lines")
    )
    met = rows.select("key", F.explode(windows("lines")).alias("w")).select("key", "w.*")
    recurring = staged(
        met.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h1", "h2"),
        "recurring-windows",
    )
    spans = staged(
        met.join(recurring, ["h1", "h2"]).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans"
    )
    named = rows.join(by_shuffle(spans), "key").select("key", "id", "lines", F.explode("spans").alias("s"))
    body = F.concat_ws("\n", F.get("lines", F.col("s.a")), F.get("lines", F.col("s.b")))
    return named.select("key", "id", "s.a", "s.b", body.alias("body")).withColumn("sha", F.unhex(F.sha2("body", 256)))


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, removed (array of start and n of the removed
    runs of lines, in order), kept (the lines that stay, joined by line breaks)
    per row."""
    found = staged(repeated_windows(docs, id_col, text_col), "repeated-windows")
    first = staged(
        found.groupBy("sha", "body")
        .agg(F.count(F.lit(1)).alias("times"), F.min(_place("a")).alias("first"))
        .where("times > 1")
        .select("sha", "first"),
        "first-windows",
    )
    later = staged(
        found.select("key", "sha", "a", "b", _place("a").alias("place"))
        .join(first, "sha")
        .where("place > first")
        .groupBy("key")
        .agg(F.collect_set(F.struct("a", "b")).alias("later")),
        "later-windows",
    )
    texts = docs.select(
        row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), lines(text_col).alias("lines")
    )
    # hash sets of line numbers: linear in the lines of the text
    covered = F.flatten(F.transform(F.coalesce("later", F.array().cast(_SPAN)), lambda s: F.sequence(s["a"], s["b"])))
    numbers = F.when(F.size("lines") == 0, F.array().cast("array<int>")).otherwise(
        F.sequence(F.lit(0), F.size("lines") - 1)
    )
    return (
        texts.join(by_shuffle(later), "key", "left")
        .select("doc_id", "lines", F.array_sort(F.array_distinct(covered)).alias("gone"), numbers.alias("numbers"))
        .select("doc_id", "lines", "gone", F.array_except("numbers", "gone").alias("stay"))
        .select(
            "doc_id",
            F.size("lines").cast("long").alias("n_lines"),
            F.size("gone").cast("long").alias("n_removed"),
            _runs("gone").alias("removed"),
            F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("kept"),
        )
    )


def _runs(numbers: str) -> Column:
    """Ascending numbers as runs: start and n of each."""
    shifted = lambda by: F.transform(numbers, lambda x: x + by)
    starts = F.array_except(numbers, shifted(1))
    stops = F.array_except(shifted(1), numbers)
    return F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), (b - a).alias("n")))
