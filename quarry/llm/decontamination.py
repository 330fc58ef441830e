"""Benchmark decontamination: short test items inside long documents.

Size-partitioned MinHash containment search. Items are partitioned by their
number of shingles, in octaves; each class has its own sketch:

* an item of n shingles is sketched by its n // 4 + 1 smallest hashes. A document
  that holds three quarters of the n shingles lacks at most n // 4 of them, so
  it holds one of the sketch for sure, however long it is;
* the largest hash in the sketches of a class is the class's bound: a document's
  sketch for that class is its hashes up to the bound. The larger the items of
  a class, the smaller the share of a document that it has to be asked for (about
  a third of the hashes for items of 32 shingles, nearly all for items of 5).

Class by class the documents' sketches meet the items', and candidates are
verified by exact containment of the shingles' words. The search loses no item
at the threshold of 0.75, and what it finds is exact.

Shingles are five consecutive lower-case words (`[^\\x20\\x09-\\x0D]+`). An
item of k < 5 words has shingles of k words, that is one, and a class of its own:
it is contained in every document that holds these words in a row.

Scale: only DataFrame functions. The classes' bounds, one number per octave, are
the only thing collected. The sketches are written and read back, so Spark
broadcasts them only while their file is under its broadcast threshold, and
joins by a shuffle beyond it; then only sketched hashes are shuffled. An item
that stands in a third of all documents gives one candidate row per document.

Defined cases: a null or empty text holds nothing and a null or empty item is
contained in nothing; rows that repeat (id and text) each give a result row per
item; items that repeat are told apart by id, and equal (id, text) item rows
count once; a null id stays null. Columns other than id and text are not read
by `find_leaks` and pass through `drop_leaks` under any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE_CLASS, SPACES, by_shuffle, row_key, staged, text_or_empty

SHINGLE = 5


def words(column: str) -> Column:
    """Lower-case words of a text; none for a null or blank one."""
    trimmed = F.btrim(F.lower(text_or_empty(column)), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _positions(words_col: str, size: int) -> Column:
    last = F.size(words_col) - size
    return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(last, F.lit(0))))


def shingle_hashes(words_col: str, size: int = SHINGLE) -> Column:
    """64-bit hash of every shingle of an array of words, repeats included."""
    return F.transform(
        _positions(words_col, size), lambda i: F.xxhash64(*[F.get(words_col, i + k) for k in range(size)])
    )


def shingle_texts(words_col: str, size: int = SHINGLE) -> Column:
    """The distinct shingles as text."""
    return F.array_distinct(
        F.transform(_positions(words_col, size), lambda i: F.concat_ws(" ", F.slice(words_col, i + 1, size)))
    )


def _by_size(k: Column, size: int, made) -> Column:
    """`made(j)` for the shingle length j that k holds."""
    out = F.when(k == size, made(size))
    for j in range(1, size):
        out = out.when(k == j, made(j))
    return out


def item_sketches(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = SHINGLE
) -> DataFrame:
    """item_id, item (key of id and text), k (words of a shingle), n_shingles,
    size_class (octave of n_shingles; -k for items shorter than a shingle),
    shingles and the sketch of each item that has words."""
    items = (
        benchmark.select(F.col(item_col).alias("item_id"), row_key(item_col, text_col).alias("item"), words(text_col).alias("w"))
        .where(F.size("w") > 0)
        .distinct()
        .withColumn("k", F.least(F.size("w"), F.lit(size)))
    )
    k = F.col("k")
    items = items.select(
        "item_id",
        "item",
        "k",
        _by_size(k, size, lambda j: shingle_texts("w", j)).alias("shingles"),
        _by_size(k, size, lambda j: F.array_sort(F.array_distinct(shingle_hashes("w", j)))).alias("hashes"),
    )
    octave = F.floor(F.log2(F.size("shingles"))).cast("int")
    return items.select(
        "item_id",
        "item",
        "k",
        F.size("shingles").alias("n_shingles"),
        F.when(k < size, -k).otherwise(octave).alias("size_class"),
        "shingles",
        F.slice("hashes", F.lit(1), F.floor(F.size("shingles") / 4).cast("int") + 1).alias("sketch"),
    )


def class_bounds(items: DataFrame) -> dict[int, int]:
    """The largest sketched hash of each size class (one row per octave)."""
    rows = items.groupBy("size_class").agg(F.max(F.array_max("sketch")).alias("bound")).collect()
    return {r.size_class: r.bound for r in sorted(rows, key=lambda r: r.size_class)}


def document_sketches(words_col: str, bounds: dict[int, int], size: int, rows: DataFrame) -> DataFrame:
    """key, size_class, hash: the sketches of the documents `rows` (key and their
    words) for every class, the distinct hashes up to the class's bound. A
    document's hashes are made once for each shingle length that items have."""
    lengths = sorted({-name if name < 0 else size for name in bounds})
    hashed = rows.select("key", *[F.array_distinct(shingle_hashes(words_col, j)).alias(f"hashes_{j}") for j in lengths])
    parts = [F.array().cast("array<struct<size_class: int, hash: bigint>>")]
    parts += [_up_to(f"hashes_{-name if name < 0 else size}", name, bound) for name, bound in bounds.items()]
    return hashed.select("key", F.explode(F.concat(*parts)).alias("s")).select("key", "s.size_class", "s.hash")


def _up_to(hashes: str, name: int, bound: int) -> Column:
    low = F.filter(hashes, lambda h: h <= F.lit(bound).cast("long"))
    return F.transform(low, lambda h: F.struct(F.lit(name).alias("size_class"), h.alias("hash")))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = SHINGLE,
) -> DataFrame:
    """key (of the document row), doc_id, item_id, n_shingles (of the item),
    n_shared for every document row and item whose containment is 0.75 or more."""
    items = staged(item_sketches(benchmark, item_col, item_text_col, size), "items")
    sketches = staged(items.select("item", "size_class", F.explode("sketch").alias("hash")), "sketches")
    bounds = class_bounds(items)
    lengths = sorted({-c if c < 0 else size for c in bounds})
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    asked = document_sketches("w", bounds, size, texts.select("key", words("t").alias("w")))
    candidates = staged(
        asked.join(sketches, ["size_class", "hash"])
        .select("key", "item")
        .distinct()
        .groupBy("key")
        .agg(F.collect_list("item").alias("found")),
        "candidates",
    )
    # the document's shingles of every length that items have, once per document
    held = F.create_map(*[x for j in lengths for x in (F.lit(j), shingle_texts("w", j))]) if lengths else None
    if held is None:
        held = F.lit(None).cast("map<int, array<string>>")
    verified = (
        texts.join(candidates, "key")
        .select("key", "doc_id", "found", words("t").alias("w"))
        .select("key", "doc_id", "found", held.alias("held"))
        .select("key", "doc_id", "held", F.explode("found").alias("item"))
        .join(items.select("item", "item_id", "k", "n_shingles", F.col("shingles").alias("wanted")), "item")
        .withColumn("n_shared", F.size(F.array_intersect("wanted", F.col("held")[F.col("k")])))
    )
    return verified.where(F.col("n_shared") * 4 >= F.col("n_shingles") * 3).select(
        "key", "doc_id", "item_id", "n_shingles", "n_shared"
    )


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that contain no item, with all their columns."""
    leaks = staged(
        find_leaks(docs, benchmark, id_col, text_col, item_col, item_text_col).select("key").distinct(), "leaks"
    )
    rows = docs.select(F.struct("*").alias("row"), row_key(id_col, text_col).alias("key"))
    return rows.join(by_shuffle(leaks), "key", "left_anti").select("row.*")
