"""Exact n-gram Jaccard join with set-relation skipping.

Documents are sets of distinct word shingles; two link when their Jaccard
similarity is 0.75 or more. The result is each document's class of reachable
documents. All links are exact; the work of finding them is cut by relations
between sets:

* Equal sets form one class, and only classes are joined.
* Index lists: shingles are ordered from rare to frequent (counts of all
  shingles in a fixed number of hash cells) and a set is listed under its
  prefix, the shingles of which a linked set must hold one.
* Block skips: a list is cut into blocks of set sizes, and a set meets only
  its own block and the next; positions in the two prefixes and the number of
  shared prefix shingles bound the overlap, and pairs whose bound is too small
  are skipped. Lists with the same members
  are one list, that of their first shingle.
* Derived answers: in each list all sets are first compared with one pivot,
  the set with the fewest shingles before the list's. The sets that link with
  it share their answers: they are in reach of each other whatever their own
  similarity. Only sets that the pivots did not bring together meet again, in
  cells: a set's position in the list bounds the sizes of the sets that it can
  still link with, so it skips to the size cells within that bound and meets
  only the sets of these. So a group of near copies costs one comparison for
  each copy, not one for each pair.

Scale: five passes over the texts, none shuffles text. Prefix shingles are
shuffled once (16 bytes each) to find those that two classes share; a Bloom
filter of these lets the next pass emit little more than what meets, and one of
row keys lets the comparisons read again only the texts they need (see
`filters`: past their size both become plain joins by shuffle). Hot lists
are aggregated before their shuffle and joined through written tables, which
adaptive execution splits. Pairs, links and components stay distributed; the
driver receives arrays of fixed size, once each.

Defined cases: a null text is empty; a text without words links with nothing
and is its own component; fewer than five words are one shingle; a null id
never is a component's smallest id unless no other id is there (then the
component is null); rows that repeat id or text are documents like any other;
very long texts are sets like any other. Other columns are never read.
Classes are told apart by 128 bits: a 64-bit name, and where two sets share one,
which a second hash shows, that hash in its place. Shingles are 64-bit hashes,
compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, by_shuffle, staged, text_or_empty
from quarry.llm.components import connected_components
from quarry.llm.filters import bloom, contains, maybe_in, merged, sliced
from quarry.llm.words import Words, portions, shingle_sets

SHINGLE = 5
# The threshold 0.75 as 3 / 4, and as 3 / 7 of the sum of the sizes.
CELLS = 21  # bits: two million cells count the shingles
_LAST_ID = 9223372036854775807
_BLOCK = math.log(1.34)  # sizes of linked sets differ by 4 / 3 at most, so blocks by one


def digests(shingles: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit hashes of a set of shingles."""
    wide = xxhash.xxh3_128_intdigest(shingles.tobytes())
    low, high = np.array([wide & 0xFFFFFFFFFFFFFFFF, wide >> 64], dtype=np.uint64).view(np.int64).tolist()
    return low, high


def class_of(shingles: np.ndarray, collided: frozenset[int] = frozenset()) -> int:
    """Name of a set: its first hash, or the second where sets share the first."""
    low, high = digests(shingles)
    return high if low in collided else low


def prefix_length(n: int) -> int:
    """A set with three quarters of these n shingles holds one of so many."""
    return n - -(-3 * n // 4) + 1


def _sizes_fit(a: str, b: str) -> Column:
    return (F.col(a) * 4 >= F.col(b) * 3) & (F.col(b) * 4 >= F.col(a) * 3)


def _bounds_fit(size_a: str, at_a: str, size_b: str, at_b: str) -> Column:
    """The overlap that the positions of a first common shingle leave possible
    reaches the needed one: 7 * overlap >= 3 * (sizes)."""
    most = F.least(F.col(size_a) - F.col(at_a), F.col(size_b) - F.col(at_b))
    return most * 7 >= (F.col(size_a) + F.col(size_b)) * 3


def _sets(batches: Iterator[pa.RecordBatch], size: int, index: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in portions(batch, index):
            yield part, shingle_sets(Words(part.column(index), lower=True), size)


_MEMBER = "doc_id long, key long, n_shingles long, class long, other long, slice int, data binary"


def _members(size: int):
    """Rows of documents (doc_id, key, n_shingles and both hashes of the set), and
    rows of slices of the task's cell counts."""

    names = ["doc_id", "key", "n_shingles", "class", "other", "slice", "data"]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELLS, dtype=np.int64)
        for part, sets in _sets(batches, size, 2):
            if sets:
                cells = (np.concatenate(sets) >> np.uint64(64 - CELLS)).astype(np.int64)
                cells, times = np.unique(cells, return_counts=True)
                counts[cells] += times
            n = len(sets)
            low, high = zip(*map(digests, sets), strict=True) if n else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names,
            )
        slices = sliced(counts)
        empty = [pa.nulls(slices.num_rows, pa.int64())] * 5
        yield pa.RecordBatch.from_arrays([*empty, *slices.columns], names)

    return members


def _levels(counts: np.ndarray) -> np.ndarray:
    """Frequency of each cell in quarters of an octave, from 0 to 127."""
    return np.minimum(np.round(4 * np.log2(counts + 1.0)), 127).astype(np.uint8)


def ordered(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Keys of a set's shingles in the global order, from rare to frequent; the
    key (positive as a signed number) names the shingle."""
    level = levels[(shingles >> np.uint64(64 - CELLS)).astype(np.int64)].astype(np.uint64)
    return np.sort(level << np.uint64(56) | shingles >> np.uint64(8))


def _prefixes(size: int, levels, shared, collided: frozenset[int]):
    """(key, class, size, position) of prefix shingles; without `shared` all of
    them, and only key and class."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = levels.value, set()
        for _, sets in _sets(batches, size, 0):
            keys, classes, sizes, at = [], [], [], []
            for shingles in sets:
                n = len(shingles)
                if not n or (name := class_of(shingles, collided)) in seen:
                    continue
                seen.add(name)  # one text of each class in a task is enough
                key = ordered(shingles, level)[: prefix_length(n)]
                place = np.arange(len(key))
                if shared is not None:
                    place = place[contains(shared.value, key)]
                    key = key[place]
                keys.append(key)
                at.append(place)
                classes.append(np.full(len(key), name))
                sizes.append(np.full(len(key), n))
            if keys:
                columns = {"key": np.concatenate(keys).view(np.int64), "class": np.concatenate(classes)}
                if shared is not None:
                    columns |= {
                        "size": np.concatenate(sizes).astype(np.int32),
                        "at": np.concatenate(at).astype(np.int32),
                    }
                yield pa.RecordBatch.from_pydict(columns)

    return prefixes


def packed(shingles: np.ndarray) -> bytes:
    return shingles.astype("<u8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _near_sets(size: int, wanted, collided: frozenset[int]):
    """(class, shingles) of the texts whose row key the filter lets pass."""

    def near_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.filter(pa.array(contains(wanted.value, batch.column(0).to_numpy())))
            for _, sets in _sets(iter([near]), size, 1):
                yield pa.RecordBatch.from_pydict(
                    {
                        "class": pa.array([class_of(s, collided) for s in sets], pa.int64()),
                        "shingles": pa.array([packed(s) for s in sets], pa.binary()),
                    }
                )

    return near_sets


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a)) if len(b) else 0
    return 4 * both >= 3 * (len(a) + len(b) - both)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2), batch.column(3), strict=True)
        rows = [linked(unpacked(x.as_py()), unpacked(y.as_py())) for x, y in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(rows, pa.bool_())], ["a", "b", "linked"]
        )


def _verified(
    pairs: DataFrame, members: DataFrame, texts: DataFrame, size: int, collided: frozenset[int]
) -> DataFrame:
    """a, b, linked of every pair, by the whole sets. One text of each class is
    read again; the filter lets only those texts pass, and few others."""
    names = staged(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "compared-classes")
    keys = members.join(names, "class").groupBy("class").agg(F.min("key").alias("key"))
    wanted = bloom(staged(keys, "compared-keys"), "key")
    near = staged(texts.mapInArrow(_near_sets(size, wanted, collided), "class long, shingles binary"), "near-sets")
    one = near.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    two = near.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    return staged(
        pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(_compared, "a long, b long, linked boolean"),
        "verified",
    )


def _labelled(lists: DataFrame, components: DataFrame | None) -> DataFrame:
    """`lists` with each class's component; only lists of several components."""
    if components is None:
        return lists.withColumn("component", F.col("class"))
    named = lists.join(components.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    named = staged(named, "named-lists")
    still_open = (
        named.groupBy("key", "block")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("key", "block")
    )
    return staged(named.join(staged(still_open, "open"), ["key", "block"]), "open-lists")


def _block(size: str) -> Column:
    return F.floor(F.log(F.col(size)) / _BLOCK).cast("int")


def _listed(lists: DataFrame) -> DataFrame:
    """class, size, and per class the names of the lists in its own block and in
    the next (`own`, `next`), with those that stand for several shingles beside
    them (`own_many`, `next_many`: name and weight). Written, so that joins on a
    pivot that a whole group shares are split."""
    named = F.xxhash64("key", "block")
    many = F.struct(named.alias("name"), F.col("weight"))
    aggs = [F.min("size").alias("size")]
    for name, here in (("own", F.col("block") == _block("size")), ("next", F.col("block") != _block("size"))):
        aggs.append(F.collect_list(F.when(here, named)).alias(name))
        aggs.append(F.collect_list(F.when(here & (F.col("weight") > 1), many)).alias(f"{name}_many"))
    return staged(lists.groupBy("class").agg(*aggs), "listed-sets")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose shared prefix shingles leave the needed overlap possible.
    All shared shingles up to the end of the prefix that ends first are in both
    prefixes, so the overlap is at most the number of shared prefix shingles
    and what one of the sets has after its prefix."""
    columns = ("size", "own", "own_many", "next", "next_many")
    one, two = (sets.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")
    larger_a, larger_b = _block("size_a") > _block("size_b"), _block("size_a") < _block("size_b")

    def side(x: str, smaller: Column, kind: str) -> Column:
        # each shared shingle is in one list of the larger set's block
        return F.when(smaller, F.col(f"next{kind}_{x}")).otherwise(F.col(f"own{kind}_{x}"))

    common = F.array_intersect(side("a", larger_b, ""), side("b", larger_a, ""))
    met = (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", "size_a", "size_b", common.alias("common"), side("a", larger_b, "_many").alias("many"))
    )
    more = F.aggregate(
        "many",
        F.lit(0).cast("long"),
        lambda n, x: n + F.when(F.array_contains("common", x["name"]), x["weight"] - 1).otherwise(F.lit(0)),
    )
    shared = F.size("common") + more
    rest = F.greatest(F.ceil(F.col("size_a") * 3 / 4), F.ceil(F.col("size_b") * 3 / 4)) - 1
    return met.where((shared + rest) * 7 >= (F.col("size_a") + F.col("size_b")) * 3).select("a", "b")


# Size cells: a sixteenth of the range in which linked sets' sizes lie.
_CELL = math.log(4 / 3) / 16


def _cell(size: Column) -> Column:
    return F.floor(F.log(size) / _CELL).cast("int")


def _meeting_cells(open_lists: DataFrame) -> DataFrame:
    """key, block, cell and p_ columns: every set of an open list under the size
    cells of the sets, no larger than itself, that it can still link with. With
    `at` shingles before the list's first common one, an overlap of three sevenths
    of both sizes needs a partner of at most (7 / 3) (size - at) - size shingles;
    the further down its list a set stands, the fewer cells it meets."""
    size, at = F.col("size"), F.col("at")
    least = F.ceil(size * 3 / 4).cast("long")
    most = F.least(size.cast("long"), F.floor((size - at) * 7 / 3).cast("long") - size)
    # a cell to spare on both sides, as logarithms are rounded
    cells = F.explode(F.sequence(_cell(least) - 1, _cell(most) + 1))
    columns = [F.col(c).alias(f"p_{c}") for c in ("class", "component", "size", "at")]
    return open_lists.where(most >= least).select("key", "block", cells.alias("cell"), *columns)


def _index_lists(texts: DataFrame, size: int, levels, collided: frozenset[int]) -> DataFrame:
    """key, block, weight, class, size, at: the index lists with two classes or
    more, one of each group of lists with the same members, and how many lists
    it stands for."""
    shared = staged(
        texts.mapInArrow(_prefixes(size, levels, None, collided), "key long, class long")
        .groupBy("key")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low < high")
        .select("key"),
        "shared-shingles",
    )
    block = _block("size")
    postings = staged(
        texts.mapInArrow(
            _prefixes(size, levels, bloom(shared, "key"), collided), "key long, class long, size int, at int"
        )
        .groupBy("key", "class")
        .agg(F.min("size").alias("size"), F.min("at").alias("at")),
        "postings",
    ).withColumn("block", F.explode(F.array(block, block + 1)))
    lists = (
        postings.groupBy("key", "block")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("class").alias("x"),
            F.min("class").alias("low"),
            F.max("class").alias("high"),
        )
        .where("low < high")
        .groupBy("block", "n", "x", "low", "high")
        .agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight"))
        .select("key", "block", "weight")
    )
    lists = staged(lists, "lists").withColumn("list", F.xxhash64("key", "block"))
    near = postings.where(maybe_in(bloom(lists, "list"), F.xxhash64("key", "block")))
    return staged(near.join(lists.drop("list"), ["key", "block"]), "index-lists")


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), text_or_empty(text_col))


def _named(read: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """The members with their class's name, and the first hashes that different
    sets share. Of n sets n^2 / 2^65 such hashes are to be expected, some tens of
    3 * 10^10; these only come to the driver."""
    shared = read.groupBy("class").agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low < high")
    collided = frozenset(r[0] for r in shared.select("class").collect())
    if collided:
        named = F.when(F.col("class").isin(list(collided)), F.col("other")).otherwise(F.col("class"))
        read = read.withColumn("class", named)
    return read.drop("other"), collided


def _named_members(docs: DataFrame, size: int, rounds: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, n_shingles, class, component (a class) of every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col).alias("key"), text_or_empty(text_col).alias("body")
    )
    read = staged(rows.mapInArrow(_members(size), _MEMBER), "members")
    counted = merged(
        read.where(F.col("slice").isNotNull()).select("slice", "data"), 1 << CELLS, np.dtype(np.int64), np.add, _levels
    )
    levels = spark.sparkContext.broadcast(counted)
    members, collided = _named(read.where(F.col("slice").isNull()).drop("slice", "data"))

    lists = _index_lists(rows.select("body"), size, levels, collided)
    listed = _listed(lists)
    texts = rows.select("key", "body")

    done = links = components = None
    for turn in range(rounds + 1):
        open_lists = _labelled(lists, components)
        if turn < rounds:
            # the most central set of each list first, then any by chance
            central = F.col("at") * F.lit(1 << 32) + F.pmod("class", F.lit(1 << 32))
            order = central if turn == 0 else F.xxhash64("class", F.lit(turn))
            pivots = open_lists.groupBy("key", "block").agg(
                *[F.min_by(c, order).alias(f"p_{c}") for c in ("class", "component", "size", "at")]
            )
            partners, on = staged(pivots, "pivots"), ["key", "block"]
            sides = F.col("component") != F.col("p_component")
        else:
            # sets of one list that no pivot brought together, by size cells
            open_lists = open_lists.withColumn("cell", _cell(F.col("size")))
            partners, on = staged(_meeting_cells(open_lists), "meeting-cells"), ["key", "block", "cell"]
            sides = (F.col("class") != F.col("p_class")) & (F.col("component") != F.col("p_component"))
        pairs = (
            open_lists.join(partners, on)
            .where(sides & _sizes_fit("size", "p_size") & _bounds_fit("size", "at", "p_size", "p_at"))
            .select(F.least("class", "p_class").alias("a"), F.greatest("class", "p_class").alias("b"))
            .distinct()
        )
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        done = pairs if done is None else done.unionByName(pairs)
        verified = _verified(staged(_near(pairs, listed), "near-pairs"), members, texts, size, collided)
        new = verified.where("linked").select("a", "b")
        links = new if links is None else links.unionByName(new)
        components = connected_components(links, "a", "b")

    named = members.join(components.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    return staged(named, "named-members")


def _smallest(with_words: DataFrame) -> DataFrame:
    """component, component_id (smallest id), keep (key of one row that has
    it) and size of each component."""
    order = F.coalesce("doc_id", F.lit(_LAST_ID))
    return staged(
        with_words.groupBy("component").agg(
            F.min("doc_id").alias("component_id"), F.min_by("key", order).alias("keep"), F.count(F.lit(1)).alias("n")
        ),
        "smallest",
    )


def similarity_classes(
    docs: DataFrame, size: int = SHINGLE, rounds: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, component_size per row: its number of
    shingles, the smallest id it reaches, itself included, and the number of
    rows in its component."""
    named = _named_members(docs, size, rounds, id_col, text_col)
    with_words = named.where("n_shingles > 0")
    return (
        with_words.join(_smallest(with_words), "component")
        .select("doc_id", "n_shingles", "component_id", F.col("n").alias("component_size"))
        .unionByName(
            named.where("n_shingles = 0").select(
                "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("component_size")
            )
        )
    )


def drop_near_copies(
    docs: DataFrame, size: int = SHINGLE, rounds: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` without near copies, with all their columns: of each
    component the row with the smallest id stays (one row, also where id and text
    are repeated), and all texts without words."""
    with_words = _named_members(docs, size, rounds, id_col, text_col).where("n_shingles > 0")
    named = with_words.join(_smallest(with_words), "component")
    gone = named.where(F.col("key") != F.col("keep")).select("key", "doc_id").distinct()
    # rows that repeat the id and the text of a row that stays, usually none
    again = (
        named.where(F.col("key") == F.col("keep"))
        .groupBy("key", "doc_id")
        .agg(F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select("key", "doc_id")
    )
    again = staged(again, "repeated-rows")
    marked = staged(gone.unionByName(again), "near-copies")
    rows = docs.select(
        F.struct("*").alias("row"), _row_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("doc_id")
    )

    def same(side: DataFrame) -> Column:
        return (rows["key"] == side["key"]) & rows["doc_id"].eqNullSafe(side["doc_id"])

    stay = rows.join(by_shuffle(marked), same(marked), "left_anti").select("row.*")
    one_each = rows.join(again, same(again), "left_semi").dropDuplicates(["key", "doc_id"]).select("row.*")
    return stay.unionByName(one_each)
