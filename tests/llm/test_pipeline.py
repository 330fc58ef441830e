"""Every stage of the pipeline on odd input: nulls, empty and very long texts,
repeated rows, ties, extra and clashing columns, empty tables."""

from __future__ import annotations

from collections import Counter, defaultdict

import brute
import pytest
from llm_test_helpers import CLASHING, sentence

import corpus_pipeline
from quarry.llm import quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def write_tables(spark, path, rows, labels, items):
    """documents, labels and benchmark as a folder of tables; documents carry
    columns with the names that operators use inside."""
    docs = [(i, t, "en" if t else None, "s", len(t or ""), *("clash" for _ in CLASHING)) for i, t in rows]
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folder(spark, odd, tmp_path_factory):
    import random

    rng = random.Random(21)
    # plain good texts and junk to learn from, a file read in twice, and the odd rows
    good = [(1000 + i, sentence(rng, 80) + ". " + sentence(rng, 60)) for i in range(60)]
    junk = [(2000 + i, "!!! ".join([rng.choice(["BUY", "WIN", "NOW"])] * 60) + str(i)) for i in range(60)]
    leaked = [(3000, sentence(rng, 40) + " " + sentence(random.Random(1), 30) + " " + sentence(rng, 40))]
    rows = odd + good + good[:5] + junk + leaked
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk] + [(None, 1, 0), (1000, None, 0), (99999, 0, 1)]
    items = [(1, sentence(random.Random(1), 30)), (2, None), (3, ""), (None, "one two three four five six")]
    return write_tables(spark, tmp_path_factory.mktemp("pipeline"), rows, labels, items), rows, items


@pytest.fixture(scope="module")
def stages(spark, folder):
    """(docs before, rows after) of each stage but the last."""
    path, _, _ = folder
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.staged(stage(spark, docs, path), name)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes, name
        out.append((docs, kept))
        docs = kept
    return out


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_quality_keeps_whole_rows_that_score(spark, folder, stages):
    path, rows, _ = folder
    docs, kept = stages[0]
    model = quality.fit_quality(docs, spark.read.parquet(f"{path}/labels.parquet"))
    scores = docs.select("doc_id", "text", quality.quality_score(model, docs["text"]).alias("s")).collect()
    want = Counter((r.doc_id, r.text) for r in scores if r.s >= corpus_pipeline.LEAST_QUALITY)
    assert Counter(rows_of(kept)) == want and len(scores) == len(rows)
    ids = {i for i, _ in want}
    assert all(1000 + i in ids for i in range(60)) and sum(2000 <= (i or 0) < 2060 for i in ids) <= 3
    assert {r.hash for r in kept.select("hash").collect()} == {"clash"}


def test_exact_dedup_keeps_one_row_of_each_group(stages):
    docs, kept = stages[1]
    groups = defaultdict(list)
    for i, t in rows_of(docs):
        groups[brute.SPACE.sub("", t or "")].append((-len(t or ""), brute.order(i), i, t))
    want = Counter((i, t or "") for _, _, i, t in (min(g, key=lambda x: x[:2]) for g in groups.values()))
    assert Counter((i, t or "") for i, t in rows_of(kept)) == want


def test_near_dedup_keeps_one_row_of_each_component(stages):
    docs, kept = stages[2]
    before = rows_of(docs)
    components = Counter(c for _, n, c in brute.near_components(before) if n)
    left = Counter(i for i, t in rows_of(kept) if brute.words(t))
    assert sum(left.values()) == len(components) or None in components
    assert set(left) >= {c for c in components if c is not None}
    assert sum(not brute.words(t) for _, t in before) == sum(not brute.words(t) for _, t in rows_of(kept))


def test_decontamination_drops_what_holds_an_item(folder, stages):
    _, _, items = folder
    docs, kept = stages[3]
    want = [(i, t) for i, t in rows_of(docs) if not brute.leaks([(i, t)], items)]
    assert Counter(rows_of(kept)) == Counter(want)
    assert 3000 not in {i for i, _ in want}


def test_packing_takes_every_id_of_every_row_once(spark, folder, stages):
    path, _, _ = folder
    docs = stages[-1][1]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    rows = rows_of(docs)
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(i for i, _ in rows)
    for p in pieces:
        assert 0 < p.length <= 4096 and p.start + p.length <= p.doc_tokens
    filled = defaultdict(list)
    for p in pieces:
        filled[p.sequence_id].append((p.offset, p.length))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    by_row = defaultdict(int)
    for p in pieces:
        by_row[p.doc_id] += p.length
    assert all(n >= 1 for n in by_row.values())


def test_whole_run_equals_its_stages(spark, folder, stages):
    path, _, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    assert Counter(p.doc_id for p in out if p.start == 0) == Counter(i for i, _ in rows_of(stages[-1][1]))


def test_a_file_read_twice_is_packed_once(spark, folder, tmp_path):
    path, rows, items = folder
    once = write_tables(spark, tmp_path / "once", rows[-70:], [], [])
    twice = write_tables(spark, tmp_path / "twice", rows[-70:] * 2, [], [])
    a, b = (corpus_pipeline.run(spark, p).groupBy("doc_id", "start").count().collect() for p in (once, twice))
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write_tables(spark, tmp_path / "none", [], [], [])).collect() == []
    texts = [(1, None), (2, ""), (None, " "), (4, "a few words"), (4, "a few words")]
    out = corpus_pipeline.run(spark, write_tables(spark, tmp_path / "some", texts, [], [])).collect()
    assert len(out) == 2 and Counter(p.doc_id for p in out) == Counter([None, 4])
