"""Registered queries against their SQL, the pipeline against its parts, and
the rest of the library without this subpackage."""

from __future__ import annotations

import subprocess
import sys

import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import jaccard_join, quality
from quarry.llm.queries import ORACLE, QUERIES
from quarry.llm.words import Words, rolling, windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, views, name):
    got = QUERIES[name](spark, SF)
    want = views.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = [tuple(r) for r in got.select(names).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names


def test_pipeline_equals_its_stages_by_hand(spark):
    """Which documents each stage keeps, by brute force on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_filter", "exact_dedup", "near_dedup", "decontamination", "packing"]
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frames.append(stage(spark, frames[-1], SF))
        assert frames[-1].columns == docs.columns
        frames[-1] = frames[-1].cache()
    rows = [[(r.doc_id, r.text) for r in f.collect()] for f in frames]
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = docs.select("doc_id", quality.quality_score(model, docs["text"]).alias("s")).collect()
    assert {i for i, _ in rows[1]} == {r.doc_id for r in scores if r.s >= 0.3}
    assert {i for i, _ in rows[2]} == {m[0] for m in brute.exact_copies(rows[1]) if m[3]}
    assert {i for i, _ in rows[3]} == {i for i, n, c in brute.near_components(rows[2]) if not n or c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {i for i, _ in rows[4]} == {i for i, _ in rows[3]} - {leak[0] for leak in brute.leaks(rows[3], items)}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in rows[4]}
    for f in frames[1:]:
        f.unpersist()


def test_entry_works_without_the_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['quarry.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'movie_rating_stats' in q and 'pipeline' not in q\n"
        "assert not any(x.startswith('op') and x[2].isdigit() for x in [*q, *e.oracle_sql()])"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rpartition("/")[0], timeout=120)


def test_hashes_follow_the_words(odd):
    """Equal words and windows have equal hashes wherever they stand."""
    import pyarrow as pa

    texts = [t for _, t in odd]
    words = Words(pa.array(texts), lower=True)
    seen, sums = {}, {}
    roll, wide = rolling(words.hashes, 3), windows(words.hashes, 3)
    for k, text in enumerate(texts):
        a, b = int(words.docs[k]), int(words.docs[k + 1])
        plain = brute.words(brute.lowered(text))
        assert b - a == len(plain)
        for i, word in enumerate(plain):
            assert seen.setdefault(word, words.hashes[a + i]) == words.hashes[a + i]
        for i in range(len(plain) - 2):
            key = tuple(plain[i : i + 3])
            pair = (roll[a + i], wide[a + i])
            assert sums.setdefault(key, pair) == pair
    assert len(set(seen.values())) == len(seen) and len(set(sums.values())) == len(sums)


def test_packed_sets_compare_like_whole_ones():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60)).astype(np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1), replace=False), rng.integers(0, 1 << 63, 4).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        want = 100 * both >= 75 * (len(a) + len(b) - both)
        assert jaccard_join.linked(jaccard_join.unpacked(jaccard_join.packed(a)), jaccard_join.unpacked(jaccard_join.packed(b))) == want
