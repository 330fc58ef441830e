"""Whitening, language identification and the divergence audit, against plain
versions on odd input."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_test_helpers import CLASHING, frame
from pyspark.sql import functions as F

from quarry.llm import divergence, language_id, whitening
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

# ---------------------------------------------------------------- whitening


def vectors(spark, rows):
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    data = [(i, v, *("clash" for _ in CLASHING)) for i, v in rows]
    return spark.createDataFrame(data, f"vec_id long, embedding array<double>, {names}").repartition(3)


def on_grid(v):
    if not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(256 * c) for c in v)


def plain_whitening(rows, k=4):
    """n, S, falling eigenvalues, components and trace, by numpy over the list."""
    xs = [x for _, v in rows if (x := on_grid(v))]
    d = max(Counter(map(len, xs)).items(), key=lambda c: (c[1], c[0]))[0]
    fit = np.array(sorted({x for x in xs if len(x) == d}), dtype=float)
    a = fit - fit.mean(0)
    values, v = np.linalg.eigh(a.T @ a / len(a))
    return len(fit), fit.sum(0), values[::-1][:k], v[:, ::-1][:, :k], values.sum(), d


def odd_vectors():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + j) for j in range(6)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]  # one vector, many times
    rows += [(2000, None), (2001, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6)]
    rows += [(2004, []), (2005, [1.0, 2.0]), (None, rows[9][1]), rows[11], rows[11], (2006, [-0.0] * 6), (2007, [1e300] * 6)]
    return rows


def test_whitening_equals_numpy(spark):
    rows = odd_vectors()
    df = vectors(spark, rows)
    model = whitening.fit_whitening(whitening.fit_list(df))
    n, sums, values, v, trace, d = plain_whitening(rows[:-1])  # 1e300 is beyond the grid
    assert model.n == n and list(model.sums) == [int(s) for s in sums]
    assert np.allclose(model.eigenvalues, values, rtol=1e-12)
    assert model.trace == pytest.approx(trace, rel=1e-12) and model.identity_error < 1e-9
    assert np.allclose(np.abs((model.components * v).sum(0)), 1, atol=1e-12)
    out = whitening.whiten(df, model).select("vec_id", "embedding", "whitened", "deviation", "hash").collect()
    want = [(i, x) for i, vec in rows[:-1] if (x := on_grid(vec)) and len(x) == d]
    assert Counter(r.vec_id for r in out) == Counter(i for i, _ in want)
    signs = np.sign((model.components * v).sum(0))
    for r in out:
        x = np.array(on_grid(r.embedding))
        assert r.hash == "clash"
        assert int(r.deviation) == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        assert np.allclose(r.whitened, (x - sums / n) @ (v * signs) / np.sqrt(values), atol=1e-9)


def test_whitening_keeps_its_precision_on_ill_conditioned_rows(spark):
    rng = random.Random(4)
    scales = [3e5, 4e3, 50.0, 1.0, 0.05, 0.05]
    rows = []
    for i in range(500):
        z = [s * rng.gauss(0, 1) for s in scales]
        rows.append((i, [z[0], z[0] + z[1], z[1] + z[2], z[2] + z[3], z[3] + z[4], z[5]]))
    df = vectors(spark, rows)
    model = whitening.fit_whitening(whitening.fit_list(df), components=6)
    assert model.passes >= 3 and model.identity_error < 1e-9 and len(model.eigenvalues) == 6
    assert model.eigenvalues[0] / model.eigenvalues[-1] > 1e10


def test_whitening_of_rows_that_span_fewer_dimensions(spark):
    rng = random.Random(5)
    rows = []
    for i in range(99):
        a, b = float(rng.randint(-9, 9)), float(rng.randint(-9, 9))
        rows.append((i, [a, 2 * a, 7.0, b, a + b]))
    model = whitening.fit_whitening(whitening.fit_list(vectors(spark, rows)))
    assert len(model.eigenvalues) == 2 and model.identity_error < 1e-6
    _, _, values, _, _, _ = plain_whitening(rows)
    assert np.allclose(model.eigenvalues, values[:2], rtol=1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_whitening_without_variance_gives_nothing(spark, tmp_path, rows):
    vectors(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op11_whitening"](spark, str(tmp_path)).collect() == []


def test_whitening_of_more_dimensions_than_rows(spark):
    rows = [(i, [float((i * 7 + j * j) % 11) for j in range(12)]) for i in range(5)]
    model = whitening.fit_whitening(whitening.fit_list(vectors(spark, rows)))
    assert model.n == 5 and len(model.eigenvalues) <= 4 and model.identity_error < 1e-6


def test_exact_numbers_beyond_a_long():
    x = np.array([[1 << 50, -(1 << 52)], [3, 5]])
    model = whitening.WhiteningModel(10**7, (12345678901234567890, -7), np.eye(2), np.ones(2), 2.0, 0.0, 1)
    want = [sum((10**7 * int(a) - s) ** 2 for a, s in zip(row, model.sums, strict=True)) for row in x]
    assert whitening.deviations(model, x) == want
    assert np.allclose(whitening.centred(x, model.n, model.sums), [[int(a) - s / 10**7 for a, s in zip(r, model.sums, strict=True)] for r in x])


def test_whitening_query_holds_its_contract(spark):
    out = QUERIES["op11_whitening"](spark, SF).toPandas()
    assert set(out.component) == {1, 2, 3, 4} and (out.identity_error < 1e-4).all()
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(np.cov(wide.T, bias=True), np.eye(4), atol=1e-6)
    assert (out.groupby("component").explained.nunique() == 1).all()


# ------------------------------------------------------------------ language


def plain_bundle(text, dims):
    """The sum of bound trigram vectors, letter by letter."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "\0" for c in text or "")
    vector = np.zeros(dims)
    padded = "\0" + low + "\0"
    of = lambda c: language_id.letter_vectors(np.array([ord(c)], np.uint64), dims)[0].astype(int)
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        if b != "\0":
            vector += np.roll(of(a), 2) * np.roll(of(b), 1) * of(c)
    return vector


TEXTS = ["Hello wörld", None, "", "123 -- \n", "a", "ÀÉî ß İx 日本語 テスト 😀b", "x" * 50, "ab" * 4000 + " cd é", "Ωmega"]


@pytest.mark.parametrize("piece", [16, 1000, 1 << 18])
def test_bundles_equal_the_plain_sum(monkeypatch, piece):
    monkeypatch.setattr(language_id, "_PIECE", piece)
    monkeypatch.setattr(language_id, "_ROWS", 2)
    monkeypatch.setattr(language_id, "_GRAMS", 3)
    got = language_id.bundles(pa.array(["zz", *TEXTS])[1:], np.arange(len(TEXTS)), len(TEXTS), 128)
    for text, vector in zip(TEXTS, got, strict=True):
        assert (vector == plain_bundle(text, 128)).all(), text


def test_prototypes_are_bundles_of_distinct_texts(spark):
    rows = [("aa", "abc abd"), ("aa", "xyz"), ("bb", "qrs"), ("bb", "12"), (None, "abc"), ("cc", "..."), ("cc", None), ("", "leer")]
    rows += [("bb", "qrs")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    model = language_id.fit_languages(docs, dims=128)
    assert model.languages == ("", "aa", "bb")  # cc has no letter to learn from
    sums = np.array([sum(plain_bundle(t, 128) for t in {t for x, t in rows if x == lang}) for lang in model.languages])
    want = language_id.make_model(list(model.languages), sums, 128)
    assert np.allclose(model.prototypes, want.prototypes) and np.allclose(model.mean, want.mean)


def test_prediction_of_odd_rows(spark, odd, odd_docs):
    docs = spark.createDataFrame([("up", "abab baba abba"), ("down", "zyzy yzyz zyyz")], "lang string, text string")
    model = language_id.fit_languages(docs, dims=256)
    out = odd_docs.select("text", language_id.predict_language(model, F.col("text")).alias("p"), "score").collect()
    assert len(out) == len(odd)
    for r in out:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.p.lang, r.p.score) == ("und", 0.0)
        else:
            vector = plain_bundle(r.text, 256) if len(r.text) < 5000 else None
            assert r.p.lang in ("up", "down") and 0 <= r.p.score <= 1
            if vector is not None:
                best, score = language_id.nearest(model, vector[None])
                assert r.p.lang == model.languages[best[0]] and r.p.score == pytest.approx(score[0])


def test_prediction_without_anything_learned(spark, odd_docs, no_docs):
    empty = spark.createDataFrame([], "lang string, text string")
    model = language_id.fit_languages(empty)
    out = odd_docs.select(language_id.predict_language(model, F.col("text")).alias("p")).collect()
    assert {tuple(r.p) for r in out} == {("und", 0.0)}
    one = language_id.fit_languages(spark.createDataFrame([("only", "some text")], "lang string, text string"))
    assert no_docs.select(language_id.predict_language(one, F.col("text"))).collect() == []
    assert odd_docs.where("text = 'one'").select(language_id.predict_language(one, F.col("text")).alias("p")).first().p.lang == "only"


def test_samples_are_bounded_and_copies_count_once(spark):
    rows = [("aa", f"word{i:03d} " + chr(97 + i % 26) * 3) for i in range(3000)] + [("aa", "word001 bbb")] * 3000
    rows += [("bb", "rare")] * 2 + [("zz", "last")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = language_id.fit_languages(docs, dims=64, per_language=300, most_languages=2)
    assert model.languages == ("aa", "bb")
    # the prototype is that of some 300 texts, each once: no text outweighs the others
    common = language_id.make_model(["aa", "bb"], np.array([plain_bundle("word001 bbb", 64), plain_bundle("rare", 64)]), 64)
    assert not np.allclose(model.prototypes, common.prototypes, atol=0.05)


def test_held_out_documents_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = QUERIES["op12_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.985


# --------------------------------------------------------------------- audit


def plain_audit(rows, least=10, top=10):
    """rows: (lang, source, text). The audit by its definition, all terms of all groups."""
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        p = {}
        for source in [s for x, s in counts if x == lang] + [None]:
            have = counts[lang, source] if source is not None else sum((c for (x, _), c in counts.items() if x == lang), Counter())
            total = sum(have[t] for t in kept) + 2 * len(kept)
            p[source] = {t: 1 + 10**9 * (have[t] + 2) // total for t in kept}
        for source in [s for s in p if s is not None]:
            pairs = [(o, sum(f(p[source][t], p[o][t]) for t in kept)) for o in p if o not in (source, None)]
            marks = [
                (t, f(p[source][t], p[None][t])) for t in kept if counts[lang, source][t] and p[source][t] > p[None][t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", marks, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def audit_rows():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("Ab", "cé", "Éa", "日", "x_y", "q9q") for b in ("m", "N", "o", "-p")]
    rows = []
    for i in range(400):
        lang = rng.choice(["aa", "aa", "bb", None, ""])
        words = rng.choices(vocabulary, [1 / (1 + j) for j in range(len(vocabulary))], k=rng.randint(0, 25))
        rows.append((lang, rng.choice(["s1", "s2", "S3", "é", None, ""]), " ".join(words)))
    rows += [("aa", "s1", "same text here")] * 300 + [("aa", "s2", "same text here")] * 5 + [("bb", "s1", "same text here")] * 9
    rows += [("cc", "only", "one source alone")] * 12 + [("dd", "a", "few"), ("dd", "b", "words"), ("dd", "c", None)]
    return rows + [("aa", "late", None), ("aa", "late", ""), ("aa", "late", "zzz" * 3000), rows[3], rows[3]]


def test_audit_equals_brute_force(spark):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], "lang string, source string, text string, sha string, term string, n int")
    got = divergence.audit_sources(docs.repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows)


def test_audit_of_no_rows(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit_sources(docs).collect() == []


def test_equal_texts_are_one_row(spark):
    import zstandard

    docs = spark.createDataFrame(audit_rows(), "lang string, source string, text string")
    texts = divergence.collapsed(docs).collect()
    body = {i: zstandard.decompress(r.packed).decode() if r.packed else "" for i, r in enumerate(texts)}
    assert len({(r.lang, body[i]) for i, r in enumerate(texts)}) == len(texts)
    same = next(r for i, r in enumerate(texts) if (r.lang, body[i]) == ("aa", "same text here"))
    assert {(c.source, c.n) for c in same.copies} == {("s1", 300), ("s2", 5)}
    assert sum(c.n for r in texts for c in r.copies) == len(audit_rows())


@pytest.mark.parametrize("piece", [7, 64, 1 << 21])
def test_terms_of_texts_cut_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(divergence, "_PIECE", piece)
    texts = ["Ab cD", None, "", "éÉ_x9Y", "w" * 9000, "a", "b", "q " * 40, "日本 語", "-"]
    got = [(int(i), t) for rows, words in divergence.terms_of(pa.array(["zz", *texts])[1:]) for i, t in zip(rows, words.to_pylist(), strict=True)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = [(i, t) for i, x in enumerate(texts) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (x or "").translate(lower))]
    assert got == want


def test_audit_reads_only_its_columns(spark):
    plan = divergence.collapsed(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "n_chars" not in plan.split("== Physical Plan ==")[1]


def test_odd_rows_of_the_other_tests_pass_the_audit(spark, odd):
    docs = frame(spark, odd).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit("s"))
    want = plain_audit([(None, "s", t) for _, t in odd])
    assert sorted(tuple(r) for r in divergence.audit_sources(docs).collect()) == want
