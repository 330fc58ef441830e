"""Quality and toxicity: the parts against brute force, the whole on labels."""

from __future__ import annotations

import random
import zlib

import pyarrow as pa
import pytest
from llm_test_helpers import frame, sentence

from quarry.llm import quality, toxicity
from quarry.llm.common import held_out, label_sample
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def edits(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def nearest(lexicon, word):
    """Least edits by trying every term and every beginning of the word."""
    found = []
    for term in lexicon.terms:
        d = edits(term, word)
        if d <= toxicity.edits_allowed(term) and term[:1] == word[:1]:
            found.append(d)
    for stem in lexicon.stems:
        allowed = 0 if len(stem) < 8 else 1
        for k in range(1, len(word) + 1):
            if stem[:1] == word[:1] and (d := edits(stem, word[:k])) <= allowed:
                found.append(d)
    return min(found, default=-1)


def test_automaton_equals_trying_every_term():
    rng = random.Random(5)
    terms = ("abba", "badcab", "cabbage", "abracadabra", "bad", "dacabbadca")
    lexicon = toxicity.Lexicon(terms, ("cabd", "abacadab"))
    automaton = toxicity.Automaton(lexicon)
    words = [w for w in terms]
    for _ in range(3000):
        word = list(rng.choice([*terms, "cabdxyz", "abacadabqq", "".join(rng.choice("abcd") for _ in range(8))]))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c", "d"])
        words.append("".join(word))
    for word in words:
        # the first letter must stand; what moves it is no hit
        want = nearest(lexicon, word) if word else -1
        got = automaton.distance(word)
        assert got == want, (word, got, want)


def nearest_of_all(lexicon, word):
    """Least Levenshtein edits to any term or to a stem before any ending; no letter must stand."""
    found = [d for term in lexicon.terms if (d := edits(term, word)) <= toxicity.edits_allowed(term)]
    for stem in lexicon.stems:
        least = min(edits(stem, word[:k]) for k in range(len(word) + 1))
        if least <= (0 if len(stem) < 8 else 1):
            found.append(least)
    return min(found, default=-1)


def test_first_letter_is_edited_like_any_other():
    rng = random.Random(6)
    terms = ("abba", "badcab", "cabbage", "abracadabra", "bad", "dacabbadca")
    lexicon = toxicity.Lexicon(terms, ("cabd", "abacadab"))
    automaton = toxicity.Automaton(lexicon, first_stands=False)
    for _ in range(3000):
        word = list(rng.choice([*terms, "cabdxyz", "abacadabqq", "".join(rng.choice("abcd") for _ in range(8))]))
        for _ in range(rng.randint(0, 3)):
            at = rng.choice((0, rng.randrange(len(word) + 1)))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "c", "d", "0"])
        word = "".join(word)
        if word:
            assert automaton.distance(word) == nearest_of_all(lexicon, word), word


def test_misspelled_words_are_hits():
    hits = toxicity.Hits(toxicity.Lexicon(("idiot", "moron", "stupid", "worthless"), ()))
    for word in ("idot", "id1ot", "m0ron", "st*pid", "w0rthl3ss,"):
        assert hits.features(pa.array([f"you {word} there"]))[0, 1] > 0, word
    for word in ("diot", "adiot", "xworthless", "(1diot!)"):
        assert hits.features(pa.array([f"you {word} there"]))[0, 2] > 0, word
    for word in ("Idiot!", "idiot-moron", "a/moron", "idiot2"):
        assert hits.features(pa.array([f"you {word} there"]))[0, 0] > 0, word
    for word in ("st**id", "2019", "riots", "--", "m00ron"):
        assert not hits.features(pa.array([f"you {word} there"])).any(), word


def test_states_are_forgotten_within_bounds(monkeypatch):
    lexicon = toxicity.Lexicon(("badcab", "abracadabra"), ())
    monkeypatch.setattr(toxicity, "_NODES_KEPT", 10)
    small = toxicity.Automaton(lexicon, first_stands=False)
    for word in ("badcab", "adcab", "bracadabra", "zabracadabra", "badcabs", "none"):
        assert small.distance(word) == nearest_of_all(lexicon, word)


def test_context_tells_quotation():
    plain = toxicity.context_weight(["you", "are", "a"], "moron", ["go", "away"])
    assert plain == 1.0
    assert toxicity.context_weight(["they", "said"], "moron", ["to", "us"]) < plain
    assert toxicity.context_weight(["the"], '"moron"', ["was"]) < plain
    assert toxicity.context_weight(["“what", "a"], "moron", ["he", "is”"]) < plain


def test_label_sample_is_bounded_and_leaves_the_fold_out(spark):
    labels = spark.createDataFrame(
        [(i, i % 3 % 2) for i in range(500)] + [(None, 1), (7, None), (9, 5), (11, 0), (11, 1)], "doc_id long, quality int"
    )
    rows = label_sample(labels, "quality", 40).collect()
    assert len(rows) == 80 and all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, label_sample(labels, "quality", 40).collect()))
    flags = labels.select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in flags)


def labelled(n=160):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        good = i % 2
        text = sentence(rng, 80) if good else " ".join(w + rng.choice(("***", "%%", "$$")) for w in sentence(rng, 80).split())
        toxic = i % 4 < 2
        words = text.split()
        if toxic:
            words[10] = words[30] = rng.choice(("wretchling", "mudbrained"))
        docs.append((i, " ".join(words)))
        labels.append((i, good, int(toxic)))
    return docs, labels


def test_both_learn_from_labels_and_take_odd_rows(spark, odd):
    docs, labels = labelled()
    rows = docs + [(i + 1000 if i is not None else None, t) for i, t in odd]
    df = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    good = quality.fit_quality(df, marks)
    bad = toxicity.fit_toxicity(df, marks)
    assert set(bad.lexicon.terms) >= {"wretchling", "mudbrained"}
    scored = df.select(
        "doc_id", "text", quality.quality_score(good, df["text"]).alias("q"), toxicity.toxicity_score(bad, df["text"]).alias("t")
    ).collect()
    assert len(scored) == len(rows)
    assert all(0 <= r.q <= 1 and 0 <= r.t <= 1 for r in scored)
    truth = {i: (q, t) for i, q, t in labels}
    assert sum((r.q >= 0.3) == truth[r.doc_id][0] for r in scored if r.doc_id in truth) >= 0.97 * len(labels)
    assert sum((r.t >= 0.5) == truth[r.doc_id][1] for r in scored if r.doc_id in truth) >= 0.97 * len(labels)
    misspelled = spark.createDataFrame([("you mudbraned wretchlng " + sentence(random.Random(1), 20),)], "text string")
    assert misspelled.select(toxicity.toxicity_score(bad, misspelled["text"])).first()[0] >= (
        misspelled.select(toxicity.toxicity_score(bad, misspelled["text"].substr(1, 3))).first()[0]
    )


def test_without_labels_or_rows(spark, no_docs):
    docs, _ = labelled(20)
    df = frame(spark, docs)
    for rows, share in (([], 0.5), ([(i, 1, 0) for i in range(20)], None)):
        marks = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        q = quality.fit_quality(df, marks)
        t = toxicity.fit_toxicity(df, marks)
        scores = df.select(quality.quality_score(q, df["text"]).alias("q"), toxicity.toxicity_score(t, df["text"]).alias("t"))
        got = {(round(r.q, 6), round(r.t, 6)) for r in scores.collect()}
        assert len(got) == 1 and (share is None or got == {(share, share)})
    q = quality.fit_quality(no_docs, marks)
    assert no_docs.select(quality.quality_score(q, no_docs["text"])).count() == 0


@pytest.mark.parametrize("name,label,least", [("op1_quality", "quality", 0.95), ("op2_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    scored = QUERIES[name](spark, SF)
    held = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r[label] for r in held) >= least * len(held)
