"""Decontamination, licence scan, packing and WARC on odd input."""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from llm_test_helpers import frame, sentence

from quarry.llm import decontamination, license_scan, packing, warc
from quarry.llm.queries import packed_digests, tokenizer_path
from quarry.session import scratch_path


def test_leaks(spark, odd, odd_docs):
    texts = dict(odd)
    items = [
        (1, " ".join((texts[8] or "").split()[20:60])),
        (2, "one two three four five"),
        (3, "one two three"),
        (4, None),
        (5, ""),
        (6, "nothing of this kind stands anywhere in here"),
        (6, "another item of the same id and words " + " ".join((texts[8] or "").split()[:30])),
        (None, " ".join((texts[8] or "").split()[60:100])),
        (2, "one two three four five"),
    ]
    benchmark = frame(spark, items, id_name="item_id")
    got = decontamination.find_leaks(odd_docs, benchmark).select("doc_id", "item_id", "n_shingles", "n_shared").collect()
    want = brute.leaks(odd, list(dict.fromkeys(items)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = decontamination.drop_leaks(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    leaked = {d for d, *_ in want}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        [d for d, t in odd if not any(x[0] == d for x in brute.leaks([(d, t)], items))], key=repr
    )
    assert leaked


def test_leaks_without_rows(spark, odd_docs, no_docs):
    none = frame(spark, [], id_name="item_id")
    assert decontamination.find_leaks(odd_docs, none).count() == 0
    assert decontamination.drop_leaks(odd_docs, none).count() == odd_docs.count()
    assert decontamination.find_leaks(no_docs, frame(spark, [(1, "a b c d e f")], id_name="item_id")).count() == 0


def test_sketches_hold_what_the_search_uses(spark):
    items = decontamination.item_sketches(frame(spark, [(1, sentence_of(43)), (2, "a b")], id_name="item_id"))
    assert items.columns == ["item_id", "item", "k", "n_shingles", "size_class", "shingles", "sketch"]
    assert sorted((r.n_shingles, len(r.sketch)) for r in items.collect()) == [(1, 1), (39, 10)]


def sentence_of(n):
    return " ".join(f"w{i}" for i in range(n))


def test_items_shorter_than_a_shingle_are_found_inside_documents(spark):
    import random

    rng = random.Random(9)
    items = [(1, "the capital of France"), (2, "Paris"), (3, "two words"), (4, "one two three"), (5, "a b c d e f g h")]
    rows = [
        (1, sentence(rng, 50) + " The capital  of\nFRANCE " + sentence(rng, 50)),
        (2, "the capital of"),
        (3, "paris"),
        (4, sentence(rng, 30) + " two words one two three"),
        (5, "two  one words"),
        (6, "x a b c d e f g h y"),
        (7, "a b c d"),
        (8, "the capital of France"),
        (9, sentence(rng, 3000) + " paris " + sentence(rng, 3000)),
    ]
    got = decontamination.find_leaks(frame(spark, rows), frame(spark, items, id_name="item_id"))
    found = sorted((r.doc_id, r.item_id) for r in got.collect())
    assert found == [(1, 1), (3, 2), (4, 3), (4, 4), (6, 5), (8, 1), (9, 2)]
    assert found == sorted(x[:2] for x in brute.leaks(rows, items))


def test_items_of_every_size_at_the_threshold(spark):
    """Items of all size classes with three quarters of their shingles, and just less, in long documents."""
    import random

    rng = random.Random(10)
    items, rows = [], []
    for k, n in enumerate((5, 6, 8, 9, 12, 20, 33, 64, 70, 130, 300)):
        item = sentence(rng, n).split()
        items.append((k, " ".join(item)))
        shingles = max(1, n - 4)
        for extra, keep in enumerate((-(-3 * shingles // 4), -(-3 * shingles // 4) - 1)):
            part = item[: keep + 4] if keep else item[:1]
            rows.append((100 * extra + k, " ".join(sentence(rng, 200).split() + part + sentence(rng, 300).split())))
    bench = frame(spark, items, id_name="item_id")
    got = sorted(tuple(r)[1:] for r in decontamination.find_leaks(frame(spark, rows), bench).collect())
    assert got == sorted(brute.leaks(rows, items))
    assert {d for d, *_ in got} >= set(range(len(items)))
    sketched = decontamination.item_sketches(bench)
    bounds = decontamination.class_bounds(sketched)
    assert len(bounds) >= 6
    for r in sketched.collect():
        assert all(h <= bounds[r.size_class] for h in r.sketch) and len(r.sketch) == r.n_shingles // 4 + 1


def test_sketch_cannot_miss():
    """Whichever quarter of an item's shingles is missing, one of its sketch is left."""
    for n in range(1, 40):
        assert n // 4 + 1 > n - -(-3 * n // 4)


LETTERS = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def notices_by_hand(rows):
    out = set()
    templates = [(n, [w.lower() for w in LETTERS.findall(t)]) for n, t in license_scan.TEMPLATES]
    for doc_id, text in rows:
        w = [x.lower() for x in LETTERS.findall(text or "")]
        for name, t in templates:
            size = min(5, len(t))
            wanted = {tuple(t[i : i + size]) for i in range(len(t) - size + 1)}
            hits = [i for i in range(len(w) - size + 1) if tuple(w[i : i + size]) in wanted]
            for a in hits:
                near = {tuple(w[i : i + size]) for i in hits if a <= i <= a + len(t) - size}
                if len(near) >= 0.75 * len(wanted):
                    out.add((doc_id, name))
    return out


def test_licenses(spark, odd):
    import random

    rng = random.Random(3)
    rows = list(odd)
    for k, (_, notice) in enumerate(license_scan.TEMPLATES):
        rows.append((100 + k, sentence(rng, 40) + "\n" + notice.upper().replace(" ", "\n ") + " " + sentence(rng, 10)))
        broken = notice.split()
        broken[len(broken) // 2] = "otherwise"
        rows.append((200 + k, " ".join(broken)))
        rows.append((300 + k, " ".join(notice.split()[: len(notice.split()) // 2])))
    got = license_scan.scan_licenses(frame(spark, rows)).collect()
    assert {(r.doc_id, r.license) for r in got} == notices_by_hand(rows)
    assert all(0.75 <= r.containment <= 1 and r.last_word > r.first_word for r in got)
    assert license_scan.scan_licenses(frame(spark, [])).count() == 0


# Written independently of TEMPLATES, as files and web pages have them: (licences, text).
LICENCE_LINES = [
    ({"all-rights-reserved"}, "(c) 2019 Example Press Ltd.\nAll rights reserved.\nContact us for prices."),
    ({"all-rights-reserved"}, "ALL RIGHTS RESERVED"),
    ({"LGPL-notice", "GPL-notice"}, " * This library is free software; you can redistribute it and/or\n * modify it under the terms of "
     "the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1"),
    ({"AGPL-notice", "GPL-notice"}, "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the "
     "GNU Affero General Public License as\n# published by the Free Software Foundation, either version 3"),
    ({"GPL-notice"}, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ({"ISC"}, "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby "
     "granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ({"EPL"}, "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0"),
    ({"CC-BY-SA-4.0"}, "This text is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ({"CC-BY-4.0"}, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ({"CC-BY-SA-4.0-short"}, "Photo: J. Doe, licensed under CC BY-SA 4.0."),
    ({"CC0-1.0"}, "Legal code: CC0 1.0 Universal"),
    ({"Unlicense"}, "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy"),
    ({"MIT-licensed"}, "This project is licensed under the MIT License - see LICENSE.md"),
    ({"SPDX-MIT"}, "// SPDX-License-Identifier: MIT"),
    ({"BSD-3-Clause"}, "3. Neither the name of the University nor the names of its contributors\n   may be used to endorse or "
     "promote products derived from this software\n   without specific prior written permission."),
    ({"AGPL-3.0-text"}, "is a free, copyleft license for software and other kinds of works, specifically designed to ensure\n"
     "cooperation with the community in the case of network server software."),
    (set(), "She reserved all her rights to the permission that was granted for this software."),
    (set(), "all rights\nof the reserved seats"),
]


def test_licence_lines_as_they_stand_in_files(spark):
    rows = [(k, text) for k, (_, text) in enumerate(LICENCE_LINES)]
    got = {k: set() for k, _ in rows}
    for r in license_scan.scan_licenses(frame(spark, rows)).collect():
        got[r.doc_id].add(r.license)
    assert got == {k: want for k, (want, _) in enumerate(LICENCE_LINES)}


def test_license_bands_reach_their_probability():
    for group in license_scan.length_classes():
        for t in group.templates:
            common = -(-3 * len(t.shingles) // 4)
            jaccard = common / (group.window + len(t.shingles) - common)
            assert 1 - (1 - jaccard) ** group.bands >= license_scan.RETRIEVAL


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_word_tokens_equal_the_tokenizer():
    texts = [
        "", None, "it's I'M we'll 'stuff' \"q's\"", "<|endoftext|> a<|startoftext|>b", "naïve Ünïcode İstanbul ΣΑΣ ß ẞ",
        "é x y z​w", "a\x1cb\x1f c\x0bd\x0ce", "x" * 300 + " " + "é" * 200, "12 3.14 a1b2c3 don't!!",
        "日本語 テスト 😀😀 a😀b", "word*** WORD!! w''s o'clock 's", "ǅ ﬁ ÀÉ À ́x", "\n\n\t", "a\r\nb",
    ]
    tokens = packing.WordTokens(tokenizer_path())
    for _ in range(2):  # the second time from memory
        ids, stops = tokens.many(pa.array(texts))
        for k, text in enumerate(texts):
            assert ids[stops[k] : stops[k + 1]].tolist() == ids_of(text)


def test_packing(odd, odd_docs):
    got = packed_digests(odd_docs).collect()
    texts = {}
    for doc_id, text in odd:
        texts.setdefault(doc_id, []).append([*ids_of(text), 2])
    pieces = {}
    for r in got:
        assert r.length <= 4096
        match = [
            ids
            for ids in texts[r.doc_id]
            if len(ids) == r.doc_tokens
            and zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        ]
        assert match
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc_id, lists in texts.items():
        assert sum(n for _, n in pieces[doc_id]) == sum(map(len, lists))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_sequences_join_the_ids(spark, odd_docs, no_docs):
    from quarry.llm.common import staged

    pieces = staged(packing.cut_documents(odd_docs, tokenizer_path()), "pieces-with-ids")
    rows = packing.sequences(packing.pack(pieces)).collect()
    total = sum(r.length for r in pieces.collect())
    assert sum(len(r.ids) // 4 for r in rows) == total
    assert all(len(r.ids) <= 4 * 4096 for r in rows)
    assert packed_digests(no_docs).count() == 0


def test_plan_places_every_piece():
    rng = np.random.default_rng(1)
    for lengths in (
        np.minimum(4095, rng.lognormal(6.2, 1.1, 20_000).astype(int) + 1),
        np.r_[np.ones(5_000, int), rng.integers(1, 4096, 9_000)],
        np.full(1000, 300),
        np.full(7, 2049),
        np.array([], int),
    ):
        histogram = {}
        for x in lengths:
            c = packing.length_class(int(x))
            histogram[c] = histogram.get(c, 0) + 1
        plan = packing.packing_plan(histogram)
        fill, placed = np.zeros(plan.sequences + 1), {}
        for kind, _, _, count, sequence, per in plan.rows:
            assert count % per == 0
            fill[sequence : sequence + count // per] += kind * per
            placed[kind] = placed.get(kind, 0) + count
        assert fill.max(initial=0) <= 4096
        assert placed == histogram
        if len(lengths) > 5_000:
            assert 1 - lengths.sum() / (4096 * plan.sequences) < 0.01


def pages(spark, rows):
    names = "row string, payload string, digest string, id string, n string"
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], f"page_id long, url string, html string, {names}")


def test_warc_round_trip(spark):
    long_text = "<p>é😀 long</p>\r\n\r\nWARC/1.1\r\n" * 9000
    rows = [
        (3, "http://a/b c\r\nX: y", "x" * 100), (1, "http://a", "x" * 100), (2, None, "x" * 99), (5, "u", "x" * 99),
        (7, "u", None), (8, "u", ""), (9, "u", long_text), (4, "ü", long_text), (9, "u", long_text), (None, "n", "y" * 200),
        (None, "n", long_text), (10, "u", "\r\n\r\n" * 50), (11, "u", "0\r\n\r\n"), (4, "ü", long_text),
    ]
    path = scratch_path(spark, "test-archive")
    warc.write_archive(pages(spark, rows).repartition(3), path)
    read = warc.read_archive(spark, path)
    got = sorted((tuple(r) for r in warc.page_digests(read).collect()), key=repr)
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = min(same, default=None) if len(payload) >= 100 else None
        revisit = first is not None and page_id != first
        want.append(
            (page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
        )
    assert got == sorted(want, key=repr)
    bodies = {r.page_id: bytes(r.payload) for r in read.where("record_type = 'response'").collect()}
    assert bodies[4] == long_text.encode()
    empty = scratch_path(spark, "test-archive")
    warc.write_archive(pages(spark, []), empty)
    assert warc.page_digests(warc.read_archive(spark, empty)).count() == 0


def test_warc_reads_every_gzip_member(spark, tmp_path):
    rng = np.random.default_rng(2)
    bodies = {i: rng.bytes(n) for i, n in ((1, 300), (2, 200_000), (3, 0), (4, 65_536))}
    records = [
        r + warc.BREAK
        for i, body in bodies.items()
        for r in warc.page_records(i, "u", body, "d", None, 1 << 20, 1 << 20, "2024-01-01T00:00:00Z")
    ]
    members = [gzip.compress(r) for r in records]
    (tmp_path / "crawl.warc.gz").write_bytes(b"".join(members))
    read = warc.read_archive(spark, str(tmp_path), "*.warc.gz").collect()
    assert {r.page_id: bytes(r.payload) for r in read} == bodies
    assert warc.inflated(members[0] + b"\0" * 9 + members[1]) == records[0] + records[1]
    with pytest.raises(ValueError, match="cut short"):
        warc.inflated(b"".join(members)[:-5])
    with pytest.raises(zlib.error):
        warc.inflated(members[0] + b"rest")


def test_warc_checks_what_it_reads():
    records = list(warc.page_records(1, "u", b"z" * 5000, "d", None, 1000, 300, "2024-01-01T00:00:00Z"))
    assert len(records) > 4
    parsed = list(warc.parse_records(b"".join(r + warc.BREAK for r in records)))
    segments = [
        (int(f["warc-segment-number"]), int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, b)
        for f, b in parsed
    ]
    assert warc.payload_of(warc.reassembled(segments[::-1], "o")) == b"z" * 5000
    with pytest.raises(ValueError, match="missing"):
        warc.reassembled(segments[:1] + segments[2:], "o")
    with pytest.raises(ValueError, match="declared"):
        warc.reassembled([*segments[:-1], (segments[-1][0], 1, segments[-1][2])], "o")
    with pytest.raises(ValueError):
        list(warc.parse_records(records[0][:-3] + warc.BREAK))
    assert warc.unchunked(warc.chunked(b"abc" * 10, 7), 0) == b"abc" * 10


def test_least_squares_solution_is_the_best_one():
    """No entry is negative, no entry at 0 would gain, free ones have no slope."""
    import numpy as np

    rng = np.random.default_rng(6)
    for m, n in ((5, 3), (12, 40), (30, 200), (4, 1)):
        a, b = rng.integers(0, 3, (m, n)).astype(float), rng.uniform(0, 50, m)
        x = packing.non_negative_least_squares(a, b)
        slope = a.T @ (a @ x - b)
        assert (x >= 0).all() and (slope > -1e-5).all() and np.abs(slope[x > 1e-9]).max(initial=0) < 1e-5
    assert not packing.non_negative_least_squares(np.ones((3, 2)), -np.ones(3)).any()


def test_plan_is_never_worse_than_greedy_alone():
    import numpy as np

    rng = np.random.default_rng(7)
    for lengths in (
        rng.integers(1, 4096, 3000),
        rng.integers(1200, 2800, 3000),
        np.minimum(rng.lognormal(6, 1, 5000).astype(int) + 1, 4095),
        np.full(1000, 1365),
    ):
        histogram = {}
        for x in lengths.tolist():
            kind = packing.length_class(x)
            histogram[kind] = histogram.get(kind, 0) + 1
        plan = packing.packing_plan(dict(histogram))
        assert plan.sequences <= packing._plan(dict(histogram), 4096, 0).sequences
        placed = {}
        for kind, _, _, count, _, _ in plan.rows:
            placed[kind] = placed.get(kind, 0) + count
        assert placed == histogram
