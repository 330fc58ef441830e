"""Licence scan: licence notices inside texts, found by MinHash bands.

Every text is cut into overlapping windows, per length class of the templates:
windows of twice the class's longest template, half of which overlaps the next,
so that any passage of a template's length lies whole inside one window. A
window's MinHash values, one per band (bands of one row), are looked up among
the templates' values. The number of bands of a class follows from the lowest
Jaccard similarity that a window holding the required share of a template can
have, so that such a window shares a band with it with a probability of at
least RETRIEVAL. A retrieved template is verified in its window, and the next,
by exact containment of its word shingles.

Words are lower-case runs of letters and digits (a version like 2.0 is two
words), so line breaks, punctuation and quoting do not matter. Shingles are
five consecutive words; templates of fewer words are one shingle, searched as
windows of that many words.

Scale: a map over whole texts without a shuffle. The templates are a fixed
list, sent with the code. Memory is one portion of a batch.

Defined cases: null and empty texts have no notices; a null id stays null;
repeated rows each give their rows; overlapping windows that find the same
template at the same place count once; templates that contain one another
(a short notice inside a long one) are each reported. Other columns are not
read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, text_or_empty
from quarry.llm.toxicity import row_parts
from quarry.llm.words import _mix, _stream, Words, windows

SHINGLE = 5
CONTAINMENT = 0.75
RETRIEVAL = 0.9999

# Notices and passages of the texts of common licences (name, wording).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0-header",
        'you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    ),
    ("Apache-2.0-text", "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License"),
    ("MIT-licensed", "licensed under the MIT License"),
    ("MIT-distributed", "distributed under the MIT License"),
    ("MIT-title", "The MIT License (MIT)"),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software",
    ),
    (
        "MIT-warranty",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
        "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "GNU General Public License, version 2"),
    ("GPL", "licensed under the GNU General Public License"),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "GPL-2.0-text",
        "take away your freedom to share and change it. By contrast, the GNU General Public License is intended to "
        "guarantee your freedom",
    ),
    (
        "GPL-3.0-text",
        "The licenses for most software and other practical works are designed to take away your freedom to share and "
        "change the works. By contrast, the GNU General Public License is intended to guarantee your freedom",
    ),
    ("LGPL", "under the GNU Lesser General Public License"),
    ("LGPL-notice", "under the terms of the GNU Lesser General Public License"),
    (
        "LGPL-2.1-text",
        "This license, the Lesser General Public License, applies to some specially designated software packages",
    ),
    (
        "LGPL-3.0-text",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the "
        "GNU General Public License",
    ),
    ("AGPL", "under the GNU Affero General Public License"),
    ("AGPL-notice", "under the terms of the GNU Affero General Public License"),
    (
        "AGPL-3.0-text",
        "specifically designed to ensure cooperation with the community in the case of network server software",
    ),
    (
        "GFDL",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "BSD-3-Clause",
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission",
    ),
    (
        "BSD-warranty",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    (
        "EPL",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License",
    ),
    ("EPL-text", "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "MPL-2.0-text",
        "means Source Code Form to which the initial Contributor has attached the notice in Exhibit A",
    ),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    (
        "CC0-1.0-waiver",
        "has waived all copyright and related or neighboring rights to",
    ),
    ("CC-BY-4.0-short", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0-short", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0-short", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-NC-SA-4.0-short", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0-short", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0-name", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    (
        "CC-BY-NC-SA-4.0",
        "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ),
    (
        "CC-BY-NC-ND-4.0",
        "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    ),
    ("CC-BY-3.0", "Creative Commons Attribution 3.0 Unported License"),
    ("CC-BY-SA-3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    (
        "CC-4.0-text",
        "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions "
        "of this Creative Commons",
    ),
    ("SPDX-MIT", "SPDX-License-Identifier: MIT"),
    ("SPDX-ISC", "SPDX-License-Identifier: ISC"),
    ("SPDX-Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("SPDX-Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("SPDX-GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("SPDX-GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("SPDX-LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("SPDX-LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("SPDX-AGPL-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("SPDX-BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("SPDX-BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("SPDX-MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("SPDX-EPL-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("all-rights-reserved", "All rights reserved"),
    ("all-rights-reserved-publication", "All rights reserved. No part of this publication may be reproduced"),
)

_APART = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def plain_words(column: pa.Array) -> Words:
    """Lower-case words of letters and digits; all other ASCII is white space."""
    table = bytes(32 if _APART.match(bytes([b])) else b for b in range(256))
    cleaned = [None if x is None else x.encode().translate(table).decode() for x in column.to_pylist()]
    return Words(pa.array(cleaned, pa.string()), lower=True)


@dataclass(frozen=True)
class Template:
    name: str
    size: int  # words of a shingle
    words: int
    shingles: np.ndarray  # sorted, distinct


@dataclass(frozen=True)
class LengthClass:
    """Templates of one shingle size and of at most `span` shingle positions."""

    size: int
    span: int
    bands: int
    templates: tuple[Template, ...]

    @property
    def window(self) -> int:
        return 2 * self.span


def bands_needed(least_shingles: int, window: int) -> int:
    """Bands of one row that a window of `window` shingles with the required
    share of a template of `least_shingles` shares one of with RETRIEVAL."""
    common = math.ceil(CONTAINMENT * least_shingles)
    jaccard = common / (window + least_shingles - common)
    return math.ceil(math.log(1 - RETRIEVAL) / math.log(1 - jaccard)) if jaccard < 1 else 1


def length_classes(templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[LengthClass]:
    """Templates by shingle size and by the power of two that their number of
    shingle positions reaches."""
    groups: dict[tuple[int, int], list[tuple[int, Template]]] = {}
    for name, text in templates:
        words = plain_words(pa.array([text]))
        n = len(words.hashes)
        if not n:
            raise ValueError(f"template {name} has no words")
        size = min(SHINGLE, n)
        positions = n - size + 1
        found = Template(name, size, n, np.unique(windows(words.hashes, size)))
        groups.setdefault((size, positions.bit_length()), []).append((positions, found))
    classes = []
    for (size, _), members in sorted(groups.items()):
        span = max(p for p, _ in members)
        least = min(len(t.shingles) for _, t in members)
        classes.append(LengthClass(size, span, bands_needed(least, 2 * span), tuple(t for _, t in members)))
    return classes


def minhash(values: np.ndarray, band: int) -> np.ndarray:
    """The band's hash of each shingle: a random odd multiple, modulo 2**64, of
    its (well mixed) value."""
    return values * (_stream(band + 1, 77)[band] | np.uint64(1))


def retrieved(values: np.ndarray, groups: list[LengthClass]) -> list[list[tuple[int, int]]]:
    """For each class of one shingle size: (window start, template index) of
    every window of the shingle values that shares a band with a template;
    windows start at multiples of `span`."""
    most = np.iinfo(np.uint64).max
    found: list[set[tuple[int, int]]] = [set() for _ in groups]
    for band in range(max(g.bands for g in groups)):
        hashed = minhash(values, band)
        for group, starts in zip(groups, found, strict=True):
            if band >= group.bands:
                continue
            low = np.minimum.reduceat(hashed, np.arange(0, len(hashed), group.span))
            low = np.minimum(low, np.append(low[1:], most))  # two blocks are a window
            for k, template in enumerate(group.templates):
                wanted = minhash(template.shingles, band).min()
                starts.update((int(b) * group.span, k) for b in np.flatnonzero(low == wanted))
    return [sorted(starts) for starts in found]


def notices(words: Words, classes: list[LengthClass]) -> list[tuple[int, str, int, int, float]]:
    """(text, template, first word, last word + 1, containment) of the notices
    in a batch of texts; words count within their text."""
    out = []
    for size in sorted({g.size for g in classes}):
        values = windows(words.hashes, size)
        if len(values):
            groups = [g for g in classes if g.size == size]
            for group, starts in zip(groups, retrieved(values, groups), strict=True):
                out += _verified(words, values, group, starts)
    return sorted(out)


def _verified(
    words: Words, values: np.ndarray, group: LengthClass, starts: list[tuple[int, int]]
) -> list[tuple[int, str, int, int, float]]:
    out = []
    reported: dict[tuple[int, int], int] = {}
    for start, k in starts:
        template, shingles = group.templates[k], group.templates[k].shingles
        # the window, with what a notice that begins in it may reach into
        stop = min(start + group.window + group.span, len(values))
        at = np.flatnonzero(np.isin(values[start:stop], shingles)) + start
        while len(at):
            doc = int(np.searchsorted(words.docs, at[0], "right")) - 1
            limit = min(at[0] + template.words, words.docs[doc + 1]) - group.size + 1
            near = at[at < limit]
            share = len(np.unique(values[near])) / len(shingles) if len(near) else 0.0
            if share >= CONTAINMENT and at[0] >= reported.get((doc, k), 0):
                first, last = int(near[0] - words.docs[doc]), int(near[-1] - words.docs[doc]) + group.size
                out.append((doc, template.name, first, last, share))
                reported[doc, k] = int(near[-1]) + 1
                at = at[at > near[-1]]
            else:
                at = at[1:]
    return out


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("license", pa.string()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("containment", pa.float64()),
    ]
)


def scan_licenses(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, license, first_word, last_word (exclusive; words of letters and
    digits, from 0) and containment of every notice found."""

    bounded_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = length_classes(templates)
        for batch in batches:
            at = 0
            for part in row_parts(batch.column(1)):
                ids = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                rows = [(ids[d], *rest) for d, *rest in notices(plain_words(part), classes)]
                columns = zip(*rows, strict=True) if rows else ([] for _ in _FOUND)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("body")).mapInArrow(
        scan, "doc_id long, license string, first_word long, last_word long, containment double"
    )
