"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def shingles(text, size=5):
    w = words(lowered(text))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def exact_copies(rows):
    """(doc_id, keep_id, group_size, kept, sha) per row."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub("", text or "")].append((doc_id, len(text or "")))
    out = []
    for doc_id, text in rows:
        body = SPACE.sub("", text or "")
        group = groups[body]
        keep = min(group, key=lambda g: (-g[1], order(g[0])))[0]
        keep = keep if len(group) > 1 else doc_id
        out.append((doc_id, keep, len(group), keep == doc_id, hashlib.sha256(body.encode()).hexdigest()))
    return out


def near_components(rows):
    """(doc_id, n_shingles, component_id) per row, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [
        (doc_id, len(s), min(groups[find(i)], key=order)) for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def repeats_removed(rows, size):
    """(doc_id, n_words, n_removed, kept words) per row."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(first.get(key, doc_id), doc_id, key=order)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if order(first[tuple(w[i : i + size])]) < order(doc_id):
                gone.update(range(i, i + size))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def leaks(docs, items):
    """(doc_id, item_id, n_shingles, n_shared); an item of fewer than five words
    is one shingle of its own length."""
    out = []
    for doc_id, text in docs:
        for item_id, item in items:
            k = min(5, len(words(item)))
            wanted = _runs(item, k)
            shared = len(wanted & _runs(text, k)) if wanted else 0
            if wanted and 4 * shared >= 3 * len(wanted):
                out.append((doc_id, item_id, len(wanted), shared))
    return out


def _runs(text, k):
    w = words((text or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()


def lines_removed(rows):
    """(doc_id, n_lines, n_removed, kept) per row: lines go that stand in two
    successive lines, blank ones passed over, which occur before."""

    def pairs(text):
        numbered = [(i, x) for i, x in enumerate((text or "").split("\n")) if words(x)] if text else []
        return [(a, b, (x, y)) for (a, x), (b, y) in zip(numbered, numbered[1:], strict=False)]

    first = {}
    for doc_id, text in rows:
        for a, _, both in pairs(text):
            first[both] = min(first.get(both, (order(doc_id), a)), (order(doc_id), a))
    out = []
    for doc_id, text in rows:
        gone = {i for a, b, both in pairs(text) if (order(doc_id), a) > first[both] for i in range(a, b + 1)}
        lines = text.split("\n") if text else []
        out.append((doc_id, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return out
