"""Rows and frames that the tests of the training-data operators share."""

from __future__ import annotations

import random

# Names that the operators use inside, as columns of the input.
CLASHING = ("row", "key", "id", "body", "hash", "class", "group_size", "lines", "score", "item", "chunk", "packed", "y")


def sentence(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """(doc_id, text): nulls, empty and blank texts, a very long text, exact
    and near copies, shared passages and lines, repeated rows."""
    rng = random.Random(7)
    base, other = sentence(rng, 120).split(), sentence(rng, 90).split()
    passage = sentence(rng, 70)
    near = [base[:i] + ["changed"] + base[i + 1 :] for i in (3, 60, 118)]
    chain = [base[: 120 - 9 * k] + sentence(rng, 9 * k).split() for k in range(1, 4)]
    block = "\n".join(sentence(rng, 6) for _ in range(14))
    long_text = sentence(rng, 20_000)
    texts = [
        None, "", "   \n\t ", "one", "One", "one two three", "one  two\nthree", "one two three four five",
        " ".join(base), " ".join(base).upper(), "  ".join(base), *(" ".join(x) for x in near + chain),
        " ".join(other), sentence(rng, 30) + " " + passage + " " + sentence(rng, 25), passage,
        sentence(rng, 5) + " " + passage + " " + passage, long_text, long_text + " end", "x " * 300, "x " * 200,
        block, "head line\n" + block + "\ntail", block + "\n" + block, "\n\n\n\n", "é ü ñ ß   日本語 テスト 😀",
        passage + "\n" + block,
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    # null ids (texts of their own, and copies), rows that repeat, one id twice
    return rows + [(None, None), (None, passage), rows[3], rows[3], (8, " ".join(base)), (11, sentence(rng, 60))]


def frame(spark, rows, text="text", id_name="doc_id"):
    names = ", ".join(f"`{c}` string" for c in CLASHING)
    data = [(i, t, *("clash" for _ in CLASHING)) for i, t in rows]
    return spark.createDataFrame(data, f"{id_name} long, {text} string, {names}").repartition(3)
