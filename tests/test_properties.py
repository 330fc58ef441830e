"""Property tests: library helpers against plain-Python statements of the
same rule, on random inputs (each example is one small Spark job)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import scalar as S
from quarry.operators import rank as K

PROP = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

ALPHABET = st.sampled_from(list("abcXYZéßÉ ,.!?@'^0123456789%-+/&:~<>=\"()*\t\n"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=25)


def py_tokens(text: str) -> list[str]:
    """The cleaning rule stated directly: blank two classes, split on separators."""
    lowered = text.lower()
    blanked = "".join(" " if ch in "@'^!?,." or ch in "0123456789%-?+/&:~<>=" else ch for ch in lowered)
    pieces, cur = [], ""
    for ch in blanked:
        if ch in ' ",()*':
            pieces.append(cur)
            cur = ""
        else:
            cur += ch
    pieces.append(cur)
    return [p for p in pieces if p]


@PROP
@given(texts=TEXTS)
def test_review_tokens_match_rule(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = sorted(
        (r.i, r.w) for r in df.select("i", F.explode(S.review_tokens("x")).alias("w")).filter("w != ''").collect()
    )
    want = sorted((i, w) for i, t in enumerate(texts) for w in py_tokens(t))
    assert got == want


TRIM_CHARS = "".join(chr(i) for i in range(0x21))


@PROP
@given(values=st.lists(st.text(alphabet=st.sampled_from(list(" \t\n\r\x00\x01ab c ")), max_size=8), min_size=1))
def test_java_trim_matches_strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert [r[0] for r in df.select(S.java_trim("x")).collect()] == [v.strip(TRIM_CHARS) for v in values]


@PROP
@given(pairs=st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 40)), min_size=1, max_size=30))
def test_round_half_up_of_means(spark, pairs):
    df = spark.createDataFrame([(float(s), n) for s, n in pairs], "s double, n int")
    got = [r[0] for r in df.select(S.round_half_up(F.col("s") / F.col("n"), 2)).collect()]
    want = [float(Decimal(repr(s / n)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for s, n in pairs]
    assert got == want


@PROP
@given(ages=st.lists(st.one_of(st.none(), st.integers(0, 99)), min_size=1, max_size=40))
def test_age_bands_match_rule(spark, ages):
    def right(a):
        return None if a is None else "0-18" if a <= 18 else "18-35" if a <= 35 else "35-50" if a <= 50 else "50+"

    def left(a):
        return None if a is None else "0 - 18" if a < 18 else "18 - 35" if a < 35 else "35 -50" if a < 50 else "50+"

    df = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [(r[0], r[1]) for r in df.select(S.age_band("a", "right"), S.age_band("a", "left")).collect()]
    assert got == [(right(a), left(a)) for a in ages]


@PROP
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=60),
    parts=st.integers(1, 9),
    ascending=st.booleans(),
)
def test_dense_rank_range_path_matches_window(spark, values, parts, ascending):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    ours = K.attach_rank(df, "v", K.dense_rank_table(df, "v", "r", ascending=ascending, num_partitions=parts))
    order = F.col("v").asc() if ascending else F.col("v").desc()
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(order)))
    assert sorted(tuple(r) for r in ours.select("id", "r").collect()) == sorted(
        tuple(r) for r in want.select("id", "r").collect()
    )
