"""Embedding whitening by shifted CholeskyQR.

Vectors are brought to a grid of whole numbers, `floor(grid * entry)`, so that
equal vectors meet exactly and sums are exact. The model is fitted on the fit
list, each distinct grid vector once: its size n, the exact sums S, and the
factor R of the centred rows A = x - S / n.

Method. A pass over the fit list sends one partial Gram matrix per task into
Spark's sum; the Gram matrix G = A'A of the first pass is shifted by a small
multiple of the identity and factored by Cholesky. The next pass solves every
row against the triangular factor (Q = A R^-1) and takes the Gram matrix of Q,
whose factor is composed with the former ones; passes go on until Q'Q is the
identity to rounding, or until no more can be gained (rows that span fewer
dimensions than they have; then the shift stays in). Squaring the condition
number, the weakness of a plain Gram matrix, is undone by the later passes.
The SVD of the composed R gives V = R'R / n's eigenvectors and eigenvalues,
hence the whitening components.

Plan. The distinct grid vectors are the only shuffle of vectors; they are
combined before it (a vector that a third of all rows share is one row per
task) and written. Every pass is a map over that table; what reaches the
driver is d * d numbers a pass. Whitening is a map over the input.

Defined cases: rows whose vector is null, empty, holds a null or non-finite
entry, or an entry beyond `MOST` on the grid, are dropped; of vectors of
different lengths those of the most frequent length stay (the longer one on a
tie). A null id stays, as do repeated rows, each with its own result. Without
rows the result is empty. Components without variance (less than `LEAST_SHARE`
of the total; all of them where n is 1) cannot be whitened and have no rows.
Equal eigenvalues have some basis of their space. `deviation` is null where it
exceeds 38 digits. Other columns pass through `whiten` under any name that
differs from the columns it adds, and are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import staged

MOST = 1 << 53  # grid numbers up to here are exact as doubles
LEAST_SHARE = 1e-18
ROUNDING = float(np.finfo(float).eps)
PASSES = 8  # three are enough for any full rank
UNRESOLVED = 1e-10  # identity errors above are rounding of the components, which one more factor takes out
_ROWS = 4096  # rows of one block of a pass


@dataclass(frozen=True)
class WhiteningModel:
    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # d x k, columns of length 1
    eigenvalues: np.ndarray  # k, falling
    trace: float
    identity_error: float  # largest entry of |covariance of whitened rows - identity|
    passes: int
    last: np.ndarray | None = None  # k x k, upper triangular: factor that the projected rows are solved against

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace if self.trace else self.eigenvalues


def on_grid(vector: Column, grid: int = 256) -> Column:
    """The vector's whole numbers as array<long>; null where it is malformed."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(grid))))
    whole = F.transform(vector, lambda c: F.abs(c.cast("double") * F.lit(float(grid))) < F.lit(float(MOST)))
    # NaN is greater than every number, so it fails this test like an infinity
    sound = F.forall(whole, lambda w: F.coalesce(w, F.lit(False))) & (F.size(vector) > 0)
    return F.when(sound, scaled.cast("array<long>"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, at: int = 0) -> Iterator[np.ndarray]:
    for batch in batches:
        x = _matrix(batch.column(at), d)
        for a in range(0, len(x), _ROWS):
            yield x[a : a + _ROWS]


def _sums(fit: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, dtype=object), 0
        for x in _blocks(batches, d):  # in two halves, so that no sum of a block leaves a long
            high, low = x >> 20, x & ((1 << 20) - 1)
            total = total + high.sum(0).astype(object) * (1 << 20) + low.sum(0).astype(object)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "j": pa.array(range(d), pa.int32()),
                    "n": pa.array([n] * d, pa.int64()),
                    "s": pa.array([str(s) for s in total]),
                }
            )

    parts = fit.select("x").mapInArrow(add, "j int, n long, s string")
    rows = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    rows = sorted(rows, key=lambda r: r.j)
    return (rows[0].n, tuple(int(r.s) for r in rows)) if rows else (0, (0,) * d)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S / n, from whole numbers n * x - S where they fit a long."""
    most = int(np.abs(x).max(initial=0))
    if (most + 1) * n + max(map(abs, sums), default=0) < 1 << 62:
        return (x * n - np.array(sums, dtype=np.int64)) / n
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole) - rest


def _gram(fit: DataFrame, d: int, k: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over the fit list of the outer products of `rows_of` its vectors
    (blocks of rows, k numbers each): one partial matrix per task, added by
    Spark; k * (k + 1) / 2 numbers come back."""
    upper = np.triu_indices(k)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((k, k)), False
        for x in _blocks(batches, d):
            a = rows_of(x)
            total += a.T @ a
            any_row = True
        if any_row:
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(upper[0], pa.int32()), "j": pa.array(upper[1], pa.int32()), "v": pa.array(total[upper])}
            )

    rows = fit.select("x").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((k, k))
    for r in rows.collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def _solved(a: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows of a, solved against each upper triangular factor in turn."""
    for r in factors:
        a = np.linalg.solve(r.T, a.T).T
    return a


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper triangular R with R'R = gram + shift * I, the shift doubled until
    the factorisation succeeds."""
    eye = np.eye(len(gram))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * eye).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, ROUNDING * float(np.trace(gram)))


def shifted_cholesky_qr(fit: DataFrame, n: int, d: int, rows_of: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, int]:
    """R of the QR factorisation of the rows, and the number of passes."""
    r, factors, before = np.eye(d), [], np.inf
    for turn in range(1, PASSES + 1):
        gram = _gram(fit, d, d, lambda x, f=tuple(factors): _solved(rows_of(x), f))
        if not factors and not gram.any():
            return np.zeros((d, d)), turn
        away = float(np.abs(gram - np.eye(d)).max()) if factors else np.inf
        if factors and (away < 64 * d * ROUNDING or away > before / 2):
            return r, turn
        # The shift of the method: 11 (n d + d (d + 1)) u ||A||^2. It grows with
        # n while rounding of a sum by tasks does not, so n is held at 2**20.
        shift = 11 * (min(n, 1 << 20) * d + d * (d + 1)) * ROUNDING / 2 * float(np.linalg.norm(gram, 2)) if not factors else 0.0
        factor = _factor(gram, shift)
        factors.append(factor)
        r, before = factor @ r, away
    return r, PASSES


def fit_whitening(fit: DataFrame, components: int = 4) -> WhiteningModel | None:
    """The model of a table of distinct grid vectors `x` of one length; None
    without rows."""
    first = fit.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first.d
    n, sums = _sums(fit, d)
    rows_of = lambda x: centred(x, n, sums)
    r, passes = shifted_cholesky_qr(fit, n, d, rows_of)
    _, sigma, vt = np.linalg.svd(r)
    values, trace = sigma**2 / n, float((sigma**2).sum() / n)
    k = int(min(components, (values > LEAST_SHARE * trace).sum()))
    v = vt[:k].T
    signs = np.sign(v[np.abs(v).argmax(0), np.arange(k)]) if k else np.ones(0)
    model = WhiteningModel(n, sums, v * signs, values[:k], trace, 0.0, passes)
    if not k:
        return model
    model, covariance = _measured(fit, model)
    if not UNRESOLVED < model.identity_error < 0.5:
        return model
    # Rounded entries of a component let large components into small ones; solved in falling order, the large ones stay.
    solved, _ = _measured(fit, replace(model, last=_factor(covariance, 0.0)))
    return min(model, solved, key=lambda m: m.identity_error)


def _measured(fit: DataFrame, model: WhiteningModel) -> tuple[WhiteningModel, np.ndarray]:
    """The model with its identity error, and the covariance of its whitened rows."""
    d, k = model.components.shape
    covariance = _gram(fit, d, k, lambda x: whitened(model, x)) / model.n
    return replace(model, identity_error=float(np.abs(covariance - np.eye(k)).max())), covariance


def whitened(model: WhiteningModel, x: np.ndarray) -> np.ndarray:
    rows = centred(x, model.n, model.sums) @ model.components / np.sqrt(model.eigenvalues)
    return rows if model.last is None else _solved(rows, [model.last])


def deviations(model: WhiteningModel, x: np.ndarray) -> list[int]:
    """Sum over dimensions of (n * x - S)^2 per row, exactly."""
    n, sums = model.n, model.sums
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most**2 * x.shape[1] < 1 << 62:
        return ((x * n - np.array(sums, dtype=np.int64)) ** 2).sum(1).tolist()
    exact = x.astype(object) * n - np.array(sums, dtype=object)
    return (exact * exact).sum(1).tolist()


def fit_list(df: DataFrame, vector_col: str = "embedding", grid: int = 256) -> DataFrame:
    """The distinct grid vectors `x` of the most frequent length, written."""
    distinct = staged(df.select(on_grid(F.col(vector_col), grid).alias("x")).where("x is not null").distinct(), "fit-list")
    lengths = df.select(on_grid(F.col(vector_col), grid).alias("x")).where("x is not null").groupBy(F.size("x").alias("d"))
    usual = lengths.agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    return distinct.where(F.size("x") == F.lit(usual.d if usual else 0))


def whiten(df: DataFrame, model: WhiteningModel | None, vector_col: str = "embedding", grid: int = 256) -> DataFrame:
    """The well-formed rows of `df` with `whitened` (array<double>, one number a
    component) and `deviation` (decimal(38,0)) added."""
    d = len(model.sums) if model else 0
    x = on_grid(F.col(vector_col), grid)
    rows = df.select(F.struct("*").alias("row"), x.alias("x")).where((F.size("x") == F.lit(d)) & F.col("x").isNotNull())

    @F.arrow_udf(T.StructType([T.StructField("w", T.ArrayType(T.DoubleType())), T.StructField("dev", T.StringType())]))
    def score(column: pa.Array) -> pa.Array:
        m = _matrix(column, d)
        w, dev = whitened(model, m), deviations(model, m)
        text = [str(v) if v < 10**38 else None for v in dev]
        return pa.StructArray.from_arrays(
            [pa.array(list(w), pa.list_(pa.float64())), pa.array(text, pa.string())], names=["w", "dev"]
        )

    if model is None:
        empty = rows.select("row.*", F.array().cast("array<double>").alias("whitened"))
        return empty.withColumn("deviation", F.lit(None).cast("decimal(38,0)"))
    done = rows.select("row", score("x").alias("s"))
    return done.select("row.*", F.col("s.w").alias("whitened"), F.col("s.dev").cast("decimal(38,0)").alias("deviation"))
