"""Whitening components of embeddings by shifted CholeskyQR.

Vectors become integers, and each distinct one is a row of the fit list. Row count and sums are exact, so
rows are centred exactly. A Gram pass is one Spark job: a task multiplies its centred rows block by block
and brings home one matrix of the vector's length squared; the matrices are summed over the cluster. The
first factor comes from the Gram matrix with a small shift, which always has a Cholesky factor; the next
passes solve the rows against the factors found so far and take the Gram matrix of what is left, which is
close to the identity. The composed factor has the singular values and right vectors of the centred rows,
without the squaring of their condition that a covariance matrix brings.

Where rows span fewer dimensions than they have, later passes need a shift as well; one more Gram pass then
measures how far the solved rows are from orthonormal, and the composed factor is corrected by its root.

The driver holds matrices of the vector's length squared, whatever the number of rows.

Defined results: a vector that is null or holds a null or non-finite entry drops out; shorter vectors are
filled up with zeros; rows with null or repeated ids stay; directions whose singular value is below 1e-11 of
the largest cannot be scaled and are not given, so fewer than the wanted components may be returned, and none
where all vectors are equal; an empty table gives an empty result; other columns are not read. ``deviation``
is null beyond 38 digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import stored

SCALE = 256
COMPONENTS = 4
PASSES = 3
LEAST = 1e-11  # of the largest singular value
BLOCK_CELLS = 1 << 20
_LOW = 1 << 32
_HALF = 1 << 62


def sound(vector: Column) -> Column:
    """Whether a vector and all its entries are finite numbers."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def integer_rows(df: DataFrame, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    """``id, x`` with integer vectors of one length, and that length."""
    vector = F.col(f"`{vector_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).filter(sound(F.col("v")))
    low, high = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    x = F.transform("v", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    if low != high:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(high) - F.size("v")))
    return rows.select("id", x.alias("x")), high or 0


def blocks(batch: pa.RecordBatch, column: int, dim: int) -> Iterator[np.ndarray]:
    """The integer vectors of a batch in matrices of bounded size."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    step = max(1, BLOCK_CELLS // dim)
    for at in range(0, len(flat), step):
        yield flat[at : at + step]


def size_and_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dim
        for batch in batches:
            for x in blocks(batch, 0, dim):
                n += len(x)
                high, low = (x >> 32).sum(axis=0), (x & (_LOW - 1)).sum(axis=0)
                sums = [s + int(h) * _LOW + int(w) for s, h, w in zip(sums, high, low)]
        columns = [list(range(-1, dim)), [n] + [s // _LOW for s in sums], [0] + [s % _LOW for s in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "high", "low"])

    parts = fit.mapInArrow(add, "place long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    found = {r["place"]: (int(r["high"]), int(r["low"])) for r in parts.groupBy("place").agg(*wide).collect()}  # a row per dimension
    return found[-1][0], [found[i][0] * _LOW + found[i][1] for i in range(dim)]


class Centre:
    """Takes integer rows to ``n * x - sums``, without rounding."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums, self.most = n, sums, max(map(abs, sums), default=0)

    def exact(self, x: np.ndarray) -> np.ndarray:
        top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if self.n * top + self.most < _HALF:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x).astype(np.float64) / self.n


def solve(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, by forward substitution."""
    out = np.empty(rows.shape, order="F")
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def gram(fit: DataFrame, dim: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The Gram matrix of ``of(rows)``, which has ``width`` columns, over the fit list."""
    above = np.triu_indices(width)
    cells = pa.array(above[0] * width + above[1], pa.int64())

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for x in blocks(batch, 0, dim):
                made = of(x)
                total += made.T @ made
        yield pa.RecordBatch.from_arrays([cells, pa.array(total[above])], names=["cell", "value"])

    summed = fit.mapInArrow(multiply, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width * width)
    out[summed["cell"].to_numpy()] = summed["value"].to_numpy()
    out = out.reshape(width, width)
    return np.triu(out) + np.triu(out, 1).T


def cholesky(matrix: np.ndarray, n: int, shifted: bool) -> tuple[np.ndarray, bool]:
    """The upper factor of a Gram matrix over n rows, and whether it took a shift."""
    dim = len(matrix)
    if not shifted:
        try:
            factor = np.linalg.cholesky(matrix).T
            if np.diag(factor).min() > 1e-6 * np.diag(factor).max():
                return factor, False
        except np.linalg.LinAlgError:
            pass
    shift = min(11 * (n * dim + dim * (dim + 1)) * 2.0**-53, 1e-4) * np.linalg.norm(matrix, 2)
    return np.linalg.cholesky(matrix + shift * np.eye(dim)).T, True


def components_of(fit: DataFrame, dim: int, centre: Centre, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the centred fit list and its right singular vectors as columns, largest first."""
    factors, composed, deficient = [], np.eye(dim), False

    def solved(x: np.ndarray) -> np.ndarray:
        rows = centre(x)
        for factor in factors:
            rows = solve(rows, factor)
        return rows

    for turn in range(passes):
        met = gram(fit, dim, dim, solved)
        if turn == 0 and not met.any():
            return np.zeros(0), np.zeros((dim, 0))
        factor, shifted = cholesky(met, centre.n, shifted=turn == 0)
        deficient = shifted and turn > 0
        factors.append(factor)
        composed = factor @ composed
    if deficient:
        values, vectors = np.linalg.eigh(gram(fit, dim, dim, solved))
        composed = (vectors * np.sqrt(np.clip(values, 0, None))) @ vectors.T @ composed
    _, values, right = np.linalg.svd(composed)
    signs = np.sign(right[np.arange(dim), np.abs(right).argmax(axis=1)])
    return values, (right * signs[:, None]).T


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """Per row and component ``id, component, n, deviation, whitened, explained, identity_error``; the id keeps its name."""
    rows, dim = integer_rows(df, id_col, vector_col, scale)
    id_type = df.schema[id_col].dataType
    schema = "component int, n long, high long, low long, whitened double, explained double, identity_error double"
    fit = stored(rows.select("x").distinct(), "whitening-fit") if dim else None
    n, sums = size_and_sums(fit, dim) if dim else (0, [])
    values, vectors = np.zeros(0), np.zeros((dim, 0))
    if n:
        centre = Centre(n, sums)
        values, vectors = components_of(fit, dim, centre)
    kept = int((values[:components] > LEAST * values[:1].max(initial=0.0)).sum())
    if not kept:
        return df.sparkSession.createDataFrame([], f"{schema}").select(F.lit(None).cast(id_type).alias(id_col), *_columns())
    projection = vectors[:, :kept] * (np.sqrt(n) / values[:kept])
    explained = (values**2 / (values**2).sum())[:kept]
    error = float(np.abs(gram(fit, dim, kept, lambda x: centre(x) @ projection) / n - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in blocks(batch, 1, dim):
                exact = centre.exact(x)
                made = (exact.astype(np.float64) / n) @ projection
                most = max(abs(int(exact.max(initial=0))), abs(int(exact.min(initial=0))))
                squares = exact if dim * most * most < 2**63 else exact.astype(object)
                deviation = (squares * squares).sum(axis=1)
                high, low = deviation // _HALF, deviation % _HALF
                columns = [
                    batch.column(0).slice(at, len(x)).take(pa.array(np.repeat(np.arange(len(x)), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * kept, n)),
                    pa.array([h if h < _HALF else None for h in np.repeat(high, kept).tolist()], pa.int64()),
                    pa.array(np.repeat(low, kept).tolist(), pa.int64()),
                    pa.array(made.reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * kept, error)),
                ]
                at += len(x)
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "high", "low", "whitened", "explained", "identity_error"])

    made = rows.mapInArrow(project, f"id {id_type.simpleString()}, {schema}")
    return made.select(F.col("id").alias(id_col), *_columns())


def _columns() -> list[Column]:
    half = F.lit(_HALF).cast("decimal(19,0)")
    deviation = F.when(F.col("high") == 0, F.col("low").cast("decimal(38,0)")).otherwise(
        F.try_add(F.try_multiply(F.col("high").cast("decimal(19,0)"), half), F.col("low").cast("decimal(19,0)")).cast("decimal(38,0)")
    )
    return ["component", "n", deviation.alias("deviation"), "whitened", "explained", "identity_error"]
