"""Embedding whitening: covariances from exact variances of dimensions and of their pairwise sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"

WHOLE = pa.decimal128(38, 0)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def rows_of(lists: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    sizes = set(np.diff(np.array(lists.offsets)).tolist())
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
    return np.array(lists.flatten(), "int64").reshape(len(lists), -1)


def squares(x: np.ndarray) -> np.ndarray:
    """Sums of squares down the columns, exact: whole numbers of any size."""
    largest = max(1, int(np.abs(x).max(initial=0)))
    if largest * largest * max(1, len(x)) >= 1 << 63:
        x = x.astype(object)
    return (x * x).sum(0).astype(object)


def polarised(y: np.ndarray) -> np.ndarray:
    """Sums of squares of every dimension (on the diagonal) and of every sum of two (above it)."""
    d = y.shape[1]
    out = np.zeros((d, d), object)
    for i in range(d):
        out[i, i] = squares(y[:, i : i + 1])[0]
        out[i, i + 1 :] = squares(y[:, i : i + 1] + y[:, i + 1 :])
    return out


def summed(rows: DataFrame, of_batch: Callable[[np.ndarray], np.ndarray], kind: pa.DataType = WHOLE) -> dict[tuple, object]:
    """``of_batch`` of all vectors added up, by index (i, j).

    A task adds up its batches before it sends them, and one row per index comes back, so
    what is shuffled and collected is bounded by the square of the dimension.
    """
    name = "decimal(38,0)" if kind == WHOLE else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(rows_of(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.nonzero(np.ones(total.shape, bool))
            values = [Decimal(int(v)) if kind == WHOLE else float(v) for v in total[i, j]]
            keep = [k for k, v in enumerate(values) if v or not (i[k] or j[k])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()), pa.array([values[k] for k in keep], kind)],
                names=["i", "j", "s"],
            )

    sums = rows.mapInArrow(run, f"i int, j int, s {name}").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return {(r.i, r.j): int(r.s) if kind == WHOLE else r.s for r in sums.collect()}


def covariance(n: int, sums: list[int], pairs: dict[tuple, int]) -> np.ndarray:
    """Covariances from sums of squares of y_i and of y_i + y_j, exact up to one last division.

    n^2 Var(z) = n sum(z^2) - sum(z)^2, and Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2.
    """
    d = len(sums)
    own = [n * pairs.get((i, i), 0) - sums[i] ** 2 for i in range(d)]
    out = np.empty((d, d))
    for i in range(d):
        out[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * pairs.get((i, j), 0) - (sums[i] + sums[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return out


def whiten(
    vectors: DataFrame,
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows id, component, n, deviation, whitened, explained, identity_error for every vector.

    Entries count as x = floor(``scale`` c) + ``offset``.  Mean and covariance are those of
    the distinct x vectors, n of them.  Three small results come back to the driver, none
    larger than the square of the dimension: the sums S; the sums of squares of every
    dimension and every sum of two dimensions, centred at the whole number next to S / n;
    and the covariance of the whitened vectors, which is measured, not assumed.  All sums
    but the last are whole numbers of any size, so the covariances are exact up to one
    rounding however far the mean is from zero.

    ``component`` counts from 1 by falling eigenvalue, each eigenvector with its largest
    entry positive.  ``deviation`` is the sum over dimensions of (n x - S)^2, NULL where it
    exceeds a long.  ``whitened`` is x - S / n on the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, ``identity_error`` the
    largest absolute entry of the whitened vectors' covariance less the identity.
    Components without variance (eigenvalue zero up to rounding) have no whitened form and
    no rows; so a table of one distinct vector gives none.

    Vectors that are NULL, empty or hold NULL or non-finite entries take no part; vectors
    of different lengths are an error.  A NULL id stays, repeated rows have rows each but
    count once in the fit, other columns are ignored, an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {OUT}"
    v = F.col("v")
    read = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    read = read.filter(v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite))
    read = read.select("id", F.transform(v, lambda c: F.floor(c.cast("double") * scale) + offset).alias("v"))
    fit = stored(read.select("v").distinct(), "whitening-fit")
    n = fit.count()
    if not n:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)

    ends = fit.agg(F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if ends.low != ends.high:
        raise ValueError(f"vectors of different lengths: {ends.low} to {ends.high}")
    d = ends.high
    found = summed(fit, lambda x: x.astype(object).sum(0)[None, :])
    total = [found.get((0, i), 0) for i in range(d)]
    centre = [round(Fraction(s, n)) for s in total]
    middle = np.array(centre, "int64")
    pairs = summed(fit, lambda x: polarised(x - middle))
    cov = covariance(n, [s - n * m for s, m in zip(total, centre)], pairs)

    value, turn = np.linalg.eigh(cov)
    order = np.argsort(-value, kind="stable")[: min(components, d)]
    order = order[value[order] > value.max() * d * np.finfo(float).eps]
    value, turn = value[order], turn[:, order]
    turn = turn * np.sign(turn[np.abs(turn).argmax(0), np.arange(len(order))])
    explained = value / np.trace(cov) if len(order) else value
    project = turn / np.sqrt(value)
    rest = np.array([float(m - Fraction(s, n)) for s, m in zip(total, centre)])
    shift = [n * m - s for s, m in zip(total, centre)]

    def project_rows(x: np.ndarray) -> np.ndarray:
        return ((x - middle).astype("float64") + rest) @ project

    def moments(x: np.ndarray) -> np.ndarray:
        w = project_rows(x)
        return np.vstack([w.sum(0), w.T @ w])

    k = len(order)
    if not k:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    seen = summed(fit, moments, pa.float64())
    table = np.array([[seen.get((i, j), 0.0) for j in range(k)] for i in range(k + 1)]) / n
    error = float(np.abs(table[1:] - np.outer(table[0], table[0]) - np.eye(k)).max())

    def deviations(x: np.ndarray) -> pa.Array:
        y = x - middle
        largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, shift))
        if largest**2 * d < 1 << 63:
            gap = y * n + np.array(shift, "int64")
            return pa.array((gap * gap).sum(1), pa.int64())
        gap = y.astype(object) * n + np.array(shift, object)
        return pa.array([s if s < 1 << 63 else None for s in map(int, (gap * gap).sum(1))], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, rows = rows_of(part.column(1)), np.repeat(np.arange(part.num_rows), k)
                columns = [
                    part.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), len(x))),
                    pa.array(np.full(len(rows), n, "int64")),
                    deviations(x).take(pa.array(rows)),
                    pa.array(project_rows(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(rows), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *(c.split()[0] for c in OUT.split(", "))])

    return read.mapInArrow(run, schema).withColumnRenamed("id", id_col)
