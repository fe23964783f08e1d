"""Embedding whitening by merging singular value decompositions.

Entries are put on a grid of whole numbers, and the model is fitted on each distinct grid vector once. A part of these
rows is kept as (n, mean, F), where F = diag(singular values) V' of the centred rows: n rows less their mean have the
covariance F'F / n. Two parts are merged by decomposing F1 over F2 over one more row, (mean2 - mean1) sqrt(n1 n2 / (n1 + n2)), which is
what the two means add to the covariance. All singular values are kept at each step, so nothing is lost, and no
covariance matrix is ever formed, which would lose half of the digits.

A task folds the rows of its partition into one part, CHUNK rows at a time; parts are merged FAN at a time until
one is left. Only that one, of dims squared numbers, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import batch_of, kept, small_batches, temporary, written

SCALE = 256
COMPONENTS = 4
#: Rows that a task decomposes at once, parts that one task merges.
CHUNK = 4_096
FAN = 8
#: Components whose share of the largest singular value is below this have no variance.
RANK = 1e-13

_PART = "n long, mean binary, factor binary"
_part = pa.schema([("n", pa.int64()), ("mean", pa.binary()), ("factor", pa.binary())])


class Part(NamedTuple):
    """n rows with their mean and diag(singular values) V' of what they are beside it."""

    n: int
    mean: np.ndarray
    factor: np.ndarray


def decomposed(rows: np.ndarray) -> np.ndarray:
    """diag(singular values) V' of rows, one row for each dimension at most."""
    _, values, vectors = np.linalg.svd(rows, full_matrices=False)
    return values[:, None] * vectors


def part_of(rows: np.ndarray) -> Part:
    mean = rows.mean(axis=0)
    return Part(len(rows), mean, decomposed(rows - mean))


def merged(a: Part, b: Part) -> Part:
    """The part of the rows of both."""
    n = a.n + b.n
    apart = b.mean - a.mean
    correction = apart * np.sqrt(a.n / n * b.n)
    return Part(n, a.mean + apart * (b.n / n), decomposed(np.vstack((a.factor, b.factor, correction[None, :]))))


def on_grid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x, array<long>: floor(SCALE * entry), of the vectors that take part.

    Left out: null and empty vectors, vectors with a null, NaN or infinite entry, or with one beyond 2 ** 53 on the grid.
    """
    c = F.col(column).cast("array<double>")
    good = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * SCALE <= float(1 << 53)))
    return vectors.where(c.isNotNull() & (F.size(c) > 0) & good).select("vec_id", F.transform(c, lambda v: F.floor(v * SCALE).cast("long")).alias("x"))


def _rows(column: pa.ListArray) -> np.ndarray:
    """The batch as a matrix of int64; all rows have one length."""
    return column.flatten().to_numpy().reshape(len(column), -1)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part of all rows of a task."""
    part, held, n = None, [], 0

    def fold(part: Part | None) -> Part:
        new = part_of(np.concatenate(held).astype(np.float64))
        return new if part is None else merged(part, new)

    for batch in batches:
        if batch.num_rows:
            held.append(_rows(batch.column("x")))
            n += batch.num_rows
        if n >= CHUNK:
            part, held, n = fold(part), [], 0
    if n:
        part = fold(part)
    if part is not None:
        yield batch_of(_part, n=[part.n], mean=[part.mean.tobytes()], factor=[part.factor.tobytes()])


def _read(n: int, mean: bytes, factor: bytes) -> Part:
    m = np.frombuffer(mean)
    return Part(n, m, np.frombuffer(factor).reshape(-1, len(m)))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = None
    for batch in batches:
        for row in batch.select(_part.names).to_pylist():
            new = _read(**row)
            part = new if part is None else merged(part, new)
    if part is not None:
        yield batch_of(_part, n=[part.n], mean=[part.mean.tobytes()], factor=[part.factor.tobytes()])


def whole(distinct: DataFrame) -> Part | None:
    """The part of all rows of distinct (column x: array<long>, one length); None without rows."""
    parts = written(distinct.select("x").mapInArrow(_folded, _PART), "parts", wide=True)
    while (n := parts.count()) > 1:
        parts = written(parts.repartition(-(-n // FAN)).mapInArrow(_merge, _PART), "parts", wide=True)
    row = parts.first()
    return _read(row["n"], bytes(row["mean"]), bytes(row["factor"])) if row else None


class Model(NamedTuple):
    """n distinct vectors with their exact sums; unit components by falling variance, and shares of the trace."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; n x - S is exact where it fits into a long."""
        y, exact = self.differences(x)
        return y / self.n if exact else x - self.sums.astype(np.float64) / self.n

    def differences(self, x: np.ndarray) -> tuple[np.ndarray, bool]:
        """n x - S, and whether it fits into int64 (else it holds Python's numbers)."""
        most = max((abs(int(v)) for v in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most < 1 << 62:
            return self.n * x - self.sums.astype(np.int64), True
        return self.n * x.astype(object) - self.sums, False

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2, exactly; None where that is beyond a long."""
        y, small = self.differences(x)
        most = int(np.abs(y).max(initial=0))
        if small and most * most * x.shape[1] < 1 << 63:
            return (y * y).sum(axis=1).tolist()
        return [d if d < 1 << 63 else None for d in (sum(int(v) ** 2 for v in row) for row in y)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task's rows, as text: they may be beyond a long."""
    total: np.ndarray | None = None
    for batch in batches:
        if batch.num_rows:
            x = _rows(batch.column("x"))
            some = sum(x[lo : lo + 512].sum(axis=0).astype(object) for lo in range(0, len(x), 512))
            total = some if total is None else total + some
    if total is not None:
        yield pa.record_batch({"i": pa.array(range(len(total)), pa.int32()), "s": pa.array([str(int(v)) for v in total], pa.string())})


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of distinct rows (column x, written, one length); None without rows."""
    with temporary():
        part = whole(distinct)
    sums = distinct.select("x").mapInArrow(_sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    if part is None:
        return None
    total = np.array([int(r["s"]) for r in sorted(sums)], dtype=object)
    _, values, vectors = np.linalg.svd(part.factor, full_matrices=False)
    some = values[:components] > max(values.max(initial=0) * RANK, 0.0)
    variances = values**2 / part.n
    return Model(part.n, total, vectors[:components][some], variances[:components][some], variances[:components][some] / max(variances.sum(), np.finfo(float).tiny))


def identity_error(distinct: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the whitened distinct rows, less the identity: a second pass over them."""
    k = len(model.variances)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_rows(batch.column("x")))
                total += w.T @ w
        yield pa.record_batch({"i": pa.array(range(k * k), pa.int32()), "v": pa.array(total.ravel(), pa.float64())})

    sums = distinct.select("x").mapInArrow(products, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    found = np.array([r["v"] for r in sorted(sums)]).reshape(k, k) / model.n
    return float(np.abs(found - np.eye(k)).max(initial=0.0))


_out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _length(rows: DataFrame) -> Column:
    """Whether x has the dimension of most rows (of equally frequent ones the larger)."""
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("k"))
    best = sizes.agg(F.max(F.struct("k", "dims")).alias("b")).first()["b"]
    return F.size("x") == (best["dims"] if best else 0)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector that takes part (on_grid()).

    The model is of the distinct grid vectors, so repeated rows do not shift it, and each of them gets rows of its own, as does a null
    vec_id. Vectors of another dimension than most are left out. Components without variance (fewer distinct
    vectors than dimensions, constant entries) have no rows; so one distinct vector alone, or no rows at all, give none. Of components
    of equal variance any orthogonal choice is right; one is made, for all rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    with temporary():
        rows = kept(written(on_grid(vectors), "grid"))
        rows = rows.where(_length(rows))
        distinct = written(rows.select("x").distinct(), "distinct")
        model = fit(distinct, components)
        if model is None or not len(model.variances):
            return spark.createDataFrame([], _OUT)
        error, k = identity_error(distinct, model), len(model.variances)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _rows(batch.column("x")), batch.num_rows
            ids, deviations = batch.column("vec_id").cast(pa.int64()), pa.array(model.deviations(x), pa.int64())
            at = pa.array(np.repeat(np.arange(m), k))
            yield batch_of(
                _out,
                vec_id=ids.take(at),
                component=np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                n=np.full(m * k, model.n),
                deviation=deviations.take(at),
                whitened=model.whitened(x).ravel(),
                explained=np.tile(model.explained, m),
                identity_error=np.full(m * k, error),
            )

    return rows.mapInArrow(out, _OUT)
