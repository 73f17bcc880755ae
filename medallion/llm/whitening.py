"""Whitening of vectors by shifted CholeskyQR.

The centred rows are a tall matrix that no machine holds. Each pass sums the Gram matrix
of the rows task by task, factors it and orthogonalises the rows by a triangular solve.
The first pass adds a small shift, so that its factorisation succeeds however
ill-conditioned the rows are; further passes bring what is left to orthogonality. The
product of the triangular factors has the rows' singular values and right singular
vectors, which are the components. Only matrices of the vectors' length come together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.vectors import finite, matrix

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
PASSES = 5
ORTHOGONAL = 1e-12
NO_VARIANCE = 1e-14
_LONG = 2**63 - 1
_UNIT = np.finfo(np.float64).eps / 2


def quantized(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """``floor(SCALE * c) + OFFSET`` as whole numbers, held within what doubles count exactly."""
    return (np.clip(np.floor(SCALE * matrix(column)), -(2.0**52), 2.0**52) + OFFSET).astype(np.int64)


@dataclass(frozen=True)
class Fit:
    """Counts, sums and factors of the fit list: all a task needs to whiten a row."""

    n: int
    sums: tuple[int, ...]
    factors: tuple[np.ndarray, ...] = ()
    left: np.ndarray | None = None
    right: np.ndarray | None = None
    values: np.ndarray | None = None
    trace: float = 0.0

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: whole numbers are subtracted first, so that the offset costs no digits."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums over dimensions of ``(n * x - S) ** 2``, exact, held at the largest long."""
        largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * self.n + max(map(abs, self.sums))
        if largest < 2**62:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            if self.dim * float(np.abs(apart).max(initial=0)) ** 2 < 2.0**62:
                return (apart * apart).sum(axis=1)
        rows = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return np.array([min(r, _LONG) for r in rows], dtype=np.int64)

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """The rows' share of the orthogonal matrix: one triangular solve per factor."""
        rows = self.centred(x)
        for factor in self.factors:
            rows = solved(rows, factor)
        return rows

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        """The centred rows on the first components, each over its deviation; without variance, NaN."""
        width = min(components, self.dim)
        if self.values is None or not len(self.values):
            return np.full((len(x), width), np.nan)
        found = (self.orthogonal(x) @ self.left[:, :width]) * np.sqrt(self.n)
        found[:, self.values[:width] <= NO_VARIANCE * self.values[0]] = np.nan
        return found


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of the upper triangular ``factor``, column by column."""
    found = np.empty_like(rows)
    for j in range(factor.shape[1]):
        if factor[j, j] == 0:
            found[:, j] = 0
        else:
            found[:, j] = (rows[:, j] - found[:, :j] @ factor[:j, j]) / factor[j, j]
    return found


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vector, the count and the sum of each dimension."""
    totals: dict[int, list[int]] = {}
    for batch in batches:
        lengths = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths):
            x = quantized(batch.filter(pa.array(lengths == dim)).column("embedding"))
            added = x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) >= 2**40 else x.sum(axis=0)
            held = totals.setdefault(int(dim), [0] * (int(dim) + 1))
            totals[int(dim)] = [a + int(b) for a, b in zip(held, [len(x), *added])]
    rows = [(dim, at, Decimal(value)) for dim, held in totals.items() for at, value in enumerate(held)]
    columns = list(zip(*rows)) if rows else [(), (), ()]
    types = (pa.int32(), pa.int32(), pa.decimal128(38, 0))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["dim", "at", "value"])


def _grams(rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task, the Gram matrix of its rows, with a last row that holds their sum."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(quantized(batch.column("embedding")))
                total[:width] += rows.T @ rows
                total[width] += rows.sum(axis=0)
        lines = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1), pa.int32()), lines], names=["at", "line"])

    return task


def _added(table: pa.Table) -> pa.Table:
    line = matrix(table.column("line")).sum(axis=0)
    return pa.table({"at": table.column("at").slice(0, 1), "line": pa.array([line], pa.list_(pa.float64()))})


def _gram(rows: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The Gram matrix of all rows and their sum; each line of it is added up by itself."""
    lines = "at int, line array<double>"
    parts = rows.select("embedding").mapInArrow(_grams(rows_of, width), lines)
    found = np.zeros((width + 1, width))
    for row in parts.groupBy("at").applyInArrow(_added, lines).collect():
        found[row.at] = row.line
    return found[:width], found[width]


def _factor(gram: np.ndarray, n: int, shift: bool) -> np.ndarray:
    """The upper triangular factor; the shift grows until the factorisation succeeds."""
    dim = len(gram)
    least = 11 * (n * dim + dim * (dim + 1)) * _UNIT * np.linalg.norm(gram, 2)
    added = min(least, 1e-2 * np.linalg.norm(gram, 2)) if shift else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + added * np.eye(dim)).T
        except np.linalg.LinAlgError:
            added = max(least, added * 10)


def _usable(df: DataFrame) -> DataFrame:
    vectors = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return vectors.where(finite()).where(F.size("embedding") > 0)


def fit(df: DataFrame) -> Fit | None:
    """Components of all usable vectors of the commonest length (the longest of equally common ones).

    None if there are none. What reaches the driver is a few matrices of that length.
    """
    vectors = _usable(df)
    totals = vectors.select("embedding").mapInArrow(_sums, "dim int, at int, value decimal(38,0)")
    totals = totals.groupBy("dim", "at").agg(F.sum("value").alias("value"))
    commonest = totals.where("at = 0").orderBy(F.desc("value"), F.desc("dim")).select("dim").first()
    if commonest is None:
        return None
    values = [int(r.value) for r in totals.where(F.col("dim") == commonest.dim).orderBy("at").collect()]
    found = Fit(values[0], tuple(values[1:]))
    rows = vectors.where(F.size("embedding") == found.dim)

    upper, trace = np.eye(found.dim), 0.0
    for number in range(PASSES):
        gram, _ = _gram(rows, found.orthogonal, found.dim)
        if number == 0:
            trace = float(np.trace(gram)) / found.n
            if trace == 0:
                return found
        elif np.abs(gram - np.eye(found.dim)).max() < ORTHOGONAL:
            break
        factor = _factor(gram, found.n, shift=number == 0)
        upper = factor @ upper
        found = Fit(found.n, found.sums, (*found.factors, factor))
    left, values, right = np.linalg.svd(upper)
    return Fit(found.n, found.sums, found.factors, left, right, values**2 / found.n, trace)


def identity_error(df: DataFrame, model: Fit, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity; components without variance aside."""
    width = min(components, model.dim)
    rows = _usable(df).where(F.size("embedding") == model.dim)
    gram, total = _gram(rows, lambda x: np.nan_to_num(model.whitened(x, width)), width)
    mean = total / model.n
    apart = gram / model.n - np.outer(mean, mean) - np.eye(width)
    real = ~np.isnan(model.whitened(np.zeros((1, model.dim), dtype=np.int64), width)[0])
    return float(np.abs(apart[np.ix_(real, real)]).max(initial=0.0))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable vector on the first ``components`` whitened components.

    ``df`` has vec_id and embedding; other columns, whatever their names, are ignored.
    Result, one row per row and component: vec_id, component from 1, n, deviation, whitened,
    explained, identity_error. Vectors that are null, empty or hold null or non-finite
    components take no part, nor do those of another length than the commonest. Repeated
    rows and ids count and come out as often as they are there; a null id stays null.
    A component without variance has whitened null and explained 0 (null if nothing varies).
    Components beyond the vectors' length don't exist. An empty table gives an empty result.
    """
    model = fit(df)
    if model is None:
        return df.sparkSession.createDataFrame([], RESULT)
    error = identity_error(df, model, components) if model.values is not None else 0.0
    width = min(components, model.dim)
    explained = [None] * width if model.values is None else [
        float(v / model.trace) if v > NO_VARIANCE * model.values[0] else 0.0 for v in model.values[:width]
    ]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = quantized(batch.column("embedding"))
            spots = np.repeat(np.arange(len(x)), width)
            flat = model.whitened(x, width).ravel()
            columns = [
                batch.column("vec_id").take(pa.array(spots)),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(spots), model.n)),
                pa.array(np.repeat(model.deviations(x), width)),
                pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                pa.array(explained * len(x), pa.float64()),
                pa.array(np.full(len(spots), error)),
            ]
            names = [part.split()[0] for part in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = _usable(df).where(F.size("embedding") == model.dim)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(task, RESULT)
