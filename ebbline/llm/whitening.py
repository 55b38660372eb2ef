"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers, so sums and scatter are added up exactly, in any order and
with any loss of executors.  A first pass gives counts and sums, a second the scatter about
the whole number nearest to each mean; what the mean differs from that number, half a unit
at most, is put right exactly afterwards.  The scatter is one small square for each
dimension of vectors, whatever their number.

The covariance is factored by Cholesky with diagonal pivoting, and one-sided Jacobi
rotations make the columns of the triangular factor orthogonal, without forming a product
of it.  Their norms squared are the eigenvalues, their directions the components.  Rotations
of one step touch disjoint pairs of columns and are done at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import keep, small_batches

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
_ROWS = 4096
_WORD = 60  # bits in the lower part of a sum
_EXACT = 2**53
#: Scaled entries from here on don't fit whole numbers with room to subtract.
_LARGEST = 2.0**61
_EPS = np.finfo(np.float64).eps


def usable(v: Column) -> Column:
    """Vectors, not null, whose entries all are finite numbers that scale to a long."""
    double = v.cast("array<double>")
    bad = F.exists(double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * SCALE >= _LARGEST))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _whole(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their entries as whole numbers) for each dimension in a batch."""
    lists = batch.column("v")
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        entries = flat[starts[rows][:, None] + np.arange(d)]
        yield rows, np.floor(SCALE * entries).astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list] = {}
    for batch in batches:
        for _, x in _whole(batch):
            own = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], dtype=object)])
            own[0] += len(x)
            high = x >> 31  # whole numbers of 31 bits can't overflow a batch's sum
            own[1] += high.sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
    rows = [(d, i, n, Decimal(int(s))) for d, (n, sums) in total.items() for i, s in enumerate(sums)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], type=t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)))],
        names=["d", "i", "n", "s"],
    )


def exact_scatter(r: np.ndarray) -> np.ndarray:
    """r^T r of whole numbers, exactly, as Python integers."""
    out = np.zeros((r.shape[1], r.shape[1]), dtype=object)
    if not r.size:
        return out
    largest = int(np.abs(r).max())
    if largest**2 > _EXACT:
        wide = r.astype(object)
        return wide.T @ wide
    step = min(_ROWS, _EXACT // max(1, largest**2))  # partial sums stay whole doubles
    for at in range(0, len(r), step):
        part = r[at : at + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _scatter(centres: dict[int, np.ndarray]):
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _whole(batch):
                d = x.shape[1]
                if d:
                    total[d] = total.get(d, 0) + exact_scatter(x - centres[d])
        cells = [(d, i, j, int(m[i, j])) for d, m in total.items() for i in range(d) for j in range(i, d)]
        split = [(d, i, j, Decimal(v >> _WORD), Decimal(v & ((1 << _WORD) - 1))) for d, i, j, v in cells]
        types = (pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([c[k] for c in split], type=t) for k, t in enumerate(types)], names=["d", "i", "j", "high", "low"]
        )

    return scatter


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with L L^T = v, a column for each pivot; columns end where only rounding is left."""
    left, columns = v.astype(np.float64).copy(), []
    least = len(v) * _EPS * max(0.0, float(v.diagonal().max(initial=0.0)))
    free = np.ones(len(v), dtype=bool)
    while free.any():
        p = int(np.argmax(np.where(free, left.diagonal(), -np.inf)))
        if left[p, p] <= least:
            break
        column = np.where(free, left[:, p], 0.0) / np.sqrt(left[p, p])
        left -= np.outer(column, column)
        free[p] = False
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((len(v), 0))


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns as rounds of disjoint pairs, as in a tournament."""
    seats = list(range(n + n % 2))
    out = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:]), strict=True) if max(a, b) < n]
        out.append((np.array([p[0] for p in pairs], dtype=int), np.array([p[1] for p in pairs], dtype=int)))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of factor @ factor.T."""
    a = factor.copy()
    rounds = _rounds(a.shape[1])
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            on = np.abs(xy) > len(a) * _EPS * np.sqrt(xx * yy)
            if not on.any():
                continue
            turned = True
            safe = np.where(on, xy, 1.0)
            zeta = (yy - xx) / (2 * safe)
            t = np.where(on, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.linalg.norm(a, axis=0)
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    return norms[order] ** 2, a[:, order] / norms[order]


@dataclass
class Whitening:
    """What whitens the vectors of one dimension."""

    n: int
    centre: np.ndarray  # whole numbers next to the means
    rest: list[int]  # sums of the differences from the centre
    values: np.ndarray  # leading eigenvalues, falling
    components: np.ndarray  # their unit eigenvectors, as columns
    trace: float

    def apply(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Exact deviations and whitened coordinates of whole-number rows."""
        r = x - self.centre
        largest = int(np.abs(r).max(initial=0)) * self.n + max(map(abs, self.rest), default=0)
        kind = np.int64 if r.shape[1] * largest**2 < 2**63 else object
        u = r.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        mean = np.array([s / self.n for s in self.rest])
        return (u * u).sum(axis=1).tolist(), (r - mean) @ self.components / np.sqrt(self.values)


def _model(n: int, centre: np.ndarray, sums: list[int], scatter: np.ndarray, components: int) -> Whitening:
    rest = [s - n * int(k) for s, k in zip(sums, centre, strict=True)]
    # Scatter about the means, n-fold, in whole numbers; only the quotient is rounded.
    about = n * scatter - np.outer(np.array(rest, dtype=object), np.array(rest, dtype=object))
    v = np.array([[cell / n**2 for cell in row] for row in about], dtype=np.float64).reshape(about.shape)
    values, vectors = one_sided_jacobi(pivoted_cholesky(v))
    return Whitening(n, centre, rest, values[:components], vectors[:, :components], float(v.trace()))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """For each dimension met, the whitening fitted on all usable vectors (column v).

    What reaches the driver are sums and scatter, d and d^2 numbers for dimension d.
    """
    schema = "d int, i int, n long, s decimal(38,0)"
    counted = vectors.mapInArrow(_sums, schema).groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    counts: dict[int, int] = {}
    sums: dict[int, dict[int, int]] = {}
    for row in counted.collect():
        counts[row["d"]] = row["n"]
        sums.setdefault(row["d"], {})[row["i"]] = int(row["s"])
    by_dimension = {d: [s[i] for i in range(d)] for d, s in sums.items()}
    centres = {d: np.array([(2 * s + counts[d]) // (2 * counts[d]) for s in by_dimension[d]], dtype=np.int64) for d in by_dimension}
    scatter = {d: np.zeros((d, d), dtype=object) for d in by_dimension}
    schema = "d int, i int, j int, high decimal(38,0), low decimal(38,0)"
    cells = vectors.mapInArrow(_scatter(centres), schema).groupBy("d", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    for row in cells.collect() if centres else []:
        value = (int(row["high"]) << _WORD) + int(row["low"])
        scatter[row["d"]][row["i"], row["j"]] = scatter[row["d"]][row["j"], row["i"]] = value
    return {d: _model(counts[d], centres[d], by_dimension[d], scatter[d], components) for d in by_dimension}


def _whitened(models: dict[int, Whitening]):
    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _whole(batch):
                model = models.get(x.shape[1])
                if model is None:  # vectors without entries have no components
                    continue
                deviations, w = model.apply(x)
                exact = [Decimal(v) if v < 10**38 else None for v in deviations]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(rows)),
                        pa.array(np.full(len(rows), x.shape[1], dtype=np.int32)),
                        pa.array(exact, type=pa.decimal128(38, 0)),
                        pa.array(list(w), type=pa.list_(pa.float64())),
                    ],
                    names=["key", "d", "deviation", "w"],
                )

    return whitened


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row for each
    vector and component.

    Entries c count as floor(1024 c) + 100000.  A null vector, one with a null, non-finite or
    unscalable entry (2^51 and more), and one without entries gives no row and isn't fitted.
    Rows without key and repeated rows are rows like any other.  Vectors of each dimension are
    fitted apart, n counting theirs.  Only components of an eigenvalue above rounding exist:
    equal vectors, and a single one, give no row, and neither does an empty table.
    ``deviation`` is exact, a decimal of 38 digits (null beyond).  ``identity_error`` is
    measured on the whitened rows, centred, over all of them.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    good = vectors.where(usable(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    models = fit(good.select("v"), components)
    schema = f"key {good.schema['key'].dataType.simpleString()}, d int, deviation decimal(38,0), w array<double>"
    rows = keep(good.mapInArrow(_whitened(models), schema), "whitened")
    found = [(i, j) for i in range(components) for j in range(i, components)]
    # Coordinates beyond a dimension's components are null and count nowhere.
    away = [F.abs(F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) - float(i == j)) for i, j in found]
    errors = {r["d"]: r["error"] for r in rows.groupBy("d").agg(F.greatest(*away, F.lit(0.0)).alias("error")).collect()}
    facts = [(d, m.n, [float(v / m.trace) for v in m.values], errors[d]) for d, m in models.items() if d in errors]
    by_dimension = spark.createDataFrame(facts, "d int, n long, shares array<double>, identity_error double")
    return (
        rows.join(F.broadcast(by_dimension), "d")  # a row for each model that the driver holds
        .select("key", "n", "deviation", "shares", "identity_error", F.posexplode("w").alias("i", "whitened"))
        .select(
            F.col("key").alias(key),
            (F.col("i") + 1).alias("component"),
            "n",
            "deviation",
            "whitened",
            F.get("shares", F.col("i")).alias("explained"),
            "identity_error",
        )
    )
