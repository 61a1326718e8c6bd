"""Whitening of embeddings; their covariance comes from variances alone (polarisation).

Every entry becomes an integer and is centred as ``n * x - S``. For each dimension and each
sum of two dimensions the squares of the centred values are added up exactly. Half of what
the square of a sum has beyond the squares of its parts is the cross-covariance, so the whole
matrix follows from these totals; its eigenvectors are taken on the driver, which holds one
total per pair of dimensions and never a vector.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.session import Staging

SCALE, OFFSET = 64.0, 1_000_000
COMPONENTS = 16
#: Entries become integers up to this size; so far they and their means are exact.
LARGEST = 2.0**52
#: Pairs of dimensions have a total each, which the driver holds.
MOST_DIMENSIONS = 4096
#: Squares are added up in parts of so many bits, over so many rows at a time, within 64 bits.
LIMB, ROWS = 26, 1024
#: A component with less than this share of the largest eigenvalue has no spread to divide by.
NO_SPREAD = 1e-13


def whole_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors as integers, without rows whose vector is null, empty or holds null, NaN or infinity.

    An entry so large that it has no exact integer is an error.
    """
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    usable = embeddings.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(~bad)
    entry = lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET)
    within = ~F.exists(vector, lambda c: F.abs(F.lit(SCALE) * c.cast("double")) >= LARGEST)
    x = F.when(within, F.transform(vector, entry)).otherwise(F.raise_error(F.lit("an entry is too large for an exact integer")).cast("array<bigint>"))
    return usable.select(F.col(id_column).alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(-1, width)


def _sum_entries(batches):
    """Per task and dimension: rows and exact sum."""
    n, total, width = 0, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        width = width or len(batch.column(0)[0])
        x = _matrix(batch.column(0), width)
        for i in range(0, len(x), ROWS):  # below 2^53 each, so 1024 of them fit
            part = x[i : i + ROWS].sum(axis=0).astype(object)
            total = part if total is None else total + part
        n += len(x)
    if n:
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(width), pa.int32()), "n": pa.array([n] * width, pa.int64()), "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))}
        )


@dataclass
class Centre:
    """The fit list's size and sums. ``base`` is near the mean, ``rest`` = S - n * base, so centred values stay small."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        base = [round(Decimal(s) / n) for s in sums]
        return cls(n, np.array(base, np.int64), np.array([s - n * b for s, b in zip(sums, base, strict=True)], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        near = x - self.base
        if len(near) and self.n * int(np.abs(near).max()) + int(np.abs(self.rest).max()) >= 1 << 61:
            raise OverflowError("centred values need more than 61 bits")
        return self.n * near - self.rest

    def floating(self, x: np.ndarray) -> np.ndarray:
        """x - S / n in double precision; the large common part goes before rounding."""
        return (x - self.base).astype(np.float64) - self.rest / self.n


class Squares:
    """Exact sums of squares of many columns, added up block by block."""

    def __init__(self, columns: int, limbs: int):
        self.limbs = limbs
        self.low = np.zeros((limbs, limbs, columns), np.int64)
        self.high = np.zeros((limbs, limbs, columns), np.int64)

    def add(self, values: np.ndarray, at: slice) -> None:
        """``values`` (at most ROWS rows) belong to the columns ``at``."""
        parts = []
        for k in range(self.limbs):
            last = k == self.limbs - 1
            parts.append(values if last else values & ((1 << LIMB) - 1))
            values = values >> LIMB
        for a in range(self.limbs):
            for b in range(a, self.limbs):
                s = np.einsum("rc,rc->c", parts[a], parts[b])
                self.low[a, b, at] += s & 0xFFFFFFFF
                self.high[a, b, at] += s >> 32

    def totals(self) -> list[int]:
        out = np.zeros(self.low.shape[2], object)
        for a in range(self.limbs):
            for b in range(a, self.limbs):
                own = self.high[a, b].astype(object) * (1 << 32) + self.low[a, b].astype(object)
                out += own * (1 if a == b else 2) * (1 << (LIMB * (a + b)))
        return out.tolist()


def _square_sums(centre: Centre, batches):
    """Per task: (i, j, sum of squares) of every dimension (i = j) and of every sum of two (i < j)."""
    width = len(centre.base)
    sums, limbs = None, 1
    starts = np.cumsum([0] + [width - i for i in range(width)])
    for batch in batches:
        u = centre.centred(_matrix(batch.column(0), width))
        for r in range(0, len(u), ROWS):
            part = u[r : r + ROWS]
            bits = int(2 * np.abs(part).max()).bit_length()
            needed = -(-bits // LIMB) or 1
            if sums is None or needed > limbs:
                sums = (sums or []) + [Squares(int(starts[-1]), needed)]
                limbs = needed
            for i in range(width):
                pair = part[:, i:] + part[:, i : i + 1]
                pair[:, 0] = part[:, i]
                sums[-1].add(pair, slice(int(starts[i]), int(starts[i + 1])))
    if sums is not None:
        total = [sum(own) for own in zip(*[s.totals() for s in sums], strict=True)]
        i = np.repeat(np.arange(width), width - np.arange(width))
        j = np.concatenate([np.arange(k, width) for k in range(width)])
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "squares": pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))}
        )


def covariance(n: int, squares: dict[tuple[int, int], int], width: int) -> np.ndarray:
    """The covariance of x (divisor n): (var(i + j) - var(i) - var(j)) / 2, exact until the last division."""
    out = np.empty((width, width))
    for i in range(width):
        for j in range(i, width):
            twice = 2 * squares[i, i] if i == j else squares[i, j] - squares[i, i] - squares[j, j]
            out[i, j] = out[j, i] = twice / (2 * n**3)
    return out


@dataclass
class Whitener:
    """Unit eigenvectors by falling eigenvalue, one per column, each with its largest entry positive."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    @classmethod
    def of(cls, centre: Centre, v: np.ndarray, components: int) -> Whitener:
        values, vectors = np.linalg.eigh(v)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        trace = np.trace(v)
        values = np.maximum(values, 0.0)
        return cls(centre, vectors * sign, values, values / trace if trace > 0 else np.zeros_like(values))

    @property
    def spread(self) -> np.ndarray:
        """Which components can be scaled to variance 1."""
        return self.values > NO_SPREAD * max(self.values.max(initial=0.0), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """(rows, components); NaN for components without spread."""
        with np.errstate(divide="ignore"):
            scale = np.where(self.spread, 1 / np.sqrt(self.values), np.nan)
        return (self.centre.floating(x) @ self.vectors) * scale


def _moments(whitener: Whitener, batches):
    """Per task: sums of whitened values (j = -1) and of their products, over the components with spread."""
    some = np.flatnonzero(whitener.spread)
    first, second = np.zeros(len(some)), np.zeros((len(some), len(some)))
    for batch in batches:
        z = whitener.whitened(_matrix(batch.column(0), len(whitener.centre.base)))[:, some]
        first += z.sum(axis=0)
        second += z.T @ z
    i, j = np.divmod(np.arange(len(some) ** 2), max(1, len(some)))
    yield pa.RecordBatch.from_pydict(
        {
            "i": pa.array(np.concatenate([np.arange(len(some)), i]), pa.int32()),
            "j": pa.array(np.concatenate([np.full(len(some), -1), j]), pa.int32()),
            "total": pa.array(np.concatenate([first, second.ravel()]), pa.float64()),
        }
    )


def fit(staging: Staging, vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitener, float] | None:
    """The whitener of the distinct ``x`` of ``vectors``, and its identity error; None without any.

    The fit list is written once and read three times: for sums, for squares, and to measure how far the
    whitened covariance is from the identity. Totals per dimension and per pair are Spark aggregates of
    what each task has added up, so a vector that holds most rows is one row here. Vectors of different
    lengths are an error, so are more than ``MOST_DIMENSIONS``.
    """
    spark = staging.spark
    lengths = [r[0] for r in vectors.select(F.size("x").alias("d")).distinct().limit(2).collect()]
    if not lengths:
        return None
    if len(lengths) > 1:
        raise ValueError("the vectors have different lengths")
    width = lengths[0]
    if width > MOST_DIMENSIONS:
        raise ValueError(f"{width} dimensions; at most {MOST_DIMENSIONS} are whitened")
    listed = staging.keep(vectors.select("x").distinct(), "fit")
    sums = listed.mapInArrow(_sum_entries, "i int, n bigint, total decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = sorted(sums.collect())
    centre = Centre.of(rows[0]["n"], [int(r["total"]) for r in rows])
    sent = spark.sparkContext.broadcast(centre)
    squared = listed.mapInArrow(lambda b: _square_sums(sent.value, b), "i int, j int, squares decimal(38,0)").groupBy("i", "j").agg(F.sum("squares").alias("squares"))
    squares = {(r["i"], r["j"]): int(r["squares"]) for r in squared.toLocalIterator()}
    sent.unpersist()
    whitener = Whitener.of(centre, covariance(centre.n, squares, width), min(components, width))
    shown = spark.sparkContext.broadcast(whitener)
    moments = listed.mapInArrow(lambda b: _moments(shown.value, b), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    total = {(r["i"], r["j"]): r["total"] for r in moments.collect()}
    shown.unpersist()
    k, n = int(whitener.spread.sum()), centre.n
    error = max((abs(total[i, j] / n - total[i, -1] * total[j, -1] / n**2 - (i == j)) for i in range(k) for j in range(k)), default=0.0)
    return whitener, float(error)


def _apply(whitener: Whitener, error: float, batches):
    k = len(whitener.values)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            x = _matrix(part.column(1), len(whitener.centre.base))
            u = whitener.centre.centred(x)
            if len(u) and int(np.abs(u).max()) ** 2 * u.shape[1] < 1 << 62:
                deviation = pa.array((u * u).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([Decimal(sum(int(v) ** 2 for v in row)) for row in u], pa.decimal128(38, 0))
            z = whitener.whitened(x).ravel()
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": part.column(0).take(rows),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    "n": pa.array(np.full(len(z), whitener.centre.n), pa.int64()),
                    "deviation": deviation.take(rows),
                    "whitened": pa.array(z, pa.float64(), mask=np.isnan(z)),
                    "explained": pa.array(np.tile(whitener.explained, len(x)), pa.float64()),
                    "identity_error": pa.array(np.full(len(z), error), pa.float64()),
                }
            )


def whiten(staging: Staging, embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row of ``embeddings`` and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    ``deviation`` is exact, as decimal(38,0). Rows that repeat an id or a vector have their own result rows;
    ids may be null. A component without spread (all vectors equal, or fewer vectors than components) has a
    NULL ``whitened`` and is left out of the identity error. Other columns are not looked at. No usable
    vector: no row.
    """
    vectors = staging.keep(whole_vectors(embeddings, id_column, vector), "vectors")
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = fit(staging, vectors, components)
    if found is None:
        return staging.spark.createDataFrame([], schema)
    whitener, error = found
    sent = staging.spark.sparkContext.broadcast(whitener)
    return vectors.mapInArrow(lambda b: _apply(sent.value, error, b), schema)


def whitening_report(staging: Staging, embeddings: DataFrame) -> DataFrame:
    """``whiten`` with the deviation as long; where it needs more than 64 bits it is NULL and ``deviation_exact`` has it."""
    out = whiten(staging, embeddings)
    long = F.expr("try_cast(deviation AS bigint)")
    return out.select("vec_id", "component", "n", long.alias("deviation"), "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"))
