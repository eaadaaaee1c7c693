"""Embedding whitening: vectors in the eigenvectors of their covariance, each of variance one.

Vectors are put on a lattice of whole numbers, so sums over the different vectors are exact
and copies count once. The covariance, centred before multiplying, is added up over tasks; a
matrix of the size of one vector squared is all that meets on the driver. There spectral
divide and conquer splits it into components, which go back to every task.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped; so
are rows of another length than most of the different vectors have (the shorter of two that
are as frequent), and vectors of length zero. Directions without variance (below ``LEAST`` of
the largest) are no components, so equal vectors have none and give no rows. Lattice values
are held to the range of a long; a deviation beyond it is null. Repeated rows each get their
rows. Only vec_id and embedding are read, so other columns may have any name.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm.spectral import eigen
from pagequarry.scratch import materialise

SCALE = 256  # fixed value: lattice steps in a unit
LEAST = 1e-11
MOST_LONG = 2**63 - 1


def on_lattice(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) to (vec_id, x): whole numbers, of the rows that have some."""
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + F.lit(0))
    rows = vectors.select("vec_id", "embedding")
    return rows.where(finite & ~F.exists("embedding", F.isnan)).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _add_up(fit: DataFrame, size: int, part, width: int) -> np.ndarray:
    """The sum over all rows of ``part``, which gives ``width`` numbers for each batch.

    Every task sends its own sum, number by number, so they are added in many tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += part(_matrix(batch.column("x"), size))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), pa.array(total)], ["place", "part"]
        )

    sums = fit.mapInArrow(run, "place long, part double").groupBy("place").agg(F.sum("part"))
    total = np.zeros(width)
    for place, value in sums.collect():
        total[place] = value
    return total


def _exact_sums(fit: DataFrame, size: int) -> list[int]:
    """The sum of each dimension, exact: halves of 32 bits are added apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        sums = [decimal.Decimal((h << 32) + v) for h, v in zip(high.tolist(), low.tolist(), strict=True)]
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(sums, kind)], ["place", "part"]
        )

    sums = fit.mapInArrow(run, "place long, part decimal(38,0)").groupBy("place").agg(F.sum("part"))
    total = [0] * size
    for place, value in sums.collect():
        total[place] = int(value)
    return total


@dataclass
class Whitening:
    """``n`` different vectors with the sum of each dimension; ``turn`` takes a centred
    vector to its components, whose shares of the variance are ``explained``."""

    n: int
    sums: list[int]
    turn: np.ndarray
    explained: list[float]
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n * x - sum) ** 2 of each row; null if no long can hold it.

        Sums modulo 2**64 are exact where the result is smaller; a sum in double precision
        tells where it surely is, whole numbers of Python decide the rest."""
        with np.errstate(over="ignore"):
            wrapped = x.astype(np.uint64) * np.uint64(self.n % 2**64)
            wrapped -= np.array([s % 2**64 for s in self.sums], np.uint64)
            found = (wrapped * wrapped).sum(axis=1, dtype=np.uint64).astype(np.int64).tolist()
        about = ((x.astype(float) * self.n - np.array(self.sums, float)) ** 2).sum(axis=1)
        plain = np.abs(x.astype(float)).max(axis=1, initial=0) * self.n < 2**52
        for row in np.flatnonzero(~plain | (about > 2**62)).tolist():
            found[row] = None
            if not plain[row] or about[row] < 2**64:
                pairs = zip(x[row].tolist(), self.sums, strict=True)
                value = sum((self.n * a - s) ** 2 for a, s in pairs)
                found[row] = value if value <= MOST_LONG else None
        return found


def fit(vectors: DataFrame, components: int | None = None) -> Whitening | None:
    """The whitening of the different vectors of ``vectors`` (vec_id, x), of all components
    or the first ones; None if there is no vector."""
    different = materialise(vectors.select("x").distinct(), "vectors").where(F.size("x") > 0)
    sizes = different.groupBy(F.size("x").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), "size").limit(1).collect()
    if not most:
        return None
    size, n = most[0]
    different = different.where(F.size("x") == size)
    sums = _exact_sums(different, size)
    centre = np.array([s / n for s in sums])

    def squares(x: np.ndarray) -> np.ndarray:
        own = x - centre
        return (own.T @ own).ravel()

    covariance = _add_up(different, size, squares, size * size).reshape(size, size) / n
    values, turn = eigen(covariance)
    kept = int((values > LEAST * values[0]).sum()) if values[0] > 0 else 0
    kept = min(kept, components or kept)
    turn = turn[:, :kept] / np.sqrt(values[:kept])
    explained = (values[:kept] / np.trace(covariance)).tolist() if kept else []

    # The whitened vectors are centred already, up to rounding: their mean comes off too.
    def whitened(x: np.ndarray) -> np.ndarray:
        own = (x - centre) @ turn
        return np.concatenate([own.sum(axis=0), (own.T @ own).ravel()])

    error = 0.0
    if kept:
        total = _add_up(different, size, whitened, kept + kept * kept) / n
        mean, found = total[:kept], total[kept:].reshape(kept, kept)
        error = float(np.abs(found - np.outer(mean, mean) - np.eye(kept)).max())
    return Whitening(n, sums, turn, explained, error)


RESULT = (
    "component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """(vec_id, x) to a row for each vector and component, numbered from 1."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, {RESULT}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    vectors = vectors.select("vec_id", "x").where(F.size("x") == len(model.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        size, count = model.turn.shape
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            row = np.repeat(np.arange(len(x)), count)
            component = np.tile(np.arange(count), len(x))
            arrays = [
                batch.column("vec_id").take(pa.array(row)),
                pa.array(component + 1, pa.int32()),
                pa.array(np.full(len(row), model.n)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(row)),
                pa.array((model.centred(x) @ model.turn).ravel()),
                pa.array(np.array(model.explained)[component]),
                pa.array(np.full(len(row), model.identity_error)),
            ]
            names = ["vec_id", *[f.split()[0] for f in RESULT.split(", ")]]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return vectors.mapInArrow(run, schema)
