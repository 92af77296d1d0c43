"""Embedding whitening by polarisation: covariances from squared values alone.

With d = n * x - S, the deviation of an entry from its mean times n, a whole number, the squares of d are added up exactly for each dimension
and for the sum of each pair of dimensions. The cross term of a pair is half of what the square of its sum exceeds the squares of both
by. Tasks give one row for each pair, Spark adds those up, and the driver gets one number for each pair of dimensions, whatever the
number of rows: enough for the covariance, which is decomposed there. Rows are then projected where they are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import discard, materialize, prepare, tuned

#: Numbers of pair sums that are squared in one go.
MANY = 1 << 20

#: Sums are taken of the two halves of a number, cut at this bit, so that nothing overflows; larger deviations are squared as Python numbers.
HALF, WIDE = 24, 1 << 46

#: An eigenvalue below this part of the largest is zero but for rounding: vectors along it are not scaled up.
FLAT = 1e-12


def quantized(rows: DataFrame, vector_col: str, scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """rows whose vector is there and has only finite entries, with `x`: floor(scale * entry) + shift, as longs."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(v.isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("x", F.transform(v, lambda c: F.floor(c * scale) + shift))


def matrix(lists: pa.Array, size: int) -> np.ndarray:
    """The lists as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def square_sums(values: np.ndarray) -> list[int]:
    """The exact sum of squares of each column of int64 values."""
    if not len(values):
        return [0] * values.shape[1]
    if max(abs(int(values.max())), abs(int(values.min()))) >= WIDE:
        return [sum(int(v) ** 2 for v in column) for column in values.T]
    low, high = values & ((1 << HALF) - 1), values >> HALF
    parts = [(a * b).sum(axis=0).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(hh << 2 * HALF) + (hl << HALF + 1) + ll for hh, hl, ll in zip(*parts)]


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact, or an error."""
    if len(x) and max(abs(int(x.max())), abs(int(x.min()))) * n >= 1 << 62:
        raise OverflowError(f"entries are too large for {n} vectors")
    return x * n - sums


@dataclass
class Whitening:
    """What fit found: n vectors, the sums of each dimension, and the components, one a row, with their eigenvalues; trace is that of the covariance."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows of x centred, projected and scaled to a variance of one."""
        # n * x - S is exact, so the mean is not rounded before it is taken off
        centred = deviations(x, self.n, self.sums).astype(np.float64) / self.n
        return centred @ self.components.T / np.sqrt(self.eigenvalues)


def fit(vectors: DataFrame, components: int = 16) -> Whitening:
    """Whitening for distinct vectors (x: array of longs, all of one length), written, as they are read twice.

    Eigenvalues fall; those that are zero but for rounding are left out, with their components. Sums are exact: they travel as whole
    numbers. No vectors: no components.
    """
    shape = vectors.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    n, size = shape["n"], shape["a"] or 0
    if shape["a"] != shape["b"]:
        raise ValueError(f"vectors have from {shape['a']} to {shape['b']} entries")
    if not n or not size:
        return Whitening(n, np.zeros(size, np.int64), np.zeros((size, size)), np.zeros((0, size)), np.zeros(0), 0.0)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += matrix(batch.column(0), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["i", "total"])

    found = vectors.select("x").mapInArrow(added, "i int, total long").groupBy("i").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros(size, np.int64)
    for r in found:
        sums[r["i"]] = r["total"]
    first, second = np.triu_indices(size, 1)

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The squares of each dimension, and of the sum of each pair."""
        alone, paired = [0] * size, [0] * len(first)
        lot = max(1, MANY // (len(first) + size))
        for batch in batches:
            d = deviations(matrix(batch.column(0), size), n, sums)
            for a in range(0, len(d), lot):
                part = d[a : a + lot]
                alone = list(map(int.__add__, alone, square_sums(part)))
                paired = list(map(int.__add__, paired, square_sums(part[:, first] + part[:, second])))
        ends = np.arange(size)
        rows = [np.concatenate([ends, first]), np.concatenate([ends, second])]
        # decimal text, as an Arrow decimal would need each number's digits; Spark adds decimals up exactly
        yield pa.RecordBatch.from_arrays([*[pa.array(r.astype(np.int32)) for r in rows], pa.array([str(v) for v in alone + paired])], ["i", "j", "squares"])

    parts = vectors.select("x").mapInArrow(squared, "i int, j int, squares string")
    totals = {(r["i"], r["j"]): int(r["squares"]) for r in parts.groupBy("i", "j").agg(F.sum(F.col("squares").cast("decimal(38,0)")).alias("squares")).collect()}
    covariance = np.empty((size, size))
    for i in range(size):
        covariance[i, i] = totals[i, i] / n**3
        for j in range(i + 1, size):
            # whole numbers until the last division, which rounds once
            covariance[i, j] = covariance[j, i] = (totals[i, j] - totals[i, i] - totals[j, j]) / (2 * n**3)
    trace = sum(totals[i, i] for i in range(size)) / n**3
    values, vectors_ = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values, kind="stable")[:components].tolist() if values[k] > FLAT * values[-1]]
    return Whitening(n, sums, covariance, vectors_[:, order].T.copy(), values[order], trace)


def identity_error(vectors: DataFrame, whitening: Whitening) -> float:
    """The largest entry, by size, of the covariance of the whitened vectors minus the identity, as measured on all of them."""
    size, k = len(whitening.sums), len(whitening.eigenvalues)
    if not k:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            w = whitening.apply(matrix(batch.column(0), size))
            total += np.column_stack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["i", "total"])

    total = np.zeros(k * (k + 1))
    for r in vectors.select("x").mapInArrow(moments, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect():
        total[r["i"]] = r["total"]
    total = total.reshape(k, k + 1) / whitening.n
    mean = total[:, -1]
    return float(np.abs(total[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def _projected(whitening: Whitening, error: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each row and component."""
    size, k = len(whitening.sums), len(whitening.eigenvalues)
    explained = whitening.eigenvalues / whitening.trace if k else whitening.eigenvalues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows or not k:
                continue
            x = matrix(batch.column(1), size)
            d = deviations(x, whitening.n, whitening.sums)
            if int(np.abs(d).max()) ** 2 * size < 1 << 63:
                deviation = (d * d).sum(axis=1)
            else:
                deviation = np.array([sum(int(v) ** 2 for v in row) for row in d], object)  # beyond a long: Arrow raises an error
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, whitening.n, np.int64)), pa.array(np.repeat(deviation, k), pa.int64()), pa.array(whitening.apply(x).ravel()),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row with a sound vector and each component.

    Vectors that are null or hold null or non-finite entries are left out. Entries become whole numbers x; the fit takes each distinct vector
    once, so copies weigh nothing more. component counts from 1 by falling eigenvalue; deviation is the sum over dimensions of
    (n * x - S)^2, exact, and an error beyond the range of a long, which large n or entries reach; explained is the component's part of
    all variance. Components without variance are left out: with fewer than two distinct vectors no row is given. Vectors of different
    lengths are an error. Null ids, and ids that repeat: rows like others. Empty table: empty result. Extra columns are ignored.
    """
    prepare(rows.sparkSession)
    id_type = rows.schema[id_col].dataType.simpleString()
    given = quantized(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), "v").select("vec_id", "x")
    vectors = materialize(given.select("x").distinct())
    whitening = fit(vectors, components)
    error = identity_error(vectors, whitening)
    discard(vectors)
    out = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return given.mapInArrow(_projected(whitening, error), out)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings along the sixteen directions in which they vary most, each scaled to a variance of one."""
    return whiten(tuned(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))
