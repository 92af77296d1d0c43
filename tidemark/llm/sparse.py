"""Hashed word features of whole texts, and models that one task fits on a bounded sample of labelled rows."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import bounded_sample, by_bytes
from tidemark.llm.textkit import U, Words


class Sparse:
    """Rows of (column, value) pairs: those of row i lie between at[i] and at[i + 1]; a row's columns differ."""

    def __init__(self, columns: np.ndarray, values: np.ndarray, at: np.ndarray):
        self.columns, self.values, self.at = columns, values, at

    def __len__(self) -> int:
        return len(self.at) - 1

    @staticmethod
    def join(parts: list[Sparse]) -> Sparse:
        """The rows of all parts, one after the other."""
        sizes = np.concatenate([np.diff(p.at) for p in parts])
        return Sparse(np.concatenate([p.columns for p in parts]), np.concatenate([p.values for p in parts]), np.concatenate([[0], np.cumsum(sizes)]))

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.at))

    def take(self, rows: np.ndarray) -> Sparse:
        n = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(n)])
        index = np.repeat(self.at[:-1][rows] - at[:-1], n) + np.arange(at[-1])
        return Sparse(self.columns[index], self.values[index], at)

    def sums(self, products: np.ndarray) -> np.ndarray:
        """Sums of products (one for each pair) over each row."""
        out = np.zeros((len(self), *products.shape[1:]), products.dtype)
        some = np.flatnonzero(np.diff(self.at))
        if len(some):
            out[some] = np.add.reduceat(products, self.at[some], axis=0)
        return out


def hashed(owner: np.ndarray, hashes: np.ndarray, rows: int, width: int) -> Sparse:
    """Log counts of hashed features, each given with the row that owns it. width: a power of two."""
    key, count = np.unique(owner.astype(np.uint64) * U(width) + (hashes & U(width - 1)), return_counts=True)
    at = np.searchsorted(key, np.arange(rows + 1).astype(np.uint64) * U(width))
    return Sparse((key & U(width - 1)).astype(np.int64), np.log1p(count), at)


def hashed_words(words: Words, width: int) -> Sparse:
    return hashed(words.doc(), words.hash, len(words.n), width)


def fit_once(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_cols: list[str], bound: int, seed: int, inputs: Callable, fit: Callable):
    """fit(features, labels as an array with a column for each of label_cols) on at most `bound` labelled rows; None if there are none.

    The rows are those whose ids hash lowest, in the order of the hash, so that reruns agree. One task holds their features,
    inputs(texts), made batch by batch: their number is bounded whatever the size of the corpus. Ids that are labelled in more than one way count as their greatest label.
    """
    told = labels.filter(" and ".join(f"{c} is not null" for c in [id_col, *label_cols]))
    told = told.groupBy(F.col(id_col).alias("id")).agg(*[F.max(F.col(c).cast("int")).alias(c) for c in label_cols])
    chosen = bounded_sample(told, bound, seed)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # chosen has `bound` rows of a few numbers at most
    rows = texts.join(F.broadcast(chosen), "id").select("turn", "text", *label_cols).repartition(1).sortWithinPartitions("turn", "text")

    def run(batches):
        features, given = [], []
        for batch in by_bytes(batches, 1):
            features.append(inputs(batch.column(1)))
            given.append(np.column_stack([batch.column(i + 2).to_numpy() for i in range(len(label_cols))]))
        if features:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(Sparse.join(features), np.concatenate(given)))], pa.binary())], ["model"])

    found = rows.mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else None
