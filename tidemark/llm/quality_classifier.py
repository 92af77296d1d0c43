"""A factorisation machine over hashed words, structure statistics and length scores the quality of whole texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality_rules import COUNTS, count_texts, features
from tidemark.llm.runtime import by_bytes, prepare, tuned
from tidemark.llm.sparse import Sparse, fit_once, hashed_words
from tidemark.llm.textkit import Words

#: Buckets of hashed words, and the length of each feature's vector.
WIDTH, RANK = 1 << 14, 8

#: Numbers that are counted in a text.
STATS = 9


def inputs(column: pa.Array) -> Sparse:
    """Words first, with a length of one together; then the statistics, which depend on the text alone."""
    words = hashed_words(Words(column, lower=True), WIDTH)
    norm = np.sqrt(words.sums(words.values**2))
    values = words.values / np.maximum(norm, 1e-9)[words.rows()]
    counts = pd.DataFrame(count_texts(column), columns=COUNTS)
    n = counts["n_words"].to_numpy(float)
    distinct = counts["n_distinct"].to_numpy(float) / np.maximum(n, 1)
    mean = counts["word_chars"].to_numpy(float) / np.maximum(n, 1)
    length = np.log1p(n) / 10
    stats = np.column_stack([features(counts), distinct, mean / 10, length, n == 0]).astype(float)
    k = stats.shape[1]
    at = words.at + np.arange(len(words) + 1) * k
    columns, out = np.empty(at[-1], np.int64), np.empty(at[-1])
    tail = (at[1:, None] - k + np.arange(k)).ravel()
    head = np.ones(at[-1], bool)
    head[tail] = False
    columns[head], out[head] = words.columns, values
    columns[tail], out[tail] = np.tile(WIDTH + np.arange(k), len(words)), stats.ravel()
    return Sparse(columns, out.astype(np.float32), at)


class Machine:
    """bias + weights . x + the sum over pairs of <v_i, v_j> x_i x_j."""

    def __init__(self, width: int, rank: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bias = np.float32(0)
        self.weights = np.zeros(width, np.float32)
        self.vectors = rng.normal(0, 0.02, (width, rank)).astype(np.float32)

    def margin(self, x: Sparse) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs' sum is half of (sum of v x) squared less the sum of (v x) squared: linear in the number of features."""
        parts = self.vectors[x.columns] * x.values[:, None]
        total = x.sums(parts)
        pairs = 0.5 * (total**2 - x.sums(parts**2)).sum(axis=1)
        return self.bias + x.sums(self.weights[x.columns] * x.values) + pairs, parts, total

    def score(self, x: Sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x)[0].astype(float), -30, 30)))

    def fit(self, x: Sparse, y: np.ndarray, epochs: int, batch: int, rate: float, ridge: float, seed: int) -> Machine:
        """Logistic loss, batches in random order, a step size for each number by its own past gradients."""
        rng = np.random.default_rng(seed)
        past_w, past_v, past_b = np.full_like(self.weights, 1e-4), np.full_like(self.vectors, 1e-4), 1e-4
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(order), batch):
                rows = x.take(order[a : a + batch])
                margin, parts, total = self.margin(rows)
                slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[order[a : a + batch]]).astype(np.float32) / len(rows)
                owner = rows.rows()
                step = slope[owner] * rows.values
                there, place = np.unique(rows.columns, return_inverse=True)
                g = np.bincount(place, step, len(there)).astype(np.float32) + ridge * self.weights[there]
                past_w[there] += g**2
                self.weights[there] -= rate * g / np.sqrt(past_w[there])
                each = step[:, None] * (total[owner] - parts)
                g = np.column_stack([np.bincount(place, each[:, j], len(there)) for j in range(each.shape[1])]).astype(np.float32) + ridge * self.vectors[there]
                past_v[there] += g**2
                self.vectors[there] -= 0.3 * rate * g / np.sqrt(past_v[there])
                past_b += slope.sum() ** 2
                self.bias -= np.float32(rate * slope.sum() / np.sqrt(past_b))
        return self


def learn(x: Sparse, labels: np.ndarray, epochs: int = 4, seed: int = 6) -> Machine:
    y = (labels[:, 0] == 1).astype(np.float32)
    return Machine(WIDTH + STATS, RANK, seed).fit(x, y, epochs, 128, 0.1, 1e-5, seed)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bound: int = 6000, seed: int = 6
) -> DataFrame:
    """(id, score, predicted): how likely each text's label is 1, and whether that is at least a half.

    The machine is fitted on at most `bound` of the labelled rows given; only the text and what is counted in it go in. Null
    text counts as empty and is scored. Without labels all scores are 0.5. Ids may be null or repeat: each row is scored.
    Empty table: empty result. Extra columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    model = fit_once(docs, labels, id_col, text_col, [label_col], bound, seed, inputs, learn)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 1):
            n = batch.num_rows
            score = shared.value.score(inputs(batch.column(1))) if shared.value and n else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double, predicted int")


def fold(id_col: str = "doc_id"):
    """The remainder by which rows are held out: 1 means held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """The quality of all documents, learnt from the labels that are not held out."""
    read = tuned(spark).read
    labels = read.parquet(f"{sf_dir}/labels.parquet").filter(fold() != 1)
    out = score_quality(read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return out.select(F.col("id").alias("doc_id"), F.coalesce(fold("id") == 1, F.lit(False)).alias("held_out"), "score", "predicted")
