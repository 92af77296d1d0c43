"""Toxicity as severity grades: cumulative-link ordinal regression on sparse word features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import by_bytes, prepare, tuned
from tidemark.llm.sparse import Sparse, fit_once, hashed
from tidemark.llm.textkit import Words, constants, hash_spans, mix

#: Buckets of hashed words: many, as a collision with a frequent word would hide a rare one.
WIDTH = 1 << 18

#: Words are runs of ASCII letters and digits and of all other code points beyond ASCII.
BREAK = np.ones(256, dtype=bool)
BREAK[0x80:] = False
BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

GRADES = ("none", "mild", "strong", "severe")


#: Beginnings of words, in bytes, that count as features too: inflected and compound words share them.
BEGINNINGS = (4, 5, 6, 8)


def inputs(column: pa.Array) -> Sparse:
    """Log counts of the words and of their beginnings, lower-cased. Long texts are not scaled down: what they hold still counts."""
    words = Words(column, lower=True, space=BREAK)
    owner, size = words.doc(), words.ends - words.starts
    owners, hashes = [owner], [words.hash]
    for n, seed in zip(BEGINNINGS, constants(909, len(BEGINNINGS))):
        longer = size > n
        owners.append(owner[longer])
        hashes.append(mix(hash_spans(words.data, words.starts[longer], words.starts[longer] + n) ^ seed))
    return hashed(np.concatenate(owners), np.concatenate(hashes), len(words.n), WIDTH)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Ordinal:
    """P(grade <= j) = sigmoid(threshold j - weights . x): one set of weights, thresholds in rising order."""

    def __init__(self, width: int, grades: int):
        self.weights = np.zeros(width)
        # the first threshold, then logarithms of the steps to the next ones, which keeps them in order
        self.steps = np.concatenate([[1.0], np.zeros(grades - 2)])

    def thresholds(self) -> np.ndarray:
        return self.steps[0] + np.concatenate([[0.0], np.cumsum(np.exp(self.steps[1:]))])

    def above(self, x: Sparse) -> np.ndarray:
        """P(grade > j) for each row and threshold."""
        return sigmoid(x.sums(self.weights[x.columns] * x.values)[:, None] - self.thresholds()[None, :])

    def fit(self, x: Sparse, y: np.ndarray, epochs: int, batch: int, rate: float, lasso: float, seed: int) -> Ordinal:
        """Maximum likelihood with a penalty on the size of the weights: words that don't tell keep none at all."""
        rng = np.random.default_rng(seed)
        past, past_t = np.full(len(self.weights), 1e-4), np.full(len(self.steps), 1e-2)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(order), batch):
                rows, grade = x.take(order[a : a + batch]), y[order[a : a + batch]]
                margin = x_dot = rows.sums(self.weights[rows.columns] * rows.values)
                t = self.thresholds()
                ends = np.concatenate([[-np.inf], t, [np.inf]])
                hi, lo = sigmoid(ends[grade + 1] - x_dot), sigmoid(ends[grade] - x_dot)
                hi, lo = np.where(grade == len(t), 1.0, hi), np.where(grade == 0, 0.0, lo)
                share = np.maximum(hi - lo, 1e-9)
                d_hi, d_lo = hi * (1 - hi) / share, lo * (1 - lo) / share
                slope = (d_hi - d_lo) / len(margin)  # of the loss by the margin
                columns, place = np.unique(rows.columns, return_inverse=True)
                g = np.bincount(place, slope[rows.rows()] * rows.values, len(columns))
                past[columns] += g**2
                step = rate / np.sqrt(past[columns])
                moved = self.weights[columns] - step * g
                self.weights[columns] = np.sign(moved) * np.maximum(np.abs(moved) - step * lasso, 0)
                by_t = np.bincount(grade[grade < len(t)], -d_hi[grade < len(t)], len(t)) + np.bincount(grade[grade > 0] - 1, d_lo[grade > 0], len(t))
                by_t /= len(margin)
                tail = np.cumsum(by_t[::-1])[::-1]  # a step moves all thresholds after it
                g = np.concatenate([[tail[0]], tail[1:] * np.exp(self.steps[1:])])
                past_t += g**2
                self.steps -= 0.5 * rate * g / np.sqrt(past_t)
        return self


def grade_rows(x: Sparse, toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to 3 for labelled rows: 0 for rows that are not toxic, and thirds of the toxic rows by how much they hold of it.

    The labels say only whether. How much is the summed log ratio of word frequencies among toxic and other rows, over the words
    that are at least 8 times as frequent among toxic rows.
    """
    owner = x.rows()
    n1, n0 = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    in1 = np.bincount(x.columns[toxic[owner]], minlength=WIDTH)
    in0 = np.bincount(x.columns[~toxic[owner]], minlength=WIDTH)
    ratio = np.log((in1 + 0.5) / (n1 + 1)) - np.log((in0 + 0.5) / (n0 + 1))
    strong = np.where((in1 >= 3) & (ratio > np.log(8)), ratio, 0.0)
    amount = x.sums(strong[x.columns] * x.values)
    grade = np.zeros(len(x), np.int64)
    cuts = np.quantile(amount[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    grade[toxic] = 1 + (amount[toxic] > cuts[0]) + (amount[toxic] > cuts[1])
    return grade


def learn(x: Sparse, labels: np.ndarray, updates: int = 750, batch: int = 128, seed: int = 9) -> Ordinal:
    """About as many updates however many rows there are."""
    epochs = max(12, -(-updates * batch // max(len(x), 1)))
    return Ordinal(WIDTH, len(GRADES)).fit(x, grade_rows(x, labels[:, 0] == 1), epochs, batch, 0.2, 5e-4, seed)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", bound: int = 8000, seed: int = 9
) -> DataFrame:
    """(id, severity, grade, toxic): expected severity from 0 to 3, the likeliest side of each threshold, and whether any is passed.

    The regression is fitted on at most `bound` labelled rows. Null text counts as empty and is scored. Without labels severity
    is 0. Ids may be null or repeat: each row is scored. Empty table: empty result. Extra columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    model = fit_once(docs, labels, id_col, text_col, [label_col], bound, seed, inputs, learn)
    if model is not None:
        keep = np.flatnonzero(model.weights)  # the penalty has left few
        model = (keep, model.weights[keep], model.steps)
    shared = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        scorer = None
        if shared.value is not None:
            scorer = Ordinal(WIDTH, len(GRADES))
            scorer.weights[shared.value[0]], scorer.steps = shared.value[1], shared.value[2]
        for batch in by_bytes(batches, 1):
            n = batch.num_rows
            above = scorer.above(inputs(batch.column(1))) if scorer and n else np.zeros((n, len(GRADES) - 1))
            grade = (above >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1), pa.float64()), pa.array(grade.astype(np.int32)), pa.array(grade > 0)], ["id", "severity", "grade", "toxic"]
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, severity double, grade int, toxic boolean")


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """The severity of all documents."""
    read = tuned(spark).read
    out = score_toxicity(read.parquet(f"{sf_dir}/documents.parquet"), read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("id").alias("doc_id"), "severity", "grade", "toxic")
