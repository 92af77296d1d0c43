"""Quality rules: statistics of whole texts, two hard limits, and an isolation forest over the statistics.

The forest is grown on the statistics of a bounded sample of labelled rows; the cut on its score is calibrated on all labelled
rows, through a histogram of scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import bounded_sample, by_bytes, chosen, few, materialize, prepare, tuned
from tidemark.llm.textkit import SPACE, U, Words, hash_spans, mix, per_text

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True

#: Base statistics, then those that only the forest uses.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_distinct"]

WINDOW = 5


def _seen_before(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value whether its text has it earlier, and whether its text has it twice or more."""
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    key = mix(hashes ^ (owner * U(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    earlier, many = np.zeros(len(key), bool), np.zeros(len(key), bool)
    twice = same.copy()
    twice[:-1] |= same[1:]
    earlier[order], many[order] = same, twice
    return earlier, many


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS for each text."""
    words = Words(column)
    data, at = words.raw, words.text_at
    solid = ~SPACE[data]
    first = (data & 0xC0) != 0x80  # the first byte of a code point
    out = {"n_words": words.n, "word_chars": per_text(solid & first, at), "n_symbols": per_text(SYMBOL[data], at)}

    line_starts, line_ends = _lines(data, at)
    spoken = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends = line_starts[spoken], line_ends[spoken]
    line_at = np.searchsorted(line_starts, at)
    line_at[-1] = len(line_starts)
    earlier, _ = _seen_before(hash_spans(data, line_starts, line_ends), line_at)
    out |= {"n_dup_lines": per_text(earlier, line_at), "n_lines": np.diff(line_at)}

    windows, window_at = words.windows(WINDOW)
    _, many = _seen_before(windows, window_at)
    covered = np.zeros(len(words.hash) + 1, np.int64)
    begin = (np.repeat(words.at[:-1] - window_at[:-1], np.diff(window_at)) + np.arange(len(windows)))[many]
    np.add.at(covered, begin, 1)
    np.add.at(covered, begin + WINDOW, -1)
    out["n_repeat_words"] = per_text(np.cumsum(covered)[:-1] > 0, words.at)

    out["n_upper"] = per_text((data >= ord("A")) & (data <= ord("Z")), at)
    out["n_digits"] = per_text((data >= ord("0")) & (data <= ord("9")), at)
    marks = np.zeros(256, bool)
    marks[list(b"!?~^_=+/\\{}[]")] = True
    out["n_marks"] = per_text(marks[data], at)
    again, _ = _seen_before(words.hash, words.at)
    out["n_distinct"] = per_text(~again, words.at)
    return out


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines of all texts that have a byte at least, split at line feeds."""
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.union1d(at[:-1], feeds + 1)
    starts = starts[starts < len(data)] if len(data) else starts[:0]
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    # the line feed itself is no part of a line
    ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 0x0A)) if len(starts) else ends
    some = ends > starts
    return starts[some], ends[some]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, COUNTS): one row for each row of docs; null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 1):
            made = count_texts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(made[c].astype(np.int64)) for c in COUNTS)], ["id", *COUNTS])

    shape = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, {shape}")


def features(rows: pd.DataFrame) -> np.ndarray:
    """Rates that don't depend on a text's length, on scales that spread out the small ones. Digits don't tell junk from text."""
    words, chars = np.maximum(rows["n_words"].to_numpy(float), 1), np.maximum(rows["word_chars"].to_numpy(float), 1)
    lines = np.maximum(rows["n_lines"].to_numpy(float), 1)
    wide = lambda c, by: np.log1p(20 * rows[c].to_numpy(float) / by)
    root = lambda c, by: np.sqrt(rows[c].to_numpy(float) / by)
    return np.column_stack([wide("n_symbols", words), wide("n_marks", words), root("n_dup_lines", lines), root("n_repeat_words", words), root("n_upper", chars)])


class Forest:
    """Isolation trees over sound rows, as arrays. A tree splits a random feature at a random point of its node's box.

    The boxes begin as the range of all labelled rows, sound or not, so that splits also fall where no sound row lies: a row
    there is soon alone and has a short path. Sound rows stay together down to the greatest depth.
    """

    def __init__(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int, sample: int, seed: int):
        rng = np.random.default_rng(seed)
        self.size = min(sample, len(rows))
        self.depth = 2 * int(np.ceil(np.log2(max(self.size, 2))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], low, high, rng) for _ in range(trees)]

    @staticmethod
    def _rest(n: float) -> float:
        """The mean path length of an unsuccessful search among n."""
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, split, left, length = [], [], [], []
        waiting = [(rows, low, high, 0)]
        while waiting:
            rows, low, high, level = waiting.pop(0)
            open_ = np.flatnonzero(high > low)
            if len(rows) <= 1 or level >= self.depth or not len(open_):
                feature.append(-1)
                split.append(0.0)
                left.append(-1)
                length.append(level + self._rest(len(rows)))
                continue
            f = int(rng.choice(open_))
            at = rng.uniform(low[f], high[f])
            feature.append(f)
            split.append(at)
            left.append(len(feature) + len(waiting))
            length.append(0.0)
            below, mid = rows[:, f] < at, np.arange(len(low)) == f
            waiting += [(rows[below], low, np.where(mid, at, high), level + 1), (rows[~below], np.where(mid, at, low), high, level + 1)]
        return np.array(feature), np.array(split), np.array(left), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter a row's paths, the higher."""
        total = np.zeros(len(rows))
        for feature, split, left, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = left[node] + (rows[inner, feature[node]] >= split[node])
            total += length[at]
        return np.exp2(-total / len(self.trees) / max(self._rest(self.size), 1e-9))


class Judge:
    """The base rule, and a forest with the highest score that it lets pass."""

    def __init__(self, forest: Forest | None, cut: int):
        self.forest, self.cut = forest, cut

    def __call__(self, counts: pd.DataFrame) -> pd.DataFrame:
        """base_failed, score and kept for rows of COUNTS."""
        failed = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])
        score = self.forest.score(features(counts)) if self.forest and len(counts) else np.zeros(len(counts))
        return pd.DataFrame({"base_failed": failed, "score": score, "kept": ~failed & (np.ceil(score * STEPS) <= self.cut)})


#: Scores are counted in so many steps when the cut is calibrated.
STEPS = 10_000


def calibrate(
    counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
    trees: int = 100, sample: int = 256, bound: int = 10_000, care: float = 20.0, seed: int = 5,
) -> Judge:
    """A judge for rows of statistics().

    The forest is grown on at most `bound` labelled rows (those whose ids hash lowest) and learns where those of label 1 lie. The
    cut is the one with the least loss over all labelled rows that pass the base rule: the share of junk that it lets pass, and
    `care` times the share of sound rows that it rejects. Without rows of label 1 the base rule alone decides.
    """
    told = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.min(label_col) == 1).alias("good"))
    told = materialize(counts.join(told, "id").filter((F.col("n_words") >= 10) & (100 * F.col("n_repeat_words") <= 20 * F.col("n_words"))))
    taught = bounded_sample(told, bound, seed).toPandas().sort_values(["turn", "id"])
    if not taught["good"].any():
        return Judge(None, STEPS)
    seen = features(taught)
    judge = Judge(Forest(seen[taught["good"].to_numpy(bool)], seen.min(axis=0), seen.max(axis=0), trees, sample, seed), STEPS)
    bins = verdicts(told, judge).groupBy(F.ceil(F.col("score") * STEPS).alias("bin")).agg(F.count_if(F.col("good")).alias("good"), F.count_if(~F.col("good")).alias("bad"))
    bins = bins.orderBy("bin").toPandas()  # at most one row for each step
    lost = 1 - bins["good"].cumsum() / max(bins["good"].sum(), 1)
    passed = bins["bad"].cumsum() / max(bins["bad"].sum(), 1)
    judge.cut = int(bins["bin"][int((care * lost + passed).to_numpy().argmin())])
    return judge


def verdicts(counts: DataFrame, judge: Judge) -> DataFrame:
    """counts with base_failed, score and kept."""
    shared = counts.sparkSession.sparkContext.broadcast(judge)  # trees * sample nodes, twice, at most

    @F.pandas_udf("base_failed boolean, score double, kept boolean")
    def found(*columns: pd.Series) -> pd.DataFrame:
        return shared.value(pd.concat(columns, axis=1, keys=COUNTS))

    return counts.withColumn("_found", found(*COUNTS)).select(*counts.columns, "_found.*")


def judge_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, COUNTS, base_failed, score, kept): the verdict on each row of docs; how: see calibrate.

    Base rule: fewer than 10 words, or over 20% of the words in 5-word windows that the text holds twice.

    Null text counts as empty and fails the base rule. Rows that repeat are judged one by one; ids may be null. Labels that are
    null, or of ids not among docs, are passed over. Empty table: empty result. Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    counts = materialize(statistics(docs, id_col, text_col))
    return verdicts(counts, calibrate(counts, labels, id_col, **how))


def keep_sound(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that judge_texts keeps, with all columns.

    The judge is calibrated on labelled rows, whose texts are picked where they are read if their ids take few bytes; otherwise all texts are
    counted for it. Texts are not moved: each task counts its own then. Null and empty texts fail. Rows that repeat are judged one by one.
    Empty table: empty result. Extra columns stay.
    """
    prepare(docs.sparkSession)
    told = labels.select(F.col(id_col).alias("id"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    judge = calibrate(materialize(statistics(chosen(texts, told) if few(told) else texts, "id", "text")), labels, id_col, **how)
    shared, at = docs.sparkSession.sparkContext.broadcast(judge), docs.columns.index(text_col)

    def run(batches):
        for batch in by_bytes(batches, at):
            counts = pd.DataFrame(count_texts(batch.column(at)), columns=COUNTS)
            yield batch.filter(pa.array(shared.value(counts)["kept"].to_numpy(bool)))

    return docs.mapInArrow(run, docs.schema)


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The verdict on all documents."""
    read = tuned(spark).read
    out = judge_texts(read.parquet(f"{sf_dir}/documents.parquet"), read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
