"""Runs of words that stand verbatim in other documents too, wherever lines begin and end: windows by their minimizers, exact.

A window is `least` words in a row. Its minimizer is the least hash among its k-word grams, so equal windows have equal minimizers.
Neighbouring windows of one minimizer form a stretch, and only stretches are shuffled, about one for every 20 words. Minimizers of one
document need no look; where all stretches of a minimizer are equal, so are their windows; where they differ (at the ends of
copied passages and around edits), one stretch of each kind is taken apart and its windows are counted one by one. Nothing is capped or
sampled: every window that two documents hold is found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import by_bytes, discard, materialize, prepare, tuned
from tidemark.llm.textkit import BASE, UNBASE, U, Words, mix, powers


class Runs:
    """Hashes of any run of words of a batch, from sums over all of them."""

    def __init__(self, column: pa.Array):
        self.words = Words(column, lower=True)
        n = len(self.words.hash)
        self.down = powers(UNBASE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words.hash * powers(BASE, n), out=self.sums[1:])

    def hash(self, begin: np.ndarray, n) -> np.ndarray:
        return mix((self.sums[begin + n] - self.sums[begin]) * self.down[begin] + np.asarray(n).astype(np.uint64) * U(0x9E3779B97F4A7C15))


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n values in a row."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == n else np.minimum(x[: len(x) - (n - size)], x[n - size :])


def stretches(docs: DataFrame, least: int, k: int) -> DataFrame:
    """(doc_id, t, at, n, f, c): the n windows from word `at` on have the minimizer f; c is a hash of all their words.

    docs: (doc_id, t, text). Hashes have 64 bits: among n different ones n * n / 2**65 equal pairs are to be expected.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 2):
            runs = Runs(batch.column(2))
            words = runs.words
            counts = np.maximum(words.n - least + 1, 0)
            first = np.concatenate([[0], np.cumsum(counts)])
            if not first[-1]:
                continue
            window = np.repeat(words.at[:-1] - first[:-1], counts) + np.arange(first[-1])
            doc = np.repeat(np.arange(len(counts)), counts)
            grams = runs.hash(np.arange(len(words.hash) - k + 1), k)
            f = sliding_min(grams, least - k + 1)[window]
            new = np.ones(len(f), bool)
            new[1:] = (f[1:] != f[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            n = np.diff(np.append(begin, len(f)))
            owner, at = doc[begin], window[begin]
            c = runs.hash(at, n + least - 1)
            of = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of), batch.column(1).take(of), pa.array((at - words.at[owner]).astype(np.int32)), pa.array(n.astype(np.int32)),
                    pa.array(f[begin].view(np.int64)), pa.array(c.view(np.int64)),
                ],
                ["doc_id", "t", "at", "n", "f", "c"],
            )

    return docs.select("doc_id", "t", "text").mapInArrow(run, f"doc_id {kind}, t long, at int, n int, f long, c long")


def taken_apart(asked: DataFrame, least: int) -> DataFrame:
    """(c, j, h): the hash of each window of the wanted stretches. asked: (text, wanted: array of (at, n, c))."""

    def run(batches):
        for batch in by_bytes(batches, 0):
            runs, wanted = Runs(batch.column(0)), batch.column(1)
            owner = pc.list_parent_indices(wanted).to_numpy()
            at, n, c = (x.to_numpy(zero_copy_only=False) for x in wanted.flatten().flatten())
            ends = np.cumsum(n.astype(np.int64))
            j = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
            h = runs.hash(np.repeat(runs.words.at[owner] + at, n) + j, least)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.repeat(c, n), j.astype(np.int32), h.view(np.int64))], ["c", "j", "h"])

    return asked.mapInArrow(run, "c long, j int, h long")


def assembled(found: DataFrame, least: int) -> DataFrame:
    """Windows joined to runs, with their place in the text. found: (doc_id, text, parts: array of (a, b, home, removed))."""
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 1):
            words, parts = Words(batch.column(1), lower=True), batch.column(2)
            owner = pc.list_parent_indices(parts).to_numpy()
            if not len(owner):
                continue
            a, b, home, removed = parts.flatten().flatten()
            a, b, gone = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b, removed))
            order = np.lexsort((a, gone, owner))
            a, b, gone, owner = a[order], b[order] + least - 1, gone[order], owner[order]
            rank = pc.rank(home, tiebreaker="dense").to_numpy().astype(np.int64)
            of_rank = np.zeros(rank.max() + 1, np.int64)
            of_rank[rank] = np.arange(len(rank))
            new = np.ones(len(a), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (gone[1:] != gone[:-1]) | (a[1:] > b[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(a)) - 1
            doc, begin, end = owner[first], a[first], b[last]
            points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
            origin = points[words.text_at[doc]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)), pa.array(points[words.starts[words.at[doc] + begin]] - origin), pa.array(points[words.ends[words.at[doc] + end - 1]] - origin),
                    pa.array((end - begin).astype(np.int32)), home.take(pa.array(of_rank[np.minimum.reduceat(rank[order], first)])), pa.array(gone[first] == 1),
                ],
                ["doc_id", "start", "end", "n_words", "first_doc", "removed"],
            )

    return found.mapInArrow(run, f"doc_id {kind}, start long, end long, n_words int, first_doc {kind}, removed boolean")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 51, k: int = 12) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc, removed): the runs of `least` words or more that other documents have too.

    Words are lower-cased (A-Z); only their order counts, not what white space is between them. start and end are code points.
    A window of `least` words belongs to the least doc_id that holds it, and is repeated if another document holds it too. A
    document's removed runs are the longest stretches of words under windows that an earlier document holds; its other runs are
    those under windows that are its own and that later ones repeat. Both kinds may overlap: words in both go, for the earlier
    document keeps them. first_doc: the least document that any window of the run belongs to.

    Repeats within one document are left alone. Texts of fewer words, null texts and null ids: no runs. Rows that repeat a doc_id
    count as one document. Empty table: empty result. Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("t", F.xxhash64("text"))
    docs = docs.filter(f"doc_id is not null and length(text) >= {2 * least - 1}")
    found = materialize(stretches(docs, least, k))
    kinds = found.groupBy("f").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), (F.min("c") != F.max("c")).alias("mixed")).filter("lo < hi")
    shared = materialize(found.join(kinds.drop("hi"), "f").drop("f"))
    discard(found)
    owned = _owned(docs, shared.filter("mixed").drop("lo", "mixed"), least)
    part = lambda a, b, home: F.struct(a.alias("a"), b.alias("b"), home.alias("home"), (home < F.col("doc_id")).alias("removed"))
    at = F.col("at")
    plain = shared.filter("not mixed").select("doc_id", "t", F.array(part(at, at + F.col("n"), F.col("lo"))).alias("parts"))
    parts = F.transform("owned", lambda x: part(at + x["from"], at + x["to"], x["home"]))
    pieces = plain.union(shared.filter("mixed").join(owned, "c").select("doc_id", "t", parts.alias("parts")))
    listed = materialize(pieces.groupBy("doc_id", "t").agg(F.flatten(F.collect_set("parts")).alias("parts")))
    discard(shared, owned)
    return assembled(docs.join(listed, ["doc_id", "t"]).select("doc_id", "text", "parts"), least)


def _owned(docs: DataFrame, mixed: DataFrame, least: int) -> DataFrame:
    """(c, owned): the repeated windows of each kind of stretch, as parts (from, to, home) of windows in a row with one home."""
    classes = mixed.groupBy("c").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min(F.struct("doc_id", "t", "at", "n")).alias("place"))
    classes = materialize(classes)
    asked = classes.groupBy("place.doc_id", "place.t").agg(F.collect_list(F.struct("place.at", "place.n", "c")).alias("wanted"))
    windows = materialize(taken_apart(docs.join(asked, ["doc_id", "t"]).select("text", "wanted"), least))
    homes = windows.join(classes.select("c", "lo", "hi"), "c").groupBy("h").agg(F.min("lo").alias("home"), F.max("hi").alias("last"))
    homes = materialize(homes.filter("home < last").drop("last"))
    rows = windows.join(homes, "h").select("c", "j", "home").distinct()
    rows = rows.withColumn("row", F.expr("j - row_number() over (partition by c, home order by j)"))
    rows = rows.groupBy("c", "home", "row").agg(F.min("j").alias("from"), (F.max("j") + 1).alias("to"))
    out = materialize(rows.groupBy("c").agg(F.collect_list(F.struct("from", "to", "home")).alias("owned")))
    discard(classes, windows, homes)
    return out


def op10_repeated_runs(spark, sf_dir: str) -> DataFrame:
    """The runs of over 50 words that stand verbatim in more than one document."""
    return repeated_runs(tuned(spark).read.parquet(f"{sf_dir}/documents.parquet"))
