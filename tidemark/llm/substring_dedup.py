"""Passages that repeat across documents: paragraph MinHash with banding, exact Jaccard, and removal by components.

Paragraphs are chosen by what they hold, not by line breaks, so that a passage has the same ones wherever it stands. Each place in a
text has a number that depends on the lengths of the eight words from there on alone. A place with the least number among some
`reach` places in a row is an anchor, and the `size` words from an anchor on are a paragraph. Any `reach` + `size` - 1 words in a
row hold a whole paragraph, so two texts with so many words in common have a paragraph in common: 51 words at the defaults.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.near_dedup import band_keys, link_classes, sketch
from tidemark.llm.repeated_runs import sliding_min
from tidemark.llm.runtime import by_bytes, chosen, discard, materialize, prepare, tuned
from tidemark.llm.textkit import U, Words, constants, mix

#: Words of a paragraph, and places in a row of which one is an anchor.
SIZE, REACH = 21, 31

#: A place's number: the lengths of so many words, cut to LONGEST, are the digits of a number to the base LONGEST + 1, which SCATTER scrambles.
LENGTHS, LONGEST, SCATTER = 8, 36, 0x9E3779B97F4A7C15


def least_similarity(n: int, percent: int) -> float:
    """The least similarity of percent or more that two sets of n values can have."""
    both = -(-2 * n * percent // (100 + percent))
    return both / (2 * n - both)


def tune_bands(similarity: float, recall: float, rows: int) -> int:
    """The fewest bands of `rows` coordinates in which a pair of that similarity meets at least once with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


class Paragraphs:
    """The paragraphs of a batch: owner (row of the batch), first and last anchor (word of the batch), and their shingles.

    Neighbours in a text whose shingle sets are equal, as where one word repeats, are one paragraph that reaches from the first to the last.
    class: a 64-bit fingerprint of the shingle set. Among n different paragraphs n * n / 2**65 pairs of equal ones are to be expected.
    """

    def __init__(self, column: pa.Array, k: int, size: int, reach: int):
        words = self.words = Words(column, lower=True)
        self.points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
        self.size = size
        owner, place = self._anchors(reach)
        # one row of shingles for each anchor
        n = len(words.hash) - k + 1
        grams = np.zeros(max(n, 0), np.uint64)
        for j, c in enumerate(constants(101 + k, k)):
            grams += words.hash[j : j + len(grams)] * c
        grams = mix(grams)
        sets = np.sort(grams[place[:, None] + np.arange(size - k + 1)], axis=1)
        fresh = np.ones(sets.shape, bool)
        fresh[:, 1:] = sets[:, 1:] != sets[:, :-1]
        kinds = (mix(sets ^ constants(606, 1)[0]) * fresh).sum(axis=1, dtype=np.uint64)
        new = np.ones(len(place), bool)
        new[1:] = (kinds[1:] != kinds[:-1]) | (owner[1:] != owner[:-1])
        self.owner, self.first, self.kind = owner[new], place[new], kinds[new]
        self.last = place[np.append(np.flatnonzero(new)[1:], len(place)) - 1] if len(place) else place
        self.sets, self.fresh = sets[new], fresh[new]

    def _anchors(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        words = self.words
        lengths = np.minimum(self.points[words.ends] - self.points[words.starts], LONGEST).astype(np.uint64)
        n = max(len(lengths) - LENGTHS + 1, 0)
        number = np.zeros(n, np.uint64)
        for j in range(LENGTHS):
            number += lengths[j : j + n] * U((LONGEST + 1) ** j)
        doc = np.repeat(np.arange(len(words.n)), words.n)[:n]
        local = (np.arange(n) - words.at[doc]).astype(np.uint64)
        # the number first; of equal ones the last place is the least
        key = (((number * U(SCATTER)) >> U(32)) << U(32)) | (U(0xFFFFFFFF) - local)
        places = np.maximum(words.n - self.size + 1, 0)
        wide = np.flatnonzero(places >= reach)
        counts = places[wide] - reach + 1
        index = np.repeat(words.at[wide] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(wide) else np.zeros(0, np.int64)
        least = sliding_min(key, reach)[index] if len(index) else np.zeros(0, np.uint64)
        owner = np.repeat(wide, counts)
        # texts with fewer places: one anchor
        few = np.flatnonzero((places > 0) & (places < reach))
        least = np.concatenate([least, np.array([key[a : a + m].min() for a, m in zip(words.at[few], places[few])], np.uint64)])
        owner = np.concatenate([owner, few])
        place = words.at[owner] + (U(0xFFFFFFFF) - (least & U(0xFFFFFFFF))).astype(np.int64)
        return (x[np.unique(place, return_index=True)[1]] for x in (owner, place))

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each paragraph in code points of its text."""
        origin = self.points[self.words.text_at[self.owner]]
        return self.points[self.words.starts[self.first]] - origin, self.points[self.words.ends[self.last + self.size - 1]] - origin


def kinds_of(docs: DataFrame, k: int, size: int, reach: int, bands: int, rows: int) -> DataFrame:
    """(class, lo, hi, mark, b0, b1, ...): the different paragraphs, with the least and greatest doc_id that hold each, and its band keys.

    mark: 64 bits, of which each shingle sets one. Two marks differ in no more bits than the sets have values that the other lacks.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f"b{i}" for i in range(bands)]

    def run(batches):
        for batch in by_bytes(batches, 1):
            found = Paragraphs(batch.column(1), k, size, reach)
            _, pick = np.unique(found.kind + found.owner.astype(np.uint64) * U(SCATTER), return_index=True)  # once a text
            fresh = found.fresh[pick]
            at = np.concatenate([[0], np.cumsum(fresh.sum(axis=1))])
            keys = band_keys(sketch(found.sets[pick][fresh], at, bands * rows), bands, rows).view(np.int64)
            ids = batch.column(0).take(pa.array(found.owner[pick]))
            marks = np.bitwise_or.reduce(U(1) << (found.sets[pick] >> U(58)), axis=1).view(np.int64)
            columns = [pa.array(found.kind[pick].view(np.int64)), ids, ids, pa.array(marks), *(pa.array(keys[:, i]) for i in range(bands))]
            yield pa.RecordBatch.from_arrays(columns, ["class", "lo", "hi", "mark", *names])

    made = docs.select("doc_id", "text").mapInArrow(run, f"class long, lo {kind}, hi {kind}, mark long, " + ", ".join(f"{b} long" for b in names))
    return made.groupBy("class").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *[F.first(b).alias(b) for b in ["mark", *names]])


def places_of(docs: DataFrame, k: int, size: int, reach: int) -> DataFrame:
    """(doc_id, t, start, end, n_words, class): where each paragraph stands; t tells rows of one doc_id apart."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 2):
            found = Paragraphs(batch.column(2), k, size, reach)
            starts, ends = found.spans()
            of = pa.array(found.owner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of), batch.column(1).take(of), pa.array(starts), pa.array(ends), pa.array((found.last - found.first + size).astype(np.int32)),
                    pa.array(found.kind.view(np.int64)),
                ],
                ["doc_id", "t", "start", "end", "n_words", "class"],
            )

    return docs.select("doc_id", "t", "text").mapInArrow(run, f"doc_id {kind}, t long, start long, end long, n_words int, class long")


def most_apart(values: int, percent: int) -> int:
    """How many values at most two sets of up to `values` values that are similar enough do not share: so many bits their marks differ in."""
    return 2 * values * (100 - percent) // (100 + percent)


def near_marks(pairs: DataFrame, marks: DataFrame, apart: int) -> DataFrame:
    """The pairs (a, b) whose marks differ in `apart` bits at most. marks: (rep, mark)."""
    for side in "ab":
        pairs = pairs.join(marks.select(F.col("rep").alias(side), F.col("mark").alias(f"mark_{side}")), side)
    return pairs.filter(F.bit_count(F.col("mark_a").bitwiseXOR(F.col("mark_b"))) <= apart).select("a", "b")


def split_by_marks(members: DataFrame, marks: DataFrame, apart: int) -> DataFrame:
    """(bucket, rep): the buckets of members split so that two whose marks differ in `apart` bits at most stay together in one part at least.

    The bits are cut into apart + 1 parts, and two such marks agree in one of them.
    """
    width = -(-64 // (apart + 1))
    part = lambda i: F.shiftrightunsigned("mark", i * width).bitwiseAND(F.lit((1 << width) - 1 if width < 63 else -1))
    cut = F.array(*[F.xxhash64("bucket", F.lit(i), part(i)) for i in range(-(-64 // width))])
    split = materialize(members.join(marks, "rep").select("rep", F.explode(cut).alias("bucket")))
    more = split.groupBy("bucket").count().filter("count > 1").select("bucket")
    return split.join(more, "bucket").select("bucket", "rep")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, recall: float = 0.99, rows: int = 3,
    size: int = SIZE, reach: int = REACH,
) -> DataFrame:
    """(doc_id, start, end, n_words, first_doc, first_start, removed): the paragraphs that other documents have too.

    Words are lower-cased (A-Z); line breaks don't matter; start and end are code points. Paragraphs of `size` words are chosen as
    said above, one for every 16 words or so, and overlap. Two are linked if 100 * intersection >= percent * union of their k-word
    shingle sets; components of links are clusters. first_doc is the least doc_id of the cluster, first_start the place of
    its first paragraph there. That document keeps its paragraphs; those of the others are removed. Clusters within one document are
    left alone.

    Two documents with `size` + `reach` - 1 words in a row in common have a common paragraph in this result, always. Two paragraphs that
    are only similar share a band with probability `recall` at least, if all their shingles differ; bands are as many as that asks for.
    At the defaults these are sets of 17 shingles, which are similar by 0.889 or more if by 0.8. (Sets that words repeated in a
    paragraph make smaller may be similar by just 0.8; they share a band with 0.94.)

    Texts with fewer than `size` words, null and empty ones: no paragraph. Null doc_id: that row takes no part. Rows that repeat a doc_id
    count as one document. Empty table: empty result. Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    docs = docs.withColumn("t", F.xxhash64("text"))
    values = size - k + 1
    bands = tune_bands(least_similarity(values, percent), recall, rows)
    kinds = materialize(kinds_of(docs, k, size, reach, bands, rows))
    made, placed = [], []

    def places() -> DataFrame:
        if not placed:
            placed.append(materialize(places_of(docs, k, size, reach)))
        return placed[0]

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = chosen(places().select(F.col("class").alias("id"), "doc_id", "t", "start", "end"), ids)
        wanted = materialize(wanted.groupBy("id").agg(F.min(F.struct("doc_id", "t", "start", "end")).alias("at")).select("id", "at.*"))
        made.append(wanted)
        own = wanted.withColumnRenamed("id", "class").withColumnRenamed("doc_id", "id")
        there = chosen(docs.withColumnRenamed("doc_id", "id"), own.select("id")).join(own, ["id", "t"])
        return there.select(F.col("class").alias("id"), F.expr("substring(text, cast(start as int) + 1, cast(end - start as int))").alias("text"))

    own = materialize(kinds.drop(*[f"b{i}" for i in range(bands)]))
    classes = kinds.select(F.col("class").alias("rep"), F.array(*[f"b{i}" for i in range(bands)]).alias("bands"))
    marks, apart = own.select(F.col("class").alias("rep"), "mark"), most_apart(values, percent)

    def possible(pairs: DataFrame) -> DataFrame:
        near = materialize(near_marks(pairs, marks, apart))
        discard(kinds)
        made.append(near)
        return near

    _, labels = link_classes(classes, texts_of, k, percent, possible, lambda members: split_by_marks(members, marks, apart))
    discard(*made)
    tagged = own.select("class", "lo", "hi").join(labels.withColumnRenamed("node", "class"), "class", "left")
    tagged = tagged.filter("component is not null or lo < hi").withColumn("component", F.coalesce("component", "class"))
    spread = tagged.groupBy("component").agg(F.min("lo").alias("first_doc"), F.max("hi").alias("last_doc")).filter("first_doc < last_doc")
    repeated = materialize(tagged.select("class", "component").join(spread.drop("last_doc"), "component"))
    discard(own, labels)
    found = materialize(places().join(repeated, "class").select("doc_id", "start", "end", "n_words", "component", "first_doc"))
    discard(repeated, *placed)
    first = found.filter("doc_id = first_doc").groupBy("component").agg(F.min("start").alias("first_start"))
    removed = (F.col("doc_id") != F.col("first_doc")).alias("removed")
    return found.join(first, "component").select("doc_id", "start", "end", "n_words", "first_doc", "first_start", removed)


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The passages that repeat across all documents. A cluster goes by its first paragraph."""
    return repeated_passages(tuned(spark).read.parquet(f"{sf_dir}/documents.parquet"))
