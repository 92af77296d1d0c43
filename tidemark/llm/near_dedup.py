"""MinHash near-duplicates: fast similarity sketching, banding, exact verification, components.

Sketching (Dahlgaard, Knudsen and Thorup, 2017): in round i every shingle is hashed into one of `coordinates` bins with a value
that grows with i, and a bin keeps its least value. Rounds go on only for texts with empty bins; from round `coordinates` on, a
round aims at one bin that it must fill, so twice that many rounds always suffice. A text with many more shingles than bins is
done after a round or two, instead of one pass for each coordinate. Coordinates of two sets agree with the sets' Jaccard
similarity as probability, and their mean concentrates like that of independent MinHash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.runtime import by_bytes, chosen, discard, materialize, prepare, tuned
from tidemark.llm.textkit import U, constants, mix, shingles

#: Bands of rows: at similarity 0.85 a pair shares no band with probability 4e-5, at 0.9 with 1e-8.
BANDS, ROWS = 32, 8

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(values: np.ndarray, at: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of `coordinates` values for each set; rows of empty sets stay at the top value."""
    n, t = len(at) - 1, coordinates
    out = np.full(n * t, _TOP, np.uint64)
    seeds = constants(303, t)
    owner = np.repeat(np.arange(n), np.diff(at))
    for i in range(2 * t):
        if not len(values):
            break
        if i < t:
            h = mix(values ^ seeds[i])
            bins = (((h >> U(32)) * U(t)) >> U(32)).astype(np.int64)
        else:
            h = mix(values ^ ~seeds[i - t])
            bins = i - t
        np.minimum.at(out, owner * t + bins, (h & U(0xFFFFFFFF)) | U(i << 32))
        if i < 4 or i % 16 == 0 or i >= t:
            open_ = (out.reshape(n, t) == _TOP).any(axis=1)[owner]
            if not open_.all():
                values, owner = values[open_], owner[open_]
    return out.reshape(n, t)


def band_keys(rows: np.ndarray, bands: int, width: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch; the band's number is part of it."""
    cut = rows.reshape(len(rows), bands, width)
    keys = np.zeros((len(rows), bands), np.uint64)
    for j, c in enumerate(constants(404, width)):
        keys += mix(cut[:, :, j]) * c
    return mix(keys ^ constants(505, bands)[None, :])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, f1, f2, bands): set size, a 128-bit fingerprint of the set, band keys (null for an empty set)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in by_bytes(batches, 1):
            values, at = shingles(batch.column(1), k)
            n = np.diff(at)
            # sums over each set, which are the same whatever the order
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ c))]) for c in constants(606, 2)]
            f1, f2 = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
            keys = band_keys(sketch(values, at, bands * rows), bands, rows).view(np.int64)
            some = n > 0
            offsets = pa.array(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys[some].ravel()), mask=pa.array(~some))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(f1), pa.array(f2), lists], ["id", "n_shingles", "f1", "f2", "bands"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, n_shingles long, f1 long, f2 long, bands array<long>"
    )


def verify(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], k: int, percent: int, share: int = 64) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union, written. texts_of(ids): (id, text) of those ids.

    The partners of one text are dealt out in lots of about `share`, each with its own copy of that text, so that a text with
    very many partners is spread over tasks; a task holds the set of one such text and one Arrow batch at a time.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    pairs = materialize(pairs)
    # written, so that the join stands by itself and Spark can split a text with very many partners
    fan = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / share).alias("lots")))
    dealt = materialize(pairs.join(fan, "a").select("a", F.expr("pmod(xxhash64(b, a), lots)").alias("lot"), "b"))
    discard(pairs, fan)
    ids = dealt.select(F.explode(F.array("a", "b")).alias("id"))
    roles = dealt.select(F.col("b").alias("id"), "a", "lot", F.lit(1).alias("role")).union(
        dealt.select(F.col("a").alias("id"), "a", "lot", F.lit(0).alias("role")).distinct()
    )
    # a lot's first text leads
    lots = roles.join(texts_of(ids), "id").repartition("a", "lot").sortWithinPartitions("a", "lot", "role", "id")

    def run(batches):
        lead, of = [], None
        for batch in by_bytes(batches, 4):
            values, at = shingles(batch.column(4), k)
            a, lot, role, ids = (batch.column(i).to_pylist() for i in range(4))
            good_a, good_b = [], []
            for i in range(len(ids)):
                if (a[i], lot[i]) != of:
                    lead, of = [], (a[i], lot[i])
                own = values[at[i] : at[i + 1]]
                if role[i] == 0:
                    lead.append(own.copy())
                    continue
                if any(similar(own, other, percent) for other in lead):
                    good_a.append(a[i])
                    good_b.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(good_a, batch.column(0).type), pa.array(good_b, batch.column(3).type)], ["a", "b"])

    out = materialize(lots.select("a", "lot", "role", "id", "text").mapInArrow(run, f"a {kind}, b {kind}"))
    discard(dealt)
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted, have 100 * intersection >= percent * union. Empty sets are like nothing."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


#: Texts of one bucket that a task compares at a time are at most about twice so many.
BLOCK = 1000


class Sets:
    """Joining sets into groups: find and merge."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def merge(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def link_within(sets: list[np.ndarray], groups: list, percent: int) -> list[tuple[int, int]]:
    """Links that join the given groups as far as similar sets do: every pair that is not in one group by then has been compared."""
    if len(sets) < 2:
        return []
    first: dict = {}
    joined = Sets(len(sets))
    for i, g in enumerate(groups):
        joined.merge(first.setdefault(g, i), i)
    n = np.array([len(s) for s in sets])
    at = np.concatenate([[0], np.cumsum(n)])
    kinds, of = np.unique(np.concatenate(sets), return_inverse=True)
    mark, links = np.zeros(len(kinds), np.int64), []
    for i in range(len(sets) - 1):
        later = np.array([joined.find(j) for j in range(i + 1, len(sets))]) != joined.find(i)
        if not later.any():
            continue
        own = of[at[i] : at[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[of[at[i + 1] :]], at[i + 1 : -1] - at[i + 1])
        mark[own] = 0
        for j in np.flatnonzero(later & (100 * both >= percent * (n[i] + n[i + 1 :] - both))) + i + 1:
            if joined.merge(i, int(j)):
                links.append((i, int(j)))
    return links


def settle(left: DataFrame, texts_of: Callable[[DataFrame], DataFrame], k: int, percent: int) -> DataFrame:
    """Links (a, b) between components of left (bucket, rep, component), written: all pairs of a bucket are compared on their full sets.

    The comparison happens inside tasks and gives one link at most for two components that meet. A bucket of more than 2 * BLOCK
    members is cut into blocks, and each two blocks are a task of their own.
    """
    kind = left.schema["rep"].dataType.simpleString()
    blocks = left.groupBy("bucket").agg(F.when(F.count("*") > 2 * BLOCK, F.ceil(F.count("*") / BLOCK)).otherwise(1).alias("m"))
    lots = f"""if(m = 1, array(0L), transform(filter(sequence(0L, m - 1), x -> x <> pmod(xxhash64(rep), m)),
               x -> least(x, pmod(xxhash64(rep), m)) * m + greatest(x, pmod(xxhash64(rep), m))))"""
    dealt = left.join(blocks, "bucket").select("bucket", F.explode(F.expr(lots)).alias("lot"), "rep", "component")
    ids = left.select(F.col("rep").alias("id"))
    rows = dealt.join(texts_of(ids), F.col("rep") == F.col("id")).repartition("bucket", "lot").sortWithinPartitions("bucket", "lot", "rep")

    def run(batches):
        of, sets, groups, reps, schema = None, [], [], [], None
        for batch in by_bytes(batches, 4):
            schema = batch.schema
            values, at = shingles(batch.column(4), k)
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            rep, component = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            a, b = [], []
            for i, key in enumerate(keys):
                if key != of:
                    found = link_within(sets, groups, percent)
                    a += [reps[x] for x, _ in found]
                    b += [reps[y] for _, y in found]
                    of, sets, groups, reps = key, [], [], []
                if at[i + 1] > at[i]:
                    sets.append(values[at[i] : at[i + 1]].copy())
                    groups.append(component[i])
                    reps.append(rep[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, schema.field(2).type), pa.array(b, schema.field(2).type)], ["a", "b"])
        if sets:
            found = link_within(sets, groups, percent)
            yield pa.RecordBatch.from_arrays([pa.array([reps[x] for x, _ in found], schema.field(2).type), pa.array([reps[y] for _, y in found], schema.field(2).type)], ["a", "b"])

    return materialize(rows.select("bucket", "lot", "rep", "component", "text").mapInArrow(run, f"a {kind}, b {kind}"))


#: Further leaders that large buckets are compared with before they are settled pair by pair.
LEADERS = 3


def link_classes(
    classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], k: int, percent: int,
    possible: Callable[[DataFrame], DataFrame] | None = None, finer: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links, components), written, among classes (rep, bands), whose texts are texts_of(ids).

    Candidates share a band. First the least member of each bucket, which buckets of one group have in common, is compared with
    all others of its bucket; that joins most of what belongs together at one comparison a member. In large buckets that then still
    hold two components, up to LEADERS further members, picked by a hash, are compared with the members of other components. At last
    the buckets that hold two components are settled pair by pair. So each candidate pair is compared or in one component; none is dropped.

    possible(pairs): the pairs (a, b) without some that are known not to be similar. finer(members): the buckets of members (bucket,
    rep) split further, where that is known to keep similar ones together. classes is read up to the first comparison only.
    """
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    # counted before the shuffle as far as it goes, and buckets of one member are gone after it
    shared = materialize(members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
    both = materialize(members.join(shared, "bucket").select("bucket", "rep"))
    discard(shared)
    least = both.groupBy("bucket").agg(F.min("rep").alias("least"))
    left = materialize(both.join(least, "bucket").filter("rep <> least").select("bucket", "least", "rep"))
    discard(both)
    compared = lambda pairs: verify(possible(pairs) if possible else pairs, texts_of, k, percent)
    links = compared(left.select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct())
    # the least members have been compared with all others, so they are left out from here on
    parts, labels = [links], connected_components(links)
    rest = _mixed(left, labels)
    discard(left)
    if finer:
        coarse, rest = rest, _mixed(finer(rest.select("bucket", "rep")), labels)
        discard(coarse)
    for turn in range(LEADERS):
        large = rest.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * BLOCK).select("bucket")
        if large.isEmpty():
            break
        open_ = rest.join(large, "bucket")
        leads = open_.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("turn"), "rep", "component")).alias("lead"))
        pairs = open_.join(leads, "bucket").filter("component <> lead.component").select(F.col("lead.rep").alias("a"), F.col("rep").alias("b"))
        parts.append(compared(pairs.distinct()))
        discard(labels)
        labels = connected_components(_union(parts))
        old, rest = rest, _mixed(rest, labels)
        discard(old)
    if not rest.isEmpty():
        parts.append(settle(rest, texts_of, k, percent))
        if not parts[-1].isEmpty():
            discard(labels)
            labels = connected_components(_union(parts))
    discard(rest)
    return _union(parts), labels


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _mixed(left: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, rep, component), written: the buckets of left that hold two components."""
    rest = materialize(left.select("bucket", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component")))
    mixed = rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    out = materialize(rest.join(mixed.select("bucket"), "bucket").select("bucket", "rep", "component"))
    discard(rest)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(id, n_shingles, component): each row's set size and the smallest id that links lead to.

    Words are lower-cased (A-Z); two texts are linked if 100 * intersection >= percent * union of their k-word shingle sets.
    Texts with equal sets are one class from the start and are never paired; see link_classes for the others.

    Null, empty or blank text: size 0, linked with nothing. Null id: its row is kept, size given, component null. Rows that
    repeat an id are one node, linked by any of their texts. An empty table gives an empty result; extra columns are ignored.
    """
    prepare(docs.sparkSession)
    made = materialize(sketches(docs, id_col, text_col, k, bands, rows))
    sets = made.filter("n_shingles > 0 and id is not null")
    key = ["n_shingles", "f1", "f2"]
    # copies are combined before they are shuffled
    kinds = materialize(sets.groupBy(*key).agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands")))
    classes = kinds.drop("bands")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    links, labels = link_classes(kinds, lambda ids: chosen(texts, ids), k, percent)
    if _repeats(sets):
        # an id that stands for one class is a member of another too
        twins = sets.join(classes, key).select(F.col("rep").alias("a"), F.col("id").alias("b"))
        labels = connected_components(twins.union(links))
    tagged = made.join(classes, key, "left")
    tagged = tagged.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")))
    return tagged.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def _repeats(sets: DataFrame) -> bool:
    """Whether any id stands with two different sets."""
    return not sets.groupBy("id").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi")).filter("lo <> hi").isEmpty()


def op4_minhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: 3-word shingles, similarity of 0.85 or more."""
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs, k=3, percent=85)
    return out.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
