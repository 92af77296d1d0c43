"""Exact top-k by inner product with no-random-access aggregation over sorted lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import materialize, prepare, tuned

#: Vectors in a shard, queries that read its lists together, and queries that one task gets.
SHARD, BLOCK, LOT = 4096, 128, 65536

#: How much of each list has been read when bounds are compared.
DEPTHS = (1 / 64, 1 / 16, 1 / 4, 1 / 2, 3 / 4, 1)


class Lists:
    """For each component a list of the rows of vectors, sorted by it, and its entries in that order."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.entries = np.take_along_axis(vectors, self.order.T, axis=0).T.astype(np.float64)


def aggregate(queries: np.ndarray, lists: Lists, k: int) -> tuple[list[np.ndarray], int]:
    """For each query the rows that may be among its k best, and how many entries were read; every row left out scores below the k-th best.

    A query reads each list in order, from the end that adds most to its score, all lists to the same depth, and adds what it reads
    to the partial sums of the rows that show. At some depths the bounds are compared: a row's lower bound takes the worst entry of
    each list in which it has not shown, its upper bound the last entry read. Rows whose upper bound is below the k-th lower bound are
    outsiders, whose entries are passed over from then on; a query stops when few rows are left. Ties stay in.

    The queries of a block read together. Partial sums are whole numbers that the floats in use hold exactly; where components are too
    large for that, all rows are left in. Scores that don't fit 64 bits are an error.
    """
    vectors, n, k = lists.vectors, len(lists.vectors), min(k, len(lists.vectors))
    far = lambda x: max(int(x.max()), -int(x.min())) if x.size else 0
    largest = far(queries) * far(vectors) * vectors.shape[1]
    if largest >= 1 << 63:
        raise OverflowError("scores do not fit 64 bits")
    if largest >= 1 << 53:
        return [np.arange(n)] * len(queries), 0
    kind = np.float32 if largest < 1 << 24 else np.float64
    out: list[np.ndarray] = [np.arange(0)] * len(queries)
    waiting, rows, read, before = np.arange(len(queries)), np.arange(n), 0, 0
    up, down, entries = queries.clip(min=0).T.astype(kind), queries.clip(max=0).T.astype(kind), lists.entries.astype(kind)
    sums = np.zeros((n, len(queries)), kind)
    high, low = np.ones((n, len(up)), bool), np.ones((n, len(up)), bool)  # not shown yet, from either end
    place = np.arange(n)
    for depth in DEPTHS:
        now = max(before + 1, int(n * depth)) if before < n else n
        for j in range(len(up)):
            for weights, hidden, there in ((up[j], high, slice(n - now, n - before)), (down[j], low, slice(before, now))):
                asking = np.count_nonzero(weights)
                if asking:
                    at = place[lists.order[j, there]]
                    kept = at >= 0
                    at = at[kept]
                    sums[at] += entries[j, there][kept, None] * weights
                    hidden[at, j] = False
                    read += asking * (now - before)
        if now == n:
            lower = upper = sums
        else:
            ends = lambda top, bottom: high.astype(kind) @ (entries[:, top, None] * up) + low.astype(kind) @ (entries[:, bottom, None] * down)
            lower, upper = sums + ends(0, n - 1), sums + ends(n - now, now - 1)
        inside = upper >= np.partition(lower, len(rows) - k, axis=0)[len(rows) - k]
        done = (inside.sum(axis=0) <= 4 * k + 16) | (now == n)
        for i in np.flatnonzero(done):
            out[waiting[i]] = rows[inside[:, i]]
        if done.all():
            break
        open_ = inside[:, ~done].any(axis=1)
        waiting, rows = waiting[~done], rows[open_]
        sums, up, down, high, low = sums[open_][:, ~done], up[:, ~done], down[:, ~done], high[open_], low[open_]
        place = np.full(n, -1)
        place[rows] = np.arange(len(rows))
        before = now
    return out, read


def _distinct(vectors: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct vectors, and the `most` smallest ids of each."""
    kinds, of = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, of.ravel()))
    parts = np.split(ids[order], np.searchsorted(of.ravel()[order], np.arange(1, len(kinds))))
    return kinds, [p[:most] for p in parts]


def best_of_shards(dealt: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each shard for each query of its lot.

    dealt: (shard, lot, size, role, id, v), each shard and lot in one partition, its vectors (role 0) before its queries (role 1). A
    task holds the vectors of one shard and one batch of queries at a time.
    """

    def run(batches):
        of, held, lists, ids = None, [], None, []
        for batch in batches:
            shard, lot, size, role, own = (batch.column(i).to_numpy() for i in range(5))
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in (shard, lot, size, role)], axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                vectors = batch.column(5).slice(a, b - a).flatten().to_numpy().reshape(b - a, size[a])
                if (shard[a], lot[a], size[a]) != of:
                    of, held, lists = (shard[a], lot[a], size[a]), [], None
                if role[a] == 0:
                    held.append((vectors, own[a:b]))
                    continue
                if not held:
                    continue
                if lists is None:
                    kinds, ids = _distinct(*(np.concatenate(x) for x in zip(*held)), k + 1)
                    lists, held = Lists(kinds), held[:1]
                found: list[tuple[int, int, int]] = []
                for c in range(0, b - a, BLOCK):
                    asked = vectors[c : c + BLOCK]
                    # one more than k, as the query's own row may be among them
                    for q, query, left in zip(own[a + c : b].tolist(), asked, aggregate(asked, lists, k + 1)[0]):
                        final = lists.vectors[left] @ query  # the final scores of those that are left
                        best = [(-int(s), int(i)) for s, x in zip(final, left) for i in ids[x] if i != q]
                        found += [(q, i, -s) for s, i in sorted(best)[:k]]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    return dealt.select("shard", "lot", "size", "role", "id", "v").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k best of all other rows; ties go to the smaller id.

    Components become floor(scale * x), as integers. Vectors are dealt into shards one by one, and stay there; queries are sent to every
    shard, in lots, and a shard is copied once for each lot of 65536 queries. A shard's best k are merged by query. A shard keeps equal
    vectors once, with as many ids as could be wanted. Only vectors of one length are compared.

    Vectors that are null, or hold null or non-finite components, take no part, nor do rows without an id. An id may repeat: its
    rows are candidates one by one, and none of them for a query of that id. Empty vectors have no score and are left out.
    Components or scores that don't fit 64 bits are an error. Empty table: empty result. Extra columns are ignored.
    """
    prepare(vectors.sparkSession)

    def whole(df: DataFrame) -> DataFrame:
        x = lambda c: c.cast("double")
        sound = F.coalesce(F.forall(vector_col, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf"))), F.lit(False))
        df = df.filter(F.col(id_col).isNotNull() & sound & (F.size(vector_col) > 0))
        wide = F.exists(vector_col, lambda c: F.abs(F.lit(scale) * x(c)) >= 2.0**63)
        v = F.when(wide, F.raise_error(F.lit("components do not fit 64 bits"))).otherwise(F.transform(vector_col, lambda c: F.floor(F.lit(scale) * x(c)).cast("long")))
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).withColumn("size", F.size("v"))

    rows, asked = materialize(whole(vectors)), materialize(whole(queries))
    shards, lots = max(1, -(-rows.count() // SHARD)), max(1, -(-asked.count() // LOT))
    number = F.monotonically_increasing_id()
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    kept = rows.select("id", "v", "size", F.pmod(number, F.lit(shards)).alias("shard"), copies(lots).alias("lot"), F.lit(0).alias("role"))
    sent = asked.select("id", "v", "size", copies(shards).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(lots)).alias("lot"), F.lit(1).alias("role"))
    keys = ["shard", "lot", "size"]
    dealt = kept.unionByName(sent).repartition(*keys).sortWithinPartitions(*keys, "role")
    found = best_of_shards(dealt, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_top_k(spark, sf_dir: str) -> DataFrame:
    """The 5 best partners of every vector whose id is divisible by 50."""
    vectors = tuned(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 50 = 0),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM c)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 5
"""
