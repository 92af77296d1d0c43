"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runtime import materialize, prepare, tuned

#: What one task rounds at a time, and how many residuals meet in one node of the tree.
LEAF, FAN = 1024, 64

WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, place, source_size, target, rate) for each source.

    Sources in order of code points, null last, take the weights in turn. Together they aim at share times all sizes; no target
    is above most times its source's size, and what that cuts off is shared among the others by weight. That fixpoint is
    found by order: with sources sorted by size over weight, the capped ones are a prefix. Works on one row for each source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count("*").alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*[F.lit(float(w)) for w in weights])
    by = by.withColumn("place", place).withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    by = by.withColumn("goal", share * F.sum("source_size").over(everything))
    by = by.withColumn("cap", most * F.col("source_size"))
    # if all before this one are capped, this is what a unit of weight gets
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("unit", (F.col("goal") - capped) / rest).withColumn("over", F.col("cap") <= F.col("unit") * F.col("weight"))
    by = by.withColumn("free", F.min(F.when(~F.col("over"), F.struct(F.col("source_size") / F.col("weight"), "place", "unit"))).over(everything))
    target = F.when(F.col("free").isNull() | F.col("over"), F.col("cap")).otherwise(F.col("free.unit") * F.col("weight"))
    by = by.withColumn("target", target.cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return by.select("source", "place", "rows", "source_size", "target", F.least(rate, F.lit(float(most))).alias("rate"))


def pivot(probability: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Round all probabilities but one, in order: two meet, mass moves until one is 0 or 1, and the other goes on.

    Each keeps its expectation and their sum stays as it is. At the end one entry at most is between 0 and 1.
    """
    out = probability.astype(float).copy()
    held = -1
    for i in range(len(out)):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = out[held], out[i]
        total = a + b
        if abs(total - 1.0) < 1e-12:
            first = draws[i] < a
            out[held], out[i] = float(first), float(not first)
            held = -1
        elif total < 1.0:
            if draws[i] < a / total:
                out[held], out[i] = total, 0.0
            else:
                out[held], out[i] = 0.0, total
                held = i
        else:
            if draws[i] < (1.0 - a) / (2.0 - total):
                out[held], out[i] = total - 1.0, 1.0
            else:
                out[held], out[i] = 1.0, total - 1.0
                held = i
    return out


def _rounded(seed: int, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # neighbours in size trade with each other, so that the words taken stay near the target, not only the count
        rows = rows.sort_values(["size", "id"], ascending=[False, True], kind="stable", na_position="last")
        p = rows["p"].to_numpy()
        rng = np.random.default_rng([seed, level, int(key[0]), int(key[1])])
        return rows.assign(p=pivot(p, rng.random(len(p))))

    return run


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 20,
) -> DataFrame:
    """(id, source, size, source_size, target, copies): how often the mix takes each row.

    A row's expected copies are its source's target over its source's size. The whole part is certain; the fractions are rounded
    by pivotal sampling in lots of about 1024 rows of like size (to a factor of two), dealt by a hash of the row and of its number among
    equal rows; each lot hands on one residual at most, and residuals of 64 lots, neighbours in size, meet in the next level until one is
    left for each source, which a single draw settles. Draws depend on the seed, level and lot only, so that reruns agree. A source's
    copies then differ from their expectation by less than one. A lot is rounded once, in order of size, so that neighbours in size
    trade with each other, and the words taken come near the target although each row keeps its probability.

    Null or blank text: size 0, and its copies are rounded like any other. Null source: a source of its own, last in order. Null
    id: dealt and rounded like others, in as many lots. Rows that repeat are rounded one by one. Empty table: empty result. Extra
    columns are ignored.
    """
    prepare(docs.sparkSession)
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.alias("size"))
    # equal rows are counted and numbered, a thousand at a time, so that they are dealt to many lots
    sizes = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("n")).withColumn("block", F.explode(F.expr("sequence(0L, (n - 1) div 1000)")))
    sizes = sizes.withColumn("turn", F.explode(F.expr("sequence(block * 1000, least(n, block * 1000 + 1000) - 1)")))
    sizes = materialize(sizes.select("id", "source", "size", "turn"))
    targets = materialize(source_targets(sizes, weights, share, most))
    # lots of each size class, numbered in order of size: a few rows for each source
    stratum = F.floor(F.log2(F.col("size") + 1)).cast("int")
    lots = sizes.groupBy("source", stratum.alias("stratum")).agg(F.ceil(F.count("*") / LEAF).alias("lots"))
    before = Window.partitionBy("source").orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.withColumn("before", F.coalesce(F.sum("lots").over(before), F.lit(0)))
    plan = lots.join(targets, lots["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    plan = materialize(plan.withColumnRenamed("source", "of").drop("rows"))
    # one number: how many levels the source with the most lots needs
    most_lots = plan.agg(F.max(F.col("before") + F.col("lots"))).first()[0] or 1
    rows = sizes.withColumn("stratum", stratum).join(plan.withColumnRenamed("stratum", "like"), F.col("source").eqNullSafe(F.col("of")) & (F.col("stratum") == F.col("like")))
    whole = F.floor("rate")
    lot = F.col("before") + F.pmod(F.xxhash64("id", "size", "turn"), F.col("lots"))
    rows = rows.withColumns({"copies": whole.cast("long"), "p": F.col("rate") - whole, "lot": lot.cast("long")})
    kind = docs.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, source string, size long, place int, source_size long, target double, copies long, p double, lot long"
    columns = [c.split()[0] for c in shape.split(", ")]
    level, left, open_, settled = 0, most_lots, rows.select(*columns), None
    while True:
        done = materialize(open_.groupBy("place", "lot").applyInPandas(_rounded(seed, level), shape))
        residual = (F.col("p") > 0) & (F.col("p") < 1)
        if left <= 1:
            last = F.when(residual, F.expr(f"cast((pmod(xxhash64(place, {seed}), 1000003) + 0.5) / 1000003 < p as double)")).otherwise(F.col("p"))
            done = done.withColumn("p", last)
            settled = done if settled is None else settled.union(done)
            break
        kept = done.filter(~residual)
        settled = kept if settled is None else settled.union(kept)
        open_ = done.filter(residual).withColumn("lot", F.floor(F.col("lot") / FAN)).select(*columns)
        left = -(-left // FAN)
        level += 1
    return settled.select("id", "source", "size", "source_size", "target", (F.col("copies") + F.round("p").cast("long")).alias("copies"))


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents at weights 3, 1, 2 for 150% of all words."""
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    out = mix_sources(docs)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
