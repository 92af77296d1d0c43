"""Bloom filters of the keys in each partition of a table, kept beside it: which partitions may hold a key, without reading them.

A filter is cut into blocks of WORDS words that hold about KEYS keys each, and a key lies in one of them. What is stored, joined and probed
is one row for each block, however large a partition is: filters differ in how many blocks they have, a power of two. Each append
adds filters for its own rows and touches no others. Filters only say "not there" or "perhaps"; an exact join over what they leave
decides, so that the result does not depend on them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import tables

#: About one false answer in 700: 16 bits for each key, of which 6 are set.
WORDS, KEYS, PROBES = 16, 64, 6


def place(path: str) -> str:
    """Where the filters of a table lie."""
    return f"{path.rstrip('/')}.keys"


def _hash(keys: list[str], seed: int) -> Column:
    """64 bits of the keys; a null among them counts as a value of its own."""
    parts = [F.when(F.col(k).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(k).cast("string"))) for k in keys]
    return F.xxhash64(*parts, F.lit(seed))


def _block(keys: list[str], level: Column) -> Column:
    """The key's block among 2^level."""
    return F.pmod(_hash(keys, 1), F.call_function("shiftleft", F.lit(1).cast("long"), level))


def _bits(keys: list[str], probes: int) -> Column:
    """The places of a key's bits in its block: steps of one hash from another."""
    first, step = F.pmod(_hash(keys, 2), F.lit(WORDS * 64)), F.pmod(_hash(keys, 3), F.lit(WORDS * 32)) * 2 + 1
    return F.transform(F.sequence(F.lit(0), F.lit(probes - 1)), lambda i: F.pmod(first + i * step, F.lit(WORDS * 64)).cast("int"))


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)


def build(rows: DataFrame, keys: list[str], by: str, probes: int = PROBES) -> DataFrame:
    """(partition, level, block, filter): the blocks that hold keys of rows, by the partition column `by`; filter has WORDS longs.

    Counts and bits are combined before they are shuffled, so a partition that most rows have is spread like any other.
    """
    level = F.greatest(F.ceil(F.log2(F.count("*") / KEYS)), F.lit(0)).cast("int")
    levels = rows.groupBy(F.col(by).alias("partition")).agg(level.alias("level"))
    at = rows.select(F.col(by).alias("_by"), *keys).join(levels, F.col("_by").eqNullSafe(F.col("partition")))
    bits = at.select("partition", "level", _block(keys, F.col("level")).alias("block"), F.explode(_bits(keys, probes)).alias("bit"))
    words = bits.groupBy("partition", "level", "block", F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(_mask(F.col("bit"))).alias("word"))
    # WORDS entries at most
    found = words.groupBy("partition", "level", "block").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("_m"))
    return found.withColumn("filter", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("long")))).drop("_m")


def remember(rows: DataFrame, path: str, keys: list[str], by: str, segment: int | str, probes: int = PROBES) -> None:
    """Add filters for rows that are about to be appended to the table, under a name of the append: a retry replaces them.

    To be done before the rows are written: a key too many costs a look into its partition, a key too few would be taken for new.
    """
    tables.overwrite(build(rows, keys, by, probes).withColumn("segment", F.lit(str(segment))), place(path), ["segment"], partitions_only=True)


def perhaps(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], probes: int = PROBES) -> DataFrame:
    """(*keys, partition): the keys of rows, and each partition of the table that may hold them.

    Keys meet the filters by block, once for each size of filter there is. What is shuffled is new keys and filters, never the table.
    """
    filters = tables.read(spark, place(path)).select("partition", "level", "block", "filter")
    # a row for each size: powers of two
    sizes = [r[0] for r in filters.select("level").distinct().collect()]
    asked = rows.select(*keys).distinct().withColumn("level", F.explode(F.array(*[F.lit(s) for s in sizes])) if sizes else F.lit(-1))
    asked = asked.withColumns({"block": _block(keys, F.col("level")), "_bits": _bits(keys, probes)})
    word = lambda bit: F.get("filter", F.floor(bit / 64).cast("int"))
    there = F.forall("_bits", lambda bit: word(bit).bitwiseAND(_mask(bit)) != 0)
    return asked.join(filters, ["level", "block"]).filter(there).select(*keys, "partition").distinct()


def within(by: str, partitions: list) -> Column:
    """Whether the partition column has one of the values, null among them."""
    some = F.col(by).isin([p for p in partitions if p is not None])
    return F.coalesce(some, F.lit(False)) | F.col(by).isNull() if None in partitions else some


@contextlib.contextmanager
def unseen(table: DataFrame, rows: DataFrame, path: str, keys: list[str], by: str) -> Iterator[DataFrame]:
    """The rows whose keys the table lacks, as an anti join with all of it would give them; to be used inside the context.

    Only partitions that may hold one of the keys are read, and of their rows the keys. What reaches the driver is those partitions' values.
    A table that has no filters, as it was written before there were any, is read whole.
    """
    spark = table.sparkSession
    if not tables.exists(spark, place(path)):
        yield tables.inserted(table, rows, keys)
        return
    found = perhaps(spark, path, rows, keys).persist()
    try:
        partitions = [r[0] for r in found.select("partition").distinct().collect()]
        if not partitions:
            yield rows
            return
        known = table.filter(within(by, partitions)).select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], F.col(by).alias("_tby"))
        same = F.col("partition").eqNullSafe(F.col("_tby"))
        for i, k in enumerate(keys):
            same = same & (F.col(k) == F.col(f"_t{i}"))
        present = found.join(known, same, "left_semi").select(*keys).distinct()
        yield rows.join(present, keys, "left_anti").select(*rows.columns)
    finally:
        found.unpersist()


def rebuild(spark: SparkSession, path: str, keys: list[str], by: str) -> None:
    """One filter for each partition instead of one for each append that touched it; also for a table that had none."""
    fresh = f"{place(path)}-new"
    tables.remove(spark, fresh)
    tables.overwrite(build(tables.read(spark, path), keys, by).withColumn("segment", F.lit("all")), fresh, ["segment"])
    tables.remove(spark, place(path))
    tables.rename(spark, fresh, place(path))
