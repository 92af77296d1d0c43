"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What one Arrow batch that a query hands to Python holds at most: whole texts are long, so less than Spark's defaults.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

#: Deletes a shuffle's files when the query that made them ends.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Bytes of text that a worker takes up in one go, but for a single text that is longer.
SLICE = 4 << 20

#: Ids of so many bytes together are sent to every executor; more of them meet the texts in a shuffle.
SENT = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """A folder for intermediate tables that every executor sees: the one that the cluster names in spark.checkpoint.dir.

    Only a local session may fall back on a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return spark


def tuned(spark: SparkSession) -> SparkSession:
    """prepare, and small Arrow batches for this session: for queries and pipelines. Operators leave the session's settings alone."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return prepare(spark)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The given settings for a while; the user's own come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Where written tables lie.
_PLACES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialize(df: DataFrame) -> DataFrame:
    """Write df to a table in the shared folder and read on from there: computed once, lineage cut, safe when executors are lost.

    The files of its shuffles are deleted as soon as it is written.
    """
    spark = prepare(df.sparkSession)
    place = f"{spark.sparkContext.getCheckpointDir()}/step-{uuid.uuid4()}"
    with settings(spark, CLEANUP):
        df.write.parquet(place)
    out = spark.read.schema(df.schema).parquet(place)
    _PLACES[out] = place
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that materialize wrote and nothing will read again."""
    for df in tables:
        place = _PLACES.pop(df, None) if df is not None else None
        if place:
            jvm = df.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in slices with about `most` bytes of text at most, so that what is made of a slice stays small too."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        lot = (np.cumsum(sizes) - 1) // most
        cuts = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), n]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def few(ids: DataFrame) -> bool:
    """Whether the distinct ids (id) take SENT bytes at most, as measured."""
    size = F.octet_length(F.col("id").cast("string")) + 16
    return (ids.distinct().agg(F.sum(size)).first()[0] or 0) <= SENT


def chosen(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of texts (id, ...) whose id is among ids, which may repeat and should be cheap to read.

    Few ids go to where the texts are read, so that only chosen texts are shuffled later.
    """
    ids = ids.distinct()
    return texts.join(F.broadcast(ids) if few(ids) else ids, "id", "left_semi")


def bounded_sample(df: DataFrame, bound: int, seed: int, key: str = "id") -> DataFrame:
    """At most `bound` rows, those whose keys hash lowest, with the hash as `turn`; all rows if there are no more.

    The rest is filtered out where it is read, so that what meets in one place is little more than the bound.
    """
    n = df.count()
    df = df.withColumn("turn", F.xxhash64(key, F.lit(seed)))
    if n > bound:
        share = min(1.0, 1.1 * bound / n + 1e-3)
        df = df.filter(F.pmod("turn", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(F.pmod("turn", F.lit(1 << 20)), "turn", key)
    return df.limit(bound)


def ascii_lower(column):
    """A-Z lower-cased, other letters as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
