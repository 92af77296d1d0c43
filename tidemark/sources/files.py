"""Which files of a table have been read: a ledger of files by increments, so that new ones are found without reading any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import declare
from tidemark.sources import tables

#: A file of an increment, and an increment that is done.
FILE = declare("path!:str modified!:ts length!:long increment!:long")
DONE = declare("increment!:long")

#: Files that one increment takes at most; the rest make up the next ones.
MOST = 10_000


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, modified, length) of a table's data files: listed by Spark, none is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select("path", F.col("modificationTime").alias("modified"), "length")


def unread(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The files that no increment has. One that was written again under its name counts as new."""
    return listing(spark, path).join(tables.read_or_empty(spark, f"{ledger}/taken", FILE).select("path", "modified"), ["path", "modified"], "left_anti")


def next_increment(spark: SparkSession, path: str, ledger: str, most: int = MOST) -> tuple[int, list[str]] | None:
    """The number and files of the increment to work on: the first that was begun and not finished, else one of new files, the oldest
    first, which is put down before it is given. None if there is nothing to do. What reaches the driver is at most `most` names."""
    taken = tables.read_or_empty(spark, f"{ledger}/taken", FILE)
    begun = taken.join(tables.read_or_empty(spark, f"{ledger}/done", DONE), "increment", "left_anti")
    number = begun.agg(F.min("increment")).first()[0]
    if number is None:
        if not tables.exists(spark, path):
            return None
        last = taken.agg(F.max("increment")).first()[0]
        number = 0 if last is None else last + 1
        new = unread(spark, path, ledger).orderBy("modified", "path").limit(most).coalesce(1).withColumn("increment", F.lit(number).cast("long"))
        tables.overwrite(new, f"{ledger}/taken", ["increment"], partitions_only=True)
        begun = tables.read_or_empty(spark, f"{ledger}/taken", FILE)
    names = [r[0] for r in begun.filter(F.col("increment") == number).select("path").collect()]
    return (number, names) if names else None


def finish(spark: SparkSession, ledger: str, number: int) -> None:
    """Put down that an increment is done."""
    tables.append(spark.createDataFrame([(number,)], DONE).coalesce(1), f"{ledger}/done")
