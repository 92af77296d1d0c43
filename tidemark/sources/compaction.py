"""Tables that are written in numbered batches, packed once their days are over: few files of about one size in place of many small ones.

What is packed goes to a folder beside the table, and a ledger says which batches of which partitions it stands for. The ledger is written
after the packed files and tells readers where rows are: nothing before, so that a crash leaves the table as it was. The small files stay,
unread, until `clean`: who began to read before that still finds them. One packer at a time; writers and readers are not held up.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import BATCH, declare
from tidemark.session import settings
from tidemark.sources import tables
from tidemark.sources.key_filters import within

#: What a packed file takes.
TARGET = 128 << 20

#: A partition `part` of column `by` (no column: the whole table), packed with its batches up to `through`; and packs whose small files are gone.
PACKED = declare("pack!:long by:str part:str through!:long")
CLEANED = declare("pack!:long")


def _packed(path: str) -> str:
    return f"{path.rstrip('/')}.packed"


def _ledger(spark: SparkSession, path: str, kind: str, schema: StructType) -> DataFrame:
    return tables.read_or_empty(spark, f"{path.rstrip('/')}.packs/{kind}", schema)


def _note(spark: SparkSession, path: str, kind: str, rows: list[tuple], schema: StructType) -> None:
    """One file, so all of the rows are there or none."""
    tables.append(spark.createDataFrame(rows, schema).coalesce(1), f"{path.rstrip('/')}.packs/{kind}")


def _pending(spark: SparkSession, path: str) -> list:
    """What is packed and not cleaned: a row for each partition that was packed since `clean` ran."""
    return _ledger(spark, path, "written", PACKED).join(_ledger(spark, path, "cleaned", CLEANED), "pack", "left_anti").select(*PACKED.fieldNames()).collect()


def _moved(pending: list, column: str | None = None) -> Column:
    """Whether a row of the table, or of its listing (column: part), is packed elsewhere."""
    groups = defaultdict(list)
    for r in pending:
        groups[(r["by"], r["through"])].append(r["part"])
    out = F.lit(False)
    for (by, through), parts in groups.items():
        here = F.coalesce(within(column or by, parts), F.lit(False)) if by else F.lit(True)
        out = out | ((F.col("batch_id") <= through) & here)
    return out


def _listed(spark: SparkSession, path: str, by: str | None) -> DataFrame:
    """(path, length, batch_id, part) of the table's files, none of which is opened."""
    # partition values as they are written
    with settings(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    part = F.col(by) if by else F.lit(None)
    return found.select("path", "length", F.col("batch_id").cast("long").alias("batch_id"), part.cast("string").alias("part"))


def rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table's rows, with batch_id, wherever they lie: the same before, while and after it is packed and cleaned.

    Filters on partition columns prune both parts. No table: empty.
    """
    full = StructType([*schema.fields, *BATCH.fields])
    loose = tables.read_or_empty(spark, path, full).select(*full.fieldNames())
    last = _ledger(spark, path, "written", PACKED).agg(F.max("pack")).first()[0]
    if last is None:
        return loose
    packed = tables.read(spark, _packed(path), schema=StructType([*full.fields, PACKED["pack"]])).filter(F.col("pack") <= last)
    return loose.filter(~_moved(_pending(spark, path))).unionByName(packed.drop("pack"))


def pack(spark: SparkSession, path: str, schema: StructType, through: int, by: str | None = None, before: str | None = None, target: int = TARGET) -> int:
    """Pack the batches up to `through`, which must be whole, of the partitions that are over; returns how many partitions that were.

    by: the date column that the table is partitioned by under its batches; without one all batches are packed together. before: only dates
    before that day, which is every date if it is not given; a null date is always over. Late batches are packed by a later call, beside what is
    there. Partitions of a single file stay as they are.

    Files are put together by their sizes as they are scanned, up to `target` bytes a task, and each task writes one file: nothing is shuffled.
    A call that dies leaves files that no reader sees, and the next call removes them.
    """
    if not tables.exists(spark, path):
        return 0
    last = _ledger(spark, path, "written", PACKED).agg(F.max("pack")).first()[0]
    number = 0 if last is None else last + 1
    place = f"{_packed(path)}/pack={number}"
    tables.remove(spark, place)
    pending = _pending(spark, path)
    files = _listed(spark, path, by).filter((F.col("batch_id") <= through) & ~_moved(pending, "part"))
    if by and before:
        files = files.filter(F.col("part").isNull() | (F.col("part") < before))
    # a row for each partition
    parts = [r["part"] for r in files.groupBy("part").count().filter("count > 1").orderBy("part").collect()]
    full = StructType([*schema.fields, *BATCH.fields])
    scan = {"spark.sql.files.maxPartitionBytes": str(target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for part in parts:
        loose = tables.read(spark, path, schema=full).filter((F.col("batch_id") <= through) & ~_moved(pending))
        with settings(spark, scan):
            tables.append(loose.filter(within(by, [part])) if by else loose, place, [by] if by else None)
    if parts:
        _note(spark, path, "written", [(number, by, part, through) for part in parts], PACKED)
    return len(parts)


def clean(spark: SparkSession, path: str) -> int:
    """Delete the small files of what is packed; returns how many folders went. To be called when whoever began to read before the packing has ended.

    A stream that reads the table's folder must have read these batches before; one that begins anew takes what is packed from `rows`. A call
    that dies is made good by the next one.
    """
    pending = _pending(spark, path)
    if not pending:
        return 0
    gone = 0
    if tables.exists(spark, path):
        files = _listed(spark, path, pending[0]["by"]).withColumn("moved", _moved(pending, "part"))
        files = files.withColumns({"batch": F.regexp_extract("path", r"^(.*/batch_id=[^/]*)/", 1), "folder": F.regexp_replace("path", "/[^/]*$", "")})
        whole = files.groupBy("batch").agg(F.bool_and("moved").alias("whole"))
        # a batch that has nothing else goes with its folder
        folders = files.filter("moved").join(whole, "batch").select(F.when(F.col("whole"), F.col("batch")).otherwise(F.col("folder")).alias("folder")).distinct()
        for row in folders.toLocalIterator():
            tables.remove(spark, row["folder"])
            gone += 1
    _note(spark, path, "cleaned", [(n,) for n in sorted({r["pack"] for r in pending})], CLEANED)
    return gone
