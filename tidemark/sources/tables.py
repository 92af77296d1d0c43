"""Tables as folders of files: scans, appends, merges and numbered commits, on Parquet or any other format that is installed.

Parquet has no transactions. A merge therefore writes its rows to a staging folder first and then replaces the partitions that
it touches; readers may see some partitions before others. With Delta on the class path, fmt="delta" uses MERGE instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST")


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None and fmt != "delta" else reader).load(path)


def exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether there is a table; only its schema is read. Errors other than its absence are raised."""
    try:
        read(spark, path, fmt)
        return True
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return False
        raise


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return read(spark, path, fmt) if exists(spark, path, fmt) else spark.createDataFrame([], schema)


def append(df: DataFrame, path: str, by: list[str] | None = None, fmt: str = "parquet") -> None:
    writer = df.write.format(fmt).mode("append")
    (writer.partitionBy(*by) if by else writer).save(path)


def overwrite(df: DataFrame, path: str, by: list[str] | None = None, fmt: str = "parquet", partitions_only: bool = False) -> None:
    """Replace the whole table, or only those partitions that df has rows of."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic" if partitions_only else "static")
    (writer.partitionBy(*by) if by else writer).save(path)


def ensure(spark: SparkSession, path: str, schema: StructType, by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Create an empty table if there is none. A partitioned Parquet table keeps its schema in its rows' files, so that it only
    begins with its first row; read_or_empty stands in for it until then."""
    if not exists(spark, path, fmt):
        overwrite(spark.createDataFrame([], schema), path, by, fmt)


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")


def query_path(spark: SparkSession, path: str, what: str = "*", fmt: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT {what} FROM {fmt}.`{path}`")


def inserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of source whose keys target lacks."""
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def upserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """target with the rows of source put in: in place of those with the same keys, or added. Nothing is deleted otherwise."""
    return target.join(source.select(*keys), keys, "left_anti").select(*source.columns).unionByName(source)


def _staged(spark: SparkSession, source: DataFrame, path: str, keys: list[str], by: list[str], fmt: str) -> tuple[str, DataFrame, list]:
    """source written beside the table, so that it is computed once; its folder, and the values of the columns `by` that it has.

    Null keys never match and repeated ones match twice: neither can be merged, and both are refused. What reaches the driver is a row for
    each partition that source touches.
    """
    place = f"{path.rstrip('/')}.source-{uuid.uuid4()}"
    source.write.format(fmt).save(place)
    rows = read(spark, place, fmt, source.schema)
    null = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.max(null).alias("_null"), *[F.first(c).alias(f"_by_{i}") for i, c in enumerate(by)])
    counts = counts.groupBy(*[F.col(f"_by_{i}").alias(f"_by_{i}") for i in range(len(by))]).agg(F.max("_n").alias("_n"), F.max("_null").alias("_null"))
    found = counts.collect()
    wrong = "null in merge keys" if any(r["_null"] for r in found) else "repeated rows for merge keys" if any((r["_n"] or 0) > 1 for r in found) else ""
    if wrong:
        remove(spark, place)
        raise ValueError(f"{wrong} {keys}")
    return place, rows, [r[0] for r in found]


def merge_insert_only(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], by: list[str], fmt: str = "parquet", within: str | None = None,
    filters: bool = False, first: Callable[[DataFrame], None] | None = None,
) -> None:
    """Add the rows whose keys are new; rows that are there stay as they are.

    within: a condition on the table that holds for every row whose key the source may repeat, such as a range of partitions; only those
    are then read for their keys. filters: keep Bloom filters of keys beside the table, by the first column of `by`, and read only the
    partitions that may hold a key of the source; all appends must then come through here. first: called with the new rows before they are
    appended, for what is derived from them; if it fails, nothing is appended.
    """
    ensure(spark, path, source.schema, by, fmt)
    place, rows, _ = _staged(spark, source, path, keys, by, fmt)
    try:
        if fmt == "delta":
            _delta_merge(spark, path, rows, keys, update=False)
            return
        old = read_or_empty(spark, path, source.schema, fmt)
        old = old.filter(within) if within else old
        if filters:
            from tidemark.sources import key_filters

            if not exists(spark, key_filters.place(path)) and not old.isEmpty():
                key_filters.rebuild(spark, path, keys, by[0])
            with key_filters.unseen(old, rows, path, keys, by[0]) as fresh:
                # the rows that are added, once, as they are written, remembered and handed on
                fresh.write.format(fmt).save(f"{place}-new")
            fresh = read(spark, f"{place}-new", fmt, source.schema)
            if first:
                first(fresh)
            if not fresh.isEmpty():
                key_filters.remember(fresh, path, keys, by[0], uuid.uuid4().hex)
                append(fresh, path, by, fmt)
        else:
            fresh = inserted(old, rows, keys)
            if first:
                first(fresh)
            append(fresh, path, by, fmt)
    finally:
        remove(spark, place)
        remove(spark, f"{place}-new")


def merge_upsert(spark: SparkSession, path: str, source: DataFrame, keys: list[str], by: str, fmt: str = "parquet") -> None:
    """Put in the rows of source. Only the partitions (column `by`, a function of the keys, perhaps null) that source has rows of are rewritten."""
    ensure(spark, path, source.schema, [by], fmt)
    place, rows, days = _staged(spark, source, path, keys, [by], fmt)
    if fmt == "delta":
        _delta_merge(spark, path, rows, keys, update=True)
    elif days:
        touched = F.coalesce(F.col(by).isin([d for d in days if d is not None]), F.lit(False))
        old = read_or_empty(spark, path, source.schema, fmt).filter(touched | F.col(by).isNull() if None in days else F.col(by).isin(days))
        staging = f"{path.rstrip('/')}.staging-{uuid.uuid4()}"
        upserted(old, rows, keys).write.format(fmt).save(staging)
        overwrite(read(spark, staging, fmt, source.schema), path, [by], fmt, partitions_only=True)
        remove(spark, staging)
    remove(spark, place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder, within one file system."""
    old, new = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{path} could not be renamed to {to}")


def merge_sql(path: str, source: str, keys: list[str], update: bool) -> str:
    """The MERGE of a view into a Delta table."""
    same = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"MERGE INTO delta.`{path}` t USING {source} s ON {same}" + " WHEN MATCHED THEN UPDATE SET *" * update + " WHEN NOT MATCHED THEN INSERT *"


def _delta_merge(spark: SparkSession, path: str, source: DataFrame, keys: list[str], update: bool) -> None:
    source.createOrReplaceTempView("_merge_source")
    spark.sql(merge_sql(path, "_merge_source", keys, update))


def commit(spark: SparkSession, df: DataFrame, path: str, version: int, at, fmt: str = "parquet") -> None:
    """Append df as a numbered version: rows carry the number and time of their commit. Writing a version again replaces it."""
    overwrite(df.withColumns({"_commit_ts": at, "_commit": F.lit(version)}), path, ["_commit"], fmt, partitions_only=True)


def version_as_of(table: DataFrame, version: int) -> DataFrame:
    """An append-only table as it was at that version."""
    return table.filter(F.col("_commit") <= version).drop("_commit", "_commit_ts")


def history(table: DataFrame) -> DataFrame:
    """One row for each commit: its number, rows and time."""
    return table.groupBy(F.col("_commit").alias("version")).agg(F.count("*").alias("rows_added"), F.min("_commit_ts").alias("committed_at"))


def has_format(spark: SparkSession, fmt: str) -> bool:
    """Whether a data source of that name is installed."""
    try:
        spark.read.format(fmt).schema("x int").load("/nowhere")
        return True
    except Exception as e:
        return "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find" not in str(e)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(position, value): the lines of a log in order. position rises within a file, and files go by name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return lines.withColumn("position", F.struct("file", "block", F.monotonically_increasing_id())).select("position", "value")


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
