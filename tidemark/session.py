"""Session settings that all queries rely on."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: UTC everywhere, so that dates don't depend on the host; strict ANSI arithmetic, with try_ functions on untrusted input.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(name: str = "tidemark", **settings: str) -> SparkSession:
    """A session with SETTINGS. settings are further Spark options, dots written as __, such as spark__hadoop__fs__s3a__endpoint."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """An existing session, with its zone set to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Some settings for a while; what was set before comes back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def workspace(spark: SparkSession) -> str:
    """A new folder for tables that a query writes, in the one that the cluster names for checkpoints.

    A local session without one gets a temporary folder; on a cluster that would not be shared, and is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="spark-")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4()}"
