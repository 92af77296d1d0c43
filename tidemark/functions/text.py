"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(*columns: Column | str) -> Column:
    """The first value that is neither null nor an empty string."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns])


def instant(text: Column) -> Column:
    """ISO-8601 text with any offset as a timestamp; null where it isn't one."""
    return F.try_to_timestamp(text)


def content_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by |; a null part is spelled None, so that it still takes its place."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]), 256)


def relative_change(now: Column, before: Column) -> Column:
    """(now - before) / before; null if there is nothing before, or zero."""
    return F.try_divide(now - before, before)
