"""Batch sinks (K1, K2, K7).  Streaming sinks live in ``ledgerlens.streaming``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_table(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    **options: str,
) -> None:
    """Write a result table (K1): executors write in parallel, nothing passes
    through the driver.  A document store works the same way given its
    connector jar, e.g. ``fmt="mongodb", connection.uri=..., database=...,
    collection=...``."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def publish_csv(
    df: DataFrame,
    options: dict[str, str],
    fmt: str = "kafka",
    columns: Sequence[str] | None = None,
    key: str | None = None,
) -> None:
    """Publish rows as CSV text in a ``value`` column (K7), e.g. to a topic.

    Fields are quoted and escaped (``to_csv``), so a comma inside a field
    no longer shifts the columns.  ``fmt="text"`` with a ``path`` option
    writes the same lines to files.
    """
    from ledgerlens.sources.topic import EXACT_TIME_FORMATS

    cols = list(columns or df.columns)
    out = [F.to_csv(F.struct(*cols), EXACT_TIME_FORMATS).alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    df.select(*out).write.format(fmt).options(**options).mode(
        "append" if fmt == "kafka" else "overwrite").save()
