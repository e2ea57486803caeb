"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default ceilings for a side we are willing to copy to every executor.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """True when ``df`` has at most ``bound`` rows.

    A plain count: every task sends one number, so no task reads the rows of
    another.  It computes ``df``; pass a materialised frame.
    """
    return df.count() <= bound


def fits_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` in all.

    A row counts as 16 bytes per column plus the bytes of its strings and
    binaries.  One partial aggregate; columns of nested types are not
    measured and never fit.
    """
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return False
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    rows, size = df.select(width.alias("w")).agg(F.count(F.lit(1)), F.sum("w")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Hint ``df`` for broadcast if it measurably fits both bounds.

    ``df`` should be materialised (a table, or a checkpointed frame), as it is
    read for the measurement.  Beyond a bound it is returned unhinted and the
    planner decides by its own size estimate.
    """
    if df.isStreaming:
        return df
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
