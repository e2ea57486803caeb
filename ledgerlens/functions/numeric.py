"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100`` as a double; null when ``whole`` is 0 or null.

    ANSI mode raises on division by zero, so this uses ``try_divide``.
    """
    value = F.try_divide(part.cast(T.DoubleType()), whole.cast(T.DoubleType())) * F.lit(100.0)
    return F.round(value, digits) if digits is not None else value


def stable_round(c: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the last bit of ``c``.

    Sums of doubles differ in their last bits with the order of addition
    (i.e. with partitioning), by up to ~1e-10 for averages of large sums.
    Rounding to 8 places first absorbs that noise, so a value on a rounding
    tie lands on the same side every run.
    """
    return F.round(F.round(c, 8), digits) + F.lit(0.0)


def round_columns(df: DataFrame, digits: int, columns=None) -> DataFrame:
    """Round the given (default: all floating) columns with :func:`stable_round`
    (adding ``0.0`` turns a negative zero into ``0.0``)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields
                   if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: stable_round(F.col(c), digits) for c in columns})
