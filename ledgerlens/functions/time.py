"""Column helpers for dates and event time.

All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _bound(year: int, dtype: T.DataType) -> Column:
    """Literal 1 January of ``year`` typed like the column it is compared to.

    Comparing a column with a literal of its own type keeps the predicate a
    plain range that Parquet pushdown and partition pruning understand.
    """
    value = _dt.datetime(year, 1, 1)
    if isinstance(dtype, T.DateType):
        return F.lit(value.date())
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(T.TimestampNTZType())
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


def landed_year(column: str) -> str:
    """Name of the partition column that a landed table has for ``column``."""
    return f"{column}_year"


def in_years(df: DataFrame, column: str, first: int, last: int | None = None) -> Column:
    """``first <= year(column) <= last`` written as a half-open range.

    ``year(d) = Y`` hides the column inside a function, so the scan only gets
    ``IsNotNull``; the range form reaches the scan as two pushed filters.  On
    a landed table the partition column is compared too, so other years'
    folders are not read.
    """
    last = first if last is None else last
    dtype = df.schema[column].dataType
    c = F.col(column)
    within = (c >= _bound(first, dtype)) & (c < _bound(last + 1, dtype))
    if landed_year(column) in df.schema.names:
        within = within & F.col(landed_year(column)).between(first, last)
    return within


def month_name(month: Column) -> Column:
    """English month name of a month number 1..12 (null otherwise)."""
    first_day = F.make_date(F.lit(2000), month, F.lit(1))
    return F.when(month.between(1, 12), F.date_format(first_day, "MMMM"))


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP with the same epoch microseconds.

    A plain cast (or ``timestampdiff``, which casts) reads the wall clock in
    the session time zone, shifting window alignment with the zone and by an
    hour across daylight-saving changes; reading the fields as UTC does not.
    """
    seconds = F.date_part(F.lit("SECOND"), ts)  # with the microsecond fraction
    return F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                            F.minute(ts), seconds, F.lit("UTC"))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ with the same epoch microseconds."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_EPOCH_NTZ))


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """Make ``column`` a TIMESTAMP (a watermark needs it); NTZ is converted
    without a time-zone shift, other types are cast."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampType):
        return df
    if isinstance(dtype, T.TimestampNTZType):
        return df.withColumn(column, ntz_to_instant(F.col(column)))
    return df.withColumn(column, F.col(column).cast(T.TimestampType()))
