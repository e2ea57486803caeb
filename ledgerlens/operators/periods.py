"""Calendar summaries of a sales table: per month, per year, year over year.

The original jobs computed per-group values with whole-partition windows
over the raw rows and then de-duplicated; that shuffles and sorts every row.
Here each summary aggregates first (partial aggregation before the shuffle)
and only the small aggregated result meets a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.time import in_years, month_name
from ledgerlens.operators.summarize import Source, count_nonnull, mean, rows_of, summarize


def monthly_counts(
    df: Source,
    date: str = "date",
    year: int = 2011,
    ordered: bool = False,
) -> DataFrame:
    """Rows per month of ``year`` (B2): ``month`` (string), ``count``, ``month_name``.

    Months without rows are absent.
    """
    m = F.month(F.col(date))
    df = rows_of(df, [date])
    res = (
        df.filter(in_years(df, date, year))
        .groupBy(m.alias("m"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if ordered:
        res = res.orderBy("m")
    return res.select(
        F.col("m").cast(T.StringType()).alias("month"),
        F.col("count"),
        month_name(F.col("m")).alias("month_name"),
    )


def yoy_change(
    df: Source,
    group: str = "county",
    date: str = "date",
    value: str = "price",
    start: int = 2011,
    end: int = 2020,
    strict_gap: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Average ``value`` per (group, year) and its change from the previous year.

    Years ``start..end`` inclusive.  ``prev_year_avg_price`` is the average
    of the previous year *present* for the group, while ``previous_year`` is
    always ``year - 1``; with ``strict_gap=True`` the previous average (and
    both changes) are null unless that year really is ``year - 1``.
    ``percentage_change`` is rounded to 2 places and null when the previous
    average is 0.
    """
    dated = df.filter(in_years(df, date, start, end)).withColumn("year", F.year(F.col(date)))
    yearly = summarize(dated, [group, "year"], {"avg_price": mean(value)})
    w = Window.partitionBy(group).orderBy("year")
    prev = F.lag("avg_price").over(w)
    if strict_gap:
        prev = F.when(F.lag("year").over(w) == F.col("year") - 1, prev)
    res = yearly.select(
        F.col(group),
        F.col("year"),
        F.col("avg_price"),
        (F.col("year") - 1).alias("previous_year"),
        prev.alias("prev_year_avg_price"),
    )
    change = F.col("avg_price") - F.col("prev_year_avg_price")
    res = res.withColumns({
        "price_change": change,
        "percentage_change": F.round(
            F.try_divide(change, F.col("prev_year_avg_price")) * F.lit(100.0), 2),
    })
    if ordered:
        res = res.orderBy(F.col(group).asc_nulls_first(), "year")
    return res


def busiest_month(
    df: Source,
    group: str = "county",
    date: str = "date",
    id_col: str = "transaction_id",
    value: str = "price",
    year: int = 2011,
) -> DataFrame:
    """Per group, the month of ``year`` with the most rows, with its average.

    ``num_transactions`` counts non-null ids; ties go to the lower month.
    One row per group is picked from the (group x 12) aggregate with a
    ranked window that Spark plans as a group limit.
    """
    dated = df.filter(in_years(df, date, year)).withColumn("m", F.month(F.col(date)))
    monthly = summarize(dated, [group, "m"],
                        {"num_transactions": count_nonnull(id_col), "avg_price": mean(value)})
    w = Window.partitionBy(group).orderBy(F.col("num_transactions").desc(), F.col("m").asc())
    return (
        monthly.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") == 1)
        .select(
            F.col(group),
            F.col("m").cast(T.StringType()).alias("month"),
            month_name(F.col("m")).alias("month_name"),
            F.col("num_transactions"),
            F.col("avg_price"),
        )
    )
