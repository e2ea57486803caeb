"""Category mix: the share of each category within its group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import percent
from ledgerlens.operators.summarize import Source, count_rows, summarize


def category_mix(
    df: Source,
    group: str = "county",
    category: str = "property_type",
    digits: int = 2,
) -> DataFrame:
    """``num_of_type``, ``total_num`` and ``percentage_of_type`` per (group, category).

    Counts are of rows (``count(*)``), so rows with null values still count.
    The group total is a window sum over the already-aggregated
    (group, category) rows, never over raw rows.
    """
    counts = summarize(df, [group, category], {"num_of_type": count_rows()})
    total = F.sum("num_of_type").over(Window.partitionBy(group))
    return counts.select(
        F.col(group),
        F.col(category),
        F.col("num_of_type"),
        total.alias("total_num"),
    ).withColumn("percentage_of_type", percent(F.col("num_of_type"), F.col("total_num"), digits))
