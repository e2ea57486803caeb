"""Per-group summaries of a sales table.

Every aggregate here is mergeable (avg, min, max, counts, the quantile
sketch), so Spark aggregates partially before the shuffle: a group holding a
third of all rows still sends one small buffer per map task, never its rows.
Each takes a DataFrame or a ``Lookup`` (group columns reached through a key,
aggregated before the join; see ``summarize``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import percent
from ledgerlens.operators.summarize import (
    Source,
    count_nonnull,
    count_true,
    maximum,
    mean,
    minimum,
    quantile_sketch,
    rows_of,
    summarize,
)


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _key_order(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).asc_nulls_first() for k in keys]


def top_groups_by_avg(
    df: Source,
    group: str = "town",
    value: str = "price",
    k: int = 10,
    out: str = "avg_price",
    tie_break: bool = True,
) -> DataFrame:
    """The ``k`` groups with the highest average ``value`` (B1).

    A null group key is a group of its own.  Sort plus limit plans as a
    single top-k (TakeOrderedAndProject): each task keeps ``k`` rows.
    ``tie_break`` orders equal averages by key so the cut is deterministic.
    """
    keys = _keys(group)
    agg = summarize(df, keys, {out: mean(value)})
    order = [F.col(out).desc_nulls_last()] + (_key_order(keys) if tie_break else [])
    return agg.orderBy(*order).limit(k)


def value_spread(
    df: Source,
    groups: Sequence[str] = ("county", "property_type"),
    value: str = "price",
    out: str = "price_difference",
    ordered: bool = True,
) -> DataFrame:
    """``max(value) - min(value)`` per group (B3); null when all values are null."""
    keys = _keys(groups)
    res = summarize(df, keys, {"_hi": maximum(value), "_lo": minimum(value)})
    res = res.select(*keys, (F.col("_hi") - F.col("_lo")).alias(out))
    if ordered:
        res = res.orderBy(F.col(keys[0]).asc_nulls_first(), F.col(out).asc_nulls_first(),
                          *_key_order(keys[1:]))
    return res


def flag_share(
    df: Source,
    group: str = "county",
    predicate: Column | None = None,
    total_out: str = "total_count",
    share_out: str = "percentage_new_properties",
    ordered: bool = True,
) -> DataFrame:
    """Rows per group and the percentage of them matching ``predicate``.

    The total counts non-null keys (``count(group)``), so the null-key group
    has total 0 and a null share rather than a division error.  The flagged
    count is not restricted to non-null keys, as in the original job.
    """
    if predicate is None:
        predicate = F.col("new_property") == F.lit("Y")
    res = summarize(df, [group], {total_out: count_nonnull(group), "_flagged": count_true(predicate)})
    res = res.select(group, total_out,
                     percent(F.col("_flagged"), F.col(total_out)).alias(share_out))
    if ordered:
        res = res.orderBy(F.col(share_out).asc_nulls_first(), F.col(group).asc_nulls_first())
    return res


def bottom_groups_by_median(
    df: Source,
    group: str = "county",
    value: str = "price",
    k: int = 20,
    out: str = "median_price",
    accuracy: int = 10000,
    tie_break: bool = True,
    sketch: str = "percentile",
) -> DataFrame:
    """The ``k`` groups with the lowest median ``value``.

    ``percentile_approx`` returns an element of the group (the lower middle
    one for an even count) with rank error at most ``1/accuracy`` of the
    group size; its sketch is merged across tasks, so memory per group is
    bounded by ``accuracy``, not by the group size.  That sketch cannot be
    built before a lookup join, so a ``Lookup`` is joined row by row here
    (AQE splits a skewed join partition).

    ``sketch="kll"`` takes a KLL sketch instead, which can: values are
    sketched per lookup key before the join and the sketches merged after it,
    so no fact row crosses a shuffle.  It is exact for groups of up to
    ``accuracy`` values (see :func:`quantile_sketch` for larger ones).
    """
    keys = _keys(group)
    if sketch == "kll":
        agg = summarize(df, keys, {out: quantile_sketch(value, 0.5, accuracy)})
    else:
        agg = rows_of(df).groupBy(*keys).agg(F.percentile_approx(value, 0.5, accuracy).alias(out))
    order = [F.col(out).asc_nulls_last()] + (_key_order(keys) if tie_break else [])
    return agg.orderBy(*order).limit(k)
