"""Sliding event-time window summaries.

Each function takes a batch *or* streaming DataFrame.  On a stream the
event-time column gets a watermark (converted to TIMESTAMP first when it is
TIMESTAMP_NTZ, without a time-zone shift); on a batch frame the watermark is
meaningless and skipped.  Results carry flat ``start``/``end`` columns of the
input's timestamp type.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.time import as_event_time, instant_to_ntz
from ledgerlens.operators.summarize import Measure, count_rows, distinct_sketch


def windowed_agg(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str | None,
    aggs: Sequence[Column],
    keys: Sequence[str] = (),
    watermark: str | None = "1 second",
    flatten: bool = True,
) -> DataFrame:
    """``groupBy(window(ts, size, slide), *keys).agg(*aggs)``, flattened.

    Output: ``start, end, *keys, *aggs`` (``window, *keys, *aggs`` with
    ``flatten=False``: the struct keeps its event-time role, so a stream can
    aggregate it again).  Each row lands in
    ``ceil(size / slide)`` candidate windows; Spark expands and filters them
    inside the scan stage and aggregates partially before the shuffle, so a
    hot key costs one buffer per task and window.
    """
    was_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    if df.isStreaming:
        df = as_event_time(df, ts)
        if watermark:
            df = df.withWatermark(ts, watermark)
    else:
        was_ntz = False  # batch windows work on NTZ directly
    window = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    res = df.groupBy(window.alias("window"), *keys).agg(*aggs)
    return flatten_window(res, was_ntz) if flatten else res


#: Microseconds of the units that have a fixed length.
UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
         "day": 86_400_000_000, "week": 604_800_000_000}


def micros(interval: str) -> int:
    """Microseconds of an interval of fixed length, such as ``"1 hour 30 minutes"``."""
    words = interval.lower().removeprefix("interval ").split()
    if not words or len(words) % 2:
        raise ValueError(f"not an interval: {interval!r}")
    try:
        return sum(round(float(n) * UNITS[unit.removesuffix("s")]) for n, unit in zip(words[::2], words[1::2]))
    except KeyError as error:
        raise ValueError(f"{error.args[0]!r} in {interval!r} has no fixed length") from None


def pane_agg(
    df: DataFrame,
    ts: str,
    size: str,
    slide: str | None,
    measures: dict[str, Measure],
    keys: Sequence[str] = (),
    watermark: str | None = "1 second",
) -> DataFrame:
    """What :func:`windowed_agg` gives, by panes (T2-T5): ``start, end, *keys, *measures``.

    A pane is as long as the greatest common divisor of ``size`` and
    ``slide``, so every window is a whole number of panes.  Rows are
    aggregated once per pane and the panes' partial results merged into the
    windows, instead of copying each row into its ``ceil(size / slide)``
    windows: the first aggregate reads as many rows as there are events, and
    what is copied are panes.  On a stream the two aggregates are chained, so
    it runs in append mode.
    """
    was_ntz = df.isStreaming and isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    if df.isStreaming:
        df = as_event_time(df, ts)
        if watermark:
            df = df.withWatermark(ts, watermark)
    pane = math.gcd(micros(size), micros(slide or size))
    fact = set(df.columns)
    parts = [c for n, m in measures.items() for c in m.parts(f"_{n}", fact)]
    panes = df.groupBy(F.window(F.col(ts), f"{pane} microseconds").alias("_pane"), *keys).agg(*parts)
    window = F.window(F.col("_pane"), size, slide) if slide else F.window(F.col("_pane"), size)
    res = panes.groupBy(window.alias("window"), *keys).agg(*[m.merge(f"_{n}", fact).alias(n) for n, m in measures.items()])
    return flatten_window(res, was_ntz)


def flatten_window(res: DataFrame, to_ntz: bool = False) -> DataFrame:
    """Replace the ``window`` struct by ``start`` and ``end`` columns."""
    start, end = F.col("window.start"), F.col("window.end")
    if to_ntz:
        start, end = instant_to_ntz(start), instant_to_ntz(end)
    return res.select(start.alias("start"), end.alias("end"),
                      *[c for c in res.columns if c != "window"])


def _window_order(ordered: bool) -> list[Column]:
    return [F.col("start").desc(), F.col("end").desc()] if ordered else []


def type_counts(
    df: DataFrame,
    ts: str = "timestamp",
    type_col: str = "crime_type",
    size: str = "12 seconds",
    slide: str = "4 seconds",
    watermark: str | None = "1 second",
    out: str = "crime_count",
    ordered: bool = False,
    panes: bool = False,
) -> DataFrame:
    """Rows per (window, type) (R2): ``start, end, type, crime_count``.

    ``ordered`` sorts newest window first, then type (needs complete mode on
    a stream).  ``panes`` counts by :func:`pane_agg`.
    """
    if panes:
        res = pane_agg(df, ts, size, slide, {out: count_rows()}, [type_col], watermark)
    else:
        res = windowed_agg(df, ts, size, slide, [F.count(F.lit(1)).alias(out)], [type_col], watermark)
    if ordered:
        res = res.orderBy(*_window_order(True), F.col(type_col).asc_nulls_first())
    return res


def top_type(
    df: DataFrame,
    ts: str = "timestamp",
    type_col: str = "crime_type",
    size: str = "10 seconds",
    slide: str = "3 seconds",
    watermark: str | None = "1 second",
    out: str = "crime_count",
    per_window: bool = False,
) -> DataFrame:
    """The most frequent type.

    Default: the single (window, type) with the highest count over the whole
    input so far (a top-1; complete mode on a stream).  Ties go to the
    earlier window, then the smaller type.  ``per_window=True`` gives one row
    per window instead: its most frequent type, ties to the smaller type.
    """
    if not per_window:
        counts = windowed_agg(df, ts, size, slide, [F.count(F.lit(1)).alias(out)], [type_col],
                              watermark)
        return counts.orderBy(F.col(out).desc(), "start", "end",
                              F.col(type_col).asc_nulls_first()).limit(1)
    to_ntz = df.isStreaming and isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    counts = windowed_agg(df, ts, size, slide, [F.count(F.lit(1)).alias(out)], [type_col],
                          watermark, flatten=False)
    # min over (-count, type) = highest count, then smallest type.  Grouping
    # by the window struct keeps event time, so a stream can chain this
    # second aggregation (append mode).
    best = F.min(F.struct((-F.col(out)).alias("neg"), F.col(type_col).alias("t")))
    per = counts.groupBy("window").agg(best.alias("_b"))
    per = per.select("window", F.col("_b.t").alias(type_col), (-F.col("_b.neg")).alias(out))
    return flatten_window(per, to_ntz)


def distinct_types(
    df: DataFrame,
    ts: str = "timestamp",
    type_col: str = "crime_type",
    size: str = "12 seconds",
    slide: str = "4 seconds",
    watermark: str | None = "1 second",
    rsd: float = 0.05,
    out: str = "num_different_types",
    ordered: bool = False,
    panes: bool = False,
    lg_k: int = 12,
) -> DataFrame:
    """Approximate number of distinct types per window (R3), HyperLogLog++.

    The sketch is fixed-size per window, so it merges across tasks and
    micro-batches without holding the values.  ``panes`` sketches each pane
    once and merges the sketches into the windows (:func:`pane_agg`; error by
    ``lg_k``, see :func:`distinct_sketch`, instead of ``rsd``).
    """
    if panes:
        res = pane_agg(df, ts, size, slide, {out: distinct_sketch(type_col, lg_k)}, (), watermark)
    else:
        res = windowed_agg(df, ts, size, slide,
                           [F.approx_count_distinct(type_col, rsd).alias(out)], (), watermark)
    return res.orderBy(*_window_order(True)) if ordered else res


def type_window_counts(
    df: DataFrame,
    ts: str = "timestamp",
    type_col: str = "crime_type",
    value: str = "Anti-social behaviour",
    size: str = "10 seconds",
    slide: str = "3 seconds",
    watermark: str | None = "1 second",
    threshold: int = 2,
    out: str = "crime_count",
    flag: str | None = "alarm",
) -> DataFrame:
    """Count of one type per window (R4's table): ``start, end, crime_count``
    plus ``alarm = crime_count > threshold`` unless ``flag`` is None."""
    res = windowed_agg(df.filter(F.col(type_col) == F.lit(value)), ts, size, slide,
                       [F.count(F.col(type_col)).alias(out)], (), watermark)
    if flag:
        res = res.withColumn(flag, F.col(out) > F.lit(threshold))
    return res


def threshold_alarm(
    df: DataFrame,
    ts: str = "timestamp",
    type_col: str = "crime_type",
    value: str = "Anti-social behaviour",
    size: str = "10 seconds",
    slide: str = "3 seconds",
    watermark: str | None = "1 second",
    threshold: int = 2,
    out: str = "crime_count",
) -> DataFrame:
    """Windows where the type occurs more than ``threshold`` times (R4 alarm).

    Alarms are rows, so any sink can take them.  How often one fires on a
    stream is the output mode's choice: complete repeats every alarm each
    trigger, update fires when a window's count changes, append fires once
    when the window closes.
    """
    res = type_window_counts(df, ts, type_col, value, size, slide, watermark, threshold, out, None)
    return res.filter(F.col(out) > F.lit(threshold))
