"""Grouped summaries that aggregate before a lookup join (eager aggregation).

When the group columns live in a lookup table reached through a key of the
fact rows (sales -> customer -> county), the plain plan joins every fact row
and then aggregates: the join shuffles and sorts the whole fact table, and a
key holding a third of the rows lands in one join partition.  With mergeable
measures the fact rows can be aggregated per (key, fact-side group) first:
the shuffle carries partial results, a hot key collapses to one row per task
before it, and the join meets one row per key instead of one per fact row.
(Eager aggregation; Yan and Larson, VLDB 1995.)

``summarize(src, keys, measures)`` takes either a DataFrame (one ordinary
``groupBy``) or a :class:`Lookup` (partial aggregate, join, merge).

Eager aggregation pays when many fact rows share a (key, fact-side group).
With group keys only from the lookup, every fact row of a key collapses
(orders per customer); once fact-side keys (year, month, type) split the key
further, few rows share a group and the extra aggregate costs more than it
saves.  Measured on 7.5M orders / 750k customers (local[8]): by county only,
eager 2.0 s vs 3.2 s row-level with a customer holding a third of the
orders; by (county, type), eager 4.3 s vs 2.8 s without skew.  So by
default (``eager=None``) a Lookup aggregates eagerly only when all group
keys come from the lookup; otherwise it joins rows and Spark aggregates
partially after the join (AQE splits a skewed join partition).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """Fact rows whose extra columns come from ``table`` through ``key``.

    ``table`` has one row per ``table_key`` (a lookup), so joining never
    multiplies fact rows; fact rows without a match get nulls (left join).
    ``hop`` is a second lookup, reached through a column of ``table``.  It is
    joined after ``table`` (left-deep): a frame of two joined lookups looks
    large to the planner, which would then shuffle every fact row to it.
    ``filter`` and ``withColumn`` act on the fact rows, like on a DataFrame.
    """

    fact: DataFrame
    key: str
    table: DataFrame
    table_key: str
    eager: bool | None = None  # None: eager only when all group keys are lookup columns
    hop: tuple[str, DataFrame, str] | None = None  # (column of table, second lookup, its key)

    @property
    def schema(self):
        return self.fact.schema

    @property
    def columns(self) -> list[str]:
        extra = [c for c in self.table.columns if c != self.table_key]
        if self.hop:
            through, second, key = self.hop
            extra = [c for c in extra if c != through] + [c for c in second.columns if c != key]
        return self.fact.columns + extra

    def filter(self, condition: Column) -> Lookup:
        return replace(self, fact=self.fact.filter(condition))

    def withColumn(self, name: str, col: Column) -> Lookup:  # noqa: N802 (DataFrame spelling)
        return replace(self, fact=self.fact.withColumn(name, col))

    def rows(self) -> DataFrame:
        """The joined row-level table."""
        return self.attach(self.fact, self.key)

    def attach(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with the lookup columns of its column ``key``."""
        t = self.table.withColumnRenamed(self.table_key, "_lookup_key")
        df = df.join(t, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")
        if self.hop:
            through, second, second_key = self.hop
            second = second.withColumnRenamed(second_key, "_hop_key")
            df = df.join(second, F.col(through) == F.col("_hop_key"), "left").drop("_hop_key", through)
        return df


Source = DataFrame | Lookup


def rows_of(src: Source, needed: Sequence[str] = ()) -> DataFrame:
    """Row-level frame: the fact rows alone when ``needed`` columns are all
    fact columns (the left join to a lookup keeps them one-to-one), else
    the joined rows."""
    if isinstance(src, DataFrame):
        return src
    if needed and set(needed) <= set(src.fact.columns):
        return src.fact
    return src.rows()


@dataclass(frozen=True)
class Measure:
    """An aggregate given three ways: over raw rows, as partial aggregates
    over fact rows, and as the merge of those partials."""

    on_rows: Callable[[], Column]
    parts: Callable[[str, set], list[Column]]
    merge: Callable[[str, set], Column]


def mean(col: str) -> Measure:
    return Measure(
        lambda: F.avg(col),
        lambda p, fact: [F.sum(col).alias(f"{p}_s"), F.count(col).alias(f"{p}_n")],
        lambda p, fact: F.try_divide(F.sum(f"{p}_s"), F.sum(f"{p}_n")),
    )


def maximum(col: str) -> Measure:
    return Measure(lambda: F.max(col), lambda p, fact: [F.max(col).alias(p)],
                   lambda p, fact: F.max(p))


def minimum(col: str) -> Measure:
    return Measure(lambda: F.min(col), lambda p, fact: [F.min(col).alias(p)],
                   lambda p, fact: F.min(p))


def count_rows() -> Measure:
    return Measure(lambda: F.count(F.lit(1)), lambda p, fact: [F.count(F.lit(1)).alias(p)],
                   lambda p, fact: F.sum(p))


def count_true(predicate: Column) -> Measure:
    """Rows where a fact-side predicate is true."""
    return Measure(lambda: F.count_if(predicate), lambda p, fact: [F.count_if(predicate).alias(p)],
                   lambda p, fact: F.sum(p))


def count_nonnull(col: str) -> Measure:
    """Rows where ``col`` is not null; ``col`` may be a lookup column, whose
    nullness is only known after the join."""
    def parts(p, fact):
        return [F.count(col if col in fact else F.lit(1)).alias(p)]

    def merge(p, fact):
        if col in fact:
            return F.sum(p)
        return F.coalesce(F.sum(F.when(F.col(col).isNotNull(), F.col(p))), F.lit(0).cast("bigint"))

    return Measure(lambda: F.count(col), parts, merge)


def distinct_sketch(col: str, lg_k: int = 12) -> Measure:
    """About how many distinct non-null values: a HyperLogLog sketch that
    merges, so raw rows are read once whatever they are merged into.  The
    relative standard error is ``1.04 / sqrt(2 ** lg_k)`` at most (1.6 % at
    12); small numbers are exact."""
    return Measure(lambda: F.hll_sketch_estimate(F.hll_sketch_agg(col, F.lit(lg_k))),
                   lambda p, fact: [F.hll_sketch_agg(col, F.lit(lg_k)).alias(p)],
                   lambda p, fact: F.hll_sketch_estimate(F.hll_union_agg(p, F.lit(False))))


def quantile_sketch(col: str, fraction: float = 0.5, k: int = 4096) -> Measure:
    """A value of rank about ``fraction`` (the lower one in the middle of an
    even count), from a KLL sketch that merges.  Exact for groups of up to
    ``k`` values; beyond, the rank is off by about ``2.3 / k ** 0.9`` of the
    group (0.13 % at 4096) with 99 % confidence.  Null without values."""
    def value(sketch: Column) -> Column:
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(fraction)))

    def agg() -> Column:
        return F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k))

    return Measure(lambda: value(agg()), lambda p, fact: [agg().alias(p)],
                   lambda p, fact: value(F.kll_merge_agg_double(p, F.lit(k))))


def summarize(src: Source, keys: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """``groupBy(*keys)`` with the named measures, eagerly through a Lookup."""
    if isinstance(src, DataFrame):
        return src.groupBy(*keys).agg(*[m.on_rows().alias(n) for n, m in measures.items()])
    fact = set(src.fact.columns)
    fact_keys = [k for k in keys if k in fact]
    eager = src.eager if src.eager is not None else not fact_keys
    if not eager:
        return summarize(src.rows(), keys, measures)
    parts = [c for n, m in measures.items() for c in m.parts(f"_{n}", fact)]
    pre = src.fact.groupBy(F.col(src.key).alias("_fact_key"), *fact_keys).agg(*parts)
    joined = src.attach(pre, "_fact_key")
    return joined.groupBy(*keys).agg(*[m.merge(f"_{n}", fact).alias(n) for n, m in measures.items()])
