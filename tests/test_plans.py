"""Plan shape: pushdown, pruning, top-k, partial aggregation, no Python in
the hot path, no keyless joins."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from ledgerlens import plans
from ledgerlens.plans import house_view
from ledgerlens.plans.inspect import (
    plan_text,
    pushed_filters,
    read_schemas,
    scan_ancestors,
    slow_operators,
)
from ledgerlens.sources import land_raw

QUERIES = plans.QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_keyless_join(spark, name):
    plan = plan_text(QUERIES[name](spark, SF001))
    assert slow_operators(plan) == []


@pytest.mark.parametrize("name", ["top_groups_by_avg", "bottom_groups_by_median",
                                  "stream_top_type"])
def test_sort_limit_is_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan_text(QUERIES[name](spark, SF001))


@pytest.mark.parametrize("name", ["monthly_counts", "busiest_month", "yoy_change"])
def test_year_filter_reaches_scan(spark, name):
    filters = " ".join(pushed_filters(plan_text(QUERIES[name](spark, SF001))))
    assert "GreaterThanOrEqual(o_orderdate" in filters
    assert "LessThan(o_orderdate" in filters


def test_scan_reads_only_needed_columns(spark):
    schemas = read_schemas(plan_text(QUERIES["top_groups_by_avg"](spark, SF001)))
    assert "struct<o_custkey:bigint,o_totalprice:double>" in schemas
    assert "struct<c_custkey:bigint,c_nationkey:int>" in schemas
    assert "struct<n_nationkey:int,n_name:string>" in schemas
    monthly = read_schemas(plan_text(QUERIES["monthly_counts"](spark, SF001)))
    assert monthly == ["struct<o_orderdate:timestamp_ntz>"]


@pytest.mark.parametrize("name", ["top_groups_by_avg", "value_spread", "flag_share",
                                  "bottom_groups_by_median", "stream_type_counts",
                                  "stream_enriched"])
def test_aggregates_partially_before_shuffle(spark, name):
    assert "partial_" in plan_text(QUERIES[name](spark, SF001))


def test_enrichment_joins_aggregated_incidents(spark):
    plan = plan_text(QUERIES["stream_enriched"](spark, SF001))
    tree = plan.split("\n\n")[0]
    join_line = next(i for i, l in enumerate(tree.splitlines()) if "Join" in l)
    below = "\n".join(tree.splitlines()[join_line:])
    assert below.count("HashAggregate") >= 2  # incidents and prices both aggregated below the join


def test_small_dimensions_are_broadcast(spark):
    plan = plan_text(QUERIES["top_groups_by_avg"](spark, SF001))
    assert "BroadcastHashJoin" in plan


def test_landed_year_is_pruned(spark, scratch):
    out = os.path.join(scratch, f"landed_{uuid.uuid4().hex[:8]}")
    land_raw(house_view(spark, SF0001), out)
    plan = plan_text(spark.read.parquet(out).filter(F.col("date_year") == 1997))
    assert "PartitionFilters: [isnotnull(date_year" in plan and "(date_year#" in plan


def _first_above_orders(spark, name):
    chain = scan_ancestors(plan_text(QUERIES[name](spark, SF001)), "orders.parquet")
    firsts = [op for op in chain if "Aggregate" in op or "Join" in op]
    assert firsts, chain
    return firsts[0]


@pytest.mark.parametrize("name", ["top_groups_by_avg", "flag_share"])
def test_orders_aggregated_before_place_join(spark, name):
    """Grouped by place only: orders are aggregated per customer before the join."""
    assert "Aggregate" in _first_above_orders(spark, name)


@pytest.mark.parametrize("name", ["yoy_change", "busiest_month", "category_mix", "value_spread"])
def test_fact_side_keys_join_rows_first(spark, name):
    """Grouped also by order columns: join rows, aggregate partially after."""
    assert "Join" in _first_above_orders(spark, name)


def test_rank_one_pick_is_a_group_limit(spark):
    assert "WindowGroupLimit" in plan_text(QUERIES["busiest_month"](spark, SF001))


def test_ordered_presentations(spark):
    from ledgerlens.operators import distinct_types, type_counts
    from ledgerlens.plans import incident_view

    inc = incident_view(spark, SF001)
    rows = type_counts(inc, "timestamp", "crime_type", "12 hours", "4 hours", ordered=True).collect()
    keys = [(r.start, r.crime_type) for r in rows]
    assert keys == sorted(keys, key=lambda k: (-k[0].timestamp(), k[1]))
    starts = [r.start for r in distinct_types(inc, "timestamp", "crime_type", "12 hours", "4 hours",
                                              ordered=True).collect()]
    assert starts == sorted(starts, reverse=True)


@pytest.mark.parametrize("name", ["value_spread", "yoy_change", "busiest_month", "category_mix",
                                  "bottom_groups_by_median"])
def test_orders_are_not_shuffled_to_the_places(spark, name):
    """Left-deep joins: the initial plan broadcasts customer and nation, and
    order rows meet no exchange before their first aggregate."""
    above = scan_ancestors(plan_text(QUERIES[name](spark, SF001)), "orders.parquet")
    first = next(i for i, op in enumerate(above) if "Aggregate" in op)
    assert not any("Exchange" in op for op in above[:first])
    assert sum(op.startswith("BroadcastHashJoin") for op in above[:first]) == 2
