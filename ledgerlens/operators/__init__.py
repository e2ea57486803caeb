from ledgerlens.operators.enrich import enriched_counts, postcode_prices
from ledgerlens.operators.groups import (
    bottom_groups_by_median,
    flag_share,
    top_groups_by_avg,
    value_spread,
)
from ledgerlens.operators.joins import bounded_broadcast, row_count_at_most
from ledgerlens.operators.mix import category_mix
from ledgerlens.operators.nearest import NearestIndex, nearest_point, open_index, store_index
from ledgerlens.operators.periods import busiest_month, monthly_counts, yoy_change
from ledgerlens.operators.shuffle import random_order
from ledgerlens.operators.summarize import Lookup, summarize
from ledgerlens.operators.windows import (
    distinct_types,
    threshold_alarm,
    top_type,
    type_counts,
    type_window_counts,
    windowed_agg,
)

__all__ = [
    "Lookup",
    "summarize",
    "bottom_groups_by_median",
    "bounded_broadcast",
    "busiest_month",
    "NearestIndex",
    "category_mix",
    "distinct_types",
    "enriched_counts",
    "flag_share",
    "monthly_counts",
    "nearest_point",
    "open_index",
    "store_index",
    "postcode_prices",
    "random_order",
    "row_count_at_most",
    "threshold_alarm",
    "top_groups_by_avg",
    "top_type",
    "type_counts",
    "type_window_counts",
    "value_spread",
    "windowed_agg",
    "yoy_change",
]
