from ledgerlens.functions.numeric import percent, round_columns, stable_round
from ledgerlens.functions.time import (
    as_event_time,
    in_years,
    instant_to_ntz,
    month_name,
    ntz_to_instant,
)

__all__ = [
    "as_event_time",
    "in_years",
    "instant_to_ntz",
    "month_name",
    "ntz_to_instant",
    "percent",
    "round_columns",
    "stable_round",
]
