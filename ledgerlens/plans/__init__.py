from ledgerlens.plans.oracle import oracle_sql
from ledgerlens.plans.queries import QUERIES
from ledgerlens.plans.views import (
    house_lookup,
    house_view,
    incident_points,
    incident_view,
    places,
    postcode_points,
    table,
)

__all__ = ["QUERIES", "house_lookup", "house_view", "incident_points", "incident_view", "places",
           "postcode_points", "oracle_sql", "table"]
