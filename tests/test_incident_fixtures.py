"""Edge cases of the incident operators on tiny literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import (
    bottom_groups_by_median,
    enriched_counts,
    postcode_prices,
    threshold_alarm,
    type_counts,
    windowed_agg,
)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def incidents(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, crime_type string, postcode long")


@pytest.mark.parametrize("size,slide,expect", [
    ("10 seconds", "3 seconds", {3, 4}),
    ("12 seconds", "4 seconds", {3}),
    ("45 seconds", "15 seconds", {3}),
])
def test_windows_per_event(spark, size, slide, expect):
    for s in (0, 1, 2, 5, 7, 11):
        one = incidents(spark, [(at(s), "Drugs", 1)])
        n = windowed_agg(one, "timestamp", size, slide, [F.count(F.lit(1)).alias("n")]).count()
        assert n in expect, (s, n)


def test_alarm_fires_on_third_event_in_window(spark):
    two = incidents(spark, [(at(0), "Drugs", 1), (at(1), "Drugs", 1), (at(1), "Theft", 1)])
    assert threshold_alarm(two, "timestamp", "crime_type", "Drugs", "10 seconds", "3 seconds",
                           threshold=2).count() == 0
    three = incidents(spark, [(at(0), "Drugs", 1), (at(1), "Drugs", 1), (at(2), "Drugs", 1)])
    alarms = threshold_alarm(three, "timestamp", "crime_type", "Drugs", "10 seconds", "3 seconds",
                             threshold=2).collect()
    assert alarms and all(r.crime_count == 3 for r in alarms)
    assert all(r.start <= at(0) and at(2) < r.end for r in alarms)


def test_type_counts_per_window(spark):
    df = incidents(spark, [(at(0), "A", 1), (at(1), "A", 1), (at(1), "B", 1)])
    rows = type_counts(df, "timestamp", "crime_type", "12 seconds", "4 seconds").collect()
    got = {(r.start, r.crime_type): r.crime_count for r in rows}
    assert set(got.values()) == {1, 2}
    assert len(rows) == 6  # 3 windows x 2 types


def test_enrichment_fan_out_and_missing_postcode(spark):
    sales = spark.createDataFrame([(10, 100.0), (10, 200.0), (10, 600.0), (20, 5.0)],
                                  "postcode long, price double")
    events = incidents(spark, [
        (at(1), "Drugs", 10), (at(2), "Theft", 10),   # two events, three sales
        (at(3), "Drugs", None),                      # no postcode
        (at(4), "Drugs", 30),                        # postcode without sales
    ])
    out = enriched_counts(events, postcode_prices(sales), "postcode", "timestamp",
                          "45 seconds", "15 seconds").collect()
    assert {r.postcode for r in out} == {10}
    assert all(r.crime_count == 2 and r.average_price == 300.0 for r in out)
    assert len(out) == 3  # the events fall in 3 sliding windows


def test_median_tie_at_the_cut(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0)], "county string, price double")
    got = [r.county for r in bottom_groups_by_median(df, "county", "price", k=2).collect()]
    assert got == ["c", "a"]
