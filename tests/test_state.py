"""Replayed messages, alarms that fire once, the running top row, panes and merged sketches."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlens.operators import bottom_groups_by_median, distinct_types, type_counts, type_window_counts, windowed_agg
from ledgerlens.operators.summarize import Lookup, count_rows, distinct_sketch, mean, quantile_sketch
from ledgerlens.operators.windows import micros, pane_agg
from ledgerlens.plans.inspect import plan_text, scan_ancestors
from ledgerlens.plans.views import house_lookup, incident_view
from ledgerlens.streaming import best_row, drop_replays, first_alarms, read_epochs, start_fan_out, start_memory, stored

SCHEMA = "ts timestamp, id long, kind string"
NOW = {"availableNow": True}
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def folder(scratch):
    return os.path.join(scratch, f"state_{uuid.uuid4().hex[:8]}")


def put(spark, folder, number, events):
    """One file of (second, id, kind) events, read in the order of ``number``."""
    rows = [(START + dt.timedelta(seconds=s), i, k) for s, i, k in events]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in/n={number:03d}")
    for top, _, names in os.walk(f"{folder}/in/n={number:03d}"):
        for name in names:
            os.utime(os.path.join(top, name), (1_000_000 + number * 10,) * 2)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def counts(df, watermark="5 seconds"):
    return type_window_counts(df, "ts", "kind", "bad", "10 seconds", "5 seconds", watermark, 2)


def test_replayed_messages_count_once(spark, folder):
    batches = [[(n * 7 + k, n * 10 + k, "bad") for k in range(6)] for n in range(8)]
    for n, events in enumerate(batches):
        put(spark, folder, 2 * n, events + events[:2])
        put(spark, folder, 2 * n + 1, events)  # the whole file again
    once = drop_replays(stream(spark, folder), ["id"], "ts", "20 seconds")
    name = f"t{uuid.uuid4().hex[:8]}"
    q = start_memory(once, name, "append", f"{folder}/check", NOW)
    q.awaitTermination(300)
    got = sorted(r["id"] for r in spark.table(name).collect())
    assert got == sorted(i for events in batches for _, i, _ in events)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] < 40 and max(held) < len(got)  # keys go as the watermark passes them


def test_replays_equal_the_clean_batch(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "ts")
    assert drop_replays(events.union(events), ["event_id"]).count() == events.count()


def run_alarms(spark, folder):
    writer = first_alarms(f"{folder}/fired", f"{folder}/out", flag="alarm", delay="5 seconds")
    seen = []

    def replayed(batch, epoch):  # every epoch twice, as after a failure between writing and committing
        writer(batch, epoch)
        writer(batch, epoch)
        seen.append(epoch)

    start_fan_out(counts(stream(spark, folder)), [replayed], f"{folder}/check", "update", NOW).awaitTermination(300)
    return seen


def test_an_alarm_fires_once_through_replays_and_restarts(spark, folder):
    put(spark, folder, 0, [(1, 1, "bad"), (2, 2, "bad"), (3, 3, "good")])
    put(spark, folder, 1, [(4, 4, "bad")])  # three in [0, 10) and in [-5, 5)
    first = run_alarms(spark, folder)
    alarms = [r["start"] for r in read_epochs(spark.range(1), f"{folder}/out").collect()]
    assert sorted(alarms) == [START - dt.timedelta(seconds=5), START]
    put(spark, folder, 2, [(6, 5, "bad"), (7, 6, "bad")])  # [0, 10) grows, [5, 15) begins
    put(spark, folder, 3, [(8, 7, "bad"), (60, 8, "bad")])
    put(spark, folder, 4, [(61, 9, "bad"), (62, 10, "bad")])
    put(spark, folder, 5, [(200, 11, "bad")])
    again = run_alarms(spark, folder)
    assert min(again) > max(first)  # went on, did not start anew
    alarms = [r["start"] for r in read_epochs(spark.range(1), f"{folder}/out").collect()]
    want = [-5, 0, 5, 55, 60]
    assert sorted(alarms) == [START + dt.timedelta(seconds=s) for s in want]
    held = spark.read.parquet(f"{folder}/fired").count()
    assert held <= 2 * 3  # windows that cannot change any more are forgotten


def test_running_top_equals_complete_mode_after_every_epoch(spark, folder):
    batches = [[(n * 3 + k % 4, n * 10 + k, ("a", "b", "c")[(n * k + n) % 3]) for k in range(5 + n % 4)] for n in range(9)]
    for n, events in enumerate(batches):
        put(spark, folder, n, events)
    by_type = type_counts(stream(spark, folder), "ts", "kind", "10 seconds", "5 seconds", "30 seconds")
    order = [F.col("crime_count").desc(), "start", "end", F.col("kind").asc_nulls_first()]
    keep, got = best_row(f"{folder}/best", order), {}

    def write(batch, epoch):
        keep(batch, epoch)
        table = stored(batch, f"{folder}/best", epoch)
        got[epoch] = [tuple(r) for r in table.collect()]

    start_fan_out(by_type, [write], f"{folder}/check", "update", NOW).awaitTermination(300)
    for epoch in range(len(batches)):
        rows = [(START + dt.timedelta(seconds=s), i, k) for events in batches[:epoch + 1] for s, i, k in events]
        so_far = type_counts(spark.createDataFrame(rows, SCHEMA), "ts", "kind", "10 seconds", "5 seconds")
        assert got[epoch] == [tuple(r) for r in so_far.orderBy(*order).limit(1).collect()], epoch


@pytest.mark.parametrize("size,slide", [("10 hours", "3 hours"), ("12 hours", "4 hours"), ("45 minutes", "20 minutes"),
                                        ("1 hour 30 minutes", None), ("7 hours", "7 hours")])
def test_panes_equal_copied_rows(spark, size, slide):
    events = incident_view(spark, SF001).select("timestamp", "crime_type", F.col("postcode").cast("double").alias("v"))
    want = windowed_agg(events, "timestamp", size, slide, [F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 6).alias("m")], ["crime_type"])
    got = pane_agg(events, "timestamp", size, slide, {"n": count_rows(), "m": mean("v")}, ["crime_type"])
    got = got.withColumn("m", F.round("m", 6))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_first_aggregate_of_panes_reads_event_rows_only(spark):
    plan = plan_text(type_counts(incident_view(spark, SF001), "timestamp", "crime_type", "10 hours", "3 hours", panes=True))
    above = scan_ancestors(plan, "events.parquet")
    first = next(i for i, op in enumerate(above) if "Aggregate" in op)
    assert not any("Expand" in op or "Generate" in op for op in above[:first])
    copied = scan_ancestors(plan_text(type_counts(incident_view(spark, SF001), "timestamp", "crime_type", "10 hours", "3 hours")),
                            "events.parquet")
    assert any("Expand" in op for op in copied[:next(i for i, op in enumerate(copied) if "Aggregate" in op)])


def test_panes_on_a_stream(spark, folder):
    for n in range(6):
        put(spark, folder, n, [(n * 4 + k, n * 10 + k, "ab"[k % 2]) for k in range(4)])
    put(spark, folder, 9, [(500, 99, "a")])
    res = type_counts(stream(spark, folder), "ts", "kind", "10 seconds", "4 seconds", "1 second", panes=True)
    name = f"t{uuid.uuid4().hex[:8]}"
    start_memory(res, name, "append", f"{folder}/check", NOW).awaitTermination(300)
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/in/*")
    want = type_counts(rows, "ts", "kind", "10 seconds", "4 seconds").filter(F.col("start") < START + dt.timedelta(seconds=400))
    assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, want.collect()))


def test_merged_distinct_sketch_is_within_its_error(spark):
    d = spark.range(200_000).select((F.timestamp_seconds(F.col("id") % 3600)).alias("ts"), (F.col("id") * 7 % 60_000).alias("v"))
    got = pane_agg(d, "ts", "40 minutes", "10 minutes", {"n": distinct_sketch("v")})
    want = {r["start"]: r["n"] for r in windowed_agg(d, "ts", "40 minutes", "10 minutes", [F.countDistinct("v").alias("n")]).collect()}
    for r in got.collect():
        assert abs(r["n"] - want[r["start"]]) <= 4 * 1.04 / 2 ** 6 * want[r["start"]]
    few = incident_view(spark, SF001)
    assert distinct_types(few, panes=True, size="12 hours", slide="4 hours").exceptAll(
        distinct_types(few, size="12 hours", slide="4 hours").withColumn("num_different_types", F.col("num_different_types").cast("long"))).count() == 0


def test_medians_merge_through_the_join(spark):
    """Exact for small groups, and what is shuffled are sketches per customer, never orders."""
    src = house_lookup(spark, SF001)
    exact = {r["county"]: r["m"] for r in src.rows().groupBy("county").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY price)").alias("m")).collect()}
    res = bottom_groups_by_median(src, "county", "price", k=100, accuracy=32768, sketch="kll")
    assert {r["county"]: r["median_price"] for r in res.collect()} == exact
    above = scan_ancestors(plan_text(res), "orders.parquet")
    first = next(i for i, op in enumerate(above) if "Exchange" in op)
    assert any("Aggregate" in op for op in above[:first]) and not any("Join" in op for op in above[:first])


def test_quantile_sketch_of_nulls_and_many_values(spark):
    fact = spark.range(100_000).select((F.col("id") % 1000).alias("k"), ((F.col("id") * 7919) % 100_003).cast("double").alias("v"))
    fact = fact.unionByName(spark.createDataFrame([(5000, None)], "k long, v double"))
    table = spark.range(1001).select(F.col("id").alias("key"), (F.col("id") % 2).alias("g"))
    from ledgerlens.operators.summarize import summarize
    got = {r["g"]: r["m"] for r in summarize(Lookup(fact, "k", table, "key", eager=True), ["g"], {"m": quantile_sketch("v")}).collect()}
    assert got[None] is None
    for g in (0, 1):
        below = fact.filter((F.col("k") % 2 == g) & (F.col("v") <= got[g])).count() / 50_000
        assert abs(below - 0.5) < 0.005


def test_interval_lengths():
    assert micros("1 hour 30 minutes") == 5_400_000_000 and micros("10 seconds") == 10_000_000 and micros("0.5 seconds") == 500_000
    for bad in ("", "1 month", "seconds", "3"):
        with pytest.raises(ValueError):
            micros(bad)
