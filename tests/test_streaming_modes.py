"""Output modes, late rows, pass-through decode, alarms and console sink."""

import datetime as dt
import functools
import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlens.operators import threshold_alarm, windowed_agg
from ledgerlens.plans import queries as Q
from ledgerlens.schemas import INCIDENT
from ledgerlens.sources import decode_csv, encode_csv
from ledgerlens.streaming import checkpoint_path, start_alarm, start_console, start_memory

AVAILABLE_NOW = {"availableNow": True}


def one_row_files(folder, seconds):
    """One CSV file per event, oldest first (a file source reads them in
    modification-time order, one per trigger)."""
    os.makedirs(folder)
    for i, s in enumerate(seconds):
        path = os.path.join(folder, f"part-{i:03d}.csv")
        stamp = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)
        with open(path, "w") as f:
            f.write(f"{stamp:%Y-%m-%d %H:%M:%S},x\n")
        os.utime(path, (1_000_000 + i * 10, 1_000_000 + i * 10))
    return folder


def late_counts(spark, folder, mode):
    stream = (spark.readStream.schema("ts timestamp, kind string")
              .option("maxFilesPerTrigger", 1).csv(folder))
    counts = windowed_agg(stream, "ts", "10 seconds", None, [F.count(F.lit(1)).alias("n")],
                          (), "1 second")
    name = "late_" + uuid.uuid4().hex[:8]
    q = start_memory(counts, name, mode, checkpoint_path(spark, name), AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    first = dt.datetime(1970, 1, 1)
    rows = spark.table(name).filter(F.col("start") == F.lit(first)).collect()
    return rows[-1].n if rows else None


@pytest.fixture(scope="module")
def utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.mark.parametrize("mode,expect", [("complete", 2), ("append", 1), ("update", 1)])
def test_late_row_two_batches_after_watermark_moves(spark, scratch, utc, mode, expect):
    folder = one_row_files(os.path.join(scratch, f"late_{uuid.uuid4().hex[:8]}"), [0, 1000, 1001, 2])
    assert late_counts(spark, folder, mode) == expect


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_late_row_in_next_batch_still_counts(spark, scratch, utc, mode):
    folder = one_row_files(os.path.join(scratch, f"late_{uuid.uuid4().hex[:8]}"), [0, 1000, 2])
    assert late_counts(spark, folder, mode) == 2


def test_passthrough_decode_append(spark, scratch):
    """Decoded rows pass through unchanged (append mode, stateless)."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    folder = os.path.join(scratch, f"msgs_{uuid.uuid4().hex[:8]}")
    encode_csv(events, ["event_id", "ts", "user_id", "event_type"]).repartition(3) \
        .write.text(folder)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"
    from pyspark.sql.types import _parse_datatype_string
    messages = spark.readStream.format("text").load(folder)
    decoded = decode_csv(messages, _parse_datatype_string(schema), keep=(), drop=())
    name = "pass_" + uuid.uuid4().hex[:8]
    q = start_memory(decoded, name, "append", checkpoint_path(spark, name), AVAILABLE_NOW)
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table(name).collect())
    want = sorted(tuple(r) for r in events.select("event_id", "ts", "user_id", "event_type").collect())
    assert got == want


def test_incident_schema_decode_stream(spark, scratch):
    """Decode with the 12-column incident schema drops key and falls_within."""
    folder = os.path.join(scratch, f"inc_{uuid.uuid4().hex[:8]}")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.txt"), "w") as f:
        f.write("k,2013-12,F,W,-1.2,51.5,On or near,E01,N,Drugs,Done,\n")
    stream = spark.readStream.format("text").load(folder).withColumn("timestamp", F.current_timestamp())
    decoded = decode_csv(stream, INCIDENT)
    assert decoded.columns[0] == "timestamp"
    assert "key" not in decoded.columns and "falls_within" not in decoded.columns
    assert len(decoded.columns) == 1 + 12 - 2


def _record_alarm(folder, row):
    # Runs on an executor: leave one file per alarm row.
    import os as _os
    import uuid as _uuid
    with open(_os.path.join(folder, _uuid.uuid4().hex), "w") as f:
        f.write(f"{row['start']},{row['crime_count']}\n")


def test_alarm_callback_runs_per_alarm_row(spark, scratch):
    folder = os.path.join(scratch, f"alarms_{uuid.uuid4().hex[:8]}")
    os.makedirs(folder)
    events = spark.read.parquet(f"{SF001}/events.parquet")
    stream = (spark.readStream.schema(events.schema)
              .option("pathGlobFilter", "events.parquet").parquet(SF001))
    incidents = stream.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("crime_type"))
    alarms = threshold_alarm(incidents, "timestamp", "crime_type", Q.ALARM_TYPE,
                             *Q.TOP_TYPE_WINDOW, Q.WATERMARK, threshold=25)
    q = start_alarm(alarms, functools.partial(_record_alarm, folder), checkpoint_path(spark, "alarm_" + uuid.uuid4().hex[:8]),
                    mode="complete", trigger=AVAILABLE_NOW)
    q.awaitTermination(300)
    assert q.exception() is None
    batch = threshold_alarm(events.select(F.col("ts").alias("timestamp"),
                                          F.col("event_type").alias("crime_type")),
                            "timestamp", "crime_type", Q.ALARM_TYPE, *Q.TOP_TYPE_WINDOW,
                            Q.WATERMARK, threshold=25)
    assert len(glob.glob(os.path.join(folder, "*"))) == batch.count() > 0


def test_console_sink_starts(spark):
    events = spark.read.parquet(f"{SF001}/events.parquet")
    stream = (spark.readStream.schema(events.schema)
              .option("pathGlobFilter", "events.parquet").parquet(SF001))
    q = start_console(stream.groupBy("event_type").count(), "complete", rows=5,
                      trigger=AVAILABLE_NOW,
                      checkpoint=checkpoint_path(spark, "console_" + uuid.uuid4().hex[:8]))
    q.awaitTermination(300)
    assert q.exception() is None


def test_ntz_instant_round_trip_in_dst_zone(spark):
    """NTZ <-> instant keeps epoch microseconds whatever the session zone,
    across daylight-saving changes too."""
    from ledgerlens.functions import instant_to_ntz, ntz_to_instant

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),), (dt.datetime(2024, 7, 1, 12, 30, 0, 1),),
             (dt.datetime(2024, 3, 10, 2, 30),), (dt.datetime(1969, 12, 31, 23, 59, 59, 999999),)],
            "ts timestamp_ntz")
        out = df.select("ts", F.unix_micros(ntz_to_instant(F.col("ts"))).alias("us"),
                        instant_to_ntz(ntz_to_instant(F.col("ts"))).alias("back")).collect()
        for r in out:
            expect = (r.ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            assert r.us == expect and r.back == r.ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
