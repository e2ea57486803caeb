"""Sources and sinks: declared-schema CSV, message decode, publish, landing,
combine-and-shuffle."""

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001, SF001
from ledgerlens.operators import (
    bounded_broadcast,
    monthly_counts,
    random_order,
    row_count_at_most,
    type_counts,
)
from ledgerlens.plans import house_view
from ledgerlens.plans.inspect import plan_text
from ledgerlens.plans import queries as Q
from ledgerlens.schemas import HOUSE, INCIDENT
from ledgerlens.sinks import publish_csv, save_table
from ledgerlens.sources import combine_shuffle, csv_headers, decode_csv, encode_csv, land_raw, read_table
from ledgerlens.streaming import checkpoint_path, start_memory


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def fresh(scratch, stem):
    return os.path.join(scratch, f"{stem}_{uuid.uuid4().hex[:8]}")


def test_house_csv_declared_schema(spark, scratch):
    path = write_text(fresh(scratch, "house"), "h.csv", "\n".join([
        '"{A}","18500","1995-01-31 00:00","AB1 2CD","D","Y","F","1","","ST","LOC","TOWN","DIST","COUNTY","A","A"',
        '"{B}","x","bad","","S","N","L","2","","ST","","TOWN","DIST","","A","A"',
    ]) + "\n")
    rows = read_table(spark, path, HOUSE).collect()
    assert len(rows) == 2
    a, b = rows
    assert a.price == 18500.0 and str(a.date) == "1995-01-31 00:00:00" and a.postcode == "AB1 2CD"
    assert (b.price, b.date, b.postcode, b.county) == (None, None, None, None)
    assert b.transaction_id == "{B}" and b.town == "TOWN"


def test_decode_header_bom_extra_and_empty(spark):
    header = ("Crime ID,Month,Reported by,Falls within,Longitude,Latitude,Location,"
              "LSOA code,LSOA name,Crime type,Last outcome category,Context")
    lines = [
        "﻿" + header,
        ",2013-12,Force,Force,,,On or near X,E01,Name,Burglary,Under investigation,",
        "k1,2013-12,Force,Force,-1.5,52.1,On or near Y,E02,Name,Drugs,Done,,EXTRA,MORE",
        "",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "timestamp long, value string")
    out = decode_csv(df, INCIDENT, header=header).orderBy("timestamp").collect()
    assert [r.timestamp for r in out] == [1, 2, 3]
    assert "key" not in out[0].asDict() and "falls_within" not in out[0].asDict()
    assert (out[0].longitude, out[0].latitude, out[0].crime_type) == (None, None, "Burglary")
    assert (out[1].longitude, out[1].crime_type, out[1].context) == (-1.5, "Drugs", None)
    assert out[2].crime_type is None and out[2].month is None
    # Without the header option the title row decodes as an event.
    raw = decode_csv(df, INCIDENT).orderBy("timestamp").first()
    assert raw.crime_type == "Crime type"


def test_decode_flags_corrupt_rows(spark):
    good = ",2013-12,F,F,1.0,2.0,L,E,N,Drugs,O,C"
    df = spark.createDataFrame([(1, good), (2, good + ",EXTRA"), (3, "k,2013-12,F,F,abc")],
                               "timestamp long, value string")
    out = {r.timestamp: r for r in decode_csv(df, INCIDENT, corrupt_col="_corrupt").collect()}
    assert out[1]._corrupt is None
    assert out[2]._corrupt == good + ",EXTRA"
    assert out[3]._corrupt is not None


def test_encode_decode_keeps_commas(spark):
    df = spark.createDataFrame([(1, "a,b", 'say "hi"', 2.5)], "timestamp long, s string, q string, x double")
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("q", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    back = decode_csv(encode_csv(df, ["s", "q", "x"], keep=["timestamp"]), schema, drop=()).first()
    assert (back.s, back.q, back.x) == ("a,b", 'say "hi"', 2.5)


def test_publish_then_stream_decode(spark, scratch):
    """Events published as CSV lines, read back as a stream of messages,
    decoded and aggregated: the batch answer."""
    out = fresh(scratch, "topic")
    events = spark.read.parquet(f"{SF001}/events.parquet").repartition(3)
    publish_csv(events, {"path": out}, fmt="text",
                columns=["event_id", "ts", "user_id", "event_type"])
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    messages = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(out)
    decoded = decode_csv(messages, schema, keep=(), drop=(),
                         options={"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
    counts = type_counts(decoded, "ts", "event_type", *Q.TYPE_COUNT_WINDOW, Q.WATERMARK)
    name = "pub_" + uuid.uuid4().hex[:8]
    q = start_memory(counts, name, "complete", checkpoint_path(spark, name), {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    want = type_counts(events, "ts", "event_type", *Q.TYPE_COUNT_WINDOW)
    assert sorted(spark.table(name).collect()) == sorted(want.collect())


def test_land_raw_partitions_and_is_idempotent(spark, scratch):
    out = fresh(scratch, "landed")
    sales = house_view(spark, SF0001)
    land_raw(sales, out)
    land_raw(sales.filter(F.year("date") == 1997), out)  # re-land one year
    landed = spark.read.parquet(out)
    assert landed.count() == sales.count()
    one = monthly_counts(landed, "date", 1997)
    assert "PartitionFilters: [isnotnull(date_year" in plan_text(one)
    one = landed.filter(F.col("date_year") == 1997)
    assert one.count() == sales.filter(F.year("date") == 1997).count()
    years = sorted(d for d in os.listdir(out) if d.startswith("date_year="))
    assert years and len(years) == landed.select("date_year").distinct().count()


def test_combine_shuffle_by_name(spark, scratch):
    folder = fresh(scratch, "combine")
    a = write_text(folder, "a.csv", "id,kind\n1,x\n2,y\n3,z\n")
    b = write_text(folder, "b.csv", "kind,id,extra\nw,4,e\n")
    df = combine_shuffle(spark, [a, b], seed=3)
    got = sorted((r.id, r.kind, r.extra) for r in df.collect())
    assert got == [("1", "x", None), ("2", "y", None), ("3", "z", None), ("4", "w", "e")]


def test_combine_shuffle_aligns_swapped_headers(spark, scratch):
    folder = fresh(scratch, "swapped")
    a = write_text(folder, "a.csv", "id,kind\n1,x\n")
    b = write_text(folder, "b.csv", "kind,id\nz,3\n")
    c = write_text(folder, "c.csv", "id,kind\n5,v\n")
    got = sorted((r.id, r.kind) for r in combine_shuffle(spark, [a, b, c]).collect())
    assert got == [("1", "x"), ("3", "z"), ("5", "v")]


def test_landing_writes_few_files(spark, scratch):
    """Files follow the years, not tasks times years."""
    out = fresh(scratch, "few")
    land_raw(house_view(spark, SF0001, with_place=False).repartition(24), out)
    files = [f for d, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * len([d for d in os.listdir(out) if d.startswith("date_year=")])


def test_random_order_is_a_permutation(spark):
    df = spark.range(0, 5000)
    shuffled = random_order(df, seed=11, partitions=4)
    ids = [r.id for r in shuffled.collect()]
    assert sorted(ids) == list(range(5000))
    assert ids != list(range(5000))
    assert ids == [r.id for r in random_order(df, seed=11, partitions=4).collect()]


def test_save_table_overwrite(spark, scratch):
    out = fresh(scratch, "saved")
    df = spark.range(10)
    save_table(df, out)
    save_table(df, out)
    assert spark.read.parquet(out).count() == 10


def test_row_count_bound(spark):
    assert row_count_at_most(spark.range(5), 5)
    assert not row_count_at_most(spark.range(6), 5)


def test_broadcast_is_bounded_in_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(df))
    assert not hinted(bounded_broadcast(df, max_rows=99))
    assert not hinted(bounded_broadcast(df, max_bytes=100_000))


def test_read_topic_with_any_streaming_format(spark, scratch):
    """S2 without a broker: the same call with a file format and a path."""
    from ledgerlens.sources import read_topic
    folder = write_text(fresh(scratch, "topicfiles"), "m.txt",
                        ",2013-12,F,W,-1.2,51.5,L,E01,N,Drugs,Done,\n")
    stream = read_topic(spark, {"path": os.path.dirname(folder)}, fmt="text")
    assert stream.isStreaming and stream.columns == ["value"]
    decoded = decode_csv(stream.withColumn("timestamp", F.current_timestamp()), INCIDENT)
    name = "topic_" + uuid.uuid4().hex[:8]
    q = start_memory(decoded, name, "append", checkpoint_path(spark, name), {"availableNow": True})
    q.awaitTermination(120)
    (row,) = spark.table(name).collect()
    assert (row.crime_type, row.longitude) == ("Drugs", -1.2)


def _csv_file(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_combine_folder_by_name(spark, scratch):
    """Files of one folder with columns in other orders, a byte-order mark, quoted names, no rows, and nothing at all."""
    folder = os.path.join(scratch, f"combine {uuid.uuid4().hex[:6]}")
    _csv_file(f"{folder}/a.csv", "id,kind\n1,x\n2,y\n")
    _csv_file(f"{folder}/b c%20d.csv", "kind,id\nz,3\n")
    _csv_file(f"{folder}/c.csv", "﻿id,kind\n4,w\n")
    _csv_file(f"{folder}/d.csv", '"id","more, and"\n5,"p,q"\n')
    _csv_file(f"{folder}/e.csv", "kind,id\n")
    _csv_file(f"{folder}/f.csv", "")
    want = [("1", "x", None), ("2", "y", None), ("3", "z", None), ("4", "w", None), ("5", None, "p,q")]
    for paths in ([folder], [f"{folder}/*.csv"]):
        got = combine_shuffle(spark, paths, seed=1)
        assert sorted(tuple(r[c] for c in ("id", "kind", "more, and")) for r in got.collect()) == want


def test_headers_of_many_files_cost_one_job(spark, scratch):
    folder = os.path.join(scratch, f"many_{uuid.uuid4().hex[:6]}")
    for i in range(300):
        _csv_file(f"{folder}/{i:03d}.csv", ("a,b\n1,2\n", "b,a\n2,1\n", "a\n1\n")[i % 3])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"headers-{folder}", "headers")
    try:
        headers = csv_headers(spark, [folder])
        jobs = tracker.getJobIdsForGroup(f"headers-{folder}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in headers.items()} == {"a,b": 100, "b,a": 100, "a": 100}
    assert len(jobs) <= 2  # the listing of many files may be a job of its own
    got = combine_shuffle(spark, [folder], seed=1).groupBy("a", "b").count().collect()
    assert sorted(map(tuple, got), key=str) == [("1", "2", 200), ("1", None, 100)]
