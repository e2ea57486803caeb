"""The registered queries: each operator applied to the driver's tables.

Every query reads whole tables.  Parameters follow the table mapping in
``views``: orders span 1995-2001 (2001 partial), so single-year queries use
1997 and the year-over-year range 1996-2000; events cover 30 days, so the
original seconds become hours (10h/3h, 12h/4h, 45h/15h windows, 1 hour
watermark) and the alarm type is ``error``.

``stream_append_counts``, ``stream_replayed_counts``, ``stream_alarm_once``
and ``stream_running_top`` are streams: they read the events files with an
available-now trigger, write their epochs to the shared folder and read them
back.  The other ``stream_*`` queries run the streaming operators on a batch
frame (the same functions; a watermark has no effect there).  That a stream
gives the same rows is tested in ``tests/test_streaming*.py``.

Floating results are rounded to 4 places (``stable_round``) so that
results do not depend on summation order; averages are ordered before
rounding.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.numeric import round_columns
from ledgerlens.functions.time import instant_to_ntz
from ledgerlens.operators import (
    bottom_groups_by_median,
    busiest_month,
    category_mix,
    distinct_types,
    enriched_counts,
    flag_share,
    monthly_counts,
    nearest_point,
    postcode_prices,
    threshold_alarm,
    top_groups_by_avg,
    top_type,
    type_counts,
    type_window_counts,
    value_spread,
    yoy_change,
)
from ledgerlens.plans.views import (
    house_lookup,
    house_view,
    incident_points,
    incident_view,
    postcode_points,
    table,
)
from ledgerlens.session import shared_folder
from ledgerlens.sinks import save_table
from ledgerlens.sources.tables import combine_shuffle, land_raw, read_table
from ledgerlens.sources.topic import decode_csv, encode_csv
from ledgerlens.streaming import best_row, drop_replays, epoch_files, first_alarms, read_epochs, start_fan_out
from ledgerlens.streaming.jobs import BatchWriter

# Fixed parameters of the registered queries.
YEAR = 1997
YEAR_RANGE = (1996, 2000)
WATERMARK = "1 hour"
TOP_TYPE_WINDOW = ("10 hours", "3 hours")
TYPE_COUNT_WINDOW = ("12 hours", "4 hours")
ENRICH_WINDOW = ("45 hours", "15 hours")
ALARM_TYPE = "error"
ALARM_THRESHOLD = 2
LOCATE_RADIUS = 0.1
DIGITS = 4

EVENT_FIELDS = ("event_id", "user_id", "event_type", "value", "props")
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

Query = Callable[[SparkSession, str], DataFrame]


def q_top_groups_by_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = top_groups_by_avg(house_lookup(spark, sf_dir), "town", "price", k=10)
    return round_columns(res, DIGITS)


def q_monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_counts(house_view(spark, sf_dir, with_place=False), "date", YEAR)


def q_value_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = value_spread(house_lookup(spark, sf_dir), ("county", "property_type"), "price")
    return round_columns(res, DIGITS)


def q_yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = yoy_change(house_lookup(spark, sf_dir), "county", "date", "price", *YEAR_RANGE)
    return round_columns(res, DIGITS)


def q_yoy_change_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = yoy_change(house_lookup(spark, sf_dir), "county", "date", "price", *YEAR_RANGE,
                     strict_gap=True)
    return round_columns(res, DIGITS)


def q_busiest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = busiest_month(house_lookup(spark, sf_dir), "county", "date", "transaction_id", "price", YEAR)
    return round_columns(res, DIGITS)


def q_flag_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = flag_share(house_lookup(spark, sf_dir), "county", F.col("new_property") == F.lit("Y"))
    return round_columns(res, DIGITS)


def q_category_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_mix(house_lookup(spark, sf_dir), "county", "property_type")


def q_bottom_groups_by_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_groups_by_median(house_lookup(spark, sf_dir), "county", "price", k=20)


def q_csv_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published as CSV text (like a topic's ``value``) and decoded."""
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "timestamp")
    messages = encode_csv(events, EVENT_FIELDS, keep=("timestamp",))
    return decode_csv(messages, schema=EVENT_SCHEMA, keep=("timestamp",), drop=())


def q_combine_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of different columns, united by name."""
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("customer", "supplier")]
    return combine_shuffle(spark, paths, fmt="parquet", seed=7)


def q_stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV text with one header line, decoded without event time."""
    events = table(spark, sf_dir, "events")
    messages = encode_csv(events, EVENT_FIELDS)
    header = ",".join(EVENT_FIELDS)
    titled = messages.union(spark.range(1).select(F.lit(header).alias("value")))
    return decode_csv(titled, schema=EVENT_SCHEMA, keep=(), drop=("props",), header=header)


def q_stream_top_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_type(incident_view(spark, sf_dir), "timestamp", "crime_type",
                    *TOP_TYPE_WINDOW, WATERMARK)


def q_stream_top_type_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_type(incident_view(spark, sf_dir), "timestamp", "crime_type",
                    *TOP_TYPE_WINDOW, WATERMARK, per_window=True)


def q_stream_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_counts(incident_view(spark, sf_dir), "timestamp", "crime_type",
                       *TYPE_COUNT_WINDOW, WATERMARK)


def q_stream_distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_types(incident_view(spark, sf_dir), "timestamp", "crime_type",
                          *TYPE_COUNT_WINDOW, WATERMARK)


def q_stream_alarm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_window_counts(incident_view(spark, sf_dir), "timestamp", "crime_type", ALARM_TYPE,
                              *TOP_TYPE_WINDOW, WATERMARK, ALARM_THRESHOLD)


def q_stream_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_alarm(incident_view(spark, sf_dir), "timestamp", "crime_type", ALARM_TYPE,
                           *TOP_TYPE_WINDOW, WATERMARK, ALARM_THRESHOLD)


def q_stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = postcode_prices(house_view(spark, sf_dir, with_place=False), "postcode", "price")
    res = enriched_counts(incident_view(spark, sf_dir), prices, "postcode", "timestamp",
                          *ENRICH_WINDOW, WATERMARK)
    return round_columns(res, DIGITS)


def q_locate_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each incident's nearest postcode within the radius."""
    res = nearest_point(incident_points(spark, sf_dir), postcode_points(spark, sf_dir),
                        "longitude", "latitude", "postcode", LOCATE_RADIUS,
                        distance_out="distance")
    return round_columns(res, DIGITS)


def q_pane_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 by panes: rows aggregated once per pane, panes merged into windows."""
    return type_counts(incident_view(spark, sf_dir), "timestamp", "crime_type", *TOP_TYPE_WINDOW, WATERMARK, panes=True)


def q_pane_distinct_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 by panes: one sketch per pane, merged into windows."""
    return distinct_types(incident_view(spark, sf_dir), "timestamp", "crime_type", *TYPE_COUNT_WINDOW, WATERMARK, panes=True)


def q_bottom_medians_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 with sketches per customer, merged after the place join."""
    return bottom_groups_by_median(house_lookup(spark, sf_dir), "county", "price", k=20, accuracy=32768, sketch="kll")


def q_landed_monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales through the three zones (S1, S6, K1): raw CSV files, typed Parquet by year, and a result read back."""
    zones = f"{shared_folder(spark)}/zones-{uuid.uuid4().hex}"
    sales = house_view(spark, sf_dir, with_place=False).select("transaction_id", "price", "date", "postcode")
    save_table(sales.select("transaction_id", "price", F.col("date").cast("timestamp_ntz"), "postcode"), f"{zones}/raw", "csv")
    raw = read_table(spark, f"{zones}/raw", "transaction_id long, price double, date timestamp_ntz, postcode long")
    land_raw(raw, f"{zones}/transformation")
    save_table(monthly_counts(spark.read.parquet(f"{zones}/transformation"), "date", YEAR), f"{zones}/curated")
    return spark.read.parquet(f"{zones}/curated")


def q_combine_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables as CSV files of different column orders in one folder, combined by name."""
    folder = f"{shared_folder(spark)}/combine-{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    for part in (customer, supplier):
        part.write.mode("append").option("header", "true").csv(folder)
    return combine_shuffle(spark, [folder], seed=7)


def incident_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events files as a stream, in the incident vocabulary."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    # a pattern, as a stream's path may be a folder or a pattern but not one file
    files = f"{sf_dir.rstrip('/')}/[e]vents.parquet"
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(files)
    return events.select(F.col("ts").alias("timestamp"), F.col("event_id").alias("crime_id"),
                         F.col("event_type").alias("crime_type"), F.col("user_id").alias("postcode"))


def _streamed(df: DataFrame, mode: str, writer: Callable[[str], BatchWriter]) -> str:
    """Run a stream over all that is there into the writer for a new shared folder; the folder."""
    folder = f"{shared_folder(df.sparkSession)}/stream-{uuid.uuid4().hex}"
    start_fan_out(df, [writer(folder)], f"{folder}/checkpoint", mode, {"availableNow": True}).awaitTermination()
    return folder


def q_stream_append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 as a stream in append mode: windows that the watermark closed, written per epoch and read back."""
    counts = type_counts(incident_stream(spark, sf_dir), "timestamp", "crime_type", *TYPE_COUNT_WINDOW, WATERMARK)
    folder = _streamed(counts, "append", lambda f: epoch_files(f"{f}/out", "parquet"))
    return read_epochs(counts, f"{folder}/out")


def q_stream_replayed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 as a stream of which every message comes twice."""
    twice = incident_stream(spark, sf_dir).union(incident_stream(spark, sf_dir))
    once = drop_replays(twice, ["crime_id"], "timestamp", WATERMARK)
    counts = type_counts(once, "timestamp", "crime_type", *TYPE_COUNT_WINDOW, watermark=None)
    counts = counts.withColumns({c: instant_to_ntz(F.col(c)) for c in ("start", "end")})
    folder = _streamed(counts, "append", lambda f: epoch_files(f"{f}/out", "parquet"))
    return read_epochs(counts, f"{folder}/out")


def q_stream_alarm_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 as a stream: the windows that raised the alarm, each put out once."""
    counts = type_window_counts(incident_stream(spark, sf_dir), "timestamp", "crime_type", ALARM_TYPE,
                                *TOP_TYPE_WINDOW, WATERMARK, ALARM_THRESHOLD)
    folder = _streamed(counts, "update", lambda f: first_alarms(f"{f}/fired", f"{f}/out", flag="alarm", delay=WATERMARK))
    return read_epochs(counts, f"{folder}/out").select("start", "end")


def q_stream_running_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 as a stream in update mode, the top row kept in a stored table of one row."""
    counts = type_counts(incident_stream(spark, sf_dir), "timestamp", "crime_type", *TOP_TYPE_WINDOW, WATERMARK)
    order = [F.col("crime_count").desc(), "start", "end", F.col("crime_type").asc_nulls_first()]
    folder = _streamed(counts, "update", lambda f: best_row(f"{f}/best", order))
    return spark.read.parquet(f"{folder}/best").orderBy(F.col("_epoch").desc()).limit(1).drop("_epoch", "slot")


QUERIES: dict[str, Query] = {
    "top_groups_by_avg": q_top_groups_by_avg,
    "monthly_counts": q_monthly_counts,
    "value_spread": q_value_spread,
    "yoy_change": q_yoy_change,
    "yoy_change_strict": q_yoy_change_strict,
    "busiest_month": q_busiest_month,
    "flag_share": q_flag_share,
    "category_mix": q_category_mix,
    "bottom_groups_by_median": q_bottom_groups_by_median,
    "csv_decode": q_csv_decode,
    "combine_shuffle": q_combine_shuffle,
    "stream_passthrough": q_stream_passthrough,
    "stream_top_type": q_stream_top_type,
    "stream_top_type_per_window": q_stream_top_type_per_window,
    "stream_type_counts": q_stream_type_counts,
    "stream_distinct_types": q_stream_distinct_types,
    "stream_alarm_counts": q_stream_alarm_counts,
    "stream_alarm": q_stream_alarm,
    "stream_enriched": q_stream_enriched,
    "locate_incidents": q_locate_incidents,
    "pane_type_counts": q_pane_type_counts,
    "pane_distinct_types": q_pane_distinct_types,
    "bottom_medians_merged": q_bottom_medians_merged,
    "landed_monthly_counts": q_landed_monthly_counts,
    "combine_folder": q_combine_folder,
    "stream_append_counts": q_stream_append_counts,
    "stream_replayed_counts": q_stream_replayed_counts,
    "stream_alarm_once": q_stream_alarm_once,
    "stream_running_top": q_stream_running_top,
}
