"""Command line: run one summary as a job (what ``spark-submit`` runs).

Batch (house-sales file with the declared 16-column schema, no header)::

    spark-submit --py-files ledgerlens.zip ledgerlens/cli.py \
        batch top_towns --input sales.csv --output out/top_towns

Stream (incident rows as CSV text in a topic's ``value``)::

    spark-submit --py-files ledgerlens.zip ledgerlens/cli.py stream type_counts \\
        --option kafka.bootstrap.servers=kafka:9092 --option subscribe=crime-data \\
        --output out/type_counts --checkpoint <shared folder>/type_counts

Stream results go to the console and to ``<output>/epoch=N`` per micro-batch
through one fan-out query; the checkpoint defaults to
``<spark.checkpoint.dir>/streams/<job>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

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
    top_groups_by_avg,
    top_type,
    type_counts,
    type_window_counts,
    value_spread,
    yoy_change,
)
from ledgerlens.schemas import HOUSE, INCIDENT, INCIDENT_HEADER, POSTCODE_POINTS
from ledgerlens.session import build_session
from ledgerlens.sinks import save_table
from ledgerlens.sources import decode_csv, read_table, read_topic
from ledgerlens.streaming import (
    alarm_rows,
    checkpoint_path,
    console_rows,
    epoch_files,
    materialize,
    start_fan_out,
)

BatchJob = Callable[[DataFrame, argparse.Namespace], DataFrame]

BATCH: dict[str, BatchJob] = {
    "top_towns": lambda df, a: top_groups_by_avg(df, "town", "price", k=a.limit or 10),
    "monthly_sales": lambda df, a: monthly_counts(df, "date", a.year, ordered=True),
    "price_spread": lambda df, a: value_spread(df, ("county", "property_type"), "price"),
    "yearly_change": lambda df, a: yoy_change(df, "county", "date", "price", a.start, a.end,
                                              strict_gap=a.strict_gap),
    "busiest_month": lambda df, a: busiest_month(df, "county", "date", "transaction_id", "price",
                                                 a.year),
    "new_share": lambda df, a: flag_share(df, "county", F.col("new_property") == F.lit("Y")),
    "type_mix": lambda df, a: category_mix(df, "county", "property_type"),
    "lowest_medians": lambda df, a: bottom_groups_by_median(df, "county", "price",
                                                            k=a.limit or 20),
}

# Window size and slide of each stream job (overridable).
STREAM_WINDOWS = {
    "top_type": ("10 seconds", "3 seconds"),
    "type_counts": ("12 seconds", "4 seconds"),
    "distinct_types": ("12 seconds", "4 seconds"),
    "alarm": ("10 seconds", "3 seconds"),
    "enriched": ("45 seconds", "15 seconds"),
}


def _stream_job(name: str, incidents: DataFrame, a: argparse.Namespace,
                spark: SparkSession) -> tuple[DataFrame, str]:
    """The job's result frame and the output mode it needs."""
    if name == "passthrough":
        return incidents, "append"
    size, slide = STREAM_WINDOWS[name]
    size, slide = a.size or size, a.slide or slide
    args = ("timestamp", "crime_type", size, slide, a.watermark)
    if name == "top_type":
        if a.mode != "complete" and not a.per_window:
            raise SystemExit("top_type needs --per-window, or --mode complete for the one top row")
        return top_type(incidents, *args, per_window=a.per_window), a.mode
    ordered = a.mode == "complete"  # a stream can only sort what it holds whole
    if name == "type_counts":
        return type_counts(incidents, *args, ordered=ordered), a.mode
    if name == "distinct_types":
        return distinct_types(incidents, *args, ordered=ordered), a.mode
    if name == "alarm":
        return type_window_counts(incidents, "timestamp", "crime_type", a.alarm_type, size,
                                  slide, a.watermark, a.threshold), a.mode
    if name == "enriched":
        if not a.static:
            raise SystemExit("enriched needs --static <house sales file>")
        if bool(a.postcodes) == bool(a.postcode_from):
            raise SystemExit("enriched needs one of --postcodes <postcode,longitude,latitude "
                             "file> (locate incidents by coordinates) or --postcode-from "
                             "<incident column holding the postcode>")
        sales = read_table(spark, a.static, HOUSE, a.static_format)
        prices = materialize(postcode_prices(sales, "postcode", "price"))
        if a.postcodes and a.radius is None:
            raise SystemExit("--postcodes needs --radius; incidents with no postcode within it "
                             "are counted under a null postcode")
        if a.postcodes:
            points = materialize(read_table(spark, a.postcodes, POSTCODE_POINTS, "csv",
                                            header="true"))
            located = nearest_point(incidents, points, "longitude", "latitude", "postcode",
                                    radius=a.radius, degrees=True)
        else:
            located = incidents.withColumn("postcode", F.col(a.postcode_from))
        return enriched_counts(located, prices, "postcode", "timestamp", size, slide, a.watermark,
                               ordered=ordered, keep_unmatched=bool(a.postcodes)), a.mode
    raise SystemExit(f"unknown stream job {name}")


def print_alarm(row) -> None:
    """What an alarm does unless a caller passes its own function to ``alarm_rows``."""
    print(f"ALARM {row.asDict()}", flush=True)


def run_batch(spark: SparkSession, a: argparse.Namespace) -> None:
    options = {} if a.format != "csv" else {"header": "false"}
    sales = read_table(spark, a.input, HOUSE if a.format == "csv" else None, a.format, **options)
    save_table(BATCH[a.job](sales, a), a.output, a.out_format)


def run_stream(spark: SparkSession, a: argparse.Namespace):
    options = dict(kv.split("=", 1) for kv in a.option)
    raw = read_topic(spark, options, a.format)
    if a.arrival_time:
        raw = raw.withColumn("timestamp", F.current_timestamp())
    elif a.time_column not in raw.columns:
        raise SystemExit(f"the source has no event time column {a.time_column!r}; name it with "
                         "--time-column, or stamp rows as they arrive with --arrival-time")
    elif a.time_column != "timestamp":
        raw = raw.withColumn("timestamp", F.col(a.time_column))
    incidents = decode_csv(raw, INCIDENT, header=a.header or None)
    result, mode = _stream_job(a.job, incidents, a, spark)
    writers = [epoch_files(a.output)] + ([console_rows(a.rows)] if a.console else [])
    if a.job == "alarm":
        writers.append(alarm_rows(print_alarm))
    trigger = {"availableNow": True} if a.available_now else None
    return start_fan_out(result, writers, a.checkpoint or checkpoint_path(spark, a.job),
                         mode, trigger)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerlens")
    sub = p.add_subparsers(dest="kind", required=True)
    b = sub.add_parser("batch")
    b.add_argument("job", choices=sorted(BATCH))
    b.add_argument("--input", required=True, nargs="+")
    b.add_argument("--format", default="csv")
    b.add_argument("--output", required=True)
    b.add_argument("--out-format", default="parquet")
    b.add_argument("--year", type=int, default=2011)
    b.add_argument("--start", type=int, default=2011)
    b.add_argument("--end", type=int, default=2020)
    b.add_argument("--strict-gap", action="store_true")
    b.add_argument("--limit", type=int)
    s = sub.add_parser("stream")
    s.add_argument("job", choices=sorted([*STREAM_WINDOWS, "passthrough"]))
    s.add_argument("--format", default="kafka")
    s.add_argument("--option", action="append", default=[], help="source option key=value")
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint")
    s.add_argument("--header", default=INCIDENT_HEADER,
                   help="header line to drop from the messages (default: the incident file's; "
                        "empty: none)")
    s.add_argument("--mode", choices=("append", "update", "complete"), default="append",
                   help="append and update keep state up to the watermark only")
    s.add_argument("--per-window", action="store_true", help="top_type: one row per window")
    s.add_argument("--time-column", default="timestamp", help="event time column of the source")
    s.add_argument("--arrival-time", action="store_true", help="stamp rows as they arrive")
    s.add_argument("--size")
    s.add_argument("--slide")
    s.add_argument("--watermark", default="1 second")
    s.add_argument("--alarm-type", default="Anti-social behaviour")
    s.add_argument("--threshold", type=int, default=2)
    s.add_argument("--static", nargs="+")
    s.add_argument("--static-format", default="csv")
    s.add_argument("--postcode-from", help="incident column holding the postcode (enriched)")
    s.add_argument("--postcodes", nargs="+",
                   help="CSV with header postcode,longitude,latitude: an incident takes the "
                        "nearest postcode within --radius (enriched)")
    s.add_argument("--radius", type=float,
                   help="search radius for --postcodes, in degrees of latitude")
    s.add_argument("--console", action="store_true")
    s.add_argument("--rows", type=int, default=20)
    s.add_argument("--available-now", action="store_true",
                   help="process what is available, then stop")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    """Run a batch job, or start a stream job and return its query."""
    a = parser().parse_args(argv)
    spark = spark or build_session(app=f"ledgerlens-{a.kind}-{a.job}")
    if a.kind == "batch":
        run_batch(spark, a)
        return None
    return run_stream(spark, a)


if __name__ == "__main__":
    query = main()
    if query is not None:
        query.awaitTermination()
