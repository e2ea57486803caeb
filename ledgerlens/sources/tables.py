"""Table sources: declared-schema scans, landing into zones, combine+shuffle
(S1, S5, S6)."""

from __future__ import annotations

import csv
import random
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.time import landed_year
from ledgerlens.operators.shuffle import random_order


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    **options: str,
) -> DataFrame:
    """Scan ``path`` with a declared schema.

    For CSV: no header by default, PERMISSIVE (a bad cell becomes null, the
    row stays).  Declaring the schema avoids an inference pass over the data.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.load(paths)


def land_raw(
    df: DataFrame,
    path: str,
    date: str = "date",
    max_records_per_file: int | None = None,
) -> None:
    """Write a raw table as typed Parquet partitioned by the year of ``date``.

    The partition column is ``<date>_year`` (:func:`landed_year`); year filters
    on ``date`` (``in_years``) add it to their predicate and so prune folders.
    Re-landing overwrites only the years present in ``df`` (dynamic partition
    overwrite), so a retried or repeated load is idempotent.  Rows are
    rebalanced by year first: the number of files follows the data's size,
    not tasks times years, and AQE splits a year that holds many rows.
    """
    year = landed_year(date)
    out = df.withColumn(year, F.year(F.col(date))).hint("rebalance", year)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.partitionBy(year).parquet(path)


def csv_headers(spark: SparkSession, paths: Sequence[str], **options: str) -> dict[str, list[str]]:
    """Header line -> the files below ``paths`` that begin with it.

    One job with a task per file, which stops after the first line: a
    thousand files cost one job, and no file is read further than a batch of
    rows.  A byte-order mark is not part of the header; files without a line
    have none and are left out.
    """
    alone = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    wanted = {k: v for k, v in options.items() if k in ("encoding", "lineSep", "pathGlobFilter", "recursiveFileLookup")}
    lines = spark.read.options(**wanted).text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\uFEFF", "").alias("header"))
    before = {k: spark.conf.get(k) for k in alone}
    try:
        for k, v in alone.items():
            spark.conf.set(k, v)
        found = lines.mapInArrow(first, "file string, header string").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    groups: dict[str, list[str]] = {}
    for file, header in sorted(tuple(r) for r in found):
        groups.setdefault(header, []).append(unquote(file))
    return groups


def _by_header(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> list[DataFrame]:
    """One scan per header among the CSV files below ``paths``, columns by name, all strings."""
    kind = {"delimiter": options.get("sep", ","), "quotechar": options.get("quote", '"')}
    frames = []
    for header, files in csv_headers(spark, paths, **options).items():
        names = next(csv.reader([header], **kind))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frames.append(read_table(spark, files, schema, "csv", **options))
    return frames


def combine_shuffle(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    seed: int | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Union tables by column name and put their rows in random order.

    Without a ``schema`` columns are united by name, a missing one becoming
    null.  For CSV the header of every file counts, also within a folder or
    glob: files with one header share a scan, and the headers are found by one
    job (:func:`csv_headers`).  Other formats give the columns of each path
    (a file, folder or glob); paths with equal columns share a scan.  A
    declared ``schema`` reads all paths in one scan (CSV by position).
    ``seed=None`` draws a new order each time.
    """
    if fmt == "csv":
        options = {"header": "true", **options}
    if schema is not None:
        frames = [read_table(spark, list(paths), schema, fmt, **options)]
    elif fmt == "csv" and options["header"] == "true":
        frames = _by_header(spark, paths, options)
    else:
        groups: dict[str, list[str]] = {}
        for p in paths:
            layout = read_table(spark, p, None, fmt, **options).schema.simpleString()
            groups.setdefault(layout, []).append(p)
        frames = [read_table(spark, group, None, fmt, **options) for group in groups.values()]
    if not frames:
        raise ValueError(f"no file with a header in {list(paths)}")
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return random_order(combined, random.randrange(1 << 31) if seed is None else seed, partitions)
