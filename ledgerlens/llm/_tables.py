"""Helpers on frames: exact column picking, and tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which executors share."""
    return shared_folder(spark)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet (compressed by ``codec``, the session's by default) in the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a re-run.
    The shuffle files of the write are dropped when it ends, so a job of many
    steps needs the disk of its largest step, not of their sum.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact (case-sensitive) name, first one if repeated.

    Other columns may have any name, also one that differs in case only.
    """
    own = [f"_c{i}" for i in range(len(df.columns))]
    flat = df.toDF(*own)
    return flat.select(*[flat[own[df.columns.index(n)]].alias(n) for n in names])


def with_side(df: DataFrame, side: DataFrame, id_col: str, how: str = "left",
              text_col: str | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """``df`` joined with ``side`` on the id, under names that cannot clash.

    Returns the joined frame, the names that stand for df's columns (in order)
    and those that stand for side's.  ``side`` has the id first; with
    ``text_col`` the text's ``xxhash64`` comes second and must match too, which
    tells apart rows that share an id.
    """
    own = [f"_c{i}" for i in range(len(df.columns))]
    extra = [f"_s{i}" for i in range(len(side.columns))]
    left, right = df.toDF(*own), side.toDF(*extra)
    on = left[own[df.columns.index(id_col)]] == right["_s0"]
    if text_col is not None:
        on &= F.xxhash64(left[own[df.columns.index(text_col)]]) == right["_s1"]
    return left.join(right, on, how), own, extra


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))
