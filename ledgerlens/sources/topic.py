"""Message sources: a topic stream and the CSV text it carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import INCIDENT, INCIDENT_DROPPED, ddl


# Lossless text forms of the two timestamp types.
EXACT_TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_topic(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    """Streaming read of a topic, e.g. ``{"kafka.bootstrap.servers": ...,
    "subscribe": ...}``.  The Kafka source needs its connector jar on the
    classpath; any other streaming format with a ``value`` column works the
    same way downstream."""
    return spark.readStream.format(fmt).options(**options).load()


def decode_csv(
    df: DataFrame,
    schema: T.StructType = INCIDENT,
    value: str = "value",
    keep: Sequence[str] = ("timestamp",),
    drop: Sequence[str] = INCIDENT_DROPPED,
    header: str | None = None,
    corrupt_col: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Parse the CSV text in ``value`` into ``schema``'s columns.

    Output: the ``keep`` columns (e.g. the message timestamp) followed by
    the parsed fields minus ``drop``.  Parsing is PERMISSIVE: a bad cell is
    null and the row is kept; extra fields are ignored.  ``header`` is a
    header line to remove (compared after stripping a byte-order mark and
    surrounding blanks).  ``corrupt_col`` adds a string column holding the
    raw text of rows with too many, too few or malformed fields.
    Works the same on batch and streaming frames.
    """
    text = F.col(value).cast(T.StringType())
    base = df.select(*[F.col(k) for k in keep], text.alias("_csv"))
    if header is not None:
        cleaned = F.trim(F.regexp_replace(F.col("_csv"), "^\\uFEFF", ""))
        base = base.filter(~cleaned.eqNullSafe(F.lit(header.strip())))
    opts = {"mode": "PERMISSIVE", **(options or {})}
    parse_schema = schema
    if corrupt_col:
        opts["columnNameOfCorruptRecord"] = corrupt_col
        parse_schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    parsed = base.select(*keep, F.from_csv(F.col("_csv"), ddl(parse_schema), opts).alias("_row"))
    out = parsed.select(*keep, "_row.*")
    return out.drop(*drop) if drop else out


def encode_csv(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    value: str = "value",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The inverse of :func:`decode_csv`: ``columns`` as one CSV text column
    ``value`` (quoted and escaped, so commas inside fields survive).

    Timestamps are written with all six fraction digits (Spark's default
    keeps three), so decoding gives back the same instant.
    """
    opts = {**EXACT_TIME_FORMATS, **(options or {})}
    return df.select(*keep, F.to_csv(F.struct(*columns), opts).alias(value))
