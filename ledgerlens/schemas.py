"""Declared schemas of the two inputs (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# The column layout of the house-sales file (16 columns, no
# header) and of the incident rows carried as CSV text in a message value
# (12 columns), in file order.
HOUSE_COLUMNS = [
    ("transaction_id", T.StringType()),
    ("price", T.DoubleType()),
    ("date", T.TimestampType()),
    ("postcode", T.StringType()),
    ("property_type", T.StringType()),
    ("new_property", T.StringType()),
    ("duration", T.StringType()),
    ("PAON", T.StringType()),
    ("SAON", T.StringType()),
    ("street", T.StringType()),
    ("locality", T.StringType()),
    ("town", T.StringType()),
    ("district", T.StringType()),
    ("county", T.StringType()),
    ("ppd", T.StringType()),
    ("record_status", T.StringType()),
]

INCIDENT_COLUMNS = [
    ("key", T.StringType()),
    ("month", T.StringType()),
    ("reported_by", T.StringType()),
    ("falls_within", T.StringType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("location", T.StringType()),
    ("lsoa_code", T.StringType()),
    ("lsoa_name", T.StringType()),
    ("crime_type", T.StringType()),
    ("last_outcome_category", T.StringType()),
    ("context", T.StringType()),
]

# A postcode reference table for locating incidents: one row per postcode
# (or per address point) with its coordinates.
POSTCODE_POINT_COLUMNS = [
    ("postcode", T.StringType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
]

# Columns the incident decode drops after parsing.
INCIDENT_DROPPED = ("key", "falls_within")


def struct_of(columns) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns])


HOUSE = struct_of(HOUSE_COLUMNS)
INCIDENT = struct_of(INCIDENT_COLUMNS)
POSTCODE_POINTS = struct_of(POSTCODE_POINT_COLUMNS)


def ddl(schema: T.StructType) -> str:
    """DDL text for ``from_csv``: ``name type, ...``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

# Fixed value: the header line of the incident file.
INCIDENT_HEADER = (
    "Crime ID,Month,Reported by,Falls within,Longitude,Latitude,Location,"
    "LSOA code,LSOA name,Crime type,Last outcome category,Context")
