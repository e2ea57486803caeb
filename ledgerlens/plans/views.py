"""The two logical inputs, derived from the driver's tables.

Sales ("house" rows) = orders joined to their customer's nation; incidents =

======================  =========================================
house column            source
======================  =========================================
transaction_id          o_orderkey
price                   o_totalprice
date                    o_orderdate
postcode                o_custkey
property_type           o_orderpriority
new_property            'Y' when o_orderstatus = 'F', else 'N'
town, county            n_name of the customer's nation
======================  =========================================

Incidents: timestamp <- ts, crime_id <- event_id, crime_type <- event_type,
postcode <- user_id.

Places on a plane (the tables carry no coordinates): customer key ``k`` sits
on a lattice at ``((k % 50) * 0.25, floor(k / 50) * 0.25)``; an incident sits
at its user's spot moved by an offset derived from its id, so its nearest
postcode is often a neighbour's and sometimes none within the radius.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.summarize import Lookup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sales(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("date"),
        F.col("o_custkey").alias("postcode"),
        F.col("o_orderpriority").alias("property_type"),
        F.when(status == F.lit("F"), F.lit("Y"))
        .when(status.isNotNull(), F.lit("N")).alias("new_property"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey -> town, county``: one row per customer (its nation's name)."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", F.col("n_name").alias("town"), F.col("n_name").alias("county")))


def house_lookup(spark: SparkSession, sf_dir: str) -> Lookup:
    """Sales whose place columns come through the customer key.

    Operators that group by place columns only aggregate orders per
    customer before joining the places (see ``operators.summarize``): the
    join meets one row per customer instead of one per order, and a
    customer holding a third of all orders collapses before the shuffle.
    ``c_custkey`` is a key, so the join never multiplies rows; an order
    with an unknown customer gets null places (its own group).
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_name").alias("town"), F.col("n_name").alias("county"))
    return Lookup(_sales(table(spark, sf_dir, "orders")), "postcode", customer, "c_custkey",
                  hop=("c_nationkey", nation, "n_nationkey"))


def house_view(spark: SparkSession, sf_dir: str, with_place: bool = True) -> DataFrame:
    """One row per order, in the house-sales column vocabulary (row level).

    Left joins keep every order.  ``with_place=False`` skips the joins when
    no place column is needed.  Joins are left-deep, orders with customer
    and then nation, without hints: the planner sees each side's own file
    size, broadcasts it under ``spark.sql.autoBroadcastJoinThreshold``, and
    otherwise plans a sort-merge join of two plain shuffles, whose skewed
    partitions AQE can split.
    """
    sales = _sales(table(spark, sf_dir, "orders"))
    if not with_place:
        return sales
    return house_lookup(spark, sf_dir).rows()


def incident_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the incident vocabulary."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("crime_id"),
        F.col("event_type").alias("crime_type"),
        F.col("user_id").alias("postcode"),
    )


# The lattice that places postcodes and incidents on a plane.
SPOT_COLUMNS = 50
SPOT_STEP = 0.25
OFFSET_X = (13, 6, 0.03)   # (modulus, shift, step): x offset = (id % 13 - 6) * 0.03
OFFSET_Y = (7, 3, 0.03)    # y offset = (id % 7 - 3) * 0.03


def _spot(key: Column) -> tuple[Column, Column]:
    return ((key % SPOT_COLUMNS).cast("double") * SPOT_STEP,
            F.floor(key / SPOT_COLUMNS).cast("double") * SPOT_STEP)


def _offset(key: Column, spec: tuple[int, int, float]) -> Column:
    modulus, shift, step = spec
    return (key % modulus - shift).cast("double") * step


def postcode_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``postcode, longitude, latitude``: one point per customer key."""
    key = F.col("c_custkey")
    x, y = _spot(key)
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("postcode"), x.alias("longitude"), y.alias("latitude"))


def incident_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``crime_id, longitude, latitude``: each event near its user's spot."""
    user, event = F.col("user_id"), F.col("event_id")
    x, y = _spot(user)
    return table(spark, sf_dir, "events").select(
        event.alias("crime_id"),
        (x + _offset(event, OFFSET_X)).alias("longitude"),
        (y + _offset(event, OFFSET_Y)).alias("latitude"))
