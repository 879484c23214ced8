"""Adapter: the star-schema test tables seen as taxi trips and zones.

Role mapping (one line item = one trip):

=====================  ==============================================
taxi column            test-table source
=====================  ==============================================
VendorID               l_suppkey
tpep_pickup_datetime   o_orderdate
tpep_dropoff_datetime  l_shipdate
passenger_count        l_linenumber
trip_distance          l_quantity
PULocationID           customer.c_nationkey (through o_custkey)
payment_type           first character of o_orderpriority, as int
fare_amount            l_extendedprice
tip_amount             l_extendedprice * l_tax
total_amount           fare_amount + tip_amount
_ingestion_ts          l_shipdate
zone / borough         nation.n_name / region.r_name
=====================  ==============================================

Taxi columns with no counterpart (drop-off location, rate code, tolls,
surcharges) are typed nulls. Join order: orders ⋈ customer first (the
smaller fact), then line items; every input is pruned to the columns used
before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.readers import read_table

# Columns that identify one line item; kept so later steps can break ties.
KEY_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw taxi-shaped trips (the bronze input of the pipelines)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    j = li.join(oc, li.l_orderkey == oc.o_orderkey, "inner")
    fare = F.col("l_extendedprice")
    tip = F.col("l_extendedprice") * F.col("l_tax")
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_suppkey").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.lit(None).cast("double").alias("RatecodeID"),
        F.col("c_nationkey").alias("PULocationID"),
        F.lit(None).cast("int").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("payment_type"),
        fare.alias("fare_amount"),
        tip.alias("tip_amount"),
        F.lit(None).cast("double").alias("tolls_amount"),
        F.lit(None).cast("double").alias("improvement_surcharge"),
        (fare + tip).alias("total_amount"),
        F.lit(None).cast("double").alias("congestion_surcharge"),
        F.col("l_shipdate").alias("_ingestion_ts"),
    )


def zones(spark: SparkSession, sf_dir: str, drop_region: str | None = None) -> DataFrame:
    """Zone lookup ``(LocationID, Borough, Zone)`` from nation and region.

    ``drop_region`` leaves one region's nations out, so a left join has
    unmatched rows to show."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    if drop_region is not None:
        region = region.filter(F.col("r_name") != drop_region)
    # both sides are small dimensions; the zone lookup as a whole is
    # size-checked where it is joined to the facts (enrich.maybe_broadcast)
    z = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    return z.select(F.col("n_nationkey").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"))


def events_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pickups: ``ts`` carries real hours (order dates are midnight)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("event_id"), F.col("ts").alias("tpep_pickup_datetime"),
                     F.col("value").alias("fare_amount"),
                     F.col("event_type"), F.col("user_id"))
