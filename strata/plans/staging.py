"""Staging model and daily mart (the SQL-model chain) as DataFrame functions.

Each CTE of a SQL model is one function; the mart takes the staged frame
(or the view it was materialized as) so Catalyst plans both as one query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import quality as Q
from strata.operators import windows


@dataclass(frozen=True)
class ModelVars:
    """Project variables of the staging model.

    Fixed values of the reference project: start 2023-01-01, fares strictly
    between 0.50 and 500.00, at most 6 passengers."""
    start_date: str = "2023-01-01"
    min_fare_usd: float = 0.50
    max_fare_usd: float = 500.00
    max_passengers: int = 6


# Output name -> raw column of the "renamed" step, in the
# reference model's order; the metadata columns pass through unchanged.
RENAMES = {
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
    "pickup_location_id": "PULocationID",
    "dropoff_location_id": "DOLocationID",
    "passenger_count": "passenger_count",
    "distance_miles": "trip_distance",
    "payment_type_code": "payment_type",
    "rate_code_id": "RatecodeID",
    "fare_usd": "fare_amount",
    "tip_usd": "tip_amount",
    "tolls_usd": "tolls_amount",
    "surcharge_usd": "improvement_surcharge",
    "total_usd": "total_amount",
}
METADATA = ("_ingestion_ts", "_batch_id", "_source_file")


def renamed(source: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Surrogate trip id, renamed fields, congestion surcharge default 0,
    metadata passed through (``extra`` keeps more source columns)."""
    cols = [C.surrogate_key("VendorID", "tpep_pickup_datetime", "PULocationID").alias("trip_id")]
    cols += [F.col(src).alias(dst) for dst, src in RENAMES.items()]
    cols.append(F.coalesce(F.col("congestion_surcharge"), F.lit(0.0))
                .alias("congestion_surcharge_usd"))
    cols += [F.col(m) for m in METADATA if m in source.columns]
    cols += [F.col(e) for e in extra]
    return source.select(*cols)


def filtered(df: DataFrame, v: ModelVars = ModelVars()) -> DataFrame:
    """Valid dates, fares, trips, and the start-date bound.

    ``pickup >= start`` selects the same rows as ``cast(pickup as date) >=
    start`` but stays a plain comparison the scan can push down."""
    fare, pax = F.col("fare_usd"), F.col("passenger_count")
    return df.filter(
        F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull()
        & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
        & (fare > v.min_fare_usd) & (fare < v.max_fare_usd)
        & (F.col("distance_miles") > 0) & (pax > 0) & (pax <= v.max_passengers)
        & (F.col("pickup_datetime") >= F.lit(v.start_date).cast("date")))


def deduplicated(df: DataFrame, tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    """Latest ingested row per trip id (``rn`` = 1 stays in the output).

    The ingestion time alone can tie (one batch shares one stamp), so
    ``tie_breakers`` (compared descending) make the winner deterministic."""
    return windows.latest_per_key(df, ["trip_id"], ["_ingestion_ts", *tie_breakers], "rn")


def stg_trips(source: DataFrame, v: ModelVars = ModelVars(),
              tie_breakers: tuple[str, ...] = ()) -> DataFrame:
    return deduplicated(filtered(renamed(source, tie_breakers), v), tie_breakers)


def daily_mart(trips: DataFrame, rolling_rows: int = 7) -> DataFrame:
    """Daily business metrics with rolling mean, day-over-day change, rank.

    Grouped by the date alone: year, month, weekday and weekend are functions
    of it, so they are derived after the aggregate instead of widening the
    shuffle key. Weekday numbering is 0 = Sunday .. 6 = Saturday."""
    dur = C.duration_minutes("pickup_datetime", "dropoff_datetime", None,
                             C.is_wall_clock(trips, "pickup_datetime"))
    g = trips.groupBy(F.to_date("pickup_datetime").alias("trip_date")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(F.col("passenger_count").cast("bigint")).alias("total_passengers"),
        C.half_up(C.money_sum("fare_usd", C.SUM_SCALE), 2).alias("total_fare_usd"),
        C.half_up(C.money_sum("tip_usd", C.SUM_SCALE), 2).alias("total_tips_usd"),
        C.half_up(C.money_sum("total_usd", C.SUM_SCALE), 2).alias("total_revenue_usd"),
        C.half_up(F.avg("fare_usd"), 2).alias("avg_fare_usd"),
        C.half_up(F.avg("distance_miles"), 2).alias("avg_distance_miles"),
        C.half_up(F.avg(dur), 1).alias("avg_duration_mins"),
        C.half_up(F.try_divide(F.count_if(F.col("tip_usd") > 0).cast("double"),
                               F.count(F.lit(1))) * 100, 1).alias("tip_rate_pct"),
        C.half_up(F.avg(C.guarded_ratio("fare_usd", "distance_miles")), 2)
        .alias("avg_fare_per_mile"))
    g = g.select(
        "trip_date",
        F.year("trip_date").alias("trip_year"),
        F.month("trip_date").alias("trip_month"),
        C.weekday_number("trip_date", sunday=0).alias("day_of_week"),
        C.is_weekend("trip_date").alias("is_weekend"),
        *[c for c in g.columns if c != "trip_date"])
    return (g.withColumn("revenue_7d_rolling_avg", C.half_up(
                windows.rolling_mean("total_revenue_usd", "trip_date", rolling_rows), 2))
             .withColumn("revenue_dod_change", C.half_up(
                windows.change("total_revenue_usd", "trip_date"), 2))
             .withColumn("trip_count_rank", windows.rank_desc("trip_count"))
             .orderBy("trip_date"))


# The declared column tests of the two models.
PAYMENT_CODES = (1, 2, 3, 4, 5, 6)
BRONZE_NOT_NULL = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
STAGING_NOT_NULL = ("trip_id", "pickup_datetime", "dropoff_datetime", "fare_usd",
                    "payment_type_code")


def bronze_tests(bronze: DataFrame) -> DataFrame:
    return Q.column_tests(bronze, "bronze_trips", BRONZE_NOT_NULL,
                          values={"payment_type": PAYMENT_CODES})


def staging_tests(staged: DataFrame) -> DataFrame:
    return Q.column_tests(staged, "stg_trips", STAGING_NOT_NULL, unique_keys=("trip_id",),
                          values={"payment_type_code": PAYMENT_CODES})
