"""Small ETLs: the zone summary flow and the daily-series (weather) flow."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregate, enrich, quality as Q
from strata.sources.readers import arrays_to_rows, read_json_payload
from strata.sources.sinks import write_csv, write_parquet

# ------------------------------------------------------------ zone summary


def trip_features(df: DataFrame, pickup: str = "pickup_datetime",
                  dropoff: str = "dropoff_datetime", fare: str = "fare_usd",
                  tip: str = "tip_usd", distance: str = "distance_km") -> DataFrame:
    """Duration, total with tip, fare per km, pickup hour (before any fill)."""
    return df.withColumns({
        "trip_duration_mins": C.duration_minutes(pickup, dropoff, 1,
                                                 C.is_wall_clock(df, pickup)),
        "total_amount": C.plus_default(fare, tip, 0.0),
        "fare_per_km": C.ratio(fare, distance, 2),
        "pickup_hour": F.hour(pickup),
    })


def zone_summary(df: DataFrame, zone: str = "pickup_zone", trip_id: str = "trip_id",
                 fare: str = "fare_usd", distance: str = "distance_km",
                 digits: int = 2) -> DataFrame:
    """Per zone: trips (non-null ids), revenue, mean fare, mean distance,
    rounded; a null zone is left out; highest revenue first."""
    return (df.filter(F.col(zone).isNotNull()).groupBy(zone).agg(
                F.count(trip_id).alias("trip_count"),
                C.half_up(C.money_sum(fare, C.SUM_SCALE), digits).alias("total_revenue"),
                C.half_up(F.avg(fare), digits).alias("avg_fare"),
                C.half_up(F.avg(distance), digits).alias("avg_distance"))
              .orderBy(F.col("total_revenue").desc_nulls_last(), F.col(zone)))


def fill_fare(df: DataFrame, fare: str = "fare_usd", tip: str = "tip_usd"):
    """Median fill of the fare, zero fill of the tip (after deriving)."""
    filled, medians = aggregate.impute_median(df, [fare])
    return aggregate.fill_constant(filled, {tip: 0.0}), medians


def zone_etl(trips: DataFrame, zones: DataFrame, base: str) -> DataFrame:
    """The whole flow: derive, fill, keep trips with a distance, write them as
    parquet; summarise per zone, join the zone's borough, write the summary as
    parquet and CSV. Returns the summary read back from parquet."""
    spark = trips.sparkSession
    filled, _ = fill_fare(trip_features(trips))
    write_parquet(filled.filter(F.col("distance_km") > 0), f"{base}/trips")
    summary = zone_summary(spark.read.parquet(f"{base}/trips"))
    summary = enrich.enrich(summary, zones, "pickup_zone", "zone", {"borough": "borough"})
    write_parquet(summary, f"{base}/summary")
    back = spark.read.parquet(f"{base}/summary")
    write_csv(back, f"{base}/summary_csv")
    return back


# ------------------------------------------------------------ daily series

# Payload field -> output column of the forecast flow.
DAILY_FIELDS = {
    "time": "date",
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "precipitation_sum": "precipitation_mm",
    "wind_speed_10m_max": "wind_speed_kmh",
}


def daily_payloads(daily: DataFrame, group: str, order: str = "date",
                   fields: Mapping[str, str] = DAILY_FIELDS) -> DataFrame:
    """Pack daily rows into payload records of parallel arrays, one record per
    ``group`` (e.g. a week), the shape a forecast API returns. Arrays are
    sorted by ``order`` so the i-th elements belong together.

    ``collect_list`` holds one group's rows in one task, so the group must be
    bounded by construction (a week holds at most seven days)."""
    cols = list(fields.values())
    packed = daily.groupBy(group).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias("__d"))
    def field(name):
        return lambda s: s[name]
    return packed.select(group, F.struct(*[
        F.transform("__d", field(c)).alias(f) for f, c in fields.items()
    ]).alias("daily"))


def flatten_daily(payloads: DataFrame, fields: Mapping[str, str] = DAILY_FIELDS) -> DataFrame:
    """Payload records -> one typed row per day."""
    rows = arrays_to_rows(payloads, "daily", fields)
    return rows.withColumn("date", F.to_date(F.col("date").cast("string")))


# The constant source and city columns of the forecast flow.
SERIES_SOURCE = "open_meteo_api"
SERIES_CITY = "Chennai"


def weather_features(df: DataFrame, run_ts: str | None = None, source: str = SERIES_SOURCE,
                     city: str = SERIES_CITY) -> DataFrame:
    """Mean and range of the temperatures, rain flag, day name, constants."""
    out = {
        "temp_avg_c": C.half_up((F.col("temp_max_c") + F.col("temp_min_c")) / 2, 1),
        "temp_range_c": C.half_up(F.col("temp_max_c") - F.col("temp_min_c"), 1),
        "is_rainy_day": F.col("precipitation_mm") > 0,
        "day_of_week": C.day_name("date"),
        "source": F.lit(source),
        "city": F.lit(city),
    }
    if run_ts is not None:
        out["ingestion_ts"] = F.lit(run_ts)
    return df.withColumns(out)


# Expected rows per weekly payload.
SERIES_ROWS = (6, 8)
SERIES_ROWS_NAME = "Row count = 7-8"


def series_checks(df: DataFrame, rows: tuple[int, int] = SERIES_ROWS) -> list[Q.Check]:
    """No nulls anywhere, max > min, rain >= 0, wind > 0, row count range."""
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return [
        Q.Check("No nulls", nulls, lambda m: m == 0, lambda m: F.lit("")),
        Q.all_rows(F.col("temp_max_c") > F.col("temp_min_c"), "Temp max > min"),
        Q.all_rows(F.col("precipitation_mm") >= 0, "Precipitation >= 0"),
        Q.all_rows(F.col("wind_speed_kmh") > 0, "Wind speed > 0"),
        Q.row_count_between(rows[0], rows[1], SERIES_ROWS_NAME),
    ]


def series_etl(spark: SparkSession, payload_path: str, out_path: str) -> DataFrame:
    """Landed JSON payloads -> daily rows with features, written as parquet and
    read back."""
    days = ", ".join(f"{f}: array<{'string' if f == 'time' else 'double'}>" for f in DAILY_FIELDS)
    payloads = read_json_payload(spark, payload_path, f"daily struct<{days}>", multiline=False)
    write_parquet(weather_features(flatten_daily(payloads)), out_path)
    return spark.read.parquet(out_path)


def series_summary(df: DataFrame) -> DataFrame:
    """Rows, first and last date, mean temperature, rainy days."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date"),
                  F.max("date").alias("last_date"),
                  C.half_up(F.avg("temp_avg_c"), 1).alias("avg_temp_c"),
                  F.count_if(F.col("is_rainy_day")).alias("rainy_days"))
