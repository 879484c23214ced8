"""Gold tables kept up to date from mergeable states.

A state row holds what an aggregate needs to go on: the number of trips, and
for each measure how many values it has and their exact sum. States are kept per pickup
month and day, zone, or hour and weekend flag, as a table partitioned by the
month. A batch touches some months; only these are read from silver, their
states are computed again and replace the old ones, and the gold tables are put
together from all states: a few rows per month instead of all of silver.

Sums are decimals, so a state table that grew batch by batch is equal, digit for
digit, to one computed from the whole of silver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import windows
from strata.plans import medallion as M
from strata.sources.sinks import overwrite_partitions

MONTH = "pickup_month"
MEASURES = ("fare_amount", "total_amount_incl_tip", "tip_amount", "trip_duration_mins", "trip_distance", "passenger_count")
_DAY, _ZONE, _HOUR = ["pickup_date"], ["pickup_zone_name", "pickup_borough"], ["pickup_hour", "is_weekend"]


def states(silver_df: DataFrame) -> DataFrame:
    """State rows of a silver frame (with ``pickup_month``), all three kinds from one scan.

    Grouping sets expand a row to three before the tasks add up; what is shuffled is a
    row per group and task."""
    keys = [MONTH, *_DAY, *_ZONE, *_HOUR]
    aggs = [F.count(F.lit(1)).alias("trips"), F.count_if(F.coalesce(F.col("has_tip"), F.lit(False))).alias("tipped")]
    for m in MEASURES:
        aggs += [F.count(m).alias(f"{m}_n"), C.money_sum(m, C.SUM_SCALE).alias(f"{m}_sum")]
    # The bits of the grouping id tell which keys a row does not have, the first key in the highest.
    without = {frozenset(s): sum(1 << (len(keys) - 1 - keys.index(k)) for k in keys if k not in s and k != MONTH)
               for s in map(tuple, (_DAY, _ZONE, _HOUR))}
    g = F.grouping_id()
    kind = (F.when(g == without[frozenset(_DAY)], F.lit("day")).when(g == without[frozenset(_ZONE)], F.lit("zone"))
            .otherwise(F.lit("hour")))
    return (silver_df.groupingSets([[MONTH, *s] for s in (_DAY, _ZONE, _HOUR)], *keys)
            .agg(kind.alias("kind"), *aggs).select("kind", *_DAY, *_ZONE, *_HOUR, "trips", "tipped",
                                                   *[f"{m}_{x}" for m in MEASURES for x in ("n", "sum")], MONTH))


def months_of(rows: DataFrame) -> list:
    """The months that rows lie in (a calendar's size)."""
    return [r[0] for r in rows.select(MONTH).distinct().orderBy(MONTH).collect()]


def read_months(spark: SparkSession, silver_path: str, months: Iterable) -> DataFrame:
    """The given months of a silver table partitioned by month: a static list, so no other folder is read."""
    return spark.read.parquet(silver_path).where(F.col(MONTH).isin([m for m in months if m is not None]))


def refresh_states(spark: SparkSession, silver_path: str, states_path: str, months: Iterable) -> None:
    """Computes the states of the given months anew and puts them in place of the old ones.

    Running it twice gives the same table. Months not given stay as they are."""
    overwrite_partitions(states(read_months(spark, silver_path, months)), states_path, [MONTH])


# ---------------------------------------------------------------- gold

def _merged(state_rows: DataFrame, kind: str, keys: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ["trips", "tipped", *[f"{m}_n" for m in MEASURES]]]
    sums += [F.sum(f"{m}_sum").cast("decimal(38,10)").alias(f"{m}_sum") for m in MEASURES]
    return state_rows.where(F.col("kind") == kind).groupBy(*keys).agg(*sums)


def _total(measure: str) -> Column:
    return C.stable(F.col(f"{measure}_sum"))


def _mean(measure: str) -> Column:
    return C.stable(F.try_divide(F.col(f"{measure}_sum").cast("double"), F.col(f"{measure}_n")))


def _stamped(df: DataFrame, run_ts: str | None) -> DataFrame:
    return df if run_ts is None else df.withColumn("_gold_ts", F.lit(run_ts).cast("timestamp"))


def daily_revenue(state_rows: DataFrame, rolling_rows: int = 7, run_ts: str | None = None) -> DataFrame:
    """:func:`medallion.daily_revenue` from states."""
    g = _merged(state_rows, "day", _DAY).select(
        "pickup_date", F.col("trips").alias("trip_count"), _total("fare_amount").alias("total_fare"),
        _total("total_amount_incl_tip").alias("total_revenue"), _mean("fare_amount").alias("avg_fare"),
        _mean("trip_duration_mins").alias("avg_duration_mins"), _mean("trip_distance").alias("avg_distance_miles"),
        F.col("tipped").alias("trips_with_tip"), _total("tip_amount").alias("total_tips"))
    g = g.withColumns({"tip_rate_pct": C.percent("trips_with_tip", "trip_count", 1),
                       "revenue_7d_rolling": C.half_up(windows.rolling_mean("total_revenue", "pickup_date", rolling_rows), 2)})
    return _stamped(g, run_ts).orderBy("pickup_date")


def zone_performance(state_rows: DataFrame, run_ts: str | None = None) -> DataFrame:
    """:func:`medallion.zone_performance` from states."""
    g = _merged(state_rows.where(F.col("pickup_zone_name").isNotNull()), "zone", _ZONE).select(
        *_ZONE, F.col("trips").alias("trip_count"), _total("fare_amount").alias("total_revenue"), _mean("fare_amount").alias("avg_fare"),
        _mean("trip_distance").alias("avg_distance_miles"), _mean("trip_duration_mins").alias("avg_duration_mins"),
        _mean("passenger_count").alias("avg_passengers")).withColumn("revenue_rank", windows.rank_desc("total_revenue"))
    return _stamped(g, run_ts).orderBy("revenue_rank", "pickup_zone_name")


def hourly_demand(state_rows: DataFrame, peak: int = M.PEAK_TRIPS, normal: int = M.NORMAL_TRIPS,
                  run_ts: str | None = None) -> DataFrame:
    """:func:`medallion.hourly_demand` from states."""
    g = _merged(state_rows, "hour", _HOUR).select(
        *_HOUR, F.col("trips").alias("trip_count"), _mean("fare_amount").alias("avg_fare"),
        _mean("trip_duration_mins").alias("avg_duration_mins")).withColumns({
            "period_label": C.flag_label("is_weekend", "Weekend", "Weekday"), "hour_label": C.hour_label("pickup_hour"),
            "demand_tier": C.tier("trip_count", [(peak, "peak"), (normal, "normal")], "off_peak")})
    return _stamped(g, run_ts).orderBy("pickup_hour", "is_weekend")


__all__ = ["states", "months_of", "read_months", "refresh_states", "daily_revenue", "zone_performance", "hourly_demand"]
