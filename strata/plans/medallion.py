"""Bronze -> silver -> gold pipelines over taxi-shaped trips.

Column roles default to the taxi names; the adapter in
:mod:`strata.plans.adapter` produces them from the test tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregate, enrich, quality, rules, upsert, windows
from strata.operators.rules import Rule
from strata.sources.readers import read_optional
from strata.sources.sinks import by_partition, ensure_database, register_path


@dataclass(frozen=True)
class Limits:
    """Business-rule limits of the cleansing step.

    Fixed values of the reference: fares strictly between 0 and 500, at most
    6 passengers. Pass other limits for other data."""
    min_fare: float = 0.0
    max_fare: float = 500.0
    max_passengers: int = 6


# Fixed value: payment code -> label, anything else "Unknown".
PAYMENT_LABELS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute"}


# ------------------------------------------------------------------ bronze

def land(df: DataFrame, batch_id: str, run_ts: str | Column | None = None,
         source_file: Column | None = None, hash_columns: Sequence[str] | None = None,
         hash_text: bool = False, null_marker: str | None = None) -> DataFrame:
    """Bronze metadata: ``_ingestion_ts``, ``_batch_id``, ``_source_file``,
    ``_row_hash`` (md5 over the source columns joined by '|').

    ``run_ts`` is fixed once per run (a literal) so every action sees the
    same value; ``source_file`` defaults to the hidden ``_metadata.file_path``
    of file scans. ``hash_text=True`` renders doubles and timestamps in an
    engine-independent form before hashing."""
    cols = list(hash_columns or df.columns)
    types = dict(df.dtypes)
    parts = [C.canonical_text(c, types.get(c)) if hash_text else F.col(c) for c in cols]
    ts = run_ts if isinstance(run_ts, Column) else (
        F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp())
    return df.withColumns({
        "_ingestion_ts": ts,
        "_batch_id": F.lit(batch_id),
        "_source_file": source_file if source_file is not None else _file_path(df),
        "_row_hash": C.row_hash(parts, "|", null_marker),
    })


def _file_path(df: DataFrame) -> Column:
    """The scanned file of each row (hidden ``_metadata`` column of file
    sources); null when the frame does not come from files or joins several
    tables: pass ``source_file`` there."""
    if df._jdf.queryExecution().analyzed().collectLeaves().size() == 1:
        try:
            df.select(F.col("_metadata.file_path")).schema
            return F.col("_metadata.file_path")
        except AnalysisException:
            pass
    return F.lit(None).cast("string")


def write_bronze(raw: DataFrame, path: str, batch_id: str, run_ts: str,
                 hash_columns: Sequence[str] | None = None,
                 source_file: Column | None = None) -> DataFrame:
    """Land one batch idempotently: the batch goes to its own ``_batch_id``
    partition with dynamic overwrite, so re-running a batch replaces it and
    leaves the other batches alone. Returns the landed table read back."""
    landed = land(raw, batch_id, run_ts, source_file=source_file, hash_columns=hash_columns)
    (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_batch_id").parquet(path))   # one value: no regrouping needed
    return raw.sparkSession.read.schema(landed.schema).parquet(path)  # batch ids stay text


# ------------------------------------------------------------------ silver

def quality_rules(limits: Limits = Limits(), pickup: str = "tpep_pickup_datetime",
                  dropoff: str = "tpep_dropoff_datetime", fare: str = "fare_amount",
                  distance: str = "trip_distance",
                  passengers: str = "passenger_count") -> list[Rule]:
    """Critical fields present, distance / fare / passenger ranges, dropoff
    after pickup."""
    f, p = F.col(fare), F.col(passengers)
    return [
        ("pickup_present", F.col(pickup).isNotNull()),
        ("dropoff_present", F.col(dropoff).isNotNull()),
        ("fare_present", f.isNotNull()),
        ("distance_positive", F.col(distance) > 0),
        ("fare_in_range", (f > limits.min_fare) & (f < limits.max_fare)),
        ("passengers_in_range", (p > 0) & (p <= limits.max_passengers)),
        ("dropoff_after_pickup", F.col(dropoff) > F.col(pickup)),
    ]


def derive(df: DataFrame, batch_col: str = "_batch_id", run_ts: str | None = None,
           pickup: str = "tpep_pickup_datetime", dropoff: str = "tpep_dropoff_datetime",
           fare: str = "fare_amount", tip: str = "tip_amount",
           distance: str = "trip_distance", payment: str = "payment_type") -> DataFrame:
    """Silver derived columns (duration, fare per mile, totals, date parts,
    labels, flags, silver metadata)."""
    out = {
        "trip_duration_mins": C.duration_minutes(pickup, dropoff, 1,
                                                 C.is_wall_clock(df, pickup)),
        "fare_per_mile": C.ratio(fare, distance, 2),
        "total_amount_incl_tip": C.plus_default(fare, tip, 0.0),
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_dow": F.dayofweek(pickup),
        "is_weekend": C.is_weekend(pickup),
        "payment_label": C.label(payment, PAYMENT_LABELS, "Unknown"),
        "has_tip": F.col(tip) > 0,
    }
    if run_ts is not None:
        out["_silver_ts"] = F.lit(run_ts).cast("timestamp")
    if batch_col in df.columns:
        out["_silver_batch"] = F.col(batch_col)
    return df.withColumns(out)


def attach_zones(df: DataFrame, zone_lookup: DataFrame | None,
                 location: str = "PULocationID") -> DataFrame:
    """Left join to the zone lookup; without one, typed null columns."""
    if zone_lookup is None:
        return enrich.add_missing(df, {"pickup_borough": "string",
                                       "pickup_zone_name": "string"})
    return enrich.enrich(df, zone_lookup, location, "LocationID",
                         {"Borough": "pickup_borough", "Zone": "pickup_zone_name"})


def silver(bronze: DataFrame, zone_lookup: DataFrame | None, limits: Limits = Limits(),
           run_ts: str | None = None) -> DataFrame:
    """Cleanse, derive and enrich in one plan (filters reach the scan)."""
    kept = rules.keep(bronze, quality_rules(limits))
    return attach_zones(derive(kept, run_ts=run_ts), zone_lookup)


def write_silver(bronze: DataFrame, zone_lookup: DataFrame | None, path: str,
                 limits: Limits = Limits(), run_ts: str | None = None,
                 partition_by: Sequence[str] | None = ("pickup_month",),
                 raw_rows: int | None = None, keys: Sequence[str] | None = None,
                 order: Sequence[str] | None = None) -> dict:
    """Cleanse, derive, enrich and write silver in ONE job; the stage counts
    (raw rows, rows kept by the rules) are gathered during that job with
    ``Observation`` instead of extra counting scans. Returns the counts.

    Where the number of raw rows is known (``raw_rows``: the audit of the batch counted
    them) nothing stands between the rules and the scan, so they reach the files.
    With ``keys`` and ``order`` the latest row of each key is written.

    Silver is partitioned by pickup month: date filters prune whole folders,
    and since the month is a function of the trip key an upsert rewrites only
    the months it touches (``upsert_into_path(partition_col="pickup_month")``).
    Months, not days: a folder per day multiplies small files and listing
    cost without adding pruning that matters for monthly batches."""
    raw_obs, kept_obs = Observation("raw"), Observation("kept")
    observed = bronze if raw_rows is not None else bronze.observe(raw_obs, F.count(F.lit(1)).alias("raw_rows"))
    kept = rules.keep(observed, quality_rules(limits)).observe(
        kept_obs, F.count(F.lit(1)).alias("kept_rows"))
    out = with_month(attach_zones(derive(kept, run_ts=run_ts), zone_lookup))
    if keys:
        out = upsert.dedupe_source(out, keys, order)
    if partition_by:
        out = by_partition(out, partition_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    raw_n = raw_obs.get["raw_rows"] if raw_rows is None else raw_rows
    kept_n = kept_obs.get["kept_rows"]
    return {"raw_rows": raw_n, "kept_rows": kept_n, "rejected_rows": raw_n - kept_n,
            "rejected_pct": round((raw_n - kept_n) * 100.0 / raw_n, 1) if raw_n else None}


def with_month(df: DataFrame, date_col: str = "pickup_date") -> DataFrame:
    """Adds ``pickup_month`` (first day of the month), the silver partition."""
    return df.withColumn("pickup_month", F.trunc(date_col, "month"))


# -------------------------------------------------------------------- gold

def daily_revenue(silver_df: DataFrame, rolling_rows: int = 7,
                  run_ts: str | None = None) -> DataFrame:
    """Revenue by pickup date, tip rate and a 7-row rolling mean of revenue.

    Money totals are summed exactly in decimal (``money_sum``); sums and
    means are fixed at 6 decimals (``stable``) so reruns on another
    partitioning give identical numbers.

    The rolling window runs after the aggregate: one row per day, so its
    single partition holds a calendar, not the data."""
    g = (silver_df.groupBy("pickup_date").agg(
            F.count(F.lit(1)).alias("trip_count"),
            C.stable(C.money_sum("fare_amount", C.SUM_SCALE)).alias("total_fare"),
            C.stable(C.money_sum("total_amount_incl_tip", C.SUM_SCALE)).alias("total_revenue"),
            C.stable(F.avg("fare_amount")).alias("avg_fare"),
            C.stable(F.avg("trip_duration_mins")).alias("avg_duration_mins"),
            C.stable(F.avg("trip_distance")).alias("avg_distance_miles"),
            F.count_if(F.coalesce(F.col("has_tip"), F.lit(False))).alias("trips_with_tip"),
            C.stable(C.money_sum("tip_amount", C.SUM_SCALE)).alias("total_tips"))
         .withColumn("tip_rate_pct", C.percent("trips_with_tip", "trip_count", 1))
         .withColumn("revenue_7d_rolling", C.half_up(
             windows.rolling_mean("total_revenue", "pickup_date", rolling_rows), 2)))
    if run_ts is not None:
        g = g.withColumn("_gold_ts", F.lit(run_ts).cast("timestamp"))
    return g.orderBy("pickup_date")


def zone_performance(silver_df: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Metrics per pickup zone, ranked by fare revenue (ties share a rank)."""
    g = (silver_df.filter(F.col("pickup_zone_name").isNotNull())
         .groupBy("pickup_zone_name", "pickup_borough").agg(
            F.count(F.lit(1)).alias("trip_count"),
            C.stable(C.money_sum("fare_amount", C.SUM_SCALE)).alias("total_revenue"),
            C.stable(F.avg("fare_amount")).alias("avg_fare"),
            C.stable(F.avg("trip_distance")).alias("avg_distance_miles"),
            C.stable(F.avg("trip_duration_mins")).alias("avg_duration_mins"),
            C.stable(F.avg("passenger_count")).alias("avg_passengers"))
         .withColumn("revenue_rank", windows.rank_desc("total_revenue")))
    if run_ts is not None:
        g = g.withColumn("_gold_ts", F.lit(run_ts).cast("timestamp"))
    return g.orderBy("revenue_rank", "pickup_zone_name")


# Demand tiers of the reference (trips per hour cell).
PEAK_TRIPS, NORMAL_TRIPS = 5000, 2000


def hourly_demand(df: DataFrame, peak: int = PEAK_TRIPS, normal: int = NORMAL_TRIPS,
                  hour: str = "pickup_hour", weekend: str = "is_weekend",
                  fare: str = "fare_amount", duration: str | None = "trip_duration_mins",
                  run_ts: str | None = None) -> DataFrame:
    """Trips per (hour, weekend) with labels and a demand tier."""
    aggs = [F.count(F.lit(1)).alias("trip_count"), C.stable(F.avg(fare)).alias("avg_fare")]
    if duration:
        aggs.append(C.stable(F.avg(duration)).alias("avg_duration_mins"))
    g = (df.groupBy(F.col(hour).alias("pickup_hour"), F.col(weekend).alias("is_weekend"))
           .agg(*aggs)
           .withColumn("period_label", C.flag_label("is_weekend", "Weekend", "Weekday"))
           .withColumn("hour_label", C.hour_label("pickup_hour"))
           .withColumn("demand_tier", C.tier("trip_count",
                                             [(peak, "peak"), (normal, "normal")],
                                             "off_peak")))
    if run_ts is not None:
        g = g.withColumn("_gold_ts", F.lit(run_ts).cast("timestamp"))
    return g.orderBy("pickup_hour", "is_weekend")


def dashboard(daily: DataFrame, zones_df: DataFrame) -> DataFrame:
    """(metric, value) summary: totals from the daily table in ONE scan,
    plus the top-ranked zone(s)."""
    totals = aggregate.metric_rows(daily, {
        "Total Revenue": C.money_text(F.sum("total_revenue")),
        "Total Trips": C.count_text(F.sum("trip_count")),
        "Avg Daily Revenue": C.money_text(F.avg("total_revenue")),
    })
    top = zones_df.filter(F.col("revenue_rank") == 1).select(
        F.lit("Top Zone").alias("metric"), F.col("pickup_zone_name").alias("value"))
    return totals.unionByName(top)


def silver_validation(silver_df: DataFrame) -> DataFrame:
    """(check, value, rows) of a written silver: null durations, negative fares and
    the rows of each payment label."""
    counts = silver_df.agg(
        F.count_if(F.col("trip_duration_mins").isNull()).alias("null_durations"),
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"))
    checks = counts.unpivot([], ["null_durations", "negative_fares"], "check", "rows")
    labels = silver_df.groupBy("payment_label").agg(F.count(F.lit(1)).alias("rows"))
    return (checks.select("check", F.lit(None).cast("string").alias("value"), "rows")
            .unionByName(labels.select(F.lit("payment_label").alias("check"),
                                       F.col("payment_label").alias("value"), "rows")))


# ------------------------------------------------------------- whole run

# Fixed value: the MERGE key of the silver table in the reference.
SILVER_KEYS = ("VendorID", "tpep_pickup_datetime", "PULocationID")


def run_layers(raw: DataFrame, zone_lookup: DataFrame | None, base: str, batch_id: str,
               run_ts: str, limits: Limits = Limits(), keys: Sequence[str] = SILVER_KEYS,
               order: Sequence[str] = ("_ingestion_ts",),
               source_file: Column | None = None, database: str | None = None,
               audit_key: str = "tpep_pickup_datetime", gold: bool = True) -> dict:
    """Bronze -> silver -> gold for one batch, every layer written as files.

    * bronze: the batch lands in its own ``_batch_id`` partition (re-running
      a batch replaces it); its audit record (rows, null ``audit_key`` values,
      status) goes to ``audit`` in the same way;
    * silver: the batch is cleansed and enriched, then merged on ``keys``
      into ``silver`` (partitioned by pickup month: only touched months are
      rewritten); within the batch the latest row by ``order`` wins;
    * gold: the months that the batch touches are read from silver and their states
      replaced (:mod:`strata.plans.gold_states`); daily revenue, zone performance and
      hourly demand are put together from all states and overwritten. Without
      ``gold`` this step is left out.

    With ``database`` the layers are also registered as external catalog
    tables (``<database>.bronze_trips``, ``.silver_trips``, ``.gold_*``).

    Returns the stage counts of the batch and the row counts of each table.
    """
    from strata.plans import gold_states      # it builds on this module
    spark = raw.sparkSession
    silver_path, states_path = f"{base}/silver", f"{base}/gold_states"
    silver_exists = read_optional(spark, silver_path, "parquet") is not None
    bronze = write_bronze(raw, f"{base}/bronze", batch_id, run_ts, source_file=source_file)
    batch = bronze.filter(F.col("_batch_id") == batch_id)
    (quality.batch_audit(batch, "bronze", "bronze_trips", batch_id, audit_key, run_ts)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(f"{base}/audit"))
    raw_rows = (spark.read.schema("rows_written long, batch_id string").parquet(f"{base}/audit")
                .where(F.col("batch_id") == batch_id).first()["rows_written"])
    staged = f"{base}/silver_batches/{batch_id}"
    counts = write_silver(batch, zone_lookup, staged, limits, run_ts, partition_by=None,
                          raw_rows=raw_rows, keys=keys, order=order)
    source = spark.read.parquet(staged)
    if silver_exists:
        upsert.upsert_into_path(source, silver_path, keys, order, partition_col="pickup_month", staged=True)
    else:
        (by_partition(source, "pickup_month").write.mode("overwrite")
             .partitionBy("pickup_month").parquet(silver_path))
    silver_df = spark.read.parquet(silver_path)
    tables, gold_tables = {"silver": silver_df.count()}, {}
    if gold:
        known = read_optional(spark, states_path, "parquet") is not None
        gold_states.refresh_states(spark, silver_path, states_path, gold_states.months_of(source if known else silver_df))
        rows = spark.read.parquet(states_path)
        gold_tables = {"daily_revenue": gold_states.daily_revenue(rows, run_ts=run_ts),
                       "zone_performance": gold_states.zone_performance(rows, run_ts=run_ts),
                       "hourly_demand": gold_states.hourly_demand(rows, run_ts=run_ts)}
    for name, df in gold_tables.items():
        df.write.mode("overwrite").parquet(f"{base}/gold/{name}")
        tables[name] = spark.read.parquet(f"{base}/gold/{name}").count()
    if database:
        ensure_database(spark, database)
        register_path(spark, f"{database}.bronze_trips", f"{base}/bronze", partitioned=True)
        register_path(spark, f"{database}.silver_trips", silver_path, partitioned=True)
        for name in gold_tables:
            register_path(spark, f"{database}.gold_{name}", f"{base}/gold/{name}")
    return {"stage_counts": counts, "tables": tables}
