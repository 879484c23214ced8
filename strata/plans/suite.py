"""The registered queries: each operator family run over the whole test
tables. Every function takes ``(spark, sf_dir)`` and returns a DataFrame;
``strata.plans.oracle`` holds the equivalent SQL for each name.

Fixed choices for the test tables (see the adapter for the role mapping):
fares up to 50,000 (order prices are large), staging start 1996-01-01,
demand tiers 300 / 110 events per hour cell, and region ``MIDDLE EAST`` left
out of the zone lookup where unmatched rows are wanted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregate, enrich, ordered, quality as Q, rules, upsert, windows
from strata.plans import adapter, etl, gate, medallion as M, staging
from strata.session import scratch_path
from strata.sources import readers, sinks
from strata.streaming import consumer, landing, monitor, publish

LIMITS = M.Limits(max_fare=50_000.0)
VARS = staging.ModelVars(start_date="1996-01-01", max_fare_usd=50_000.0)
TIE_BREAKERS = ("l_orderkey", "l_linenumber", "l_partkey")
RUN_TS = "2024-01-01 00:00:00"
BATCH_ID = "batch_001"
DROPPED_REGION = "MIDDLE EAST"
PEAK, NORMAL = 300, 110
TRIP_KEYS = ("l_orderkey", "l_linenumber", "l_partkey")


def _t(spark, sf, name):
    return readers.read_table(spark, sf, name)


def _silver(spark, sf, drop_region=None):
    raw = adapter.trips(spark, sf).withColumn("_batch_id", F.lit(BATCH_ID))
    return M.silver(raw, adapter.zones(spark, sf, drop_region), LIMITS)


# ------------------------------------------------------------------ bronze

def landing_metadata(spark: SparkSession, sf: str) -> DataFrame:
    orders = _t(spark, sf, "orders")
    landed = M.land(orders, BATCH_ID, RUN_TS, hash_text=True,
                    hash_columns=orders.columns)
    return landed.select(
        "o_orderkey", "_batch_id", "_row_hash",
        F.col("_ingestion_ts").cast("timestamp_ntz").alias("_ingestion_ts"),
        F.regexp_extract("_source_file", r"[^/]+$", 0).alias("_source_file"))


def batch_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows for line items keyed by supplier, and for the same rows with
    the supplier missing on line 7 (a WARNING case), from one scan."""
    li = _t(spark, sf, "lineitem")
    nulled = F.when(F.col("l_linenumber") == 7, None).otherwise(F.col("l_suppkey"))
    return Q.batch_audits(li, "bronze", BATCH_ID, {"lineitem": F.col("l_suppkey"),
                                                    "lineitem_nulled": nulled})


def bronze_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze ingest: land, overwrite an external table, read back, audit."""
    orders = _t(spark, sf, "orders")
    landed = M.land(orders, BATCH_ID, RUN_TS, hash_text=True, hash_columns=orders.columns)
    path = scratch_path(spark, "bronze-orders")
    name = "bronze_orders_" + path.rsplit("-", 1)[-1]
    sinks.overwrite_table(landed, name, path)
    back = readers.read_catalog(spark, name)
    audit = Q.batch_audit(back, "bronze", "bronze_orders", BATCH_ID, "o_orderkey")
    # Hashes are grouped by themselves, so that the audit stays a count in each task.
    hashes = back.groupBy("_row_hash").agg(F.lit(1)).agg(F.count("_row_hash").alias("distinct_hashes"))
    return audit.join(F.broadcast(hashes))


# ------------------------------------------------------------------ silver

SILVER_COLUMNS = [
    *TRIP_KEYS, "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "PULocationID", "payment_type", "fare_amount",
    "tip_amount", "total_amount", "trip_duration_mins", "fare_per_mile",
    "total_amount_incl_tip", "pickup_date", "pickup_hour", "pickup_dow", "is_weekend",
    "payment_label", "has_tip", "_silver_batch", "pickup_borough", "pickup_zone_name"]


def silver_cleansed(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf).select(*SILVER_COLUMNS)


def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.stage_counts(adapter.trips(spark, sf), M.quality_rules(LIMITS))


def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = staging.filtered(staging.renamed(adapter.trips(spark, sf), TIE_BREAKERS), VARS)
    return kept.select(*TIE_BREAKERS, "vendor_id", "pickup_datetime", "dropoff_datetime",
                       "fare_usd", "distance_miles", "passenger_count")


def trip_derived(spark: SparkSession, sf: str) -> DataFrame:
    d = M.derive(adapter.trips(spark, sf))
    return d.select(*TRIP_KEYS, "trip_duration_mins", "fare_per_mile",
                    "total_amount_incl_tip", "pickup_date", "pickup_hour", "pickup_dow",
                    "is_weekend", "has_tip")


def guarded_ratio(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        C.guarded_ratio("l_extendedprice", "l_discount").alias("price_per_discount"),
        F.coalesce(F.nullif(F.col("l_tax"), F.lit(0.0)), F.lit(0.0)).alias("tax_or_zero"))


def payment_label(spark: SparkSession, sf: str) -> DataFrame:
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    labelled = _t(spark, sf, "orders").select(
        C.label(code, M.PAYMENT_LABELS, "Unknown").alias("payment_label"))
    return aggregate.frequency(labelled, "payment_label", "count")


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", d.alias("trip_date"), F.year(d).alias("trip_year"),
                    F.month(d).alias("trip_month"),
                    C.weekday_number(d, sunday=0).alias("day_of_week"),
                    C.is_weekend(d).alias("is_weekend"), C.day_name(d).alias("day_name"))


def zone_left_join(spark: SparkSession, sf: str) -> DataFrame:
    t = adapter.trips(spark, sf)
    z = adapter.zones(spark, sf, DROPPED_REGION)
    return M.attach_zones(t, z).select(*TRIP_KEYS, "PULocationID", "pickup_borough",
                                       "pickup_zone_name")


def heavy_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined to customers as to a dimension too large to broadcast, with a third
    of the orders at one customer (and another part at none)."""
    orders = _t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).when(
        F.col("o_orderkey") % 7 > 0, F.col("o_custkey")).alias("customer"))
    return enrich.enrich(orders, _t(spark, sf, "customer"), "customer", "c_custkey",
                         {"c_name": "c_name", "c_nationkey": "c_nationkey"}, broadcast_bytes=0, salt=True)


def zone_match_count(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.match_count(zone_left_join(spark, sf), "pickup_zone_name")


def null_safe_join(spark: SparkSession, sf: str) -> DataFrame:
    cust = _t(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_nationkey"), F.lit(0)).alias("cust_nation"))
    nation = _t(spark, sf, "nation").select(
        F.nullif(F.col("n_nationkey"), F.lit(0)).alias("nation_key"), "n_name")
    return enrich.enrich(cust, nation, "cust_nation", "nation_key", {"n_name": "n_name"},
                         null_safe=True, keep_right_key=True)


# -------------------------------------------------------------------- gold

def daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return M.daily_revenue(_silver(spark, sf))


def zone_performance(spark: SparkSession, sf: str) -> DataFrame:
    return M.zone_performance(_silver(spark, sf))


def _events_hourly(spark, sf):
    ev = adapter.events_as_trips(spark, sf).withColumns({
        "pickup_hour": F.hour("tpep_pickup_datetime"),
        "is_weekend": C.is_weekend("tpep_pickup_datetime")})
    return M.hourly_demand(ev, PEAK, NORMAL, duration=None)


def hourly_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Both averages (fare and duration) over silver."""
    return M.hourly_demand(_silver(spark, sf), PEAK, NORMAL)


def hourly_demand(spark: SparkSession, sf: str) -> DataFrame:
    return _events_hourly(spark, sf)


def dashboard(spark: SparkSession, sf: str) -> DataFrame:
    """Silver is written once; both gold tables read it back."""
    s = sinks.persist(_silver(spark, sf), scratch_path(spark, "silver"))
    return M.dashboard(M.daily_revenue(s), M.zone_performance(s))


def gold_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Silver written once; the three gold tables overwritten as external
    tables; (table, rows) read back from the catalog."""
    s = sinks.persist(_silver(spark, sf), scratch_path(spark, "silver"))
    tag = scratch_path(spark, "gold").rsplit("-", 1)[-1]
    gold = {"gold_daily_revenue": M.daily_revenue(s, run_ts=RUN_TS),
            "gold_zone_performance": M.zone_performance(s, run_ts=RUN_TS),
            "gold_hourly_demand": _events_hourly(spark, sf)}
    out = None
    for name, df in gold.items():
        table = f"{name}_{tag}"
        sinks.overwrite_table(df, table, scratch_path(spark, name))
        n = readers.read_catalog(spark, table).agg(F.count(F.lit(1)).alias("rows")) \
            .select(F.lit(name).alias("table_name"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


def layered_run(spark: SparkSession, sf: str) -> DataFrame:
    """One batch through bronze, silver (merged on the trip key, latest row
    per key) and gold, all as files; returns gold daily revenue read back."""
    base = scratch_path(spark, "layers")
    M.run_layers(adapter.trips(spark, sf), adapter.zones(spark, sf), base, BATCH_ID, RUN_TS,
                 LIMITS, order=("_ingestion_ts", *TIE_BREAKERS),
                 source_file=F.lit(None).cast("string"))  # joined input: no single file
    return spark.read.parquet(f"{base}/gold/daily_revenue").drop("_gold_ts")


def _two_batches(spark, sf, gold=False, database=None):
    """Two batches with overlapping months through the layers: the second has
    other fares, some location keys are null, and the ids look like numbers."""
    raw = adapter.trips(spark, sf).withColumn(
        "PULocationID", F.nullif(F.col("PULocationID"), F.lit(0)))
    day = F.col("tpep_pickup_datetime")
    batches = {"001": raw.filter(day < FIRST_BATCH_END),
               "2023_02": raw.filter(day >= SECOND_BATCH_START)
                             .withColumn("fare_amount", F.col("fare_amount") + 1.0)}
    base = scratch_path(spark, "batches")
    for batch_id, rows in batches.items():
        M.run_layers(rows, adapter.zones(spark, sf), base, batch_id, RUN_TS, LIMITS,
                     order=TIE_BREAKERS, source_file=F.lit(None).cast("string"), gold=gold, database=database)
    return base


FIRST_BATCH_END, SECOND_BATCH_START = "1996-01-01", "1995-07-01"


def silver_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Silver after the second batch is merged into the first's."""
    return spark.read.parquet(f"{_two_batches(spark, sf)}/silver").select(
        *M.SILVER_KEYS, *TRIP_KEYS, "fare_amount", "pickup_month", "_silver_batch")


def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of the three gold tables after the second of two batches, read from
    the catalog; only the months of a batch are read from silver for them."""
    db = "gold_" + scratch_path(spark, "db").rsplit("-", 1)[-1]
    _two_batches(spark, sf, gold=True, database=db)

    def of(table, key, *columns):
        names = ("trip_count", "total_revenue", "avg_fare", "avg_duration_mins", "figure", "note")
        return spark.table(f"{db}.gold_{table}").select(F.lit(table).alias("table_name"), key.alias("key"),
                                                        *[c.alias(n) for c, n in zip(columns, names)])
    common = [F.col(c) for c in ("trip_count", "total_revenue", "avg_fare", "avg_duration_mins")]
    none = F.lit(None)
    daily = of("daily_revenue", F.col("pickup_date").cast("string"), *common, F.col("revenue_7d_rolling"), none.cast("string"))
    zone = of("zone_performance", F.col("pickup_zone_name"), *common, F.col("revenue_rank").cast("double"), F.col("pickup_borough"))
    hour = of("hourly_demand", F.concat_ws(" ", "hour_label", "period_label"), F.col("trip_count"), none.cast("double"),
              F.col("avg_fare"), F.col("avg_duration_mins"), none.cast("double"), F.col("demand_tier"))
    return daily.unionByName(zone).unionByName(hour)


def silver_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Null durations, negative fares and label counts of the merged silver."""
    return M.silver_validation(spark.read.parquet(f"{_two_batches(spark, sf)}/silver"))


def bronze_audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """The audit records that the two batches left (batch ids read as text)."""
    return spark.read.schema("layer string, table_name string, rows_written long, null_keys long, "
                             "status string, batch_id string").parquet(f"{_two_batches(spark, sf)}/audit")


def run_history(spark: SparkSession, sf: str) -> DataFrame:
    """One audit record per order year appended to an audit table, then the
    latest five runs (a top-n report)."""
    o = _t(spark, sf, "orders")
    audit = (o.groupBy(F.year("o_orderdate").alias("y")).agg(
                F.count(F.lit(1)).alias("rows_written"),
                F.count_if(F.col("o_orderkey").isNull()).alias("null_keys"),
                F.max("o_orderdate").alias("run_ts"))
              .select(F.lit("bronze").alias("layer"), F.lit("orders").alias("table_name"),
                      F.concat(F.lit("year_"), F.col("y").cast("string")).alias("batch_id"),
                      "rows_written", "null_keys", "run_ts"))
    path = scratch_path(spark, "audit")
    table = "audit_log_" + path.rsplit("-", 1)[-1]
    sinks.append_table(audit, table, path=path)
    return sinks.run_history(readers.read_catalog(spark, table), 5)


def zone_file_join(spark: SparkSession, sf: str) -> DataFrame:
    """Zone lookup landed as a CSV file (header, inferred types) and joined;
    a second lookup at a path that does not exist falls back to typed
    null columns."""
    path = scratch_path(spark, "zone-csv")
    sinks.write_csv(adapter.zones(spark, sf), path)
    found = readers.read_optional(spark, path, "csv", options={"header": "true",
                                                               "inferSchema": "true"})
    missing = readers.read_optional(spark, scratch_path(spark, "absent"), "csv",
                                    options={"header": "true"})
    t = M.attach_zones(adapter.trips(spark, sf), found)
    if missing is None:
        t = enrich.add_missing(t, {"dropoff_zone_name": "string"})
    else:
        t = enrich.enrich(t, missing, "DOLocationID", "LocationID", {"Zone": "dropoff_zone_name"})
    return t.select(*TRIP_KEYS, "pickup_borough", "pickup_zone_name", "dropoff_zone_name")


# ---------------------------------------------------------- staging / mart

def _staged(spark, sf):
    return staging.stg_trips(adapter.trips(spark, sf), VARS, TIE_BREAKERS)


def staged_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _staged(spark, sf)


def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     C.surrogate_key("l_orderkey", "l_linenumber", F.to_date("l_shipdate"))
                     .alias("line_key"))


def daily_mart(spark: SparkSession, sf: str) -> DataFrame:
    return staging.daily_mart(_staged(spark, sf))


def _order_days(spark, sf):
    return (_t(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("order_date"))
            .agg(F.count(F.lit(1)).alias("order_count"),
                 C.half_up(F.sum("o_totalprice"), 2).alias("revenue")))


def rolling_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _order_days(spark, sf).withColumn(
        "revenue_7_rows", C.half_up(windows.rolling_mean("revenue", "order_date", 7), 2))


def day_over_day(spark: SparkSession, sf: str) -> DataFrame:
    return _order_days(spark, sf).withColumn(
        "revenue_change", C.half_up(windows.change("revenue", "order_date"), 2))


def rank_days(spark: SparkSession, sf: str) -> DataFrame:
    return _order_days(spark, sf).withColumns({
        "count_rank": windows.rank_desc("order_count"),
        "count_dense_rank": windows.rank_desc("order_count", dense=True)})


# Columns that tell all line items apart.
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def rolling_facts(spark: SparkSession, sf: str) -> DataFrame:
    """All line items in shipping order: mean price over 7 rows and change to the row before."""
    li = _t(spark, sf, "lineitem").select(*LINE_KEYS, "l_shipdate", "l_extendedprice")

    def mean(w):
        rows = w.rowsBetween(-6, 0)
        total = C.money_sum("l_extendedprice", C.SUM_SCALE).over(rows).cast("double")
        return C.half_up(total / F.count("l_extendedprice").over(rows), 4)
    return ordered.windowed(li, ["l_shipdate"], LINE_KEYS, 7, {
        "price_7_rows": mean,
        "price_change": lambda w: C.half_up(F.col("l_extendedprice") - F.lag("l_extendedprice").over(w), 4)})


def running_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Quantity and price shipped up to each line item, and the item's number."""
    li = _t(spark, sf, "lineitem").select(*LINE_KEYS, "l_shipdate", "l_quantity", "l_extendedprice")
    totals = ordered.running(li, ["l_shipdate"], LINE_KEYS, {
        "quantity_so_far": F.col("l_quantity").cast("decimal(38,2)"), "price_so_far": F.col("l_extendedprice").cast("decimal(38,2)")})
    return totals.select(*LINE_KEYS, F.col("quantity_so_far").cast("double").alias("quantity_so_far"),
                         C.half_up("price_so_far", 2).alias("price_so_far"))


def rank_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Rank and dense rank of all line items by price, and by quantity (50 values, each a
    fiftieth of the rows: they are spread over buckets by the tie columns)."""
    li = _t(spark, sf, "lineitem").select(*LINE_KEYS, "l_extendedprice", "l_quantity")
    by_price = ordered.ranked(li, [("l_extendedprice", False)], LINE_KEYS, "price_rank", "price_dense")
    return ordered.ranked(by_price, [("l_quantity", False)], LINE_KEYS, "quantity_rank", "quantity_dense")


def mart_table(spark: SparkSession, sf: str) -> DataFrame:
    """The daily mart kept as a table and read from the catalog."""
    path = scratch_path(spark, "mart")
    return sinks.materialize(daily_mart(spark, sf), "mart_" + path.rsplit("-", 1)[-1], as_table=True, path=path)


def bronze_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Orders landed from a folder that grows: three runs, the last with nothing new."""
    orders = _t(spark, sf, "orders")
    source, bronze, ckpt = (scratch_path(spark, x) for x in ("drop", "bronze", "ckpt"))
    late = F.col("o_orderkey") % 3 == 0
    for name, part in (("d0", orders.where(~late)), ("d1", orders.where(late)), (None, None)):
        if name:
            part.repartition(2).write.parquet(f"{source}/{name}")
        landing.land_new_files(spark, f"{source}/*", bronze, ckpt, orders.schema, RUN_TS)
    return spark.read.parquet(bronze).select(
        "o_orderkey", "o_totalprice", "_batch_id", F.regexp_extract("_source_file", r"/(d\d)/[^/]+$", 1).alias("folder"))


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return windows.latest_per_key(li, ["l_orderkey", "l_linenumber"],
                                  ["l_shipdate", "l_partkey", "l_suppkey"], "rn")


# ------------------------------------------------------------- aggregates

def zone_summary(spark: SparkSession, sf: str) -> DataFrame:
    t = M.attach_zones(adapter.trips(spark, sf), adapter.zones(spark, sf, DROPPED_REGION))
    return etl.zone_summary(t, zone="pickup_zone_name", trip_id="l_orderkey",
                            fare="fare_amount", distance="trip_distance")


def median_fill(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", None)
        .otherwise(F.col("o_totalprice")).alias("price"))
    filled, _ = aggregate.impute_median(o, ["price"])
    return filled


def median_fill_types(spark: SparkSession, sf: str) -> DataFrame:
    """Median fill of an integer column with nulls and of one with NaN and nulls;
    constant fill of a text column."""
    status = F.col("o_orderstatus")
    o = _t(spark, sf, "orders").select(
        "o_orderkey",
        F.when(status != "P", F.col("o_custkey")).alias("customer"),
        F.when(status == "F", F.col("o_totalprice"))
         .when(status == "O", F.lit(float("nan"))).alias("price"),
        F.when(status != "P", F.col("o_orderpriority")).alias("priority"))
    filled, _ = aggregate.impute_median(o, ["customer", "price"])
    return aggregate.fill_constant(filled, {"priority": "none"}).withColumn(
        "customer", F.col("customer").cast("double"))


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct (flag, status) pairs themselves, null flags included."""
    return _nulled_lineitem(spark, sf).select("l_returnflag", "l_linestatus").distinct()


def zone_etl(spark: SparkSession, sf: str) -> DataFrame:
    """Derive, fill, filter, write, summarise, join and write both formats; fares
    of line 7 and tips of line 6 are missing."""
    t = M.attach_zones(adapter.trips(spark, sf), adapter.zones(spark, sf, DROPPED_REGION))
    line = F.col("l_linenumber")
    trips = t.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.col("pickup_zone_name").alias("pickup_zone"),
        F.col("trip_distance").alias("distance_km"),
        F.when(line != 7, F.col("fare_amount")).alias("fare_usd"),
        F.when(line != 6, F.col("tip_amount")).alias("tip_usd"))
    zones = adapter.zones(spark, sf).select(F.col("Zone").alias("zone"),
                                            F.col("Borough").alias("borough"))
    return etl.zone_etl(trips, zones, scratch_path(spark, "zone-etl"))


def _nulled_lineitem(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.withColumns({
        "l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
        "l_tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
        "l_returnflag": F.nullif(F.col("l_returnflag"), F.lit("N"))})


def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate.null_profile(_nulled_lineitem(spark, sf), completeness_digits=1)


def global_stats(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    return li.agg(F.count("l_quantity").alias("n"), C.stable(F.sum("l_quantity")).alias("total"),
                  C.stable(F.avg("l_quantity")).alias("mean"), F.max("l_quantity").alias("max"),
                  F.min("l_quantity").alias("min"),
                  F.count_if(F.col("l_returnflag") == "R").alias("returned"))


def distinct_and_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").withColumn(
        "l_linestatus", F.nullif(F.col("l_linestatus"), F.lit("O")))
    return aggregate.distinct_report(li, ["l_returnflag", "l_linestatus", "l_suppkey"])


def _fare_text(spark, sf):
    ev = _t(spark, sf, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("N/A"))
             .when(F.col("event_type") == "view", F.lit(""))
             .otherwise(F.get_json_object("props", "$.k")))
    return ev.select("event_id", text.alias("fare_text"))


def text_cast_split(spark: SparkSession, sf: str) -> DataFrame:
    return rules.cast_report(_fare_text(spark, sf), "fare_text", "double", sum_col="parsed_sum")


def safe_cast_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides of the split: parsed rows with their number, rejected ones with their text."""
    parsed, rejected = rules.safe_cast(_fare_text(spark, sf), "fare_text", "double", out="fare")
    return parsed.select("event_id", "fare", F.lit(None).cast("string").alias("rejected")).unionByName(
        rejected.select("event_id", F.lit(None).cast("double").alias("fare"),
                        F.col("fare_text").alias("rejected")))


def route_by_size(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem")
    size = C.tier("l_quantity", [(5, "short"), (15, "medium")], "long", above=False)
    routed = rules.route(li, {
        "short": F.col("l_quantity") < 5, "medium": F.col("l_quantity") < 15}, "long")
    return (routed.groupBy("_route").agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
                F.count_if(F.col("l_quantity") > 10).alias("n_over_10"),
                F.count_if(size == F.col("_route")).alias("n_consistent"))
              .withColumnRenamed("_route", "route"))


# ---------------------------------------------------------------- quality

def _gate_input(spark, sf):
    return gate.gate_frame(adapter.trips(spark, sf))


def _quarantine_folders(spark, sf):
    """Tag every row once, write clean and quarantined rows in one pass
    (routed by partition), then append the quarantined part to the
    bad-records folder from the written files."""
    g = _gate_input(spark, sf).withColumns({
        "payment_type_code": F.nullif(F.col("payment_type_code"), F.lit(5)),
        "fare_usd": F.when(F.col("pickup_location_id") == 0, None)
                     .otherwise(F.col("fare_usd"))})
    tagged = rules.tag(g, gate.quarantine_rules(), reason=gate.QUARANTINE_REASON)
    routed = scratch_path(spark, "routed")
    sinks.write_routed(tagged, routed, "_quarantined", F.col("_quarantine_reason").isNotNull())
    back = spark.read.parquet(routed)
    quarantined = back.filter(F.col("_quarantined").cast("string") == "true")
    bad_records = scratch_path(spark, "bad-records")
    sinks.write_quarantine(quarantined.drop("_quarantined"), bad_records)
    return back.drop("_quarantined"), spark.read.parquet(bad_records)


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return _quarantine_folders(spark, sf)[0]


def quarantine_written(spark: SparkSession, sf: str) -> DataFrame:
    """The bad-records folder read back."""
    return _quarantine_folders(spark, sf)[1]


def quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    """On a written layer: the key column alone is read again for uniqueness."""
    g = sinks.persist(_gate_input(spark, sf), scratch_path(spark, "gate"))
    return Q.run_checks(g, gate.trip_checks(g))


def quality_missing_column(spark: SparkSession, sf: str) -> DataFrame:
    """The gate over trips without a passenger count: the checks that need it fail."""
    g = sinks.persist(_gate_input(spark, sf).drop("passenger_count"), scratch_path(spark, "gate"))
    return Q.run_checks(g, gate.trip_checks(g))


def model_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Declared column tests of the bronze and staging models; bronze lacks the
    pickup of line 7 and has code 9 for 5, so that two tests fail."""
    trips = adapter.trips(spark, sf)
    bronze = trips.withColumns({
        "tpep_pickup_datetime": F.when(F.col("l_linenumber") != 7, F.col("tpep_pickup_datetime")),
        "payment_type": F.when(F.col("payment_type") == 5, 9).otherwise(F.col("payment_type"))})
    stg = sinks.persist(_staged(spark, sf), scratch_path(spark, "staged"))
    return staging.bronze_tests(bronze).unionByName(staging.staging_tests(stg))


def _daily_series(spark, sf):
    ev = _t(spark, sf, "events")
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(
        F.max("value").alias("temp_max_c"), F.min("value").alias("temp_min_c"),
        F.count_if(F.col("event_type") == "error").cast("double").alias("precipitation_mm"),
        C.stable(F.avg("value")).alias("wind_speed_kmh"))
    return daily


def series_checks(spark: SparkSession, sf: str) -> DataFrame:
    s = etl.weather_features(_daily_series(spark, sf))
    return Q.run_checks(s, etl.series_checks(s), overall="Overall")


def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    g = sinks.persist(_gate_input(spark, sf), scratch_path(spark, "gate"))
    _, scored, _, _ = gate.run_gate(g)
    return scored


def failing_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return Q.failing_not_null(_nulled_lineitem(spark, sf), "l_tax").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def failing_unique(spark: SparkSession, sf: str) -> DataFrame:
    li = _t(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return Q.failing_unique(li, "line_key")


def failing_values(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", None)
        .otherwise(F.col("o_orderstatus")))
    return Q.failing_values(o, "o_orderstatus", ["F", "O"])


# ----------------------------------------------------------------- upsert

def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Target: orders with status F or O; source: orders with status O or P,
    price raised by 1. O rows update, P rows insert, F rows stay.

    The target table is created empty if absent (schema of the data), loaded,
    then merged into a new version folder and read back."""
    orders = _t(spark, sf, "orders")
    target = orders.filter(F.col("o_orderstatus").isin("F", "O"))
    source = (orders.filter(F.col("o_orderstatus").isin("O", "P"))
                    .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    base = scratch_path(spark, "upsert")
    v0, v1 = f"{base}/v0", f"{base}/v1"
    name = "silver_orders_" + base.rsplit("-", 1)[-1]
    sinks.ensure_table(spark, target, name, v0)
    target.write.mode("append").saveAsTable(name)
    current = upsert.upsert_into_path(source, v0, ["o_orderkey"], new_path=v1)
    return spark.read.parquet(current)


def key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    return ev.select("event_id", "event_type",
                     C.lookup("event_type", EVENT_CLASSES).alias("event_class"))


# Event type -> class for the lookup query.
EVENT_CLASSES = {"view": "browse", "click": "browse", "purchase": "revenue",
                 "signup": "account", "error": "system"}


def tax_and_range(spark: SparkSession, sf: str) -> DataFrame:
    d = _t(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).agg(
        F.max("value").alias("hi"), F.min("value").alias("lo"),
        F.sum("value").alias("day_value"))
    return d.select(
        "date",
        C.half_up((F.col("hi") + F.col("lo")) / 2, 1).alias("mid_value"),
        C.half_up(F.col("hi") - F.col("lo"), 1).alias("value_range"),
        C.scaled("day_value", 1.18, 2).alias("value_with_tax"))


def unpivot_record(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    text = c.select("c_custkey", F.col("c_name"),
                    F.col("c_nationkey").cast("string").alias("c_nationkey"),
                    C.canonical_text("c_acctbal", "double", 2).alias("c_acctbal"),
                    "c_mktsegment")
    return text.unpivot(["c_custkey"], ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                        "field", "value")


def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return windows.row_ids(o, ["o_orderdate", "o_orderkey"], "row_id")


def sort_and_top(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") == "P", None)
        .otherwise(F.col("o_orderpriority")))
    return (o.select("o_orderkey", "o_orderpriority", "o_totalprice")
             .orderBy(F.col("o_orderpriority").asc_nulls_last(),
                      F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc())
             .limit(10))


def arrays_to_rows(spark: SparkSession, sf: str) -> DataFrame:
    daily = _daily_series(spark, sf).withColumns({
        "date": F.col("date").cast("string"),
        "week": F.date_trunc("week", F.col("date").cast("timestamp"))})
    flat = etl.flatten_daily(etl.daily_payloads(daily, "week"))
    return etl.weather_features(flat)


def series_etl(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly payloads landed as JSON files, then flattened, enriched, written and read."""
    daily = _daily_series(spark, sf).withColumns({
        "date": F.col("date").cast("string"),
        "week": F.date_trunc("week", F.col("date").cast("timestamp"))})
    landed = scratch_path(spark, "payloads")
    etl.daily_payloads(daily, "week").select("daily").write.json(landed)
    return etl.series_etl(spark, landed, scratch_path(spark, "series"))


def series_summary(spark: SparkSession, sf: str) -> DataFrame:
    return etl.series_summary(series_etl(spark, sf))


# Priority code -> desk for the inline lookup.
DESKS = ((1, "urgent desk"), (2, "urgent desk"), (3, "day desk"))


def inline_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined to a literal lookup; codes outside it stay without a desk."""
    desks = readers.inline_rows(spark, DESKS, "code int, desk string")
    orders = _t(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_code"))
    return enrich.enrich(orders, desks, "priority_code", "code", {"desk": "desk"})


def csv_text(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as CSV and read without a schema: every column is text."""
    path = scratch_path(spark, "csv-customer")
    sinks.write_csv(_t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                     "c_mktsegment"), path)
    return readers.read_csv(spark, path)


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv-nation")
    sinks.write_csv(_t(spark, sf, "nation"), path)
    typed = readers.read_csv(spark, path, infer=True)
    text = readers.read_csv(spark, path)
    assert all(t == "string" for _, t in text.dtypes)
    return typed


def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tbl-region")
    name = "region_" + path.rsplit("-", 1)[-1]
    sinks.overwrite_table(_t(spark, sf, "region"), name, path)
    sinks.materialize(readers.read_catalog(spark, name), name + "_v")
    return spark.table(name + "_v")


# -------------------------------------------------------------- streaming

def _message_rows(spark, sf):
    ev = _t(spark, sf, "events")
    status = (F.when(F.col("event_type") == "purchase", F.lit("SUCCESS"))
               .when(F.col("event_type") == "error", F.lit("FAILED"))
               .when(F.col("event_type") == "signup", F.lit("PENDING"))
               .otherwise(F.upper("event_type")))
    return ev.select("event_id", F.col("ts").cast("string").alias("ts"), "user_id",
                     status.alias("status"), F.col("value").alias("amount"), "props",
                     "event_type")


MESSAGE_FIELDS = ["event_id", "ts", "user_id", "status", "amount", "props"]


def _published(spark, sf, rows=None, path=None):
    path = path or scratch_path(spark, "publish")
    publish.publish_files(_message_rows(spark, sf) if rows is None else rows, "user_id", path,
                          fields=MESSAGE_FIELDS)
    return path


def publish_json(spark: SparkSession, sf: str) -> DataFrame:
    """Messages as published; the key is the one that the file carries."""
    messages = monitor.read_messages(spark, _published(spark, sf))
    good, _ = monitor.parse_events(messages, monitor.TABLE_EVENT, keep=["key"])
    return good.select("key", "event_id", C.parse_timestamp("ts").cast("timestamp_ntz").alias("ts"),
                       "status", "amount")


def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    """Messages streamed from the earliest position, with key and position; the
    position must be a partition's place 0, 1, 2, ... without gaps."""
    source = monitor.message_source(spark, _published(spark, sf), starting="earliest")
    good, _ = monitor.parse_events(source, monitor.TABLE_EVENT, keep=["key", *monitor.POSITION])
    out = scratch_path(spark, "stream-records")
    monitor.run_append(good, out, scratch_path(spark, "ckpt"))
    rows = spark.read.parquet(out)
    dense = rows.groupBy("partition").agg(
        ((F.min("offset") == 0) & (F.max("offset") + 1 == F.count_distinct("offset"))
         & (F.count(F.lit(1)) == F.count_distinct("offset"))).alias("dense"))
    return rows.join(dense, "partition").select("key", "event_id", "status", "amount", "dense")


def stream_first_n(spark: SparkSession, sf: str) -> DataFrame:
    """A consumer that stops after 100 good messages (the limit is the feature)."""
    good, _ = monitor.parse_events(monitor.read_messages(spark, _published(spark, sf)),
                                   monitor.TABLE_EVENT, keep=["key"])
    return monitor.first_messages(good, 100, ["event_id"]).select("key", "event_id", "status")


def message_placement(spark: SparkSession, sf: str) -> DataFrame:
    """A topic of 8 partitions in which one sender has a third of the messages: per key
    the partitions it lies in, and whether offsets are without gaps and follow event time."""
    rows = _message_rows(spark, sf).withColumn("sender", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    path = scratch_path(spark, "topic")
    publish.publish_topic(rows, "sender", path, 8, ["ts", "event_id"], MESSAGE_FIELDS)
    good, _ = monitor.parse_events(monitor.read_messages(spark, path), monitor.TABLE_EVENT, keep=["key", *monitor.POSITION])
    here = ["partition", "offset", "ts", "event_id"]
    seen = ordered.windowed(good.select("key", *here), list(monitor.POSITION), [], 2,
                            {"before": lambda w: F.lag(F.struct(*here)).over(w)})
    follows = (F.col("before.offset") + 1 == F.col("offset")) & (F.col("before.ts") <= F.col("ts"))
    opens = F.col("before").isNull() | (F.col("before.partition") != F.col("partition"))
    return seen.groupBy("key").agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("partition").alias("n_partitions"),
                                   F.bool_and(F.when(opens, F.col("offset") == 0).otherwise(follows)).alias("in_order"))


def _topic(spark, path, rows, partitions=4):
    """Adds events to a topic whose producer places them by user number; offsets go on."""
    there = readers.read_optional(spark, path, "json") is not None
    ends = consumer.end_positions(monitor.read_messages(spark, path)) if there else None
    publish.publish_topic(rows, "user_id", path, partitions, ["ts", "event_id"], MESSAGE_FIELDS,
                          partition=F.col("user_id") % partitions, after=ends)


# Start offsets of one consumer; partition 3 has none and is read from its beginning.
MIDDLE = {0: 10, 1: 100, 2: 40}


def stream_start_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Two consumers of a topic that gets two deliveries: one starts at given offsets, one
    at the end of the first delivery; both are restarted after the second, when the
    stored positions hold whatever is asked for."""
    rows = _message_rows(spark, sf)
    topic = scratch_path(spark, "topic")
    places = {name: (scratch_path(spark, name), scratch_path(spark, "ckpt")) for name in ("middle", "latest")}
    late = F.col("event_id") % 3 == 0
    for delivery in (rows.where(~late), rows.where(late)):
        _topic(spark, topic, delivery)
        for name, (out, ckpt) in places.items():
            source = consumer.positioned_source(spark, topic, ckpt, {"middle": MIDDLE, "latest": "latest"}[name])
            good, _ = monitor.parse_events(source, monitor.TABLE_EVENT, keep=monitor.POSITION)
            monitor.run_append(good.select("event_id", *monitor.POSITION), out, ckpt)
    columns = ["event_id", *monitor.POSITION]
    read = [spark.read.parquet(out).select(*columns, F.lit(name).alias("consumer")) for name, (out, _) in places.items()]
    return read[0].unionByName(read[1])


def stream_take(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries and three portions: the first ends within the first delivery, the
    second takes the rest of it and a part of the next, the third takes what is left.
    Failed payments arrive as broken text and are not counted."""
    rows = _message_rows(spark, sf)
    n = rows.count()
    topic, out, ckpt = (scratch_path(spark, x) for x in ("topic", "taken", "ckpt"))
    found = None
    for i, upto in enumerate((n // 6 + 3, n * 2 // 5, n)):
        wave = publish.place_in_topic(rows.where(F.col("event_id") % 3 == i), "user_id", 2, ["ts", "event_id"], MESSAGE_FIELDS,
                                      partition=F.col("user_id") % 2)
        broken = F.when(F.col("value").contains('"FAILED"'), F.substring("value", 1, 12)).otherwise(F.col("value"))
        wave.withColumn("value", broken).write.mode("append").json(topic)
        good, _ = monitor.parse_events(monitor.message_source(spark, topic), monitor.TABLE_EVENT, keep=monitor.POSITION)
        taker = consumer.Taker(spark, out, ckpt)        # a new one each time: it goes on behind the last portion
        got = taker.take(good.select("event_id", "status", *monitor.POSITION), upto - taker.taken()[1])
        got = got.select(F.lit(i + 1).alias("portion"), "seq", "event_id", "status")
        found = got if found is None else found.unionByName(got)
    return found


def _stream_lines(spark, sf):
    """Messages for every event, plus data-derived bad input: a cut-off copy
    of every error message, a blank line per view, and an empty object per
    click (a good message without a status)."""
    rows = _message_rows(spark, sf)
    msgs = rows.select("event_type", F.to_json(F.struct(
        "event_id", "ts", "user_id", "status", "amount", "props")).alias("value"))
    extra = msgs.select(
        F.when(F.col("event_type") == "error", F.substring("value", 1, 12))
         .when(F.col("event_type") == "view", F.lit(""))
         .when(F.col("event_type") == "click", F.lit("{}")).alias("value")
    ).filter(F.col("value").isNotNull())
    return msgs.select("value").unionByName(extra)


def _stream_dir(spark, sf):
    path = scratch_path(spark, "stream-in")
    _stream_lines(spark, sf).write.mode("overwrite").text(path)
    return path


def stream_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    src = _stream_dir(spark, sf)
    good, _ = monitor.parse_events(monitor.text_source(spark, src, 2), monitor.TABLE_EVENT)
    out = scratch_path(spark, "stream-status")
    monitor.run_update(monitor.status_counts(good), ["status"], out, scratch_path(spark, "ckpt"))
    return monitor.current_version(spark, out)


def stream_failure_rate(spark: SparkSession, sf: str) -> DataFrame:
    src = _stream_dir(spark, sf)
    good, _ = monitor.parse_events(monitor.text_source(spark, src, 2), monitor.TABLE_EVENT)
    out = scratch_path(spark, "stream-summary")
    monitor.run_update(monitor.failure_summary(good), [], out, scratch_path(spark, "ckpt"))
    return monitor.current_version(spark, out)


def stream_bad_records(spark: SparkSession, sf: str) -> DataFrame:
    src = _stream_dir(spark, sf)
    _, bad = monitor.parse_events(monitor.text_source(spark, src), monitor.TABLE_EVENT)
    out = scratch_path(spark, "stream-bad")
    monitor.run_append(bad, out, scratch_path(spark, "ckpt"))
    return spark.read.parquet(out).select("raw")


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries: all events, then purchases twice more in one go, SETTLING
    and an hour later SETTLED. The same checkpoint resumes after the first run;
    after each, the log is folded into the next version of the state table."""
    rows = _message_rows(spark, sf)
    src, log = scratch_path(spark, "stream-up"), scratch_path(spark, "stream-log")
    ckpt, states = scratch_path(spark, "ckpt"), scratch_path(spark, "stream-state")
    bought = _t(spark, sf, "events").filter(F.col("event_type") == "purchase").select(
        "event_id", F.col("ts").alias("at"))
    again = rows.join(bought, "event_id")

    def later(hours, status):
        at = F.col("at") + F.make_dt_interval(hours=F.lit(hours))
        return again.withColumns({"ts": at.cast("string"), "status": F.lit(status)}).drop("at")

    deliveries = [rows, later(1, "SETTLING").unionByName(later(2, "SETTLED"))]
    state, done = None, -1
    for i, delivery in enumerate(deliveries):
        _published(spark, sf, delivery, f"{src}/d{i}")
        good, _ = monitor.parse_events(
            monitor.message_source(spark, src + "/*", max_files_per_trigger=2),
            monitor.TABLE_EVENT, keep=monitor.POSITION)
        monitor.run_append(good.select("event_id", "user_id", "status", "amount", "ts",
                                       *monitor.POSITION), log, ckpt)
        written = spark.read.parquet(log)
        state = monitor.compact_log(written, "event_id", ["ts"], f"{states}/v{i}",
                                    state=state, after=done)
        done = monitor.last_batch(written)
    return state.select("event_id", "user_id", "status", "amount")
