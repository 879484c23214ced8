"""Quality gate: a suite of checks in one pass, a score, a quarantine split
and a proceed / halt decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators import rules
from strata.sources.readers import nan_as_null

# Fixed values of the reference gate: inputs, limits, and the 14 check
# names with their detail texts, in the order the checks run.
REQUIRED_COLUMNS = ("trip_id", "pickup_datetime", "dropoff_datetime", "fare_usd",
                    "distance_miles", "passenger_count", "payment_type_code")
NULL_CHECKED = ("trip_id", "pickup_datetime", "fare_usd")
PAYMENT_CODES = (1, 2, 3, 4, 5, 6)
FARE_OUTLIER = 500
PASSENGERS = (1, 6)
MEAN_FARE = (5, 100)
COMPLETENESS_PCT = 95.0
QUARANTINE_REASON = "failed quality check"
CHECK_NAMES = (
    "All required columns present",
    "No nulls in [trip_id]",
    "No nulls in [pickup_datetime]",
    "No nulls in [fare_usd]",
    "trip_id is unique",
    "fare_usd >= 0",
    "fare_usd < $500 (outlier check)",
    "distance_miles > 0",
    "passenger_count between 1 and 6",
    "payment_type_code in [1,2,3,4,5,6]",
    "dropoff_datetime > pickup_datetime",
    "avg fare between $5 and $100",
    "Overall completeness >= 95%",
    "Row count >= 1",
)
DETAILS = {
    "nulls": " nulls found",
    "duplicates": " duplicates found",
    "negative": " negative fares found",
    "outliers": " outliers found",
    "passengers": " invalid rows",
    "codes": " invalid codes found",
    "order": " rows with bad date order",
    "mean": "avg fare",
}


def trip_checks(df: DataFrame) -> list[Q.Check]:
    """The 14 checks of the gate, in order (names from ``CHECK_NAMES``)."""
    n = iter(CHECK_NAMES)
    lo, hi = PASSENGERS
    return [
        Q.columns_present(df, REQUIRED_COLUMNS, next(n)),
        *[Q.no_nulls(c, next(n), DETAILS["nulls"]) for c in NULL_CHECKED],
        Q.unique("trip_id", next(n), DETAILS["duplicates"]),
        Q.count_where(F.col("fare_usd") < 0, next(n), DETAILS["negative"], ["fare_usd"]),
        Q.count_where(F.col("fare_usd") > FARE_OUTLIER, next(n), DETAILS["outliers"],
                      ["fare_usd"]),
        Q.all_rows(F.col("distance_miles") > 0, next(n), ["distance_miles"]),
        Q.in_range("passenger_count", lo, hi, next(n), DETAILS["passengers"]),
        Q.accepted("payment_type_code", PAYMENT_CODES, next(n), DETAILS["codes"]),
        Q.count_where(F.col("dropoff_datetime") <= F.col("pickup_datetime"), next(n),
                      DETAILS["order"], ["dropoff_datetime", "pickup_datetime"]),
        Q.mean_between("fare_usd", MEAN_FARE[0], MEAN_FARE[1], next(n), label=DETAILS["mean"]),
        Q.completeness_at_least(df.columns, COMPLETENESS_PCT, next(n)),
        Q.row_count_between(1, name=next(n)),
    ]


def quarantine_rules() -> list[rules.Rule]:
    """Row rules of the quarantine split, as *good-row* predicates.

    Null handling follows the gate: a null fare, passenger count or time
    breaks no comparison rule, but a null payment code is not an accepted
    code, so it is quarantined."""
    lo, hi = PASSENGERS
    not_ = lambda p: ~F.coalesce(p, F.lit(False))
    return [
        ("negative_fare", not_(F.col("fare_usd") < 0)),
        ("too_many_passengers", not_(F.col("passenger_count") > hi)),
        ("too_few_passengers", not_(F.col("passenger_count") < lo)),
        ("bad_payment_code", F.coalesce(F.col("payment_type_code").isin(*PAYMENT_CODES),
                                        F.lit(False))),
        ("dropoff_not_after_pickup",
         not_(F.col("dropoff_datetime") <= F.col("pickup_datetime"))),
    ]


def run_gate(df: DataFrame):
    """Returns (check results, score with decision, clean rows, quarantined rows).

    NaN values count as missing (as in the reference's frame checks)."""
    df = nan_as_null(df)
    results = Q.run_checks(df, trip_checks(df))
    scored = Q.decide(Q.score(results))
    clean, bad = rules.split(df, quarantine_rules(), reason=QUARANTINE_REASON)
    return results, scored, clean, bad


def gate_frame(raw_trips: DataFrame) -> DataFrame:
    """Adapter trips in the shape the gate reads."""
    return raw_trips.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        F.col("fare_amount").alias("fare_usd"),
        F.col("tip_amount").alias("tip_usd"),
        F.col("trip_distance").alias("distance_miles"),
        F.col("passenger_count"),
        F.col("payment_type").alias("payment_type_code"),
        F.col("PULocationID").alias("pickup_location_id"))
