"""Small hand-made rows with one of each fault the operators must handle; the
expected values in the tests are worked out from these rows."""

import datetime as dt

T = dt.datetime


def ts(s):
    return T.strptime(s, "%Y-%m-%d %H:%M:%S")


# Trips: B6 has no fare, A1 and A2 tie on the fare, C4 has no tip.
TRIPS_SCHEMA = ("trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, "
                "pickup_zone string, dropoff_zone string, distance_km double, fare_usd double, "
                "tip_usd double, payment_type string, passenger_count int")
TRIPS = [
    ("A1", "2022-06-03 06:50:00", "2022-06-03 07:20:00", "Harbour", "Old Town", 10.0, 25.00, 3.00, "card", 2),
    ("A2", "2022-06-03 07:10:00", "2022-06-03 07:30:00", "Harbour", "Station", 8.0, 25.00, 0.00, "cash", 1),
    ("A3", "2022-06-03 22:05:00", "2022-06-03 22:45:00", "Harbour", "Hill", 16.0, 40.00, 6.00, "card", 1),
    ("B5", "2022-06-03 09:00:00", "2022-06-03 09:12:00", "Station", "Hill", 4.0, 11.00, 1.00, "card", 4),
    ("B6", "2022-06-03 10:30:00", "2022-06-03 10:35:00", "Station", "Station", 1.0, None, 0.50, "cash", 3),
    ("C4", "2022-06-03 18:40:00", "2022-06-03 19:10:00", "Hill", "Harbour", 12.5, 30.00, None, "card", 1),
]

# Zones of the trips.
ZONES_SCHEMA = "zone string, borough string, zone_type string"
ZONES = [("Harbour", "South", "port"), ("Station", "Centre", "rail"), ("Hill", "North", "homes"),
         ("Old Town", "Centre", "shops")]

# Gate input: Q3 has a negative fare, Q5 has 40 passengers, the rest is clean.
QUALITY_SCHEMA = ("trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, "
                  "fare_usd double, tip_usd double, distance_miles double, passenger_count int, "
                  "payment_type_code int, pickup_location_id int")
QUALITY = [
    ("Q1", "2022-06-03 06:50:00", "2022-06-03 07:20:00", 25.00, 3.00, 6.2, 2, 1, 11),
    ("Q2", "2022-06-03 07:10:00", "2022-06-03 07:30:00", 18.00, 0.00, 5.0, 1, 2, 11),
    ("Q3", "2022-06-03 09:00:00", "2022-06-03 09:12:00", -3.00, 1.00, 2.5, 4, 1, 12),
    ("Q4", "2022-06-03 10:30:00", "2022-06-03 10:35:00", 6.00, 0.50, 0.6, 3, 2, 12),
    ("Q5", "2022-06-03 18:40:00", "2022-06-03 19:10:00", 30.00, 0.00, 7.8, 40, 1, 13),
    ("Q6", "2022-06-03 22:05:00", "2022-06-03 22:45:00", 40.00, 6.00, 9.9, 1, 4, 11),
]

# A forecast payload of six days, rain on two.
WEATHER = {
    "daily": {
        "time": ["2022-06-01", "2022-06-02", "2022-06-03", "2022-06-04", "2022-06-05",
                 "2022-06-06"],
        "temperature_2m_max": [20.0, 21.5, 19.0, 18.0, 22.5, 24.0],
        "temperature_2m_min": [10.0, 12.0, 11.0, 12.5, 13.0, 14.0],
        "precipitation_sum": [0.0, 0.0, 5.5, 1.0, 0.0, 0.0],
        "wind_speed_10m_max": [9.0, 11.5, 20.0, 17.0, 8.0, 6.5],
    }
}

# Small lists.
DISTANCES = [3.0, 5.0, 14.5, 15.0, 40.0]
RAW_FARES = ["7.25", "free", "-1", "  ", "NaN"]
FARES = [10.0, 2.25, 100.0]
PAYMENTS = ["cash", None, "cash", "card", "card", None]


def frame(spark, rows, schema, ts_cols=()):
    """Rows with timestamp text converted (index positions in ``ts_cols``)."""
    conv = [tuple(ts(v) if i in ts_cols and v is not None else v for i, v in enumerate(r))
            for r in rows]
    return spark.createDataFrame(conv, schema)
