"""Results whose order is promised come in that order."""

import duckdb
import pytest

import __spark_entry__ as E
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
import compare as C  # noqa: E402

PROMISED = {
    "daily_revenue": "pickup_date",
    "zone_performance": "revenue_rank, pickup_zone_name",
    "hourly_demand": "pickup_hour, is_weekend",
    "zone_summary": "total_revenue DESC NULLS LAST, pickup_zone_name",
    "payment_label": '"count" DESC, payment_label',
    "sort_and_top": "o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey",
    "run_history": "run_ts DESC, batch_id DESC",
}


@pytest.mark.parametrize("name", sorted(PROMISED))
def test_rows_come_in_the_promised_order(spark, sf_small, name):
    got = E.queries()[name](spark, sf_small)
    cur = C.duck(sf_small).execute(f"SELECT * FROM ({E.oracle_sql()[name]}) ORDER BY {PROMISED[name]}")
    columns = [d[0] for d in cur.description]
    want = [tuple(C._norm(v) for v in r) for r in cur.fetchall()]
    assert [tuple(C._norm(r[c]) for c in columns) for r in got.collect()] == want
    assert duckdb
