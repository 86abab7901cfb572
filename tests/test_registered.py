from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from registry.compare import connect, differences
from registry.oracles import ORACLES
from registry.spark_queries import QUERIES

SMALL = os.environ.get("CONVOY_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    sql = entry_points.oracle_sql()[name]
    assert duck.execute(f"select count(*) from ({sql})").fetchone()[0] > 0
    assert differences(spark, duck, entry_points.queries()[name], sql, SMALL) is None


def test_comparison_sees_a_difference(spark, duck):
    def query(session, _):
        return session.createDataFrame([(1, 0.1)], "a int, b double")

    assert differences(spark, duck, query, "select 1 as a, 0.1::double as b", SMALL) is None
    assert differences(spark, duck, query, "select 1::bigint as a, 0.1::double as b", SMALL)
    assert differences(spark, duck, query, "select 1 as a, 0.2::double as b", SMALL)
    assert differences(spark, duck, query, "select 1 as a, 0.1::double as c", SMALL)
    assert differences(spark, duck, query, "select 1 as a, 0.1::double as b where false", SMALL)


_ORDERS = {
    "fuel_efficiency": ("unit_no", "report_date"),
    "fuel_anomalies": ("unit_no", "report_date"),
    "shift_anomalies": None,
    "anomalies_all": ("category", "anomaly_type", "entity"),
}


@pytest.mark.parametrize("name", [n for n, keys in _ORDERS.items() if keys])
def test_sorted_sets_are_in_order(spark, name):
    """The comparison with SQL is one of bags, so the order is looked at here."""
    rows = QUERIES[name](spark, SMALL).collect()
    keys = [tuple((r[k] is None, r[k]) for k in _ORDERS[name]) for r in rows]
    assert len(keys) > 1 and keys == sorted(keys)


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.columns[-1] == "anomaly" and not found.isEmpty()


def test_known_counts(spark):
    """Label counts at the smallest scale, as listed in FIXTURES.md."""
    queries = entry_points.queries()

    def labels(name):
        return dict(queries[name](spark, SMALL).groupBy("anomaly").count().collect())

    assert labels("fuel_anomalies") == {
        "zero_or_missing_litres": 24,
        "odometer_backwards": 25,
        "implausible_low_economy": 249,
        "implausible_high_economy": 238,
    }
    assert labels("shift_anomalies") == {
        "nonpositive_duration": 11,
        "excessive_shift": 247,
        "odometer_backwards": 9,
        "missing_hourly_rate": 138,
    }
    assert labels("shift_anomalies_quantized") == {
        "nonpositive_duration": 14,
        "excessive_shift": 243,
        "odometer_backwards": 9,
        "missing_hourly_rate": 138,
    }


@pytest.mark.parametrize("name", ["completed_shifts", "driver_hours_all", "fuel_deltas"])
def test_results_do_not_follow_the_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        query, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
        assert differences(spark, duck, query, sql, SMALL) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
