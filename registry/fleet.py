"""Fleet tables derived from the given parquet tables (see FIXTURES.md).

Every expression is free of the session's time zone, and every source row is
kept, so the work grows with the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

DAY_1 = "2026-07-01"
DAY_2 = "2026-07-02"
DAY_3 = "2026-07-03"
TODAY = DAY_2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles(spark: SparkSession, sf_dir: str, day: str = TODAY) -> DataFrame:
    """The roster; on the first day every positive rate is one lower."""
    less = 1 if day == DAY_1 else 0
    return _table(spark, sf_dir, "customer").selectExpr(
        "'D' || c_custkey as id",
        "'Driver ' || (c_custkey % 400) as name",
        "case when c_custkey % 17 = 0 then null when c_custkey % 13 = 0 then 0D "
        f"else cast(18 + c_custkey % 5 - {less} as double) end as hourly_rate",
        "'tok-' || c_custkey as Session_Token",
        "'x' as password_hash",
    )


def time_entries(spark: SparkSession, sf_dir: str, day: str = TODAY) -> DataFrame:
    """Shifts; on the first day those of status O are still open."""
    waiting = "o_orderkey % 11 = 0" + (" or o_orderstatus = 'O'" if day == DAY_1 else "")
    timed = _table(spark, sf_dir, "orders").selectExpr(
        "*",
        "timestampadd(HOUR, cast(o_orderkey * 7 % 24 as int), o_orderdate) as began",
        "cast(o_orderkey * 7919 % 72000 - 600 as int) as span",
    )
    return timed.selectExpr(
        "o_orderkey as id",
        "case when o_orderkey % 97 = 0 then null when o_orderkey % 50 = 49 "
        "then 'X' || o_custkey else 'D' || o_custkey end as employee_id",
        "'U' || (o_orderkey % 40) as unit_no",
        "translate(cast(began as string), ' ', 'T') || '+00:00' as clock_in",
        f"case when not ({waiting}) then "
        "translate(cast(timestampadd(SECOND, span, began) as string), ' ', 'T') || '+00:00' "
        "end as clock_out",
        "case when o_orderkey % 19 <> 0 then cast(o_orderkey * 10 as double) end as odometer_in",
        "case when o_orderkey % 23 <> 0 "
        "then cast(o_orderkey * 10 + o_orderkey * 31 % 500 - 5 as double) end as odometer_out",
    )


def fuel_reports(spark: SparkSession, sf_dir: str, day: str = TODAY) -> DataFrame:
    """Fills; on the first day the litres of signup events are not entered yet."""
    hidden = "when event_type = 'signup' then null" if day == DAY_1 else ""
    texts = _table(spark, sf_dir, "events").selectExpr(
        "*", "cast(ts as date) as day", "cast(ts as string) as moment"
    )
    return texts.selectExpr(
        "event_id as id",
        "'U' || user_id as unit_no",
        "substring(moment, 1, 10) as report_date",
        # Spark drops trailing zeros of the fraction; all six digits are wanted.
        "substring(moment, 1, 10) || 'T' || substring(moment, 12, 8) || '.' "
        "|| rpad(substring(moment, 21, 6), 6, '0') || '+00:00' as created_at",
        "case when event_id % 61 <> 0 then cast("
        "datediff(day, date'2024-01-01') * 1440 + hour(ts) * 60 + minute(ts) "
        "- if(event_id % 37 = 0, 5000, 0) as double) end as odometer",
        f"case {hidden} when event_id % 53 = 0 then null when event_id % 41 = 0 then 0D "
        "else 40D + 4D * value end as fuel_litres",
        "'D' || user_id as employee_id",
    )


def loads(spark: SparkSession, sf_dir: str, day: str = TODAY) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as id", "'D' || l_suppkey as employee_id"
    )


def truck_changes(spark: SparkSession, sf_dir: str, day: str = TODAY) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr("event_id as id")


TABLES = {
    "profiles": profiles,
    "time_entries": time_entries,
    "fuel_reports": fuel_reports,
    "truck_changes": truck_changes,
    "loads": loads,
}


def snapshot(spark: SparkSession, sf_dir: str, day: str) -> dict[str, DataFrame]:
    """All five operational tables as they stood on one day."""
    return {name: make(spark, sf_dir, day) for name, make in TABLES.items()}


# Dates up to which fills have arrived by each of three days.
ARRIVED = {DAY_1: "2024-01-12", DAY_2: "2024-01-24", DAY_3: "2024-12-31"}


def arriving(spark: SparkSession, sf_dir: str, day: str) -> dict[str, DataFrame]:
    """The tables that detection reads, filling up over three days.

    Some fills come days late, litres of the first day are corrected on the second, as are
    rates; shifts that were open are closed, and some arrive on the last day only.
    """
    values = DAY_1 if day == DAY_1 else TODAY
    late = "" if day == DAY_3 else " and id % 89 <> 0"
    shifts = "true" if day == DAY_3 else "id % 7 <> 0"
    return {
        "profiles": profiles(spark, sf_dir, values),
        "time_entries": time_entries(spark, sf_dir, values).filter(shifts),
        "fuel_reports": fuel_reports(spark, sf_dir, values).filter(
            f"report_date <= '{ARRIVED[day]}'{late}"
        ),
    }


# A way to get an operational table by name.
Fleet = Callable[[str], DataFrame]


def derived(spark: SparkSession, sf_dir: str) -> Fleet:
    """Today's tables, computed from the given ones inside the query."""
    return lambda name: TABLES[name](spark, sf_dir)


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with SQL texts of many kinds built around each whole message."""
    quoted = "concat('\\'', replace(text, '\\'', '\\'\\''), '\\'')"
    kinds = [
        f"'SELECT * FROM loads l WHERE l.note = ' || {quoted}",
        "'  with x as (select 1 as a) select a from x -- ' || text",
        "'DROP TABLE loads -- ' || text",
        f"'SELECT 1; SELECT ' || {quoted}",
        f"'SELECT \\'please update it\\', ' || {quoted}",
        f"'SELECT \\'a;b\\', ' || {quoted}",
        f"'SELECT l.updated_at FROM loads l WHERE l.note = ' || {quoted}",
        f"'SELECT replace(' || {quoted} || ', \\'a\\', \\'b\\')'",
        "'selection of ' || text",
        "'/* ' || text || ' */ SELECT 1'",
        f"'(SELECT ' || {quoted} || ')'",
        f"'EXPLAIN SELECT ' || {quoted}",
        "'select 1 from loads MERGE ' || text",
        f"'```sql\\nSELECT ' || {quoted} || '\\n```'",
        f"'```\\nwith t as (select ' || {quoted} || ' as a) select a from t;;\\n```'",
        "text",
    ]
    arms = " ".join(f"when {i} then {kind}" for i, kind in enumerate(kinds))
    return _table(spark, sf_dir, "conversations").selectExpr(
        "conv_id * 100000 + turn as id",
        "text as question",
        f"case (turn + conv_id) % {len(kinds)} {arms} end as sql",
    )
