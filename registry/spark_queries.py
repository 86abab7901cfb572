"""One Spark query per operator, over fleet tables derived from the given ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.rules import pair_counts
from convoy.operators.anomalies import (
    anomalies_all,
    anomalies_latest,
    detection_summary,
    first_records,
    severity_feed,
)
from convoy.operators.fuel import (
    flagged_fills,
    fuel_anomalies,
    fuel_deltas,
    fuel_economy,
    fuel_efficiency,
)
from convoy.operators.governance import audit_sql
from convoy.operators.insights import (
    kpi_tiles,
    percent_of_max,
    source_tiles,
    stringify,
    text_lines,
)
from convoy.operators.shifts import (
    completed_shifts,
    driver_hours,
    flagged_shifts,
    shift_anomalies,
    with_driver,
)
from convoy.operators.snapshots import as_of_snapshot, latest_snapshot
from convoy.plans.ask import readonly_query
from convoy.plans.dashboard import collect_insights, insights, lake_insights
from convoy.plans.detect import detect, detection_feed
from convoy.plans.extract import run_extract
from convoy.plans.incremental import detect_changes
from convoy.session import scratch_path
from convoy.sources.anomaly_store import read_anomalies, read_runs
from convoy.sources.lake import ALL, LATEST, day_path, read_table
from convoy.sources.catalog import (
    catalog_text,
    describe_catalog,
    register_tables,
    register_views,
)
from convoy.sources.operational import read_files, sampled_bounds, text_ranges
from registry.fleet import (
    DAY_1,
    DAY_2,
    DAY_3,
    TABLES,
    TODAY,
    Fleet,
    arriving,
    derived,
    query_log,
    snapshot,
)

# Over operational tables, wherever they come from.
FleetQuery = Callable[[Fleet], DataFrame]
# Over the given parquet tables.
Query = Callable[[SparkSession, str], DataFrame]

READONLY_SQL = """
SELECT p.name AS driver, fr.unit_no, count(*) AS fills,
       min(date_diff('second', from_iso8601_timestamp('2024-01-01T00:00:00Z'),
                     from_iso8601_timestamp(fr.created_at))) AS first_second
FROM fuel_reports fr JOIN profiles p ON fr.employee_id = p.id
GROUP BY p.name, fr.unit_no
ORDER BY fills DESC, driver, fr.unit_no
"""

# ------------------------------------------------- queries over the fleet tables


def _feed(fleet: Fleet) -> DataFrame:
    return detection_feed(fleet("fuel_reports"), fleet("time_entries"), fleet("profiles"))


def _hours(limit: int | None, **options) -> FleetQuery:
    return lambda fleet: driver_hours(
        fleet("time_entries"), fleet("profiles"), limit=limit, **options
    )


def _economy(limit: int | None) -> FleetQuery:
    return lambda fleet: fuel_economy(fleet("fuel_reports"), limit=limit)


def _shifts(hour_scale: int | None) -> FleetQuery:
    return lambda fleet: shift_anomalies(
        fleet("time_entries"), fleet("profiles"), hour_scale=hour_scale
    )


def _tiles(fleet: Fleet, **limits: int) -> DataFrame:
    return source_tiles(
        fleet("time_entries"), fleet("profiles"), fleet("fuel_reports"), **limits
    )


def _tiles_of_sets(fleet: Fleet) -> DataFrame:
    """The same tiles, counted over the result sets that the dashboard is given."""
    top = schemas.DASHBOARD_TOP
    return kpi_tiles(
        _hours(top)(fleet), _economy(top)(fleet), _feed(fleet).limit(schemas.FEED_TOP)
    )


def _severity_counts(fleet: Fleet) -> DataFrame:
    rated = severity_feed(_feed(fleet))
    return rated.groupBy("severity").agg(F.count(F.lit(1)).alias("records"))


def _loads_per_driver(fleet: Fleet) -> DataFrame:
    per_employee = fleet("loads").groupBy("employee_id").agg(F.count(F.lit(1)).alias("loads"))
    joined = with_driver(per_employee, fleet("profiles"))
    return joined.groupBy("driver").agg(F.sum("loads").alias("loads"))


def _result_text(form: Callable[[DataFrame], DataFrame], fleet: Fleet) -> DataFrame:
    """The dashboard's three result sets as one table of (insight, line)."""
    entries, roster, reports = (fleet(t) for t in ("time_entries", "profiles", "fuel_reports"))
    sets = insights(entries, roster, reports, _feed(fleet))
    parts = [form(df).select(F.lit(name).alias("insight"), "line") for name, df in sets.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _flags(fleet: Fleet) -> DataFrame:
    """All broken rules of fills and shifts, as (category, all_flags)."""
    fills = flagged_fills(fleet("fuel_reports"))
    shifts = flagged_shifts(fleet("time_entries"), fleet("profiles"))
    parts = [
        df.select(F.lit(kind).alias("category"), "all_flags")
        for kind, df in (("fuel", fills), ("shift", shifts))
    ]
    return parts[0].unionByName(parts[1])


def _cells(df: DataFrame) -> DataFrame:
    text = stringify(df)
    return text.select(F.to_json(F.array(*text.columns)).alias("line"))


FLEET_QUERIES: dict[str, FleetQuery] = {
    "fuel_deltas": lambda fleet: fuel_deltas(fleet("fuel_reports")).select(
        "id", "unit_no", "prev_odometer", "distance_km", "economy", "km_per_litre"
    ),
    "fuel_efficiency": lambda fleet: fuel_efficiency(fleet("fuel_reports")),
    "fuel_anomalies": lambda fleet: fuel_anomalies(fleet("fuel_reports")),
    "fuel_economy_top25": _economy(schemas.DASHBOARD_TOP),
    "fuel_economy_all": _economy(None),
    "completed_shifts": lambda fleet: completed_shifts(fleet("time_entries"), fleet("profiles")),
    "driver_hours_top10": _hours(schemas.EXAMPLE_TOP),
    "driver_hours_top25": _hours(schemas.DASHBOARD_TOP),
    "driver_hours_all": _hours(None),
    "driver_hours_quantized": _hours(None, hour_scale=1),
    "loads_per_driver": _loads_per_driver,
    "shift_anomalies": _shifts(None),
    "shift_anomalies_quantized": _shifts(1),
    "anomaly_feed": _feed,
    "detection_summary": lambda fleet: detection_summary(_feed(fleet), TODAY),
    "severity_feed": lambda fleet: severity_feed(_feed(fleet)),
    "severity_counts": _severity_counts,
    "fault_pairs": lambda fleet: pair_counts(_flags(fleet), "all_flags", "category"),
    "kpi_tiles": lambda fleet: _tiles(
        fleet,
        drivers=schemas.DASHBOARD_TOP,
        units=schemas.DASHBOARD_TOP,
        records=schemas.FEED_TOP,
    ),
    "kpi_tiles_uncapped": _tiles,
    "kpi_tiles_of_sets": _tiles_of_sets,
    "driver_hours_share": lambda fleet: percent_of_max(
        _hours(schemas.DASHBOARD_TOP)(fleet), "driver", "hours", "h"
    ),
    "fuel_economy_share": lambda fleet: percent_of_max(
        _economy(None)(fleet), "unit_no", "avg_km_per_litre", " km/L"
    ),
    "stringified_insights": lambda fleet: _result_text(_cells, fleet),
    "text_lines": lambda fleet: _result_text(text_lines, fleet),
}

# ------------------------------------------- queries that fill a lake or a catalog


_DETECTED = ("profiles", "time_entries", "fuel_reports")


def _two_days(spark: SparkSession, sf: str, *tables: str) -> str:
    """A lake in the shared folder with two days of the named tables."""
    root = scratch_path(spark, "lake")
    for day in (DAY_1, DAY_2):
        run_extract(spark, {t: TABLES[t](spark, sf, day) for t in tables}, root, day)
    return root


def _two_runs(view: Callable[[SparkSession, str], DataFrame]) -> Query:
    """A view over a lake with the detection runs of two days."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        root = _two_days(spark, sf, "profiles", "time_entries", "fuel_reports")
        for day in (DAY_1, DAY_2):
            detect(spark, root, day, snapshot=day)
        return view(spark, root)

    return run


def _all_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    root = _two_days(spark, sf, "profiles", "time_entries")
    entries = read_table(spark, root, "time_entries", ALL)
    return driver_hours(entries, read_table(spark, root, "profiles", ALL), limit=None)


def _both_fuel_days(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, _two_days(spark, sf, "fuel_reports"), "fuel_reports", ALL)


def _lake_snapshot(snapshot: str) -> Query:
    return lambda spark, sf: read_table(
        spark, _two_days(spark, sf, "time_entries"), "time_entries", snapshot
    )


def _evolved(spark: SparkSession, sf: str) -> DataFrame:
    """One day with whole-number odometers and no entry time, one day as declared, and
    one with files of both kinds."""
    root = scratch_path(spark, "lake")
    old = TABLES["fuel_reports"](spark, sf, DAY_1).drop("created_at")
    old.withColumn("odometer", F.col("odometer").cast("long")).write.parquet(
        day_path(root, "fuel_reports", DAY_1)
    )
    fills = TABLES["fuel_reports"](spark, sf)
    fills.write.parquet(day_path(root, "fuel_reports", DAY_2))
    whole = fills.withColumn("odometer", F.col("odometer").cast("long"))
    for i, part in enumerate((fills, whole)):
        part = part.filter(F.col("id") % 2 == i)
        part.write.mode("append").parquet(day_path(root, "fuel_reports", DAY_3))
    return read_table(spark, root, "fuel_reports", ALL)


def _extract_report(spark: SparkSession, sf: str) -> DataFrame:
    return run_extract(spark, snapshot(spark, sf, TODAY), scratch_path(spark, "lake"), TODAY)


def _read_minimized(spark: SparkSession, sf: str) -> DataFrame:
    """The roster through the file source, which drops sensitive columns."""
    path = scratch_path(spark, "source")
    TABLES["profiles"](spark, sf).write.parquet(path)
    return read_files(spark, path)


def _incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The records of three days, each found from the changes since the one before."""
    root = scratch_path(spark, "lake")
    for day in (DAY_1, DAY_2, DAY_3):
        run_extract(spark, arriving(spark, sf, day), root, day)
        detect_changes(spark, root, day)
    return read_anomalies(spark, root)


def _external(spark: SparkSession, sf: str) -> DataFrame:
    """Shifts and records of external tables, which were registered before the second day."""
    database, root = f"fleet_{uuid.uuid4().hex}", scratch_path(spark, "lake")
    for day in (DAY_1, DAY_2):
        run_extract(spark, {t: TABLES[t](spark, sf, day) for t in _DETECTED}, root, day)
        detect(spark, root, day, snapshot=day)
        register_tables(spark, root, database)
    entries = spark.table(f"{database}.time_entries").groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("shifts"), F.count("clock_out").alias("closed")
    )
    records = spark.table(f"{database}.anomalies").groupBy("detect_date").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("entity").alias("entities")
    )
    return entries.join(records, F.col("ingest_date") == F.col("detect_date")).drop("detect_date")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The description of the registered tables, a line for each with its rows."""
    database, root = f"fleet_{uuid.uuid4().hex}", scratch_path(spark, "lake")
    run_extract(spark, snapshot(spark, sf, TODAY), root, TODAY)
    detect(spark, root, TODAY)
    names = register_tables(spark, root, database)
    lines = catalog_text(describe_catalog(spark, database))
    counts = [
        spark.table(f"{database}.{n}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n in names
    ]
    return lines.join(reduce(DataFrame.unionByName, counts), "table")


def _split_reads(spark: SparkSession, sf: str) -> DataFrame:
    """How many of the ranges of a text key each shift falls into, its driver's or none."""
    path = scratch_path(spark, "source")
    TABLES["time_entries"](spark, sf).write.parquet(path)
    entries = read_files(spark, path)
    ranges = text_ranges("employee_id", sampled_bounds(entries.select("employee_id"), 16))
    hits = [F.coalesce(F.expr(f"cast({one} as int)"), F.lit(0)) for one in ranges]
    times = reduce(lambda a, b: a + b, hits)
    known = F.when(F.col("employee_id").isNull(), "none").otherwise("driver")
    placed = entries.select(known.alias("key"), times.alias("ranges"))
    return placed.groupBy("key", "ranges").agg(F.count(F.lit(1)).alias("rows"))


def _ask(spark: SparkSession, sf: str) -> DataFrame:
    """A guarded question over the extracted and registered tables."""
    root = scratch_path(spark, "lake")
    run_extract(spark, snapshot(spark, sf, TODAY), root, TODAY)
    register_views(spark, root)
    return readonly_query(spark, READONLY_SQL)


def _isolated(spark: SparkSession, sf: str) -> DataFrame:
    """One row per result set of a lake without fuel reports: its rows, and whether it failed."""
    found = collect_insights(lake_insights(spark, _two_days(spark, sf, "profiles", "time_entries")))
    rows = [(name, len(one["rows"]), "error" in one) for name, one in sorted(found.items())]
    return spark.createDataFrame(rows, "insight string, n_rows long, failed boolean")


# The hot unit is to be cut into slices in small test data too.
_HEAVY = 1000


def _hot_unit(query: Callable[[DataFrame], DataFrame]) -> FleetQuery:
    """Two of three fills belong to one unit, all rows kept."""

    def run(fleet: Fleet) -> DataFrame:
        unit = F.when(F.col("id") % 3 != 0, F.lit("U1")).otherwise(F.col("unit_no"))
        return query(fleet("fuel_reports").withColumn("unit_no", unit))

    return run


def _extremes(fleet: Fleet) -> DataFrame:
    """The feed over fills with absurd odometers, in a unit of their own, and next to no litres.

    All figures are doubles without a rounding error, so every engine writes them alike.
    """
    far, dry = F.col("id") % 101 == 0, F.col("id") % 103 == 0
    columns = {
        "unit_no": F.when(far, F.lit("FAR")).otherwise(F.col("unit_no")),
        "odometer": F.when(far, F.col("id") % 7 * F.lit(1e17)).otherwise(F.col("odometer")),
        "fuel_litres": F.when(far, F.lit(100.0))
        .when(dry, F.lit(2.0**-30))
        .otherwise(F.col("fuel_litres")),
    }
    fills = fleet("fuel_reports").withColumns(columns)
    return detection_feed(fills, fleet("time_entries"), fleet("profiles"))


def _over_derived(query: FleetQuery) -> Query:
    return lambda spark, sf: query(derived(spark, sf))


QUERIES: dict[str, Query] = {
    **{name: _over_derived(query) for name, query in FLEET_QUERIES.items()},
    "fuel_deltas_hot_unit": _over_derived(
        _hot_unit(
            lambda fills: fuel_deltas(fills, heavy_rows=_HEAVY).select(
                "id", "unit_no", "prev_odometer", "distance_km", "economy", "km_per_litre"
            )
        )
    ),
    "fuel_economy_hot_unit": _over_derived(
        _hot_unit(lambda fills: fuel_economy(fills, heavy_rows=_HEAVY))
    ),
    "anomaly_feed_extremes": _over_derived(_extremes),
    "profiles_minimized": _read_minimized,
    "extract_report": _extract_report,
    "lake_latest": _lake_snapshot(LATEST),
    "lake_as_of": _lake_snapshot(DAY_1),
    "latest_snapshot": lambda spark, sf: latest_snapshot(_both_fuel_days(spark, sf)),
    "as_of_snapshot": lambda spark, sf: as_of_snapshot(_both_fuel_days(spark, sf), DAY_1),
    "driver_hours_all_snapshots": _all_snapshots,
    "evolved_table": _evolved,
    "detection_runs": _two_runs(lambda spark, root: read_runs(spark, root).drop("output")),
    "anomalies_all": _two_runs(lambda spark, root: anomalies_all(read_anomalies(spark, root))),
    "anomalies_latest": _two_runs(
        lambda spark, root: first_records(read_anomalies(spark, root, LATEST))
    ),
    "anomalies_latest_by_max": _two_runs(
        lambda spark, root: anomalies_latest(read_anomalies(spark, root))
    ),
    "incremental_detection": _incremental,
    "external_tables": _external,
    "split_reads": _split_reads,
    "catalog_description": _catalog,
    "audit_sql": lambda spark, sf: audit_sql(query_log(spark, sf)),
    "readonly_query": _ask,
    "insights_isolated": _isolated,
}
