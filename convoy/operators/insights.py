"""Dashboard figures: KPI tiles, bar shares, and results as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.functions.numeric import parsed_or_zero, round_ieee, trimmed_text
from convoy.operators.fuel import fuel_deltas, fuel_label
from convoy.operators.shifts import driver_totals


def kpi_tiles(driver_hours: DataFrame, fuel_economy: DataFrame, feed: DataFrame) -> DataFrame:
    """One row of tiles over the three result sets, in the form they are passed.

    Given the capped sets it shows what the dashboard shows; given the
    uncapped ones, the fleet's true figures. Hours are summed as displayed,
    each already rounded to one decimal.
    """
    # Tenths of an hour are whole numbers, so their sum has no rounding order.
    tenths = F.sum(F.round(parsed_or_zero(F.col("hours")) * 10).cast("long"))
    drivers = driver_hours.agg(
        F.count(F.lit(1)).alias("active_drivers"),
        (F.coalesce(tenths, F.lit(0)) / F.lit(10.0)).cast("double").alias("total_hours"),
    )
    units = fuel_economy.agg(F.count(F.lit(1)).alias("units_fuelled"))
    flags = feed.agg(F.count(F.lit(1)).alias("open_anomalies"))
    return drivers.select(
        "active_drivers",
        units.scalar().alias("units_fuelled"),
        "total_hours",
        flags.scalar().alias("open_anomalies"),
    )


def source_tiles(
    entries: DataFrame,
    profiles: DataFrame,
    reports: DataFrame,
    *,
    drivers: int | None = None,
    units: int | None = None,
    records: int | None = None,
) -> DataFrame:
    """The tiles straight from the tables, each of which is read once.

    Fills are counted and judged in one aggregate by unit, shifts in one by driver; the
    limits say how many rows of each set the dashboard would show.
    """
    fills = fuel_deltas(reports).groupBy("unit_no").agg(F.count(fuel_label()).alias("flags"))
    fuel = fills.agg(F.count(F.lit(1)).alias("units"), F.sum("flags").alias("flags"))
    totals = driver_totals(entries, profiles)
    # Both use all columns of the totals, so the shuffle below them is one and the same.
    shown = totals if drivers is None else totals.limit(drivers)
    tenths = F.sum(F.round(parsed_or_zero(F.col("hours")) * 10).cast("long"))
    top = shown.agg(
        F.count(F.lit(1)).alias("active_drivers"),
        (F.coalesce(tenths, F.lit(0)) / F.lit(10.0)).cast("double").alias("total_hours"),
        F.sum("flags").alias("flags"),
    )
    shift_flags = F.col("flags")
    if drivers is not None:
        used = [F.sum("flags").alias("flags"), F.max("hours"), F.max("est_gross_pay"), F.max("driver")]
        shift_flags = totals.select(F.struct(*used).alias("all")).scalar()["flags"]
    fuel_row = fuel.select(F.struct("units", "flags")).scalar()
    tiles = top.select(
        "active_drivers",
        "total_hours",
        F.coalesce(shift_flags, F.lit(0)).alias("shift"),
        fuel_row.alias("fuel"),
    )
    found = F.col("shift") + F.coalesce("fuel.flags", F.lit(0))
    return tiles.select(
        "active_drivers",
        _atmost(F.col("fuel.units"), units).alias("units_fuelled"),
        "total_hours",
        _atmost(found, records).alias("open_anomalies"),
    )


def _atmost(count: Column, limit: int | None) -> Column:
    return count if limit is None else F.least(count, F.lit(limit).cast("long"))


def percent_of_max(rows: DataFrame, name: str, value: str, unit: str = "") -> DataFrame:
    """Bar list: each value as a percentage of the largest, with its label.

    A missing value has a bar of 0 and the label of a dash. The largest value
    is one scalar subquery, so no window spans the whole set; the subquery
    shares the shuffles of ``rows``.
    """
    number = parsed_or_zero(F.col(value))
    present = F.nanvl(F.col(value).try_cast("double"), F.lit(None).cast("double")).isNotNull()
    top = rows.select(F.max(number)).scalar()
    measured = rows.select(
        F.col(name).alias("name"), F.col(value), number.alias("_n"), top.alias("_top")
    )
    share = F.when(F.col("_top") != 0, F.col("_n") / F.col("_top") * 100).otherwise(F.lit(0.0))
    label = F.when(present, F.concat(trimmed_text(F.col("_n")), F.lit(unit))).otherwise(F.lit("—"))
    return measured.select("name", round_ieee(share, 6).alias("pct"), label.alias("label"))


def stringify(df: DataFrame) -> DataFrame:
    """Every cell as text, NULL as the empty string."""
    return df.select(
        *[F.coalesce(F.col(f"`{c}`").cast(T.StringType()), F.lit("")).alias(c) for c in df.columns]
    )


def text_rows(df: DataFrame, max_rows: int | None = None) -> tuple[list[list[str]], bool]:
    """The rows as lists of text, and whether ``max_rows`` left any out."""
    text = stringify(df if max_rows is None else df.limit(max_rows + 1))
    rows = [list(r) for r in text.collect()]
    return rows[:max_rows], max_rows is not None and len(rows) > max_rows


def text_lines(df: DataFrame, *, limit: int | None = None) -> DataFrame:
    """Rows as one line of text each, cells parted by a bar; all unless ``limit`` is given."""
    cells = stringify(df if limit is None else df.limit(limit))
    return cells.select(F.concat_ws(" | ", *[F.col(f"`{c}`") for c in cells.columns]).alias("line"))
