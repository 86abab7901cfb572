"""Fuel stops: distance and economy between consecutive fills, and their rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.numeric import exact_sum, guarded_ratio, round_ieee
from convoy.functions.ordering import ascending, descending, spread_sort
from convoy.functions.rules import Rules, every_match, first_match
from convoy.operators.previous import HEAVY_ROWS, with_previous

_CHRONOLOGY = ["report_date", "created_at"]
_FILL = ["unit_no", "report_date", "odometer", "fuel_litres"]


def fill_order(reports: DataFrame) -> list[str]:
    """Date, then entry time, then whatever makes the order of a day definite."""
    ties = ["id"] if "id" in reports.columns else ["odometer", "fuel_litres"]
    return _CHRONOLOGY + ties


def fuel_deltas(
    reports: DataFrame, *, heavy_rows: int = HEAVY_ROWS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Each fill with ``prev_odometer``, ``distance_km``, ``economy`` and ``km_per_litre``.

    ``economy`` is the unrounded ratio that averages use, ``km_per_litre`` the
    two-decimal one that is shown and compared with the thresholds. Both are
    NULL for a unit's first fill and where no litres were taken. Units with more
    than ``heavy_rows`` fills may be spread over several tasks. Other columns are kept
    only if named in ``carry``.
    """
    order = fill_order(reports)
    kept = reports.select(*dict.fromkeys([*_FILL, *order, *carry]))
    previous = with_previous(
        kept, "unit_no", order, "odometer", "prev_odometer", heavy_rows=heavy_rows
    )
    # A missing previous odometer makes the distance, and with it the ratio, NULL.
    measured = previous.withColumn("distance_km", F.col("odometer") - F.col("prev_odometer"))
    economy = guarded_ratio(F.col("distance_km"), F.col("fuel_litres"))
    return measured.withColumn("economy", economy).withColumn(
        "km_per_litre", round_ieee(F.col("economy"), 2)
    )


def fuel_efficiency(reports: DataFrame) -> DataFrame:
    """Every fill with distance and km/L, by unit and date."""
    ordered = spread_sort(fuel_deltas(reports), *ascending("unit_no", *fill_order(reports)))
    return ordered.select(*_FILL, "distance_km", "km_per_litre")


def fuel_rules(
    low: float = schemas.LOW_KM_PER_LITRE, high: float = schemas.HIGH_KM_PER_LITRE
) -> Rules:
    """The rules on a fill with its distance."""
    return [
        ("zero_or_missing_litres", F.col("fuel_litres") <= 0),
        ("odometer_backwards", F.col("distance_km") < 0),
        ("implausible_low_economy", F.col("km_per_litre") < low),
        ("implausible_high_economy", F.col("km_per_litre") > high),
    ]


def fuel_label(
    low: float = schemas.LOW_KM_PER_LITRE, high: float = schemas.HIGH_KM_PER_LITRE
) -> Column:
    """The first fuel rule a fill breaks, or NULL."""
    return first_match(fuel_rules(low, high))


def flagged_fills(
    reports: DataFrame,
    *,
    low: float = schemas.LOW_KM_PER_LITRE,
    high: float = schemas.HIGH_KM_PER_LITRE,
) -> DataFrame:
    """Fills that break a rule, with all rules they break in ``all_flags``."""
    flagged = fuel_deltas(reports).withColumn("all_flags", every_match(fuel_rules(low, high)))
    return flagged.where(F.size("all_flags") > 0)


def fuel_anomalies(
    reports: DataFrame,
    *,
    low: float = schemas.LOW_KM_PER_LITRE,
    high: float = schemas.HIGH_KM_PER_LITRE,
    ordered: bool = True,
) -> DataFrame:
    """Fills that break a rule, with the rule's label in ``anomaly``."""
    deltas = fuel_deltas(reports)
    hits = deltas.withColumn("anomaly", fuel_label(low, high)).where(F.col("anomaly").isNotNull())
    if ordered:
        hits = spread_sort(hits, *ascending("unit_no", *fill_order(reports)), settle=True)
    return hits.select(*_FILL, "distance_km", "km_per_litre", "anomaly")


def fuel_economy(
    reports: DataFrame, *, limit: int | None = None, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Fills, litres and mean km/L per unit, best first; all units unless ``limit`` is given.

    Sums are taken in exact decimals, so they do not depend on the order of tasks.
    """
    per_unit = (
        fuel_deltas(reports, heavy_rows=heavy_rows)
        .groupBy("unit_no")
        .agg(
            F.count(F.lit(1)).alias("fills"),
            exact_sum(F.col("fuel_litres")).alias("litres"),
            (exact_sum(F.col("economy")) / F.count("economy")).alias("mean_economy"),
        )
    )
    shown = per_unit.select(
        "unit_no",
        "fills",
        round_ieee(F.col("litres"), 1).alias("total_litres"),
        round_ieee(F.col("mean_economy"), 2).alias("avg_km_per_litre"),
    ).orderBy(*descending("avg_km_per_litre"), *ascending("unit_no"))
    return shown if limit is None else shown.limit(limit)
