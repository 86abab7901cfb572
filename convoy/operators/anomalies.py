"""The unified anomaly record and the views over stored runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.numeric import fixed_text
from convoy.functions.ordering import ascending, spread_sort
from convoy.operators.snapshots import latest_snapshot

_RECORD = schemas.ANOMALY.names
_SHOWN = ["category", "anomaly_type", "entity", "detail"]


def _labelled(*parts: tuple[str, Column]) -> Column:
    """``name=value`` pairs joined by a comma and a blank."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{name}="), value) for name, value in parts])


def anomaly_feed(fuel: DataFrame, shift: DataFrame) -> DataFrame:
    """Fuel and shift hits as one bag of four-column records; duplicates stay."""
    return fuel_records(fuel).unionByName(shift_records(shift))


def fuel_records(fuel: DataFrame, *carry: Column) -> DataFrame:
    """Fuel hits as records, with further columns behind them."""
    return fuel.select(
        F.lit("fuel").alias("category"),
        F.col("unit_no").alias("entity"),
        F.col("anomaly").alias("anomaly_type"),
        _labelled(
            ("km/L", fixed_text(F.col("km_per_litre"), 2)),
            ("distance", fixed_text(F.col("distance_km"), 1)),
            ("litres", fixed_text(F.col("fuel_litres"), 2)),
        ).alias("detail"),
        *carry,
    )


def shift_records(shift: DataFrame, *carry: Column) -> DataFrame:
    """Shift hits as records, with further columns behind them."""
    return shift.select(
        F.lit("shift").alias("category"),
        F.col("driver").alias("entity"),
        F.col("anomaly").alias("anomaly_type"),
        _labelled(
            ("hours", fixed_text(F.col("hours"), 1)),
            ("rate", fixed_text(F.col("hourly_rate"), 2)),
            ("unit", F.coalesce("unit_no", F.lit("None"))),
        ).alias("detail"),
        *carry,
    )


def summary_columns() -> list[Column]:
    """Totals over a feed, usable in ``agg`` and in ``observe``."""
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("category") == "fuel").alias("fuel"),
        F.count_if(F.col("category") == "shift").alias("shift"),
    ]


def detection_summary(feed: DataFrame, detect_date: str) -> DataFrame:
    """One row: the day, all records, and records per category."""
    counted = feed.agg(*summary_columns())
    return counted.select(F.lit(detect_date).alias(schemas.DETECT_KEY), "total", "fuel", "shift")


def anomalies_all(stored: DataFrame) -> DataFrame:
    """Records of every run. A fault that persists shows once per run."""
    return spread_sort(stored.select(*_SHOWN), *ascending(*_SHOWN[:3]))


def anomalies_latest(stored: DataFrame, *, limit: int = schemas.FEED_TOP) -> DataFrame:
    """The first ``limit`` records of the newest run that has any."""
    return first_records(latest_snapshot(stored, schemas.DETECT_KEY), limit=limit)


def first_records(records: DataFrame, *, limit: int = schemas.FEED_TOP) -> DataFrame:
    """The first ``limit`` records by category, type and entity."""
    # `detail` makes the cut at the limit definite.
    return records.select(*_SHOWN).orderBy(*ascending(*_SHOWN)).limit(limit)


def severity(anomaly_type: Column) -> Column:
    """Severity of an anomaly type, from a constant map inside the projection."""
    pairs = [F.lit(text) for pair in schemas.SEVERITY.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[anomaly_type], F.lit(schemas.DEFAULT_SEVERITY))


def severity_feed(anomalies: DataFrame) -> DataFrame:
    """Records with severity and a readable type, as the feed table shows them."""
    return anomalies.select(
        severity(F.col("anomaly_type")).alias("severity"),
        F.translate("anomaly_type", "_", " ").alias("type"),
        "category",
        "entity",
        "detail",
    )
