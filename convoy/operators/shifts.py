"""Shifts: hours and pay per driver, and the shift and payroll rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.numeric import round_ieee, seconds_between, to_hours
from convoy.functions.ordering import ascending, descending, spread_sort
from convoy.functions.rules import Rules, every_match, first_match

_SHIFT = ["unit_no", "clock_in", "clock_out", "odometer_in", "odometer_out"]


def with_driver(facts: DataFrame, profiles: DataFrame) -> DataFrame:
    """Join any table that has ``employee_id`` to the roster, adding ``driver`` and rate.

    Rows without a matching profile drop out. The roster is broadcast when the
    optimizer finds it small enough; beyond that the join shuffles, and AQE
    splits the partition of a driver that holds a large share of the rows.
    """
    roster = profiles.select(
        F.col("id").alias("_profile_id"), F.col("name").alias("driver"), "hourly_rate"
    )
    joined = facts.join(roster, facts["employee_id"] == roster["_profile_id"], "inner")
    return joined.drop("_profile_id")


def _closed(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("clock_out").isNotNull())


def _hours(scale: int | None) -> Column:
    return to_hours(seconds_between(F.col("clock_in"), F.col("clock_out")), scale)


def completed_shifts(
    entries: DataFrame,
    profiles: DataFrame,
    *,
    hour_scale: int | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Closed shifts of known drivers with their length in hours, and the columns in ``carry``.

    The length is taken before the join. Behind it, a filter on the length
    would make the optimizer parse both times again inside the join condition.
    """
    kept = dict.fromkeys(["employee_id", *_SHIFT, *carry])
    timed = _closed(entries).select(*kept, _hours(hour_scale).alias("hours"))
    return with_driver(timed, profiles).select("driver", *_SHIFT, "hourly_rate", "hours", *carry)


def driver_hours(
    entries: DataFrame,
    profiles: DataFrame,
    *,
    limit: int | None = None,
    hour_scale: int | None = None,
) -> DataFrame:
    """Shifts, hours and estimated pay per (name, rate), most hours first.

    Shifts are summed per employee before the roster is joined, so neither the
    join nor its shuffle sees more than one row per employee and map task, and
    a driver holding a large share of the shifts costs no more than any other.
    """
    seconds = seconds_between(F.col("clock_in"), F.col("clock_out"))
    # Whole seconds and scaled decimals add up the same in any task order.
    length = seconds if hour_scale is None else to_hours(seconds, hour_scale)
    per_employee = (
        _closed(entries)
        .where(F.col("employee_id").isNotNull())
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("shifts"), F.sum(length).alias("length"))
    )
    per_driver = (
        with_driver(per_employee, profiles)
        .groupBy("driver", "hourly_rate")
        .agg(F.sum("shifts").alias("shifts"), F.sum("length").alias("length"))
    )
    worked = F.col("length").cast("double") if hour_scale is not None else to_hours(F.col("length"))
    shown = _most_hours(per_driver, worked)
    return shown if limit is None else shown.limit(limit)


def _most_hours(per_driver: DataFrame, worked: Column, *more: str) -> DataFrame:
    """Hours and pay as shown, most hours first; further columns follow the others in the order."""
    return per_driver.select(
        "driver",
        "shifts",
        round_ieee(worked, 1).alias("hours"),
        round_ieee(worked * F.col("hourly_rate"), 2).alias("est_gross_pay"),
        *more,
    ).orderBy(*descending("hours"), *ascending("driver", "est_gross_pay", *more))


def driver_totals(
    entries: DataFrame, profiles: DataFrame, *, max_hours: float = schemas.MAX_SHIFT_HOURS
) -> DataFrame:
    """``driver_hours`` with ``flags``, the shifts that break a rule, from one pass over both tables.

    Only the rule on the rate needs the roster: it flags all shifts that no other rule
    does, so two counts per employee are enough before the join.
    """
    seconds = seconds_between(F.col("clock_in"), F.col("clock_out"))
    timed = _closed(entries).where(F.col("employee_id").isNotNull())
    timed = timed.withColumn("length", seconds).withColumn("hours", to_hours(F.col("length")))
    per_employee = timed.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("shifts"),
        F.sum("length").alias("length"),
        F.count(first_match(fault_rules(max_hours))).alias("faults"),
    )
    known = with_driver(per_employee, profiles)
    flags = F.when(_unpaid(), F.col("shifts")).otherwise(F.col("faults"))
    per_driver = known.withColumn("flags", flags).groupBy("driver", "hourly_rate")
    sums = per_driver.agg(*[F.sum(c).alias(c) for c in ("shifts", "length", "flags")])
    return _most_hours(sums, to_hours(F.col("length")), "flags")


def _unpaid() -> Column:
    return F.col("hourly_rate").isNull() | (F.col("hourly_rate") == 0)


def fault_rules(max_hours: float = schemas.MAX_SHIFT_HOURS) -> Rules:
    """The rules on a closed shift itself."""
    return [
        ("nonpositive_duration", F.col("hours") <= 0),
        ("excessive_shift", F.col("hours") > max_hours),
        ("odometer_backwards", F.col("odometer_out") < F.col("odometer_in")),
    ]


def shift_rules(max_hours: float = schemas.MAX_SHIFT_HOURS) -> Rules:
    """All rules on a closed shift with its driver's rate."""
    return [*fault_rules(max_hours), ("missing_hourly_rate", _unpaid())]


def shift_label(max_hours: float = schemas.MAX_SHIFT_HOURS) -> Column:
    """The first shift rule a closed shift breaks, or NULL."""
    return first_match(shift_rules(max_hours))


def flagged_shifts(
    entries: DataFrame, profiles: DataFrame, *, max_hours: float = schemas.MAX_SHIFT_HOURS
) -> DataFrame:
    """Closed shifts that break a rule, with all rules they break in ``all_flags``."""
    shifts = completed_shifts(entries, profiles)
    flagged = shifts.withColumn("all_flags", every_match(shift_rules(max_hours)))
    return flagged.where(F.size("all_flags") > 0)


def shift_anomalies(
    entries: DataFrame,
    profiles: DataFrame,
    *,
    max_hours: float = schemas.MAX_SHIFT_HOURS,
    hour_scale: int | None = None,
    ordered: bool = True,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Closed shifts that break a rule, with the rule's label in ``anomaly``.

    Rules see the unrounded hours; only the shown column has one decimal.
    """
    shifts = completed_shifts(entries, profiles, hour_scale=hour_scale, carry=carry)
    shifts = shifts.withColumn("hours", F.col("hours").cast("double"))
    hits = shifts.withColumn("anomaly", shift_label(max_hours)).where(
        F.col("anomaly").isNotNull()
    )
    if ordered:
        hits = spread_sort(hits, *ascending("driver", "clock_in", "unit_no"), settle=True)
    return hits.select(
        "driver",
        "unit_no",
        round_ieee(F.col("hours"), 1).alias("hours"),
        "hourly_rate",
        "odometer_in",
        "odometer_out",
        "anomaly",
        *carry,
    )
