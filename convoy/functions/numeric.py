"""Numbers: rounding, durations, and fixed-scale text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_HOUR = 3600.0
# Doubles from here on are whole numbers.
_WHOLE = float(2**52)


def round_ieee(value: Column, digits: int) -> Column:
    """Round half away from zero on the binary value of a double.

    Spark's own ``round`` goes through the shortest decimal text, so 1.005
    becomes 1.01 there; scaling the double first gives 1.0, which is what the
    reference engine returns. Values that are so large that no fraction is left,
    and those that are not finite, stay as they are.
    """
    scale = F.lit(float(10**digits))
    scaled = F.abs(value) * scale
    rounded = F.signum(value) * F.floor(scaled + F.lit(0.5)) / scale
    return F.when(scaled < F.lit(_WHOLE), rounded).otherwise(value)


def exact_sum(value: Column) -> Column:
    """The sum of doubles, taken in decimals so that any order gives the same.

    A group with a value that has no such decimal is summed as doubles.
    """
    exact = value.try_cast(T.DecimalType(30, 12))
    total = F.try_sum(exact).cast("double")
    return F.when(F.count(exact) == F.count(value), total).otherwise(F.sum(value))


def instant(text: Column) -> Column:
    """ISO-8601 text to a point in time; malformed text raises under ANSI."""
    return text.cast("timestamp")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds, truncated toward zero (not second boundaries).

    Taken from the instants: ``timestamp_diff`` compares wall clocks of the
    session's zone, which is an hour off across a change to summer time.
    """
    micros = F.unix_micros(instant(end)) - F.unix_micros(instant(start))
    return F.call_function("div", micros, F.lit(1_000_000))


def to_hours(seconds: Column, scale: int | None = None) -> Column:
    """Seconds as hours.

    ``scale=None`` keeps the exact quotient as a double. With a ``scale`` every
    value is first rounded half up to that many decimals, as engines do that
    type a bigint over a one-decimal literal as a decimal.
    """
    hours = seconds / F.lit(SECONDS_PER_HOUR)
    if scale is None:
        return hours
    return F.round(hours, scale).cast(T.DecimalType(21, scale))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def fixed_text(value: Column, digits: int, missing: str = "None") -> Column:
    """Plain decimal text with a fixed number of digits; NULL as ``missing``.

    A number beyond 38 digits, or one that is not finite, is shown as the double's own text.
    """
    text = value.try_cast(T.DecimalType(38, digits)).cast("string")
    return F.coalesce(text, value.cast("string"), F.lit(missing))


def trimmed_text(value: Column, digits: int = 2) -> Column:
    """Decimal text without trailing zeros: 12.50 -> 12.5, 100.00 -> 100."""
    text = value.try_cast(T.DecimalType(38, digits)).cast("string")
    return F.coalesce(F.regexp_replace(text, r"\.?0+$", ""), value.cast("string"))


def parsed_or_zero(value: Column) -> Column:
    """A number read from text or a number; unreadable, NULL and NaN count as 0."""
    number = value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(0.0))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares greater than every number, so it must not reach a threshold."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None)) for c in floating})
