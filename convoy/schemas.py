"""Declared table shapes and the fixed values the rules rest on."""

from __future__ import annotations

from pyspark.sql import types as T

INGEST_KEY = "ingest_date"
DETECT_KEY = "detect_date"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

# Only the columns some rule relies on are declared. A source may carry more;
# those travel through the lake untouched.
TABLES: dict[str, T.StructType] = {
    "profiles": _struct(id=_S, name=_S, hourly_rate=_D),
    "time_entries": _struct(
        employee_id=_S,
        unit_no=_S,
        clock_in=_S,
        clock_out=_S,
        odometer_in=_D,
        odometer_out=_D,
    ),
    "fuel_reports": _struct(
        unit_no=_S,
        report_date=_S,
        created_at=_S,
        odometer=_D,
        fuel_litres=_D,
        employee_id=_S,
    ),
    "truck_changes": _struct(),
    "loads": _struct(employee_id=_S),
}

# The body of an anomaly record. The day lives in the partition path only.
ANOMALY = _struct(category=_S, entity=_S, anomaly_type=_S, detail=_S)

RUN = _struct(total=_L, fuel=_L, shift=_L, output=_S)
EXTRACT_REPORT = _struct(table=_S, ingest_date=_S, rows=_L)

# Columns that never reach the lake, matched without case.
SENSITIVE = (
    "session_token",
    "otp_failed_attempts",
    "otp_locked_until",
    "otp_secret",
    "password",
    "password_hash",
)

# Rule thresholds.
LOW_KM_PER_LITRE = 1.0
HIGH_KM_PER_LITRE = 6.0
MAX_SHIFT_HOURS = 16.0

# Severity shown for an anomaly type; any other type is "info".
SEVERITY = {
    "missing_hourly_rate": "critical",
    "odometer_backwards": "serious",
    "implausible_low_economy": "serious",
    "implausible_high_economy": "serious",
    "zero_or_missing_litres": "serious",
    "excessive_shift": "warning",
}
DEFAULT_SEVERITY = "info"

# How many rows each consumer is shown.
EXAMPLE_TOP = 10
DASHBOARD_TOP = 25
FEED_TOP = 50
