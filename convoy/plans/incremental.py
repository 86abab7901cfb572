"""Detection that reads what changed, not the whole history.

A run keeps two tables for the next one: the last fill of every unit, and every record with
the unit or the employee it belongs to. From a day's changes it then needs

- new fills after the unit's last one: judged with that fill as their predecessor,
- units where a fill went, or came at or before the last one: *reopened*,
- new closed shifts: judged on their own,
- employees whose closed shift went or whose roster row changed: *reopened*.

Records of what is not reopened are taken over. Only for what is reopened is the snapshot
read, and not at all if there is nothing. The stored day is the same as a run over
the whole history would give, and running a day again replaces it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy import schemas
from convoy.functions.ordering import comparable
from convoy.operators.anomalies import fuel_records, shift_records
from convoy.operators.fuel import fill_order, fuel_deltas, fuel_label
from convoy.operators.shifts import shift_anomalies
from convoy.session import scratch_path
from convoy.sources.anomaly_store import write_anomalies, write_run
from convoy.sources.changes import came, read_changes, went, write_changes
from convoy.sources.lake import read_table
from convoy.sources.versions import current, publish

_TABLES = ("fuel_reports", "time_entries", "profiles")
_OWNER = "owner"
_RECORDS = ["category", "entity", "anomaly_type", "detail", _OWNER]
_COLUMNS = ["unit_no", "report_date", "created_at", "odometer", "fuel_litres", "id"]


def state_path(root: str, name: str) -> str:
    return f"{root}/detection_state/{name}"


@dataclass
class Outcome:
    """The records and last fills of a day, and how much had to be opened again."""

    records: DataFrame
    last_fills: DataFrame
    reopened_units: int
    reopened_employees: int


def _kept(df: DataFrame, label: str) -> DataFrame:
    """A small table that several steps read, computed once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _within(df: DataFrame, column: str, keys: DataFrame, how: str) -> DataFrame:
    """Rows whose ``column`` is (``left_semi``) or is not (``left_anti``) among the keys."""
    return df.join(keys, df[column].eqNullSafe(keys["key"]), how)


def _fills(df: DataFrame) -> DataFrame:
    """The columns that matter, whether or not fills have an id."""
    return df.select(*[c for c in _COLUMNS if c in df.columns])


def _last(fills: DataFrame) -> DataFrame:
    """The last fill of every unit."""
    row = F.struct(*fills.columns)
    ends = fills.groupBy("unit_no").agg(F.max_by(row, comparable(*fill_order(fills))).alias("row"))
    return ends.select("row.*")


def _fuel_hits(fills: DataFrame, *carry: str) -> DataFrame:
    judged = fuel_deltas(fills, carry=carry).withColumn("anomaly", fuel_label())
    return judged.where(F.col("anomaly").isNotNull())


def _fuel_of(hits: DataFrame) -> DataFrame:
    return fuel_records(hits, F.col("unit_no").alias(_OWNER))


def _shifts_of(entries: DataFrame, profiles: DataFrame) -> DataFrame:
    hits = shift_anomalies(entries, profiles, ordered=False, carry=("employee_id",))
    return shift_records(hits, F.col("employee_id").alias(_OWNER))


def from_scratch(spark: SparkSession, root: str, day: str) -> Outcome:
    """A day without a day before: everything is new."""
    fills = _fills(read_table(spark, root, "fuel_reports", day))
    entries = read_table(spark, root, "time_entries", day)
    records = _fuel_of(_fuel_hits(fills)).unionByName(
        _shifts_of(entries, read_table(spark, root, "profiles", day))
    )
    return Outcome(records, _last(fills), 0, 0)


def from_changes(spark: SparkSession, root: str, day: str, before: str) -> Outcome:
    """A day from the state of an earlier one and the changes since then."""
    known = spark.read.parquet(current(spark, state_path(root, "records"), schemas.DETECT_KEY)[before])
    last = spark.read.parquet(current(spark, state_path(root, "fills"), schemas.DETECT_KEY)[before])
    with ThreadPoolExecutor(max_workers=2) as pool:
        fills = pool.submit(_fuel_changes, spark, root, day, last, known)
        shifts = pool.submit(_shift_changes, spark, root, day, known)
        (fuel, last, units), (shift, employees) = fills.result(), shifts.result()
    return Outcome(fuel.unionByName(shift), last, units, employees)


def _fuel_changes(
    spark: SparkSession, root: str, day: str, last: DataFrame, known: DataFrame
) -> tuple[DataFrame, DataFrame, int]:
    changes = read_changes(spark, root, "fuel_reports", day)
    new = _fills(came(changes))
    order = fill_order(new)
    ends = last.select(F.col("unit_no").alias("_unit"), comparable(*order).alias("_end"))
    late = new.join(ends, new["unit_no"].eqNullSafe(ends["_unit"]))
    late = late.filter(comparable(*order) <= F.col("_end")).select("unit_no")
    reopened = went(changes).select("unit_no").unionByName(late).distinct()
    reopened = _kept(reopened.select(F.col("unit_no").alias("key")), "reopened")
    fresh = _within(new, "unit_no", reopened, "left_anti")
    touched = _kept(fresh.select(F.col("unit_no").alias("key")).distinct(), "touched")

    seeds = _within(last, "unit_no", touched, "left_semi").withColumn("_seed", F.lit(True))
    joined = fresh.withColumn("_seed", F.lit(False)).unionByName(seeds)
    hits = _fuel_hits(joined, "_seed").filter(~F.col("_seed"))
    records = _within(known.filter("category = 'fuel'"), _OWNER, reopened, "left_anti")
    records = records.unionByName(_fuel_of(hits))
    untouched = _within(_within(last, "unit_no", reopened, "left_anti"), "unit_no", touched, "left_anti")
    last = untouched.unionByName(_last(fresh))
    count = reopened.count()
    if count:
        history = _fills(read_table(spark, root, "fuel_reports", day))
        history = _within(history, "unit_no", reopened, "left_semi")
        records = records.unionByName(_fuel_of(_fuel_hits(history)))
        last = last.unionByName(_last(history))
    return records, last, count


def _shift_changes(
    spark: SparkSession, root: str, day: str, known: DataFrame
) -> tuple[DataFrame, int]:
    changes = read_changes(spark, root, "time_entries", day).filter("clock_out IS NOT NULL")
    roster = read_changes(spark, root, "profiles", day)
    reopened = went(changes).select(F.col("employee_id").alias("key"))
    reopened = reopened.unionByName(roster.select(F.col("id").alias("key"))).distinct()
    reopened = _kept(reopened, "reopened")
    profiles = read_table(spark, root, "profiles", day)
    fresh = _within(came(changes), "employee_id", reopened, "left_anti")
    records = _within(known.filter("category = 'shift'"), _OWNER, reopened, "left_anti")
    records = records.unionByName(_shifts_of(fresh, profiles))
    count = reopened.count()
    if count:
        entries = read_table(spark, root, "time_entries", day)
        entries = _within(entries, "employee_id", reopened, "left_semi")
        records = records.unionByName(_shifts_of(entries, profiles))
    return records, count


def detect_changes(spark: SparkSession, root: str, day: str) -> dict:
    """Check one day from the state of the newest day before it; its summary.

    The changes of the day's tables are found first, against the day that the state is of.
    Steps that do not depend on each other are submitted side by side, so that short jobs fill
    the gaps of long ones.
    """
    states = current(spark, state_path(root, "records"), schemas.DETECT_KEY)
    before = max((d for d in states if d < day), default=None)
    if before is None:
        found = from_scratch(spark, root, day)
    else:
        with ThreadPoolExecutor(max_workers=len(_TABLES)) as pool:
            pending = [pool.submit(write_changes, spark, root, t, day, since=before) for t in _TABLES]
            for job in pending:
                job.result()
        found = from_changes(spark, root, day, before)
    fills, records = state_path(root, "fills"), state_path(root, "records")
    with ThreadPoolExecutor(max_workers=1) as pool:
        last = pool.submit(publish, spark, fills, schemas.DETECT_KEY, day, found.last_fills.write.parquet)

        def write(path: str) -> None:
            found.records.select(*_RECORDS).write.parquet(path)
            # The records make the day known to later ones, so they are marked last.
            last.result()

        path = publish(spark, records, schemas.DETECT_KEY, day, write)
    summary = write_anomalies(spark.read.parquet(path), root, day)
    write_run(spark, root, summary)
    return {
        **summary,
        "reopened_units": found.reopened_units,
        "reopened_employees": found.reopened_employees,
    }
