"""Times the headline queries over a landed lake and prints one JSON line.

The fleet tables are first landed by the extract job itself; then every query
runs once to warm up and three times for its median, beside DuckDB on the same files.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import duckdb  # noqa: E402

from convoy.operators.anomalies import first_records  # noqa: E402
from convoy.operators.governance import audit_sql  # noqa: E402
from convoy.plans.detect import detect  # noqa: E402
from convoy.plans.extract import run_extract  # noqa: E402
from convoy.session import build_session  # noqa: E402
from convoy.sources.anomaly_store import read_anomalies  # noqa: E402
from convoy.sources.catalog import register_views  # noqa: E402
from convoy.sources.lake import day_path  # noqa: E402
from registry.fleet import TABLES, TODAY, query_log, snapshot  # noqa: E402
from registry.oracles import ORACLES, fleet_oracles  # noqa: E402
from registry.spark_queries import FLEET_QUERIES  # noqa: E402

HEADLINE = [
    "fuel_efficiency",
    "fuel_anomalies",
    "fuel_economy_top25",
    "fuel_economy_all",
    "completed_shifts",
    "driver_hours_top10",
    "driver_hours_top25",
    "driver_hours_all",
    "loads_per_driver",
    "shift_anomalies",
    "anomaly_feed",
    "detection_summary",
    "severity_counts",
    "kpi_tiles",
    "fuel_economy_share",
]


def seconds(action) -> float:
    """The median time of three runs after one to warm up."""
    action()
    taken = []
    for _ in range(3):
        start = time.perf_counter()
        action()
        taken.append(time.perf_counter() - start)
    return round(statistics.median(taken), 3)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def spark_times(spark, sf_dir: str, root: str) -> dict[str, float]:
    times = {
        "run_extract": seconds(
            lambda: run_extract(spark, snapshot(spark, sf_dir, TODAY), root, TODAY)
        )
    }
    times["register_views"] = seconds(lambda: register_views(spark, root))
    for name in HEADLINE:
        times[name] = seconds(lambda: run(FLEET_QUERIES[name](spark.table)))
    times["detect"] = seconds(lambda: detect(spark, root, TODAY))
    times["anomalies_latest"] = seconds(
        lambda: run(first_records(read_anomalies(spark, root, "latest")))
    )
    times["audit_sql"] = seconds(lambda: run(audit_sql(query_log(spark, sf_dir))))
    return times


def duckdb_times(sf_dir: str, root: str, cpus: int) -> dict[str, float]:
    con = duckdb.connect()
    con.execute(f"set threads = {cpus}; set timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")

    def files(name):
        return lambda day: f"select * from '{day_path(root, name, day)}/*.parquet'"

    sql = fleet_oracles({name: files(name) for name in TABLES})
    sql["audit_sql"] = ORACLES["audit_sql"]
    return {
        name: seconds(lambda: con.execute(f"create or replace temp table r as {sql[name]}"))
        for name in [*HEADLINE, "audit_sql"]
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    with tempfile.TemporaryDirectory(prefix="convoy-bench-") as root:
        # Spark's own messages must not mix with the one line of output.
        with contextlib.redirect_stdout(sys.stderr):
            spark = build_session(
                "convoy-bench",
                master=f"local[{cpus}]",
                **{
                    "spark.sql.shuffle.partitions": str(cpus),
                    "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
                    "spark.checkpoint.dir": f"{root}/shared",
                    "spark.ui.showConsoleProgress": "false",
                },
            )
            spark.sparkContext.setLogLevel("ERROR")
            times = spark_times(spark, sf_dir, root)
            spark.stop()
            beside = duckdb_times(sf_dir, root, cpus)
    print(
        json.dumps(
            {
                "metric": "fleet queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "duckdb": beside,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
