from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from convoy.operators.fuel import fuel_efficiency
from convoy.operators.governance import (
    NOT_A_QUERY,
    SEVERAL_STATEMENTS,
    WRITE_KEYWORD,
    audit_sql,
)
from convoy.operators.shifts import completed_shifts
from convoy.plans.ask import Blocked, _refuse, guard, readonly_query, run_file, run_readonly
from tests.helpers import ENTRIES, PROFILES, reports, rows, shift

CASES = [
    ("SELECT 1", None),
    ("with x as (select 1) select * from x", None),
    ("  \n\tSELECT 1", None),
    (" SELECT 1", None),
    ("SELECT 1;", None),
    ("SELECT 1;;", None),
    ("SELECT updated_at FROM t", None),
    ("SELECT replace(a, 'b', 'c') FROM t", None),
    ("selection", None),
    ("DROP TABLE t", NOT_A_QUERY),
    ("EXPLAIN SELECT 1", NOT_A_QUERY),
    ("-- why\nSELECT 1", NOT_A_QUERY),
    ("(SELECT 1)", NOT_A_QUERY),
    ("", NOT_A_QUERY),
    (None, NOT_A_QUERY),
    ("SELECT 1; SELECT 2", SEVERAL_STATEMENTS),
    ("SELECT ';'", SEVERAL_STATEMENTS),
    ("SELECT 1; DROP TABLE t", SEVERAL_STATEMENTS),
    ("SELECT 'please update'", WRITE_KEYWORD),
    ("with x as (select 1) INSERT into t select * from x", WRITE_KEYWORD),
    ("select 1 UnIoN call f()", WRITE_KEYWORD),
    ("SELECT 'écall'", None),
]
FENCED = [
    ("```sql\nSELECT 1\n```", "SELECT 1"),
    ("```\nSELECT 1;\n```", "SELECT 1"),
    (" ```sql\nSELECT 1``` ", "SELECT 1"),
    ("SELECT 1 ;", "SELECT 1 "),
    ("SELECT '```'", "SELECT '```'"),
    ("``````", ""),
]


def log(spark, texts):
    return spark.createDataFrame(
        [(i, "q", t) for i, t in enumerate(texts)], "id long, question string, sql string"
    )


def test_audit(spark):
    found = audit_sql(log(spark, [t for t, _ in CASES])).orderBy("id").collect()
    assert [r["reason"] for r in found] == [why and f"blocked: {why}" for _, why in CASES]
    assert [r["allowed"] for r in found] == [why is None for _, why in CASES]


def test_cleaning(spark):
    found = audit_sql(log(spark, [t for t, _ in FENCED])).orderBy("id").collect()
    assert [r["clean_sql"] for r in found] == [clean for _, clean in FENCED]


@pytest.mark.parametrize(
    "sql",
    [
        "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
        "SELECT java_method('java.lang.System', 'getenv', 'HOME')",
        "SELECT try_reflect('java.lang.System', 'getenv', 'HOME')",
        "SELECT TRANSFORM (id) USING 'cat' AS (x) FROM numbers",
        "SELECT TRANSFORM (id) USING /* ( */ 'cat' AS (x) FROM numbers",
        "DELETE FROM numbers",
    ],
)
def test_guard_blocks_code_and_writes(spark, sql):
    with pytest.raises(Blocked):
        guard(spark, sql)
    assert run_readonly(spark, sql)["error"].startswith("blocked: ")


def test_files_are_out_of_reach(spark, tmp_path):
    path = str(tmp_path / "secret")
    spark.range(3).write.parquet(path)
    for sql in (f"SELECT * FROM parquet.`{path}`", f"SELECT (SELECT max(id) FROM parquet.`{path}`)"):
        found = run_readonly(spark, sql)
        assert found["error"].startswith("blocked") and "rows" not in found
    assert spark.read.parquet(path).count() == 3


def test_two_questions_at_once(spark):
    spark.range(50).createOrReplaceTempView("numbers")
    sql = "SELECT sum(n.id) AS s FROM numbers n"
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda _: run_readonly(spark, sql), range(8)))
    assert all(f["rows"] == [["1225"]] for f in found)


def test_rows_are_text_and_whole(spark):
    spark.range(200).createOrReplaceTempView("numbers")
    fenced = "```sql\nSELECT n.id, null AS none FROM numbers n ORDER BY n.id;\n```"
    found = run_readonly(spark, fenced)
    assert found["row_count"] == 200 and found["columns"] == ["id", "none"]
    assert not found["truncated"]
    cut = run_readonly(spark, fenced, max_rows=59)
    assert cut["row_count"] == 59 and cut["truncated"] and cut["rows"] == found["rows"][:59]
    assert not run_readonly(spark, fenced, max_rows=200)["truncated"]
    assert found["rows"][:2] == [["0", ""], ["1", ""]]
    joined = "SELECT count(*) AS c FROM numbers a JOIN numbers b USING (id)"
    assert run_readonly(spark, joined)["rows"] == [["200"]]
    assert readonly_query(spark, "SELECT * FROM numbers").count() == 200


def test_failures_come_back_with_their_text(spark):
    for sql in ("SELECT nothing FROM nowhere", "SELECT 1 +", "SELECT raise_error('no')"):
        found = run_readonly(spark, sql)
        assert found["sql"] == sql and found["error"].startswith("the query failed to run")


def test_time_functions_of_stored_queries(spark):
    sql = (
        "SELECT date_diff('second', from_iso8601_timestamp('2026-01-01T00:00:00+01:00'), "
        "from_iso8601_timestamp('2026-01-01T01:00:00Z')) AS s"
    )
    assert run_readonly(spark, sql)["rows"] == [["7200"]]


def test_stored_style_queries_agree_with_the_operators(spark):
    entries = spark.createDataFrame(
        [shift(3600), shift(5400.7), shift(17 * 3600), shift(0, "D2")], ENTRIES
    )
    people = spark.createDataFrame([("D1", "Ann", 20.0), ("D2", "Bo", 0.0)], PROFILES)
    fills = reports(spark, (0.0, 50.0), (300.0, 50.0), (250.0, 0.0), (600.0, 100.0))
    for name, df in (("time_entries", entries), ("profiles", people), ("fuel_reports", fills)):
        df.createOrReplaceTempView(name)
    per_unit = """
        SELECT t.unit_no, sum(date_diff('second', from_iso8601_timestamp(t.clock_in),
                              from_iso8601_timestamp(t.clock_out))) AS busy
        FROM time_entries t WHERE t.clock_out IS NOT NULL AND t.employee_id = 'D1'
        GROUP BY t.unit_no
    """
    hours = completed_shifts(entries, people).where("driver = 'Ann'").groupBy("unit_no")
    expected = hours.agg(F.sum(F.floor(F.col("hours") * 3600 + 0.001)).alias("busy")).collect()
    found = run_readonly(spark, per_unit)["rows"]
    assert sorted((u, int(n)) for u, n in found) == sorted((r[0], int(r[1])) for r in expected)
    longest = """
        SELECT max(gap.km) AS km FROM (
          SELECT r.odometer - lead(r.odometer) OVER (
                   PARTITION BY r.unit_no ORDER BY r.created_at DESC) AS km
          FROM fuel_reports r) gap
    """
    expected = fuel_efficiency(fills).agg(F.max("distance_km")).first()[0]
    assert [float(r[0]) for r in run_readonly(spark, longest)["rows"]] == [expected]


def test_quoted_text_is_left_alone(spark):
    sql = """SELECT 'date_diff(''second'', 1' AS t -- date_diff('day', x)"""
    assert run_readonly(spark, sql)["rows"] == [["date_diff('second', 1"]]


def test_query_files(spark, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("-- a comment\nSELECT id FROM range(2000);\n")
    assert run_file(spark, str(file)).count() == 2000


HIDDEN = [
    "SELECT * FROM (SELECT * FROM parquet.`{p}`)",
    "WITH a AS (SELECT * FROM parquet.`{p}`) SELECT * FROM a",
    "WITH a AS (WITH b AS (SELECT * FROM orc.`{p}`) SELECT * FROM b) SELECT * FROM a",
    "SELECT 1 WHERE EXISTS (SELECT 1 FROM json.`{p}`)",
    "SELECT 1 WHERE 1 IN (SELECT id FROM text.`{p}`)",
    "SELECT CASE WHEN (SELECT max(id) FROM csv.`{p}`) > 1 THEN 1 END",
    "SELECT * FROM range(3) r JOIN LATERAL (SELECT * FROM parquet.`{p}` WHERE id = r.id)",
    "SELECT 1 UNION ALL SELECT id FROM parquet.`{p}`",
    "SELECT * FROM `parquet`.`{p}`",
    "SELECT * FROM spark_catalog.parquet.`{p}`",
    "SELECT id FROM range(2) ORDER BY (SELECT max(id) FROM parquet.`{p}`)",
    "SELECT * FROM read_files('{p}')",
    "SELECT * FROM range(3) r, LATERAL no_such_function(r.id)",
    "SELECT id, (SELECT sum(x) FROM (SELECT id AS x FROM parquet.`{p}`)) FROM range(2)",
]


@pytest.mark.parametrize("sql", HIDDEN)
def test_files_are_refused_wherever_they_stand(spark, tmp_path, sql):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(Blocked):
        readonly_query(spark, sql.format(p=path))


def test_functions_are_refused_by_name_not_by_text(spark):
    with pytest.raises(Blocked):
        _refuse(spark, "SELECT `reflect`('java.lang.System', 'getenv', 'HOME')")
    with pytest.raises(Blocked):
        _refuse(spark, "WITH a AS (SELECT 1 AS x WHERE java_method('a', 'b') = '') SELECT x FROM a")
    with pytest.raises(Blocked):
        _refuse(spark, "INSERT INTO t SELECT 1")
    # Names of columns and tables, and quoted text, are no calls.
    _refuse(spark, "SELECT 1 AS reflect, 'parquet.`x`' AS t, \"FROM orc.`y`\" AS u")


def test_registered_names_stay_readable(spark):
    spark.range(4).createOrReplaceTempView("four")
    spark.sql("CREATE DATABASE IF NOT EXISTS guard_test")
    spark.sql("CREATE TABLE IF NOT EXISTS guard_test.five USING parquet AS SELECT * FROM range(5)")
    for sql, count in (
        ("WITH a AS (SELECT * FROM four) SELECT * FROM a WHERE id IN (SELECT id FROM four)", 4),
        ("SELECT * FROM guard_test.five", 5),
        ("SELECT * FROM spark_catalog.guard_test.five", 5),
        ("SELECT * FROM range(6)", 6),
        ("SELECT f.id, e.col FROM four f, LATERAL explode(array(1, 2)) e", 8),
    ):
        assert readonly_query(spark, sql).count() == count
