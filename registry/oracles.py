"""DuckDB SQL that recomputes each registered query from the raw test tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from registry.fleet import ARRIVED, DAY_1, DAY_2, DAY_3, TODAY
from registry.spark_queries import READONLY_SQL

# ---------------------------------------------------------------- fleet tables


def _iso(moment: str, fraction: str = "") -> str:
    return f"strftime({moment}, '%Y-%m-%dT%H:%M:%S{fraction}+00:00')"


def _profiles(day: str) -> str:
    less = 1 if day == DAY_1 else 0
    return f"""
    select 'D' || c_custkey as id, 'Driver ' || (c_custkey % 400) as name,
           case when c_custkey % 17 = 0 then null
                when c_custkey % 13 = 0 then 0.0
                else 18 + c_custkey % 5 - {less} end::double as hourly_rate
    from customer"""


def _time_entries(day: str) -> str:
    waiting = " or o_orderstatus = 'O'" if day == DAY_1 else ""
    return f"""
    select id, employee_id, unit_no, {_iso('began')} as clock_in,
           case when not pending then {_iso('began + to_seconds(span)')} end as clock_out,
           odometer_in, odometer_out
    from (select o_orderkey as id,
                 case when o_orderkey % 97 = 0 then null
                      when o_orderkey % 50 = 49 then 'X' || o_custkey
                      else 'D' || o_custkey end as employee_id,
                 'U' || (o_orderkey % 40) as unit_no,
                 o_orderdate + to_hours((o_orderkey * 7) % 24) as began,
                 (o_orderkey * 7919) % 72000 - 600 as span,
                 (o_orderkey % 11 = 0{waiting}) as pending,
                 case when o_orderkey % 19 <> 0 then o_orderkey * 10 end::double as odometer_in,
                 case when o_orderkey % 23 <> 0
                      then o_orderkey * 10 + (o_orderkey * 31) % 500 - 5 end::double as odometer_out
          from orders)"""


def _fuel_reports(day: str) -> str:
    hidden = "when event_type = 'signup' then null" if day == DAY_1 else ""
    return f"""
    select event_id as id, 'U' || user_id as unit_no, strftime(ts, '%Y-%m-%d') as report_date,
           {_iso('ts', '.%f')} as created_at,
           case when event_id % 61 <> 0
                then date_sub('minute', timestamp '2024-01-01 00:00:00', ts)
                     - case when event_id % 37 = 0 then 5000 else 0 end end::double as odometer,
           case {hidden} when event_id % 53 = 0 then null
                when event_id % 41 = 0 then 0.0
                else 40.0::double + 4.0::double * value end as fuel_litres,
           'D' || user_id as employee_id
    from events"""


_TABLES = {
    "profiles": _profiles,
    "time_entries": _time_entries,
    "fuel_reports": _fuel_reports,
    "loads": lambda day: "select l_orderkey as id, 'D' || l_suppkey as employee_id from lineitem",
    "truck_changes": lambda day: "select event_id as id from events",
}

# ------------------------------------------------------------------- operators


def _deltas(source: str) -> str:
    return f"""
    select *, odometer - prev_odometer as distance_km,
           case when fuel_litres > 0 then (odometer - prev_odometer) / fuel_litres end as economy,
           round(case when fuel_litres > 0
                      then (odometer - prev_odometer) / fuel_litres end, 2) as km_per_litre
    from (select *, lag(odometer) over (partition by unit_no order by report_date nulls last,
                    created_at nulls last, id) as prev_odometer from {source})"""


def _fuel_hits(source: str) -> str:
    return f"""
    select * from (
      select unit_no, report_date, odometer, fuel_litres, distance_km, km_per_litre,
             case when fuel_litres <= 0 then 'zero_or_missing_litres'
                  when distance_km < 0 then 'odometer_backwards'
                  when km_per_litre < 1 then 'implausible_low_economy'
                  when km_per_litre > 6 then 'implausible_high_economy' end as anomaly
      from {source}) where anomaly is not null"""


_ELAPSED = "date_sub('second', clock_in::timestamptz, clock_out::timestamptz)"
_EXACT = f"{_ELAPSED} / 3600.0"
_TENTHS = f"cast(round({_ELAPSED} / 3600.0, 1) as decimal(21, 1))"


def _closed(entries: str, roster: str, hours: str) -> str:
    return f"""
    select p.name as driver, p.hourly_rate, e.unit_no, e.clock_in, e.clock_out,
           e.odometer_in, e.odometer_out, {_ELAPSED} as seconds, {hours} as hours
    from {entries} e join {roster} p on p.id = e.employee_id
    where e.clock_out is not null"""


def _shift_hits(source: str) -> str:
    return f"""
    select * from (
      select driver, unit_no, round(hours::double, 1) as hours, hourly_rate,
             odometer_in, odometer_out,
             case when hours <= 0 then 'nonpositive_duration'
                  when hours > 16 then 'excessive_shift'
                  when odometer_out < odometer_in then 'odometer_backwards'
                  when coalesce(hourly_rate, 0) = 0 then 'missing_hourly_rate' end as anomaly
      from {source}) where anomaly is not null"""


def _labour(source: str, total: str = "sum(seconds) / 3600.0") -> str:
    return f"""
    select driver, count(*) as shifts, round({total}, 1) as hours,
           round({total} * hourly_rate, 2) as est_gross_pay
    from {source} group by driver, hourly_rate"""


_LABOUR_ORDER = "order by hours desc nulls last, driver, est_gross_pay nulls last"


def _economy(source: str) -> str:
    return f"""
    select unit_no, count(*) as fills, round(sum(fuel_litres), 1) as total_litres,
           round(avg(economy), 2) as avg_km_per_litre
    from {source} group by unit_no"""


_ECONOMY_ORDER = "order by avg_km_per_litre desc nulls last, unit_no"


def _text(column: str, digits: int) -> str:
    # By way of the shortest text of the double, which is what Spark's decimals come from.
    return (
        f"coalesce(cast(cast(cast({column} as varchar) as decimal(38, {digits})) as varchar), 'None')"
    )


def _records(fuel: str, shift: str) -> str:
    return f"""
    select 'fuel' as category, unit_no as entity, anomaly as anomaly_type,
           'km/L=' || {_text('km_per_litre', 2)} || ', distance=' || {_text('distance_km', 1)}
           || ', litres=' || {_text('fuel_litres', 2)} as detail
    from {fuel}
    union all
    select 'shift', driver, anomaly,
           'hours=' || {_text('hours', 1)} || ', rate=' || {_text('hourly_rate', 2)}
           || ', unit=' || unit_no
    from {shift}"""


_FEED_ORDER = "order by category, anomaly_type, entity, detail limit 50"

_SEVERITY = """
    select case anomaly_type when 'missing_hourly_rate' then 'critical'
                             when 'odometer_backwards' then 'serious'
                             when 'implausible_low_economy' then 'serious'
                             when 'implausible_high_economy' then 'serious'
                             when 'zero_or_missing_litres' then 'serious'
                             when 'excessive_shift' then 'warning'
                             else 'info' end as severity,
           replace(anomaly_type, '_', ' ') as type, category, entity, detail
    from feed"""


_FAULTS = {
    "fuel": ("deltas", {
        "zero_or_missing_litres": "fuel_litres <= 0",
        "odometer_backwards": "distance_km < 0",
        "implausible_low_economy": "km_per_litre < 1.0",
        "implausible_high_economy": "km_per_litre > 6.0",
    }),
    "shift": ("closed", {
        "nonpositive_duration": "hours <= 0",
        "excessive_shift": "hours > 16",
        "odometer_backwards": "odometer_out < odometer_in",
        "missing_hourly_rate": "hourly_rate is null or hourly_rate = 0",
    }),
}


def _fault_pairs() -> str:
    """One count for each two rules of a category."""
    counts = []
    for category, (source, rules) in _FAULTS.items():
        names = list(rules)
        for i, one in enumerate(names):
            for other in names[i:]:
                counts.append(
                    f"select '{category}' as category, '{one}' as fault, '{other}' as beside, "
                    f"count(*) as records from {source} where ({rules[one]}) and ({rules[other]})"
                )
    return f"select * from ({' union all '.join(counts)}) where records > 0"


_FAULT_PAIRS = _fault_pairs()


def _day_ctes(
    day: str, tag: str = "", hours: str = _EXACT, tables: Mapping[str, Callable] = _TABLES
) -> dict[str, str]:
    """Everything a day's results rest on, each name with an optional tag."""

    def t(name: str) -> str:
        return f"{name}{tag}"

    return {
        **{t(name): make(day) for name, make in tables.items()},
        t("deltas"): _deltas(t("fuel_reports")),
        t("fuel_hits"): _fuel_hits(t("deltas")),
        t("closed"): _closed(t("time_entries"), t("profiles"), hours),
        t("shift_hits"): _shift_hits(t("closed")),
        t("feed"): _records(t("fuel_hits"), t("shift_hits")),
        t("labour"): _labour(t("closed")),
        t("economy"): _economy(t("deltas")),
    }


def _with(ctes: dict[str, str], query: str) -> str:
    parts = ",\n".join(f"{name} as ({body})" for name, body in ctes.items())
    return f"with {parts}\n{query}"


def _both_days(query: str, **more: str) -> str:
    return _with({**_day_ctes(DAY_1, "_1"), **_day_ctes(DAY_2, "_2"), **more}, query)


def _hot_ctes() -> dict[str, str]:
    unit = "case when id % 3 <> 0 then 'U1' else unit_no end as unit_no"
    return {
        **_day_ctes(TODAY),
        "hot_fills": f"select * replace ({unit}) from fuel_reports",
        "hot_deltas": _deltas("hot_fills"),
    }


def _extreme_ctes() -> dict[str, str]:
    unit = "case when id % 101 = 0 then 'FAR' else unit_no end as unit_no"
    odometer = "case when id % 101 = 0 then id % 7 * 1e17::double else odometer end as odometer"
    litres = (
        "case when id % 101 = 0 then 100.0::double when id % 103 = 0 then pow(2, -30) "
        "else fuel_litres end as fuel_litres"
    )
    return {
        **_day_ctes(TODAY),
        "extreme_fills": f"select * replace ({unit}, {odometer}, {litres}) from fuel_reports",
        "extreme_deltas": _deltas("extreme_fills"),
        "extreme_hits": _fuel_hits("extreme_deltas"),
        "extreme_feed": _records("extreme_hits", "shift_hits"),
    }


def _snapshot(table: str, tag: str, day: str) -> str:
    return f"select *, '{day}' as ingest_date from {table}{tag}"


def _tiles(labour: str, economy: str, feed: str) -> str:
    return f"""
    select (select count(*) from {labour}) as active_drivers,
           (select count(*) from {economy}) as units_fuelled,
           (select sum(cast(round(hours * 10) as bigint)) / 10.0 from {labour}) as total_hours,
           (select count(*) from {feed}) as open_anomalies"""


def _share(source: str, name: str, value: str, unit: str) -> str:
    shown = f"regexp_replace(cast(cast({value} as decimal(38, 2)) as varchar), '\\.?0+$', '')"
    return f"""
    select {name} as name,
           round(case when top <> 0 then coalesce({value}, 0) / top * 100 else 0 end, 6) as pct,
           case when {value} is null then '—' else {shown} || '{unit}' end as label
    from {source}, (select max(coalesce({value}, 0)) as top from {source})"""


_TOP = {
    "top_labour": f"select * from labour {_LABOUR_ORDER} limit 25",
    "top_economy": f"select * from economy {_ECONOMY_ORDER} limit 25",
    "top_feed": f"select category, anomaly_type, entity, detail from feed {_FEED_ORDER}",
}

_INSIGHT_COLUMNS = {
    "driver_hours": ("top_labour", ["driver", "shifts", "hours", "est_gross_pay"]),
    "fuel_economy": ("top_economy", ["unit_no", "fills", "total_litres", "avg_km_per_litre"]),
    "anomalies": ("top_feed", ["category", "anomaly_type", "entity", "detail"]),
}


def _insight_lines(join: str) -> str:
    """All three sets as text lines; ``join`` holds the place of the cell list."""
    branches = []
    for name, (source, columns) in _INSIGHT_COLUMNS.items():
        cells = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in columns)
        line = join.format(cells=cells)
        branches.append(f"select '{name}' as insight, {line} as line from {source}")
    return " union all ".join(branches)


# Words that a read-only query may not hold.
_BLANK = r"[\s\x1c-\x1f]+"
_KEYWORDS = "insert|update|delete|drop|create|alter|grant|revoke|truncate|merge|call"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_BLANK}|{_BLANK}$', '', 'g')"


def _query_log() -> str:
    quoted = "'''' || replace(text, '''', '''''') || ''''"
    kinds = [
        f"'SELECT * FROM loads l WHERE l.note = ' || {quoted}",
        "'  with x as (select 1 as a) select a from x -- ' || text",
        "'DROP TABLE loads -- ' || text",
        f"'SELECT 1; SELECT ' || {quoted}",
        f"'SELECT ''please update it'', ' || {quoted}",
        f"'SELECT ''a;b'', ' || {quoted}",
        f"'SELECT l.updated_at FROM loads l WHERE l.note = ' || {quoted}",
        f"'SELECT replace(' || {quoted} || ', ''a'', ''b'')'",
        "'selection of ' || text",
        "'/* ' || text || ' */ SELECT 1'",
        f"'(SELECT ' || {quoted} || ')'",
        f"'EXPLAIN SELECT ' || {quoted}",
        "'select 1 from loads MERGE ' || text",
        f"'```sql' || chr(10) || 'SELECT ' || {quoted} || chr(10) || '```'",
        f"'```' || chr(10) || 'with t as (select ' || {quoted} "
        "|| ' as a) select a from t;;' || chr(10) || '```'",
        "text",
    ]
    arms = " ".join(f"when {i} then {kind}" for i, kind in enumerate(kinds))
    return f"""
    select conv_id * 100000 + turn as id, text as question,
           case (turn + conv_id) % {len(kinds)} {arms} end as sql
    from conversations"""


def _audit() -> str:
    fenced = f"regexp_replace({_strip('sql')}, '^```[a-z]*\\n?|\\n?```$', '', 'g')"
    return _with(
        {
            "query_log": _query_log(),
            "cleaned": f"select *, rtrim({_strip(fenced)}, ';') as clean_sql from query_log",
            "judged": f"""
    select *, case
        when not regexp_matches(lower(clean_sql), '^{_BLANK[:-1]}*(select|with)')
          then 'only SELECT/WITH queries are allowed'
        when contains(clean_sql, ';') then 'multiple statements are not allowed'
        when regexp_matches(clean_sql, '\\b({_KEYWORDS})\\b', 'i')
          then 'query contains a forbidden (write) keyword' end as why
    from cleaned""",
        },
        "select id, question, sql, clean_sql, why is null as allowed, "
        "'blocked: ' || why as reason from judged",
    )


def _evolved() -> str:
    columns = "unit_no, report_date, {entry} as created_at, odometer, fuel_litres, employee_id, id"
    old = columns.format(entry="cast(null as varchar)")
    new = columns.format(entry="created_at")
    return _both_days(
        f"select {old}, '{DAY_1}' as ingest_date from fuel_reports_1 "
        f"union all select {new}, '{DAY_2}' from fuel_reports_2 "
        f"union all select {new}, '{DAY_3}' from fuel_reports_2"
    )


def _runs() -> str:
    def one(day: str, tag: str) -> str:
        return (
            f"select count(*) as total, count(*) filter (category = 'fuel') as fuel, "
            f"count(*) filter (category = 'shift') as shift, '{day}' as detect_date "
            f"from feed{tag}"
        )

    return _both_days(f"{one(DAY_1, '_1')} union all {one(DAY_2, '_2')}")


def _arriving(day: str) -> dict[str, Callable[[str], str]]:
    """The tables as they had arrived by one of three days."""
    values = DAY_1 if day == DAY_1 else TODAY
    late = "true" if day == DAY_3 else "id % 89 <> 0"
    shifts = "true" if day == DAY_3 else "id % 7 <> 0"
    return {
        "profiles": lambda _: _profiles(values),
        "time_entries": lambda _: f"select * from ({_time_entries(values)}) where {shifts}",
        "fuel_reports": lambda _: (
            f"select * from ({_fuel_reports(values)}) "
            f"where report_date <= '{ARRIVED[day]}' and {late}"
        ),
    }


def _recomputed() -> str:
    """The records of three days, each over its whole history."""
    ctes: dict[str, str] = {}
    parts = []
    for i, day in enumerate((DAY_1, DAY_2, DAY_3)):
        ctes |= _day_ctes(day, f"_{i}", tables=_arriving(day))
        parts.append(
            f"select category, entity, anomaly_type, detail, '{day}' as detect_date from feed_{i}"
        )
    return _with(ctes, " union all ".join(parts))


def _external() -> str:
    parts = [
        f"select '{day}' as ingest_date, (select count(*) from time_entries{tag}) as shifts, "
        f"(select count(clock_out) from time_entries{tag}) as closed, count(*) as records, "
        f"count(distinct entity) as entities from feed{tag}"
        for day, tag in ((DAY_1, "_1"), (DAY_2, "_2"))
    ]
    return _both_days(" union all ".join(parts))


# Names and types of the registered columns, partition columns last.
_CATALOG = {
    "profiles": "id string, name string, hourly_rate double, ingest_date string",
    "time_entries": "id bigint, employee_id string, unit_no string, clock_in string, "
    "clock_out string, odometer_in double, odometer_out double, ingest_date string",
    "fuel_reports": "id bigint, unit_no string, report_date string, created_at string, "
    "odometer double, fuel_litres double, employee_id string, ingest_date string",
    "truck_changes": "id bigint, ingest_date string",
    "loads": "id bigint, employee_id string, ingest_date string",
    "anomalies": "category string, entity string, anomaly_type string, detail string, "
    "detect_date string, run string",
}


def _catalog() -> str:
    parts = [
        f"select '{table}' as \"table\", '- {table}({columns})' as line, count(*) as rows "
        f"from {'feed' if table == 'anomalies' else table}"
        for table, columns in _CATALOG.items()
    ]
    return _with(_day_ctes(TODAY), " union all ".join(parts))


def _report() -> str:
    counts = " union all ".join(
        f"select '{t}' as \"table\", count(*) as rows from {t}" for t in _TABLES
    )
    return _with(
        {**_day_ctes(TODAY), "counts": counts},
        f"select \"table\", '{TODAY}' as ingest_date, rows from counts "
        f"union all select 'total', '{TODAY}', sum(rows)::bigint from counts",
    )


_DELTA_COLUMNS = "unit_no, report_date, odometer, fuel_litres, distance_km, km_per_litre"
_FILLS = "id, unit_no, report_date, created_at, odometer, fuel_litres, employee_id, ingest_date"


def fleet_oracles(tables: Mapping[str, Callable] = _TABLES) -> dict[str, str]:
    """SQL for the queries over fleet tables; ``tables`` says how to get each for a day."""
    exact = _day_ctes(TODAY, tables=tables)
    tenths = _day_ctes(TODAY, hours=_TENTHS, tables=tables)

    def today(query: str, **more: str) -> str:
        return _with({**exact, **more}, query)

    return {
        "fuel_deltas": today(
            "select id, unit_no, prev_odometer, distance_km, economy, km_per_litre from deltas"
        ),
        "fuel_efficiency": today(f"select {_DELTA_COLUMNS} from deltas"),
        "fuel_anomalies": today("select * from fuel_hits"),
        "fuel_economy_top25": today(f"select * from economy {_ECONOMY_ORDER} limit 25"),
        "fuel_economy_all": today("select * from economy"),
        "completed_shifts": today("select * exclude (seconds) from closed"),
        "driver_hours_top10": today(f"select * from labour {_LABOUR_ORDER} limit 10"),
        "driver_hours_top25": today(f"select * from labour {_LABOUR_ORDER} limit 25"),
        "driver_hours_all": today("select * from labour"),
        "driver_hours_quantized": _with(tenths, _labour("closed", "cast(sum(hours) as double)")),
        "loads_per_driver": today(
            "select name as driver, count(*) as loads from loads l "
            "join profiles p on p.id = l.employee_id group by name"
        ),
        "shift_anomalies": today("select * from shift_hits"),
        "shift_anomalies_quantized": _with(tenths, "select * from shift_hits"),
        "anomaly_feed": today("select * from feed"),
        "detection_summary": today(
            f"select '{TODAY}' as detect_date, count(*) as total, "
            "count(*) filter (category = 'fuel') as fuel, "
            "count(*) filter (category = 'shift') as shift from feed"
        ),
        "severity_feed": today(_SEVERITY),
        "severity_counts": today(
            f"select severity, count(*) as records from ({_SEVERITY}) group by severity"
        ),
        "kpi_tiles_of_sets": today(_tiles("top_labour", "top_economy", "top_feed"), **_TOP),
        "fault_pairs": today(_FAULT_PAIRS),
        "kpi_tiles": today(_tiles("top_labour", "top_economy", "top_feed"), **_TOP),
        "kpi_tiles_uncapped": today(_tiles("labour", "economy", "feed")),
        "driver_hours_share": today(_share("top_labour", "driver", "hours", "h"), **_TOP),
        "fuel_economy_share": today(_share("economy", "unit_no", "avg_km_per_litre", " km/L")),
        "stringified_insights": today(
            _insight_lines("cast(to_json([{cells}]) as varchar)"), **_TOP
        ),
        "text_lines": today(_insight_lines("concat_ws(' | ', {cells})"), **_TOP),
    }


_LATEST = _both_days(f"select category, anomaly_type, entity, detail from feed_2 {_FEED_ORDER}")

ORACLES: dict[str, str] = {
    **fleet_oracles(),
    "driver_hours_all_snapshots": _both_days(
        _labour("stacked"),
        all_entries="select * from time_entries_1 union all select * from time_entries_2",
        all_profiles="select * from profiles_1 union all select * from profiles_2",
        stacked=_closed("all_entries", "all_profiles", _EXACT),
    ),
    "detection_runs": _runs(),
    "anomalies_all": _both_days(
        "select category, anomaly_type, entity, detail from feed_1 "
        "union all select category, anomaly_type, entity, detail from feed_2"
    ),
    "anomalies_latest": _LATEST,
    "anomalies_latest_by_max": _LATEST,
    "fuel_deltas_hot_unit": _with(
        _hot_ctes(),
        "select id, unit_no, prev_odometer, distance_km, economy, km_per_litre from hot_deltas",
    ),
    "fuel_economy_hot_unit": _with(
        {**_hot_ctes(), "hot_economy": _economy("hot_deltas")}, "select * from hot_economy"
    ),
    "anomaly_feed_extremes": _with(_extreme_ctes(), "select * from extreme_feed"),
    "insights_isolated": _with(
        _day_ctes(DAY_2),
        "select 'anomalies' as insight, 0::bigint as n_rows, false as failed union all "
        "select 'driver_hours', least(count(*), 25), false from labour union all "
        "select 'fuel_economy', 0, true",
    ),
    "profiles_minimized": f"select * from ({_profiles(TODAY)})",
    "latest_snapshot": _both_days(
        f"select {_FILLS} from ({_snapshot('fuel_reports', '_2', DAY_2)})"
    ),
    "as_of_snapshot": _both_days(
        f"select {_FILLS} from ({_snapshot('fuel_reports', '_1', DAY_1)})"
    ),
    "lake_latest": _both_days(_snapshot("time_entries", "_2", DAY_2)),
    "lake_as_of": _both_days(_snapshot("time_entries", "_1", DAY_1)),
    "extract_report": _report(),
    "evolved_table": _evolved(),
    "incremental_detection": _recomputed(),
    "external_tables": _external(),
    "split_reads": _with(
        _day_ctes(TODAY),
        "select case when employee_id is null then 'none' else 'driver' end as key, "
        "1 as ranges, count(*) as rows from time_entries group by all",
    ),
    "catalog_description": _catalog(),
    "audit_sql": _audit(),
    "readonly_query": _with(
        _day_ctes(TODAY),
        READONLY_SQL.replace("date_diff", "date_sub")
        .replace("from_iso8601_timestamp(fr.created_at)", "fr.created_at::timestamptz")
        .replace(
            "from_iso8601_timestamp('2024-01-01T00:00:00Z')", "timestamptz '2024-01-01 00:00:00+00'"
        ),
    ),
}
