"""Guarded, read-only SQL over the registered tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.operators.governance import (
    NOT_A_QUERY,
    SCRIPT,
    SPARK_FORBIDDEN,
    clean_sql,
    rejection,
)
from convoy.operators.insights import text_rows

# Table functions that only make rows of their arguments.
TABLE_FUNCTIONS = (
    "range",
    "explode",
    "explode_outer",
    "posexplode",
    "posexplode_outer",
    "inline",
    "inline_outer",
    "stack",
    "json_tuple",
)


class Blocked(ValueError):
    """The guard refused a query."""


def register_functions(spark: SparkSession) -> None:
    """SQL functions that ad-hoc queries on this data are used to having."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION from_iso8601_timestamp(text STRING) "
        "RETURNS TIMESTAMP RETURN cast(text AS TIMESTAMP)"
    )


# Quoted text and comments, which stay as they are, or the start of a date difference.
_DATE_DIFF = re.compile(
    r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/"""
    r"""|\bdate_diff\s*\(\s*'(\w+)'\s*,""",
    re.IGNORECASE | re.DOTALL,
)


def _plain_units(sql: str) -> str:
    """Spark names the unit of a date difference by a bare word, not a string."""
    return _DATE_DIFF.sub(lambda m: f"timestampdiff({m[1]}," if m[1] else m[0], sql)


def _items(sequence) -> list:
    """The members of a Scala sequence."""
    return [sequence.apply(i) for i in range(sequence.size())]


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _expressions(node) -> Iterator:
    for expression in _items(node.expressions()):
        stack = [expression]
        while stack:
            one = stack.pop()
            yield one
            stack += _items(one.children())


def _nodes(plan) -> Iterator:
    """All nodes of a parsed query: below it, in its named parts, and in its subqueries."""
    stack = [plan]
    while stack:
        node = stack.pop()
        yield node
        stack += _items(node.children())
        if _kind(node) == "UnresolvedWith":
            stack += [pair._2() for pair in _items(node.cteRelations())]
        # Subqueries of every kind hold their plan in ``plan``, also below other expressions.
        stack += [e.plan() for e in _expressions(node) if _has(e, "plan")]


def _has(node, name: str) -> bool:
    return any(m.getName() == name and m.getParameterCount() == 0 for m in node.getClass().getMethods())


def _refuse(spark: SparkSession, sql: str) -> None:
    """A query sees registered names and harmless functions, wherever in it they stand.

    Walks the parsed query, before any name is resolved, and changes no setting: no
    ``FROM parquet.`path```, no call into the JVM or to a script, and no command.
    """
    for node in _nodes(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)):
        kind = _kind(node)
        if kind == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) > 1 and not _known(spark, parts[:-1]):
                raise Blocked(f"only registered tables can be read, not {'.'.join(parts[:-1])}.*")
        elif kind == "UnresolvedTableValuedFunction":
            _harmless(_items(node.name()), TABLE_FUNCTIONS)
        elif kind == "ScriptTransformation":
            raise Blocked(SCRIPT)
        elif kind.endswith(("Statement", "Command")) or kind.startswith("InsertInto"):
            raise Blocked(NOT_A_QUERY)
        for expression in _expressions(node):
            if _kind(expression) == "UnresolvedFunction":
                _harmless(_items(expression.nameParts()))


def _known(spark: SparkSession, names: list[str]) -> bool:
    """Whether a name's leading parts are a database, with its catalog or without."""
    if len(names) > 1 and names[0].lower() == spark.catalog.currentCatalog().lower():
        names = names[1:]
    return len(names) == 1 and spark.catalog.databaseExists(f"`{names[0].replace('`', '``')}`")


def _harmless(name: list[str], allowed: tuple[str, ...] | None = None) -> None:
    last = name[-1].lower()
    if last in SPARK_FORBIDDEN or (allowed is not None and last not in allowed):
        raise Blocked(f"the function {last} cannot be called")


def guard(spark: SparkSession, sql: str) -> str:
    """The cleaned text, or ``Blocked`` with the failing rule's message.

    Uses the same expressions as the audit of a query log, on one row.
    """
    cleaned = clean_sql(F.lit(sql))
    text, why = (
        spark.range(1).select(cleaned.alias("sql"), rejection(cleaned, strict=True).alias("why"))
    ).first()
    if why is not None:
        raise Blocked(why)
    return text


def readonly_query(spark: SparkSession, sql: str, max_rows: int | None = None) -> DataFrame:
    """A guarded query as a DataFrame with all of its rows, or the first ``max_rows``."""
    text = _plain_units(guard(spark, sql))
    register_functions(spark)
    _refuse(spark, text)
    result = spark.sql(text)
    return result if max_rows is None else result.limit(max_rows)


def run_readonly(spark: SparkSession, sql: str, max_rows: int | None = None) -> dict:
    """Run a guarded query; a refusal or failure comes back as ``error``, never raised.

    With ``max_rows``, ``truncated`` tells whether rows are left out. Large results
    belong into ``save_readonly``, which does not pass them through the driver.
    """
    try:
        result = readonly_query(spark, sql)
        rows, truncated = text_rows(result, max_rows)
    except Blocked as refusal:
        return {"sql": sql, "error": f"blocked: {refusal}"}
    except PySparkException as problem:
        return {"sql": sql, "error": f"the query failed to run: {problem}"}
    return {
        "sql": sql,
        "row_count": len(rows),
        "columns": result.columns,
        "rows": rows,
        "truncated": truncated,
    }


def save_readonly(spark: SparkSession, sql: str, path: str) -> None:
    """Write the whole result of a guarded query to ``path`` as parquet."""
    readonly_query(spark, sql).write.parquet(path)


def run_file(spark: SparkSession, path: str) -> DataFrame:
    """A query kept in a ``.sql`` file, with all of its rows."""
    with open(path, encoding="utf-8") as file:
        return spark.sql(_plain_units(file.read().strip().rstrip(";")))
