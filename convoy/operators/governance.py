"""The read-only guard as column expressions over a table of SQL texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that may not occur in a query, and the messages.
FORBIDDEN = (
    "insert",
    "update",
    "delete",
    "drop",
    "create",
    "alter",
    "grant",
    "revoke",
    "truncate",
    "merge",
    "call",
)
NOT_A_QUERY = "only SELECT/WITH queries are allowed"
SEVERAL_STATEMENTS = "multiple statements are not allowed"
WRITE_KEYWORD = "query contains a forbidden (write) keyword"

# Needed on Spark only: functions that run JVM code from a plain SELECT.
SPARK_FORBIDDEN = ("reflect", "java_method", "try_reflect")
SCRIPT = "query runs a script"

# (?U) makes blanks and word edges follow Unicode.
_BLANKS = r"[\s\x1c-\x1f]+"
_STRIP = rf"(?U)\A{_BLANKS}|{_BLANKS}\z"
_LEFT_STRIP = rf"(?U)\A{_BLANKS}"
_FENCES = r"\A```[a-z]*\n?|\n?```\z"
# USING is only harmless before a column list; SELECT TRANSFORM ... USING 'cmd' forks.
_SCRIPT = r"(?iU)\busing\b(?!\s*\()"


def clean_sql(sql: Column) -> Column:
    """Without surrounding blanks, one code fence, and closing semicolons."""
    bare = F.regexp_replace(F.regexp_replace(sql, _STRIP, ""), _FENCES, "")
    return F.regexp_replace(F.regexp_replace(bare, _STRIP, ""), r";+\z", "")


def _any_word(words: tuple[str, ...]) -> str:
    return rf"(?iU)\b({'|'.join(words)})\b"


def rejection(sql: Column, *, strict: bool = False) -> Column:
    """Why a text may not run, or NULL when it may; the first failing rule speaks.

    The rules look at raw text on purpose: a keyword inside a literal is
    rejected too. ``strict`` adds what Spark needs on top.
    """
    start = F.lower(F.regexp_replace(sql, _LEFT_STRIP, ""))
    words = FORBIDDEN + (SPARK_FORBIDDEN if strict else ())
    reason = (
        F.when(~(start.startswith("select") | start.startswith("with")), NOT_A_QUERY)
        .when(sql.contains(";"), SEVERAL_STATEMENTS)
        .when(sql.rlike(_any_word(words)), WRITE_KEYWORD)
    )
    return reason.when(sql.rlike(_SCRIPT), SCRIPT) if strict else reason


def audit_sql(query_log: DataFrame, *, strict: bool = False) -> DataFrame:
    """Each logged text with ``clean_sql``, ``allowed`` and ``reason``."""
    cleaned = query_log.withColumn("clean_sql", clean_sql(F.col("sql")))
    text = F.coalesce("clean_sql", F.lit(""))
    return (
        cleaned.withColumn("_why", rejection(text, strict=strict))
        .withColumn("allowed", F.col("_why").isNull())
        .withColumn("reason", F.concat(F.lit("blocked: "), F.col("_why")))
        .drop("_why")
    )
