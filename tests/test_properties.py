"""Random inputs against plain restatements of the rules."""

from __future__ import annotations

import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convoy.functions.numeric import round_ieee
from convoy.operators.governance import (
    FORBIDDEN,
    NOT_A_QUERY,
    SEVERAL_STATEMENTS,
    WRITE_KEYWORD,
    audit_sql,
)

# Batches, because every example is a Spark job.
FEW = settings(max_examples=4, deadline=None)

PIECES = [
    *FORBIDDEN,
    "SELECT",
    "with",
    "select ",
    ";",
    "```",
    "```sql\n",
    "\n```",
    " ",
    "\n",
    "\t",
    " ",
    "_at",
    "é",
    "'",
    "Update",
    "(",
    "--",
    "1",
]


def expected_clean(text: str) -> str:
    bare = text.strip()
    if bare.startswith("```"):
        bare = re.sub(r"\A```[a-z]*\n?", "", bare)
    if bare.endswith("```"):
        bare = bare[:-3].removesuffix("\n")
    return bare.strip().rstrip(";")


def expected_reason(text: str) -> str | None:
    if not text.lstrip().lower().startswith(("select", "with")):
        return NOT_A_QUERY
    if ";" in text:
        return SEVERAL_STATEMENTS
    words = {w.lower() for w in re.findall(r"\w+", text)}
    return WRITE_KEYWORD if words & set(FORBIDDEN) else None


TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@FEW
@given(st.lists(TEXT, min_size=200, max_size=300))
def test_guard_agrees_with_its_rules(spark, texts):
    log = [(i, "q", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(log, "id long, question string, sql string")
    for row in audit_sql(df).collect():
        assert row["clean_sql"] == expected_clean(row["sql"])
        why = expected_reason(row["clean_sql"])
        assert row["reason"] == (why and f"blocked: {why}")
        assert row["allowed"] == (why is None)


@FEW
@given(st.lists(st.floats(-1e9, 1e9), min_size=200, max_size=300), st.integers(0, 3))
def test_round_ieee_is_half_away_from_zero(spark, values, digits):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    scale = 10.0**digits
    for v, r in df.select("v", round_ieee(F.col("v"), digits)).collect():
        assert r == math.copysign(math.floor(abs(v) * scale + 0.5) / scale, v) or (v == 0 == r)
