"""License labels against plain loops over words and sentences."""

import re

import duckdb
import pandas as pd

from convoy.llm.licenses import (
    CONTAINED, NOTICES, PHRASES, WIDTH, license_digest, license_scan, notice_tokens,
)
from convoy.llm.oracles import license_sql

SCHEMA = "doc_id long, text string, words string, lower string, blocks long"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def expected(text):
    found = split(text)
    places, base = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(found)) if found[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    best, named = 0.0, set()
    blocks = [set(split(b)) for b in re.split(r"\n+|(?<=[.!?;])[ \t]+", lower(text))]
    space = "[\\x09-\\x0D ]"
    sentences = re.split(rf"\n[ \t\r]*\n{space}*|(?<=[.!?;]){space}+", lower(text))
    wrapped = [split(s) for s in sentences if "\n" in s]
    for label, tokens in notice_tokens(NOTICES).items():
        width = WIDTH * len(tokens)
        near = [set(w[i : i + width]) for w in wrapped for i in range(len(w)) if w[i] in tokens]
        share = max(len(tokens & b) for b in blocks + near) / len(tokens)
        if share >= CONTAINED - 1e-12:
            named.add(label)
            best = max(best, share)
    return (
        len(found),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | named)),
        1.0 if base else best,
    )


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in license_digest(license_scan(docs)).collect()}
    assert got == {i: expected(t) for i, t in rows}
    return got


def test_phrases_and_notices(spark):
    rows = [
        (1, None),
        (2, ""),
        (3, "..."),
        (4, "MIT LICENSE mit license. Mit-License\nthe mit  license"),
        (5, "Text before. " + NOTICES["bsd"] + " And after."),
        (6, "Redistribution and use in source or binary forms, with or without modification, are"
            " permitted provided that following conditions are met"),
        (7, "é gnu general public licensed, cc by. CC-BY cc'by ccby"),
        (8, "Released here under the MIT terms; license granted"),
        (9, "word " * 30_000 + NOTICES["mit-grant"].upper() + " word" * 30_000),
        (10, "İ ſ K mit license"),
    ]
    got = check(spark, rows)
    assert got[5][4:] == ("", "bsd", 1.0)
    assert got[6][5] == "bsd"


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(spark, [(r.doc_id, r.text) for r in docs.collect()])
    assert sum(g[1] for g in got.values()) > 0


def test_empty_table(spark):
    assert check(spark, []) == {}


def test_no_python_and_no_shuffle(spark):
    plan = license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", text)


WRAPPED = {
    "bsd": """/* Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 *
 * 1. Redistributions of source code must retain the above copyright notice""",
    "mpl-2.0": """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this""",
    "mit-grant": """Copyright (c) 2020\n
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
}


def test_notices_with_line_breaks(spark):
    rows = [(i, text) for i, text in enumerate(WRAPPED.values())]
    # The notice's words far from one another, or with a blank line between, are no notice.
    rows += [(10, WRAPPED["mpl-2.0"].replace(" ", "\n" + "word " * 20)), (11, WRAPPED["bsd"].replace("without\n", "without\n\n"))]
    rows += [(12, "a; b.\x01c\n \n" + WRAPPED["bsd"].replace("\n", "\r\n")), (13, None), (14, "\n.\n\n")]
    full = check(spark, rows)
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    answer = duckdb.sql(license_sql()).fetchall()
    assert {r[0]: tuple(r[1:]) for r in answer} == full
    assert full.pop(12)[5] == "bsd" and not full.pop(13)[5] and not full.pop(14)[5]
    got = {i: r[5] for i, r in full.items()}
    assert got == {0: "bsd", 1: "mpl-2.0", 2: "mit-grant", 10: "", 11: ""}
