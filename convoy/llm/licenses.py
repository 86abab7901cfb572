"""License scan: known phrases, and notices by an exact containment join.

Everything is column expressions on the row of the document: no shuffle, no Python.
One row comes out per input row, also for repeated rows and null ids; null texts are empty.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that name a license, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of common notices.
NOTICES = {
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "mit-release": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files, to deal in the software without restriction."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification,"
        " are permitted provided that the following conditions are met."
    ),
    "mpl-2.0": (
        "This source code form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}
CONTAINED = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A text block is a sentence or a line.
_BLOCK_END = r"\n+|(?<=[.!?;])[ \t]+"
# A sentence may also go on over line breaks, up to a blank line. So many times the
# notice's words of such a sentence are looked at together.
_SENTENCE_END = r"\n[ \t\r]*\n\s*|(?<=[.!?;])\s+"
WIDTH = 2


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words(lower: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII."""
    return F.array_remove(F.split(lower, _BETWEEN), "")


def notice_tokens(notices: dict[str, str]) -> dict[str, set[str]]:
    """The distinct words of each notice."""
    table = {}
    for label, text in notices.items():
        kept = "".join(c if c.isalnum() else " " for c in text.lower())
        table[label] = set(kept.split())
    return table


def global_order(docs: DataFrame, tokens: set[str]) -> list[str]:
    """``tokens`` from rare to frequent, by the number of documents that hold them.

    The counts are summed over all documents; as many reach the driver as there are tokens.
    """
    listed = F.array(*[F.lit(t) for t in sorted(tokens)])
    held = F.explode(F.array_intersect(words(lowered(F.col("text"))), listed))
    counted = docs.select(held.alias("token")).groupBy("token").count().collect()
    counts = {row["token"]: row["count"] for row in counted}
    return sorted(tokens, key=lambda t: (counts.get(t, 0), t))


def phrase_places(all_words: Column, joined: Column, phrase: str) -> Column:
    """Indexes of the words where ``phrase`` begins."""
    parts = phrase.split()
    last = F.size(all_words) - len(parts)

    def here(i: Column) -> Column:
        return reduce(
            lambda a, b: a & b, [F.get(all_words, i + k) == F.lit(p) for k, p in enumerate(parts)]
        )

    found = F.filter(F.sequence(F.lit(0), last), here)
    none = F.array().cast("array<int>")
    return F.when(joined.contains(f" {phrase} "), found).otherwise(none)


def containment(
    blocks: Column, wrapped: Column, ordered: list[str], threshold: float
) -> Column:
    """The largest share of a notice's words that one block holds, null below the threshold.

    A block is one of ``blocks``, or some consecutive words of a sentence of ``wrapped``.

    ``ordered`` has the notice's words from rare to frequent. A block that reaches the
    threshold has enough words (length filter), one of the rarest words (prefix
    filter), and enough of them that the rest can still make up for those it lacks
    (positional filter); only then are all words compared.
    """
    need = ceil(threshold * len(ordered) - 1e-9)
    rare = ordered[: len(ordered) - need + 1]
    notice = F.array(*[F.lit(t) for t in ordered])
    prefix = F.array(*[F.lit(t) for t in rare])

    def possible(block: Column) -> Column:
        return (
            (F.size(block) >= need)
            & F.arrays_overlap(block, prefix)
            & (F.size(F.array_intersect(prefix, block)) + (len(ordered) - len(rare)) >= need)
        )

    def held(block: Column) -> Column:
        return F.size(F.array_intersect(notice, block))

    def nearby(block: Column) -> Column:
        """The most words of the notice that stand together in a long block."""
        begins = F.filter(
            F.sequence(F.lit(1), F.size(block)),
            lambda i: F.array_contains(notice, F.element_at(block, i)),
        )
        width = F.lit(WIDTH * len(ordered))
        return F.array_max(F.transform(begins, lambda i: held(F.slice(block, i, width))))

    lines = F.transform(F.filter(blocks, possible), held)
    whole = F.filter(wrapped, lambda block: possible(block) & (held(block) >= need))
    best = F.array_max(F.concat(lines, F.transform(whole, nearby)))
    return F.when(best >= need, best / F.lit(float(len(ordered))))


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    notices: dict[str, str] = NOTICES,
    threshold: float = CONTAINED,
) -> DataFrame:
    """(doc_id, n_words, places, base, containments): what each text says about licenses.

    ``places`` are the word indexes of all phrases, ``base`` the labels of phrases found,
    and ``containments`` maps the notices found to the share of their words.
    """
    tokens = notice_tokens(notices)
    order = global_order(docs, set().union(*tokens.values()))
    rank = {t: i for i, t in enumerate(order)}
    ordered = {label: sorted(t, key=rank.__getitem__) for label, t in tokens.items()}

    base = docs.select("doc_id", lowered(F.col("text")).alias("lower"))
    base = base.withColumn("words", words(F.col("lower")))
    base = base.withColumn(
        "joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    )
    places = {
        label: phrase_places(F.col("words"), F.col("joined"), phrase)
        for phrase, label in phrases.items()
    }
    rare = {t for o in ordered.values() for t in o[: len(o) - ceil(threshold * len(o) - 1e-9) + 1]}
    candidate = F.arrays_overlap("words", F.array(*[F.lit(t) for t in sorted(rare)]))
    blocks = F.when(
        candidate,
        F.transform(
            F.split("lower", _BLOCK_END),
            lambda b: F.array_distinct(F.array_remove(F.split(b, _BETWEEN), "")),
        ),
    )
    wrapped = F.when(
        candidate,
        F.transform(
            F.filter(F.split("lower", _SENTENCE_END), lambda b: b.contains("\n")),
            lambda b: F.array_remove(F.split(b, _BETWEEN), ""),
        ),
    )
    found = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.struct(*[c.alias(label) for label, c in places.items()]).alias("by_phrase"),
        blocks.alias("blocks"),
        wrapped.alias("wrapped"),
    )
    held = F.create_map(
        *[
            x
            for label, o in ordered.items()
            for x in (F.lit(label), containment(F.col("blocks"), F.col("wrapped"), o, threshold))
        ]
    )
    found_notices = F.map_filter(held, lambda _, share: share.isNotNull())
    all_places = F.concat(*[F.col("by_phrase").getField(label) for label in phrases.values()])
    labels = F.array_compact(
        F.array(
            *[
                F.when(F.size(F.col("by_phrase").getField(label)) > 0, F.lit(label))
                for label in phrases.values()
            ]
        )
    )
    return found.select(
        "doc_id",
        "n_words",
        all_places.alias("places"),
        labels.alias("base"),
        F.when(F.col("blocks").isNotNull(), found_notices).alias("containments"),
    )


def license_digest(result: DataFrame) -> DataFrame:
    """Counts, first and last places, and joined labels of ``license_scan``."""
    named = F.coalesce(F.map_keys("containments"), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.map_values("containments")), F.lit(0.0))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return result.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", named)).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
