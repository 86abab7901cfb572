"""Named conditions: the first that holds, or all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels and conditions, the first one having precedence.
Rules = list[tuple[str, Column]]


def first_match(rules: Rules) -> Column:
    """The label of the first condition that holds, or NULL."""
    return F.coalesce(*every_outcome(rules))


def every_match(rules: Rules) -> Column:
    """The labels of all conditions that hold, in their order."""
    return F.array_compact(F.array(*every_outcome(rules)))


def every_outcome(rules: Rules) -> list[Column]:
    return [F.when(condition, label) for label, condition in rules]


def pair_counts(flagged: DataFrame, flags: str, *groups: str) -> DataFrame:
    """(groups, fault, beside, records): how many rows break two rules at once.

    ``fault`` comes before ``beside`` in the order of the rules; a rule beside itself counts
    all rows that break it. Rows are expanded to pairs of their own rules only and summed before
    they are shuffled.
    """
    pairs = F.flatten(
        F.transform(
            F.col(flags),
            lambda one, i: F.transform(
                F.slice(flags, i + 1, F.size(flags)),
                lambda other: F.struct(one.alias("fault"), other.alias("beside")),
            ),
        )
    )
    each = flagged.select(*groups, F.inline(pairs))
    return each.groupBy(*groups, "fault", "beside").agg(F.count(F.lit(1)).alias("records"))
