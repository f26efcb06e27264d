"""Two-sided comparison of keyed rows, the base of every diff, reconciliation and verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_sided(left: DataFrame, right: DataFrame, keys: list[str], attrs: list[str],
              suffixes: tuple[str, str] = ("_from", "_to")) -> DataFrame:
    """Full outer match of rows unique per ``keys``: attributes of both sides and ``in_left``/``in_right``.

    Keys are unique on either side, so the shuffle on the whole key spreads evenly.
    """
    def side(df: DataFrame, suffix: str, mark: str) -> DataFrame:
        return df.select(*keys, *[F.col(a).alias(a + suffix) for a in attrs], F.lit(True).alias(mark))

    joined = side(left, suffixes[0], "in_left").join(side(right, suffixes[1], "in_right"), keys, "full_outer")
    return (joined.withColumn("in_left", F.coalesce("in_left", F.lit(False)))
            .withColumn("in_right", F.coalesce("in_right", F.lit(False))))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def differs(name: str, suffixes: tuple[str, str] = ("_from", "_to")) -> Column:
    return ~F.col(name + suffixes[0]).eqNullSafe(F.col(name + suffixes[1]))


def both_set_and_differ(name: str, suffixes: tuple[str, str] = ("_from", "_to")) -> Column:
    """Unequal and neither side empty: an empty text is unresolved, not a different reading."""
    a, b = F.col(name + suffixes[0]), F.col(name + suffixes[1])
    return (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "") & (a != b)
