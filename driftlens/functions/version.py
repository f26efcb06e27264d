"""Dotted version strings as ordering and grouping keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS, DIGITS = 4, 38


def version_key(version: Column) -> Column:
    """Array of four whole numbers; parts that are not all digits are left out, short keys padded.

    Parts beyond 38 digits count as the largest number that fits, so no version string can fail a job.
    """
    digits = F.regexp_extract_all(F.coalesce(version, F.lit("")), F.lit(r"(?:^|\.)(\d+)(?=\.|\z)"), 1)
    def fitted(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(plain) > DIGITS, F.lit("9" * DIGITS)).otherwise(plain)

    zeros = F.array(*[F.lit(0).cast(f"decimal({DIGITS},0)")] * PARTS)
    return F.slice(F.concat(F.transform(digits, fitted).cast(f"array<decimal({DIGITS},0)>"), zeros), 1, PARTS)


def version_order(version: Column) -> Column:
    """The key as one text that sorts as :func:`version_key` does: of each part how many digits it has, then the digits.

    Sorting and slicing compare many keys per row, which takes a short text a fraction of what four decimals take.
    """
    digits = F.regexp_extract_all(F.coalesce(version, F.lit("")), F.lit(r"(?:^|\.)(\d+)(?=\.|\z)"), 1)

    def sortable(part: Column) -> Column:
        plain = F.regexp_replace(F.coalesce(part, F.lit("0")), "^0+(?=.)", "")
        fitted = F.when(F.length(plain) > DIGITS, F.lit("9" * DIGITS)).otherwise(plain)
        return F.concat(F.lpad(F.length(fitted).cast("string"), 2, "0"), fitted)

    return F.concat(*[sortable(F.get(digits, F.lit(at))) for at in range(PARTS)])


def version_key_text(version: Column) -> Column:
    """The key as comparable text, for outputs that should stay scalar."""
    return F.array_join(version_key(version).cast("array<string>"), ",")


def family(version: Column) -> Column:
    """Third dotted part as text, null unless there are three parts and it is all digits."""
    third = F.get(F.split(F.coalesce(version, F.lit("")), r"\."), 2)
    return F.when(third.rlike(r"^[0-9]+$"), third)


def channel_label(channel: Column, version: Column, mixed: Column) -> Column:
    """Sequence label: the channel, or ``channel/family`` where the channel mixes families.

    Null when a mixed channel's entry has no family and so cannot be placed.
    """
    found = family(version)
    return F.when(~mixed, channel).when(found.isNotNull(), F.concat_ws("/", channel, found))


def filled(column: Column) -> Column:
    """Empty text read as missing."""
    return F.nullif(column, F.lit(""))
