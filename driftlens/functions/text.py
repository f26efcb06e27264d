"""Rendering and parsing of hex, keys, labels and feed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_upper(number: Column) -> Column:
    """``0x1A2B``."""
    return F.concat(F.lit("0x"), F.hex(number.cast("bigint")))


def hex_lower(number: Column) -> Column:
    """``0x1a2b``, the form used in messages."""
    return F.concat(F.lit("0x"), F.lower(F.hex(number.cast("bigint"))))


def parse_hex(text: Column) -> Column:
    """``0x1A2B`` to bigint."""
    return F.conv(F.regexp_replace(text, "^0[xX]", ""), 16, 10).cast("bigint")


def symbol_key(guid: Column, age: Column) -> Column:
    """GUID digits followed by the age in hex."""
    return F.concat(F.upper(F.replace(guid, F.lit("-"), F.lit(""))), F.hex(age.cast("bigint")))


def readable_key(guid: Column, age: Column) -> Column:
    """GUID digits, a dash and the age in decimal."""
    return F.concat(F.upper(F.replace(guid, F.lit("-"), F.lit(""))), F.lit("-"), age.cast("string"))


# Byte order of the little-endian memory form of a GUID (first three fields reversed).
GUID_MEMORY_ORDER = (3, 2, 1, 0, 5, 4, 7, 6, 8, 9, 10, 11, 12, 13, 14, 15)


def guid_bytes(guid: Column) -> Column:
    """The 16-byte memory form; binary comparison of it is unsigned."""
    digits = F.replace(guid, F.lit("-"), F.lit(""))
    return F.unhex(F.concat(*[F.substring(digits, 2 * byte + 1, 2) for byte in GUID_MEMORY_ORDER]))


# Machine codes and their names.
MACHINES = {0x014C: "x86", 0x8664: "amd64", 0xAA64: "arm64"}


def machine_name(code: Column) -> Column:
    chosen = None
    for value, name in MACHINES.items():
        chosen = (F if chosen is None else chosen).when(code == value, F.lit(name))
    return chosen.otherwise(F.format_string("0x%04X", code))


def build_label(version: Column, kbs: Column, key: Column) -> Column:
    """What a reader can look up: the version, else the KB numbers, else the head of the key."""
    return F.coalesce(
        F.nullif(version, F.lit("")),
        F.nullif(F.array_join(kbs, "/"), F.lit("")),
        F.substring(F.coalesce(F.nullif(key, F.lit("")), F.lit("unknown")), 1, 12),
    )


def short_label(version: Column, key: Column, width: int = 10) -> Column:
    return F.coalesce(F.nullif(version, F.lit("")), F.substring(key, 1, width))


def xml_escape(text: Column) -> Column:
    """Ampersand first, then the angle brackets."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


NO_VISIBLE_DIFFERENCE = "layout hash changed with no visible difference"


def summarise(first_names: Column, total: Column) -> Column:
    """First four names of a change and how many more there are."""
    more = F.when(total > 4, F.concat(F.lit(", and "), (total - 4).cast("string"), F.lit(" more")))
    return F.when(total == 0, F.lit(NO_VISIBLE_DIFFERENCE)).otherwise(
        F.concat(F.array_join(F.slice(first_names, 1, 4), ", "), F.coalesce(more, F.lit(""))))


def listed(prefix: str, names: Column, total: Column, shown: int, dots: bool = True) -> Column:
    """``prefix: a, b, c ...``; null when there is nothing to list, so ``concat_ws`` skips it."""
    tail = F.when(total > shown, F.lit(" ...")).otherwise(F.lit("")) if dots else F.lit("")
    return F.when(total > 0, F.concat(F.lit(f"{prefix}: "), F.array_join(F.slice(names, 1, shown), ", "), tail))


def counted(prefix: str, total: Column) -> Column:
    return F.when(total > 0, F.concat(F.lit(f"{prefix}: "), total.cast("string")))


def change_id(feed_id: str, from_key: Column, to_key: Column) -> Column:
    return F.concat_ws(":", F.lit(feed_id), from_key, to_key)


def build_url(base_url: str, key: Column) -> Column:
    return F.concat(F.lit(f"{base_url}/v1/build/"), key, F.lit(".json"))
