"""Turning index entries into keys: ordered alternatives, duplicates, caches, fallbacks, address ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the outcome that lets the next alternative be tried.
NOT_PUBLISHED = "binary_404"


def first_terminal(entries: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcome of each entry over its ordered ``sizes``, and the size that decided it.

    The first outcome other than "not published" ends the search; if there is none the entry is missing.
    """
    tried = entries.select("sha256", F.posexplode("sizes").alias("_at", "size")).join(outcomes, ["sha256", "size"])
    decided = (tried.filter(F.col("outcome") != NOT_PUBLISHED).groupBy("sha256")
               .agg(F.min_by(F.struct("outcome", "size"), "_at").alias("_d")))
    return entries.join(decided, "sha256", "left").select(
        "sha256", F.coalesce("_d.outcome", F.lit(NOT_PUBLISHED)).alias("outcome"),
        F.when(F.col("_d.outcome") == "ok", F.col("_d.size")).alias("size_of_image"))


def mark_duplicates(resolved: DataFrame, key: str = "symbol_key", order: str = "ord") -> DataFrame:
    """``ok`` for the first entry of a key in ``order``, ``duplicate_key`` for the rest.

    The first place is an aggregate joined back, so one key may hold any number of entries.
    """
    first = resolved.groupBy(key).agg(F.min(order).alias("_first"))
    return resolved.join(first, key).withColumn(
        "outcome", F.when(F.col(order) == F.col("_first"), "ok").otherwise("duplicate_key")).drop("_first")


def with_cached_keys(entries: DataFrame, cache: DataFrame) -> DataFrame:
    """Attach the key a previous run found; null where the entry must be read."""
    return entries.join(cache.select("sha256", "symbol_key"), "sha256", "left")


def updated_cache(cache: DataFrame, found: DataFrame) -> DataFrame:
    """The cache with new keys put in; a new key replaces an old one."""
    kept = cache.join(found.select("sha256"), "sha256", "left_anti")
    return kept.select("sha256", "symbol_key").unionByName(found.select("sha256", "symbol_key"))


def with_fallback(wanted: DataFrame, published: DataFrame) -> DataFrame:
    """Find (name, key) among ``published``, else the compressed name (last character ``_``); null if neither."""
    compressed = F.concat(F.expr("left(name, length(name) - 1)"), F.lit("_"))
    plain = published.select(F.col("name"), F.col("key"), F.lit(True).alias("_plain"))
    packed = published.select(F.col("name").alias("_packed_name"), F.col("key"), F.lit(True).alias("_packed"))
    looked = (wanted.withColumn("_packed_name", compressed).join(plain, ["name", "key"], "left").join(packed, ["_packed_name", "key"], "left"))
    return looked.withColumn("found", F.when(F.col("_plain"), F.col("name")).when(F.col("_packed"), F.col("_packed_name"))).drop(
        "_plain", "_packed", "_packed_name")


def address_offsets(addresses: DataFrame, sections: DataFrame, cell: int = 65536) -> DataFrame:
    """File offset of each (image, rva): the first section, by ``ord``, whose range holds it.

    Sections are listed under every cell of ``cell`` bytes they cover and an address under the one it is
    in, so the range condition only meets sections nearby.
    """
    span = F.greatest("vsize", "rawsize")
    ranged = sections.withColumn("_end", F.col("va") + span).filter(F.col("_end") > F.col("va")).withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("va") / cell), F.floor((F.col("_end") - 1) / cell))))
    points = addresses.select("image", "rva").distinct().withColumn("_cell", F.floor(F.col("rva") / cell))
    hits = points.join(ranged, ["image", "_cell"]).filter((F.col("rva") >= F.col("va")) & (F.col("rva") < F.col("_end")))
    return hits.groupBy("image", "rva").agg(
        F.min_by(F.col("rawptr") + F.col("rva") - F.col("va"), "ord").alias("offset"))
