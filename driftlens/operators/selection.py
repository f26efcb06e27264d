"""Choosing entries: channel and tier filters, resume, allowlists, breadth-first picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlens.functions.version import version_key
from driftlens.operators.ordering import top_per_group
from driftlens.operators.sequences import place

# Channels of the first tier.
FIRST_TIER = ("11-26H1", "11-25H2", "11-24H2", "11-23H2", "11-22H2", "22H2")
EVERYTHING = "*"


def in_channel(entries: DataFrame, channel: str, column: str = "channel") -> DataFrame:
    return entries.filter(F.array_contains(column, channel))


def in_tier(entries: DataFrame, tier=FIRST_TIER, column: str = "channel") -> DataFrame:
    return entries.filter(F.arrays_overlap(F.col(column), F.array(*[F.lit(name) for name in tier])))


def sources_of(builds: DataFrame, column: str = "sha256") -> DataFrame:
    """Every entry hash a stored build stands for; the column may be a list or, in older rows, one string."""
    kind = builds.schema[column].dataType.typeName()
    value = F.explode(column) if kind == "array" else F.col(column)
    return builds.select(value.alias("sha256")).filter(F.col("sha256").isNotNull()).distinct()


def not_yet_stored(entries: DataFrame, builds: DataFrame, column: str = "sha256") -> DataFrame:
    return entries.join(sources_of(builds, column), "sha256", "left_anti")


def allowlist_names(groups: DataFrame) -> DataFrame:
    """Flatten (group, names) to distinct names; the ``gate`` group counts too."""
    return groups.select(F.explode("names").alias("name")).distinct()


def select_allowed(entities: DataFrame, wanted: DataFrame, name: str = "name") -> DataFrame:
    """Entities named in ``wanted`` (column ``name``); a ``*`` row selects everything.

    Whether a star is asked for is one bit, looked up first; else a list of any length is a semi join.
    """
    names = wanted.select(F.col("name").alias("_wanted"))
    if not names.filter(F.col("_wanted") == EVERYTHING).isEmpty():
        return entities
    return entities.join(names, entities[name] == names["_wanted"], "left_semi")


def missing_names(wanted: DataFrame, entities: DataFrame, name: str = "name") -> DataFrame:
    """Requested names nothing was found for."""
    found = entities.select(F.col(name).alias("name")).distinct()
    return wanted.filter(F.col("name") != EVERYTHING).select("name").distinct().join(found, "name", "left_anti")


def first_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Limit after ordering: a top-n per task, then one merge of n rows."""
    return df.orderBy(*order).limit(n)


def stratified(entries: DataFrame, count: int, key: str = "symbol_key", input_order: str = "symbol_key") -> DataFrame:
    """One entry per label and round, newest first, until ``count`` are picked.

    Labels take turns by their newest version. An entry shipped under several labels is taken at its
    earliest turn, which is the minimum of (depth, label order) over its labels.
    """
    placed = place(entries.withColumn("_in", F.col(input_order))).withColumn("_version", version_key(F.col("file_version")))
    turns = placed.groupBy("label").agg(
        F.max("_version").alias("_top"), F.min(F.struct("_in", "channel")).alias("_first"))
    deep = top_per_group(placed.select(key, "label", "_in", "_version"), ["label"],
                         [F.col("_version").desc(), F.col("_in")], count, "_depth")  # no label can give more than all of them
    turn = F.struct("_depth", F.transform("_top", lambda part: -part).alias("_top"), "_first", "label")
    picked = (deep.join(turns, "label").groupBy(key).agg(F.min(turn).alias("_turn"))
              .orderBy("_turn").limit(count))
    # At most `count` rows are left to number.
    return picked.withColumn("pick", F.row_number().over(Window.orderBy("_turn")) - 1).select(key, "pick")
