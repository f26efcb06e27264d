"""Which releases are adjacent: channel labels, ordered sequences, transitions and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.version import channel_label, family, filled, version_key, version_order
from driftlens.operators.ordering import positions, with_next
from driftlens.runtime import durable

SEQUENCE = ["label", "machine"]
CARRIED = ["layout", "symbol_key", "file_version", "release_date", "kb"]


def by_channel(builds: DataFrame) -> DataFrame:
    """One row per (build, channel); a build without channels counts as ``unknown``."""
    listed = F.array_distinct(F.coalesce("channel", F.array()))
    return (builds.withColumn("machine", F.coalesce(filled(F.col("machine")), F.lit("unknown")))
            .withColumn("channel", F.explode(F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit("unknown"))))))


def mixed_channels(builds: DataFrame) -> DataFrame:
    """Channels that hold more than one family. The distinct runs before the shuffle, so rows per channel do not matter."""
    return (builds.select(F.explode(F.array_distinct(F.coalesce("channel", F.array()))).alias("channel"),
                          family(F.col("file_version")).alias("family"))
            .filter(F.col("family").isNotNull()).distinct()
            .groupBy("channel").agg(F.count("*").alias("families"))
            .filter(F.col("families") > 1))


def place(builds: DataFrame) -> DataFrame:
    """Rows (build, channel) with their sequence label; unplaceable rows are dropped."""
    mixed = mixed_channels(builds).select("channel", F.lit(True).alias("mixed"))
    return (by_channel(builds).join(mixed, "channel", "left")
            .withColumn("label", channel_label(F.col("channel"), F.col("file_version"), F.coalesce("mixed", F.lit(False))))
            .filter(F.col("label").isNotNull())
            .drop("mixed"))


def release_order(version: Column, date: Column, key: Column) -> list[Column]:
    return [F.coalesce(date, F.lit("")), version_key(version), F.coalesce(key, F.lit(""))]


def ordered(placed: DataFrame) -> DataFrame:
    """Add the order columns ``o1..o4`` of each sequence.

    A sequence whose builds all carry a version is ordered by version first; any other by date first.
    With ``o1`` null throughout the latter, one ordering serves both. Whether all carry one is a
    partial aggregate joined back, not a window over the sequence.
    """
    complete = placed.groupBy(*SEQUENCE).agg(
        F.min(filled(F.col("file_version")).isNotNull()).alias("all_versioned"))
    return (placed.withColumn("_key", version_order(F.col("file_version"))).join(complete, SEQUENCE)
            .withColumn("o1", F.when(F.col("all_versioned"), F.col("_key")))
            .withColumn("o2", F.coalesce("release_date", F.lit("")))
            .withColumnRenamed("_key", "o3")
            .withColumn("o4", F.coalesce("symbol_key", F.lit(""))))


ORDER = ["o1", "o2", "o3", "o4"]


def adjacency(builds: DataFrame) -> DataFrame:
    """Every placed row with its successor in ``next`` (null at the end of a sequence).

    The narrow placed rows are written once: the completeness check, the sampling of slice bounds and
    the slicing itself all read them.
    """
    narrow = durable(place(builds.select("channel", "machine", *CARRIED)), "placed")
    return with_next(ordered(narrow), SEQUENCE, ORDER, CARRIED)


def transitions(adjacent: DataFrame) -> DataFrame:
    """Adjacent pairs, one row each."""
    return adjacent.filter(F.col("next").isNotNull()).select(
        *SEQUENCE,
        F.col("file_version").alias("from_version"), F.col("next.file_version").alias("to_version"),
        F.col("symbol_key").alias("from_key"), F.col("next.symbol_key").alias("to_key"),
        F.col("kb").alias("from_kb"), F.col("next.kb").alias("kb"),
        F.col("next.release_date").alias("date"),
        F.col("layout").alias("layout_from"), F.col("next.layout").alias("layout_to"),
        *ORDER)


def changed(pairs: DataFrame) -> DataFrame:
    """Only the transitions whose layout differs."""
    return pairs.filter(F.col("layout_from") != F.col("layout_to"))


def layout_pairs(changes: DataFrame) -> DataFrame:
    """Distinct (from, to): many transitions share one, and the expensive comparison runs once for it."""
    return changes.select("layout_from", "layout_to").distinct()


def sequence_stats(adjacent: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """Totals per sequence. ``missing`` (channel, missing) is matched on the label, so a split label finds none."""
    place_in_run = F.struct(*ORDER)
    ends = F.struct("file_version", "release_date", "layout")
    stats = adjacent.groupBy(*SEQUENCE).agg(
        F.count("*").alias("builds"),
        F.count_if(F.col("next").isNotNull()).alias("transitions"),
        F.count_if(F.col("next.layout") != F.col("layout")).alias("layout_changes"),
        F.min_by(ends, place_in_run).alias("first"), F.max_by(ends, place_in_run).alias("last"),
    ).select(
        *SEQUENCE, "builds", "transitions", "layout_changes",
        F.col("first.file_version").alias("from_version"), F.col("last.file_version").alias("to_version"),
        F.col("first.release_date").alias("from_date"), F.col("last.release_date").alias("to_date"),
        F.col("last.layout").alias("latest_layout"))
    if missing is None:
        return stats.withColumn("known_missing_in_channel", F.lit(0).cast("bigint"))
    known = missing.select(F.col("channel").alias("label"), F.col("missing").alias("known_missing_in_channel"))
    return stats.join(known, "label", "left").fillna(0, ["known_missing_in_channel"])


def verdict(stats: DataFrame) -> DataFrame:
    """``nothing to compare`` for a single build is not the same as ``0 changes``."""
    return stats.withColumn("verdict", F.when(F.col("transitions") == 0, F.lit("nothing to compare")).otherwise(
        F.concat(F.col("layout_changes").cast("string"), F.lit(" changes"))))


def verdict_counts(stats: DataFrame) -> DataFrame:
    compared = F.col("transitions") > 0
    return stats.agg(
        F.count("*").alias("sequences"), F.sum("transitions").alias("transitions"),
        F.sum("layout_changes").alias("layout_changes"),
        F.count_if(compared & (F.col("layout_changes") == 0)).alias("quiet"),
        F.count_if(~compared).alias("single"))


def feed_order() -> list[Column]:
    """Newest first; ties keep the ascending order inside their sequence."""
    return [F.coalesce("date", F.lit("")).desc(), F.col("label").desc(), F.col("machine").desc(),
            *[F.col(name).asc() for name in ORDER]]


def feed_order_columns() -> list[Column]:
    """The columns of :func:`feed_order`, with a missing date as empty text."""
    return [F.coalesce("date", F.lit("")).alias("date"), F.col("label"), F.col("machine"), *[F.col(name) for name in ORDER]]


def in_feed_order(changes: DataFrame, out: str = "feed_pos") -> DataFrame:
    return positions(changes, feed_order(), out)


def newest_first(entries: DataFrame, version: str, tie: str, out: str = "pos") -> DataFrame:
    """Number entries by version, newest first; ``tie`` is the input order."""
    return positions(entries, [version_key(F.col(version)).desc(), F.col(tie).asc()], out)
