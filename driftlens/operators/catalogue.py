"""Index tables over the store: versions, layouts, names, run lengths, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from driftlens.functions.version import filled, version_key
from driftlens.operators.ordering import positions, renamed, same_group, sliced
from driftlens.operators.sequences import ORDER, SEQUENCE, ordered, place
from driftlens.runtime import durable


def by_version(builds: DataFrame) -> DataFrame:
    """(version, key) rows; builds without a version are found by key only. Sort by both to publish."""
    rows = builds
    key = F.col("symbol_key")
    if "key" in builds.columns:
        key = F.coalesce(filled(key), F.replace(F.col("key"), F.lit("-"), F.lit("")))
    return rows.filter(filled(F.col("file_version")).isNotNull()).select(F.col("file_version").alias("version"), key.alias("key"))


def compact_order(builds: DataFrame, tie: str = "symbol_key", out: str = "pos") -> DataFrame:
    """Newest date first, then version as text, then input order."""
    return positions(builds, [F.coalesce("release_date", F.lit("")).desc(), F.coalesce("file_version", F.lit("")).desc(),
                              F.col(tie).asc()], out)


def compact_builds(builds: DataFrame) -> DataFrame:
    """The build index with its short field names."""
    return builds.select(
        F.col("symbol_key").alias("k"), F.col("file_version").alias("v"), F.col("machine").alias("m"),
        F.coalesce("channel", F.array()).alias("c"), F.coalesce("kb", F.array()).alias("kb"),
        F.col("release_date").alias("d"), F.element_at(F.split(F.col("layout").cast("string"), ":"), -1).alias("l"),
        F.coalesce("symbol_count", F.lit(0).cast("bigint")).alias("y"), F.col("pdb_name").alias("n"))


def layout_usage(builds: DataFrame, manifest: DataFrame, tie: str = "symbol_key") -> DataFrame:
    """Builds, types and enums per layout, most used first, ties by first appearance."""
    used = builds.groupBy("layout").agg(F.count("*").alias("builds"), F.min(tie).alias("_first"))
    held = manifest.groupBy("layout").agg(
        F.count_if(F.col("kind") == "type").alias("types"), F.count_if(F.col("kind") == "enum").alias("enums"))
    joined = used.join(held, "layout", "left").fillna(0, ["types", "enums"])
    return positions(joined, [F.col("builds").desc(), F.col("_first").asc()], "pos").drop("_first")


def layout_keys(builds: DataFrame) -> DataFrame:
    """(layout, symbol_key): which builds have a layout, in long form."""
    return builds.select("layout", "symbol_key").distinct()


def name_catalogue(manifest: DataFrame, builds: DataFrame) -> DataFrame:
    """Per (kind, name): number of distinct definitions and the newest layout that has one."""
    newest = builds.groupBy("layout").agg(F.max(F.struct(
        F.coalesce("release_date", F.lit("")).alias("date"), version_key(F.col("file_version")).alias("version"),
        F.coalesce("symbol_key", F.lit("")).alias("key"))).alias("_last"))
    return (manifest.join(newest, "layout").groupBy("kind", "name")
            .agg(F.count_distinct("blob").alias("variants"), F.max_by("layout", "_last").alias("layout")))


def definition_ranking(catalogue: DataFrame, n: int) -> DataFrame:
    """Names with the most definitions."""
    return catalogue.orderBy(F.col("variants").desc(), "kind", "name").limit(n)


def layout_runs(builds: DataFrame) -> DataFrame:
    """Stretches of adjacent builds with one layout: (sequence, layout, builds, first and last version, place of the last).

    Each slice of a sequence is summed up as its runs. Only its first and last run can go on in another slice, so only
    these meet again, in slice order, and are put together where their layouts agree.
    """
    carried = ["layout", "file_version", "symbol_key"]
    placed = ordered(durable(place(builds.select("channel", "machine", "release_date", *carried)), "placed")).select(*SEQUENCE, *carried, *ORDER)

    def work(rows: DataFrame, w: WindowSpec) -> DataFrame:
        fresh = F.when(F.lag(F.struct("layout")).over(w).eqNullSafe(F.struct("layout")), 0).otherwise(1)
        return rows.withColumns({"_fresh": fresh, "_nth": F.row_number().over(w)}).withColumn("_run", F.sum("_fresh").over(w)).select(*SEQUENCE, "layout", "file_version", "_slice", "_run", "_nth")

    rows = sliced(placed, SEQUENCE, ORDER, work, "runs")
    version = F.struct(F.col("file_version").alias("v"))
    runs = durable(rows.groupBy(*SEQUENCE, "layout", "_slice", "_run").agg(
        F.count("*").alias("builds"), F.max("_nth").alias("_upto"), F.min_by(version, "_nth").alias("_first"), F.max_by(version, "_nth").alias("_last")), "runs")
    in_order = Window.partitionBy(*SEQUENCE).orderBy("_slice")
    before = F.coalesce(F.sum("_builds").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slices = runs.groupBy(*SEQUENCE, "_slice").agg(F.sum("builds").alias("_builds"), F.max("_run").alias("_runs")).withColumn("_before", before).drop("_builds")
    told = runs.join(renamed(slices, [*SEQUENCE, "_slice"]), same_group([*SEQUENCE, "_slice"])).select(
        *SEQUENCE, "layout", "builds", F.col("_first.v").alias("first_version"), F.col("_last.v").alias("last_version"), (F.col("_before") + F.col("_upto") - 1).alias("at"), "_slice", "_run", "_runs")
    edges = told.filter((F.col("_run") == 1) | (F.col("_run") == F.col("_runs")))
    # two rows a slice and sequence at most
    w = Window.partitionBy(*SEQUENCE).orderBy("_slice", "_run")
    goes_on = (F.col("_run") == 1) & F.lag(F.struct("layout")).over(w).eqNullSafe(F.struct("layout"))
    joined = edges.withColumn("_starts", F.when(goes_on, 0).otherwise(1)).withColumn("_island", F.sum("_starts").over(w)).groupBy(*SEQUENCE, "layout", "_island").agg(
        F.sum("builds").alias("builds"), F.min_by(F.struct("first_version"), "at").alias("_f"), F.max_by(F.struct("last_version"), "at").alias("_l"), F.max("at").alias("at"))
    columns = [*SEQUENCE, "layout", "builds", "first_version", "last_version", "at"]
    return joined.select(*SEQUENCE, "layout", "builds", "_f.first_version", "_l.last_version", "at").unionByName(told.filter((F.col("_run") != 1) & (F.col("_run") != F.col("_runs"))).select(*columns))


def store_stats(builds: DataFrame, manifest: DataFrame, blobs: DataFrame, universe: DataFrame) -> DataFrame:
    """Counts, document bytes and the builds-per-layout ratio, one row."""
    one = F.lit(1)

    def size(df: DataFrame, name: str):
        return df.agg(F.count("*").alias(name), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))
                      .alias(f"{name}_bytes")).withColumn("_k", one)

    layouts = manifest.select("layout").distinct().agg(F.count("*").alias("layouts")).withColumn("_k", one)
    return (size(builds, "builds").join(layouts, "_k").join(size(blobs, "blobs"), "_k").join(size(universe, "names"), "_k").drop("_k")
            .withColumn("dedup", F.when(F.col("layouts") > 0, F.round(F.col("builds") / F.col("layouts"), 2))))
