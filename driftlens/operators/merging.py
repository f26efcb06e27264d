"""Keyed merges of a run into what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SETS = ("sha256", "channel", "kb")
KEPT = ("file_version", "timestamp", "size_of_image", "release_date")


def fold(incoming: DataFrame, key: str, order: str, sets=SETS, kept=KEPT) -> DataFrame:
    """Several rows of one key in a run become one: sets united, the last filled value kept, the rest last.

    Lists are flattened before they are gathered, so each task passes on distinct values only.
    """
    rest = [c for c in incoming.columns if c not in (key, order, *sets, *kept)]
    scalars = [F.max_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(order))).alias(c) for c in kept if c in incoming.columns]
    others = [F.max_by(c, order).alias(c) for c in rest]
    folded = incoming.groupBy(key).agg(F.max(order).alias(order), *scalars, *others)
    held = [s for s in sets if s in incoming.columns]
    if held:
        # One pass over all lists: each value goes with the name of its list.
        def tagged(name: str):
            values = F.coalesce(name, F.array().cast(incoming.schema[name].dataType))
            return F.transform(values, lambda v: F.struct(F.lit(name).alias("_set"), v.cast("string").alias("_value")))

        named = F.flatten(F.array(*map(tagged, held)))
        values = incoming.select(key, F.explode(named).alias("_v")).select(key, "_v.*").distinct()
        lists = values.groupBy(key).agg(*[F.collect_list(F.when(F.col("_set") == name, F.col("_value"))).cast(incoming.schema[name].dataType).alias(name) for name in held])
        folded = folded.join(lists, key, "left").withColumns({name: F.array_sort(F.coalesce(name, F.array().cast(incoming.schema[name].dataType))) for name in held})
    return folded.drop(order)


def upsert_builds(existing: DataFrame, incoming: DataFrame, key: str = "symbol_key", sets=SETS, kept=KEPT) -> DataFrame:
    """Lists become sorted unions, kept fields take the new value unless it is empty, all else is overwritten.

    ``incoming`` has one row per key (see :func:`fold`).
    """
    rest = [c for c in incoming.columns if c not in (key, *sets, *kept)]
    old = existing.select(key, *[F.col(c).alias(f"_{c}") for c in incoming.columns if c != key], F.lit(True).alias("_old"))
    merged = incoming.withColumn("_new", F.lit(True)).join(old, key, "full_outer")

    def empty(name: str):
        return F.array().cast(incoming.schema[name].dataType)

    columns = [F.col(key)]
    for name in incoming.columns:
        if name in sets:
            columns.append(F.array_sort(F.array_union(F.coalesce(f"_{name}", empty(name)), F.coalesce(name, empty(name)))).alias(name))
        elif name in kept:
            columns.append(F.coalesce(F.when(F.col(name).cast("string") != "", F.col(name)), F.col(f"_{name}")).alias(name))
        elif name in rest:
            columns.append(F.when(F.col("_new"), F.col(name)).otherwise(F.col(f"_{name}")).alias(name))
    return merged.select(*columns)


def last_wins(existing: DataFrame, recorded: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Keyed overwrite; within ``recorded`` the highest ``order`` counts."""
    names = existing.columns
    newest = recorded
    if order is not None:
        fields = [c for c in names if c != key]
        newest = recorded.groupBy(key).agg(F.max_by(F.struct(*fields), order).alias("_r")).select(key, "_r.*")
    return existing.join(newest.select(key), key, "left_anti").unionByName(newest.select(*names))


def upsert_ledger(existing: DataFrame, recorded: DataFrame, stored: DataFrame, order: str = "ord") -> DataFrame:
    """Last reason per hash; a hash that is now stored has none."""
    return last_wins(existing, recorded, "sha256", order).join(stored.select("sha256").distinct(), "sha256", "left_anti")


def run_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("entries"))
