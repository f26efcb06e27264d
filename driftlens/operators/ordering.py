"""Order-dependent building blocks that never put a whole group into one task.

A plain ``lead`` or ``row_number`` window sends each group to a single task, which fails when one group holds a large share
of the rows. Here rows are dealt to slices of the order (group, order), so that a large group spans many slices, and
only what stands at the slices' edges meets again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from driftlens.runtime import durable

#: Keys sampled for a slice, and slices for a shuffle partition, so that partitions even out.
SAMPLED, SLICES = 20, 3


def _columns(order) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in order]


def slice_number(df: DataFrame, keys: list[str], slices: int | None = None) -> Column:
    """Number of the slice of the ascending order of ``keys`` that a row falls into, as an expression over its columns.

    The bounds come from one bounded sample (by hash, so each key counts once) and are literals: unlike the number of
    a range partition the slice is a value of the row, which a shuffle can be made on and later steps can rely on. A row
    is compared with as many bounds as a binary search takes.
    """
    slices = slices or SLICES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(k) for k in keys])
    kind = df.select(key.alias("k")).schema["k"].dataType
    sample = df.select(key.alias("k")).orderBy(F.xxhash64("k")).limit(SAMPLED * slices)
    sample = [row[0] for row in sample.distinct().orderBy("k").select(F.to_json("k")).collect()]
    step = max(1, len(sample) // slices)
    bounds = sample[step::step]
    if not bounds:
        return F.lit(0)
    known = F.from_json(F.lit(json.dumps([json.loads(bound) for bound in bounds])), ArrayType(kind))
    strides = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    beyond = lambda at, stride: F.coalesce(F.get(known, at + stride - 1) <= key, F.lit(False))
    return F.aggregate(strides, F.lit(0), lambda at, stride: F.when(beyond(at, stride), at + stride).otherwise(at))


def sliced(df: DataFrame, group: list[str], order: list[str], work: Callable[[DataFrame, WindowSpec], DataFrame], label: str = "slices") -> DataFrame:
    """``df`` with ``_slice``, after ``work`` on each part of a group within a slice, written once.

    All rows move once, by slice; the window of ``work`` is over (slice, group) in ``order``, ascending.
    """
    placed = df.withColumn("_slice", slice_number(df, [*group, *order])).repartition("_slice")
    return durable(work(placed, Window.partitionBy("_slice", *group).orderBy(*order)), label)


def same_group(group: list[str], left: str = "", right: str = "_") -> Column:
    """Equality of group columns on two sides, a missing value equal to itself."""
    same = F.lit(True)
    for name in group:
        same = same & F.col(f"{left}{name}").eqNullSafe(F.col(f"{right}{name}"))
    return same


def renamed(df: DataFrame, names: list[str], prefix: str = "_") -> DataFrame:
    return df.withColumnsRenamed({name: f"{prefix}{name}" for name in names})


def with_next(df: DataFrame, group: list[str], order: list[str], carry: list[str], out: str = "next") -> DataFrame:
    """Add the struct of ``carry`` columns of the row that follows within ``group``; null on the last.

    ``order`` (ascending) must be total within the group. A row finds its neighbour inside its slice; the last one of a
    slice finds the first one of the next slice that has the group. Those first rows, one per slice and group, are linked
    among themselves and joined to the last rows alone.
    """
    rows = sliced(df, group, order, lambda placed, w: placed.withColumns({out: F.lead(F.struct(*carry)).over(w), "_nth": F.row_number().over(w)}), "neighbours")
    following = F.lead("_first").over(Window.partitionBy(*group).orderBy("_slice"))
    firsts = rows.filter("_nth = 1").select(*group, "_slice", F.struct(*carry).alias("_first"))
    far = durable(renamed(firsts.select(*group, "_slice", following.alias("_far")).filter("_far is not null"), [*group, "_slice"]), "neighbours")
    final = rows.filter(F.col(out).isNull()).join(far, same_group([*group, "_slice"]), "left").withColumn(out, F.col("_far"))
    columns = [*df.columns, out]
    return rows.filter(F.col(out).isNotNull()).select(*columns).unionByName(final.select(*columns))


def positions(df: DataFrame, order: list, out: str = "pos", start: int = 0) -> DataFrame:
    """Number all rows consecutively in ``order`` without a single-partition sort.

    The slices are written once, so every consumer sees the same slice bounds; the running total spans
    only the slices.
    """
    order = _columns(order)
    sliced = durable(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "positions")
    so_far = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sliced.groupBy("_slice").agg(F.count("*").alias("_rows"))
               .select("_slice", F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before")))
    nth = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return (sliced.withColumn("_nth", nth).join(offsets, "_slice")
            .withColumn(out, F.col("_before") + F.col("_nth") - 1 + start)
            .drop("_slice", "_nth", "_before"))


def positions_within(df: DataFrame, group: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """0-based position inside each group, any group size, in ascending ``order``.

    Rows move once and are numbered within their slice of a group; of each slice and group only the number of rows is carried on.
    """
    rows = sliced(df, group, order, lambda placed, w: placed.withColumn("_nth", F.row_number().over(w)), "positions")
    so_far = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*group, "_slice").agg(F.count("*").alias("_rows"))
    before = renamed(counts.select(*group, "_slice", F.coalesce(F.sum("_rows").over(so_far), F.lit(0)).alias("_before")), [*group, "_slice"])
    return rows.join(before, same_group([*group, "_slice"])).select(*df.columns, (F.col("_before") + F.col("_nth") - 1).alias(out))


def top_per_group(df: DataFrame, group: list[str], order: list, n: int, out: str = "nth") -> DataFrame:
    """First ``n`` rows of each group, numbered from 1. Spark keeps only ``n`` per task before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*_columns(order))
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= n)
