"""Mixing sources to target weights with whole repetitions and one hash-seeded Bernoulli copy.

Sizes are added up per source before anything is shuffled; sources are numbered and their targets settled as tables, so
neither their number nor a source that holds most rows matters. A document is emitted floor(rate) times, plus once more
if its hash falls below the fraction of the rate: no order, the same on every run.

A single draw leaves a source with few or very unequal documents some per cent from its target. So each source looks at
``TURNS`` draws that differ in the point of the hash circle where the fraction begins, each with the same probability for
every document, and takes the one whose words come nearest to its target. Their sums are one aggregate with a row for
each source.

Defined results: a null text has size 0; a null source is a source of its own and comes last; the draw depends on the
seed, ``doc_id`` and the source's turn alone, so repeated rows of a document are drawn alike; a null id draws as the text
"null"; sources without words get target 0 and rate 0; of turns that come equally near the first is taken; an empty table
gives an empty table. Only ``taken``/copies are decided here, so extra columns pass through ``mix`` untouched, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.runtime import durable

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = "[ \\t\\n\\x0B\\f\\r]+"
#: Draws are whole numbers of 48 bits.
DRAW_RANGE = 1 << 48
#: Draws that a source looks at; a power of two.
TURNS = 64


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    trimmed = F.regexp_replace(text, "^" + GAP, "")
    parts = F.size(F.split(F.concat(trimmed, F.lit(" ")), GAP)) - 1
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(parts).cast("long")


def draw(seed: int, id_col: Column) -> Column:
    """A whole number below ``DRAW_RANGE``: the first 12 digits of the MD5 of ``seed:id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def drawn(value: Column, turn: Column | int, fraction: Column) -> Column:
    """Whether a draw falls into the part of the circle that has ``fraction`` of it and begins at the turn."""
    return (value + turn * F.lit(DRAW_RANGE // TURNS)) % DRAW_RANGE < fraction * float(DRAW_RANGE)


def numbered(sources: DataFrame) -> DataFrame:
    """Sources with ``_rank`` from 0 in code-point order, null last; ranges are counted first, so no task sees all of them."""
    ranged = durable(sources.repartitionByRange(F.col("_source").isNull(), F.col("_source")).withColumn("_slice", F.spark_partition_id()), "mix-sources")
    heads = ranged.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = heads.withColumn("_before", F.expr("sum(_n) over (order by _slice) - _n")).drop("_n")  # a row per slice
    local = ranged.withColumn("_local", F.expr("row_number() over (partition by _slice order by _source is null, _source)"))
    return local.join(before, "_slice").withColumn("_rank", F.col("_before") + F.col("_local") - 1).drop("_slice", "_local", "_before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``_source, source_size, target`` from rows of ``_source, size``.

    All targets add up to ``share`` (a fraction) of all sizes, by weight. Sources whose part exceeds ``most`` times
    their size stop there, and the rest is shared again, until none exceeds it. Each round is one aggregate whose two
    numbers decide whether another is needed.
    """
    totals = sizes.groupBy(F.col("_source")).agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    known = durable(numbered(totals).select("_source", "source_size", weight.cast("long").alias("_weight"), (F.col("source_size") * most).alias("_cap")), "mix-weights")
    budget = (known.agg(F.sum("source_size")).first()[0] or 0) * share[0] / share[1]
    level, capped = 0.0, None
    while True:
        full = F.lit(False) if capped is None else F.col("_weight") * F.lit(level) >= F.col("_cap")
        row = known.agg(F.sum(F.when(full, F.col("_cap"))).alias("spent"), F.sum(F.when(~full, F.col("_weight"))).alias("open"), F.count(F.when(full, 1)).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped, level = row["n"], (budget - (row["spent"] or 0)) / row["open"]
    share_of = F.col("_weight") * F.lit(level)
    return known.select("_source", "source_size", F.when(share_of >= F.col("_cap"), F.col("_cap").cast("double")).otherwise(share_of).alias("target"))


def _sizes(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``doc_id, _source, size, _draw`` of every row, written once: texts are read for it and never shuffled."""
    return durable(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("_source"), n_words(F.col(text_col)).alias("size"), draw(seed, F.col(id_col)).alias("_draw")), "mix-sizes")


def rates(sizes: DataFrame, **settings) -> DataFrame:
    """``_of, source_size, target, _rate, _turn``: each source's target, rate and the turn that comes nearest to the target."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = durable(targets(sizes, **settings).withColumnRenamed("_source", "_of").withColumn("_rate", rate), "mix-targets")
    fraction = F.col("_rate") - F.floor("_rate")
    rows = sizes.join(goal, F.col("_source").eqNullSafe(F.col("_of"))).select("_of", "_draw", "size", fraction.alias("_fraction"))
    words = F.array(*[F.sum(F.when(drawn(F.col("_draw"), k, F.col("_fraction")), F.col("size")).otherwise(0)) for k in range(TURNS)])
    sums = rows.groupBy(F.col("_of").alias("_at")).agg(words.alias("_words"))
    off = F.transform("_words", lambda w, k: F.struct(F.abs(F.floor("_rate") * F.col("source_size") + w - F.col("target")).alias("off"), k.alias("turn")))
    near = goal.join(sums, F.col("_of").eqNullSafe(F.col("_at")))
    return near.select("_of", "source_size", "target", "_rate", F.array_min(off)["turn"].alias("_turn"))


def _copies() -> Column:
    fraction = F.col("_rate") - F.floor("_rate")
    return (F.floor("_rate") + F.when(drawn(F.col("_draw"), F.col("_turn"), fraction), 1).otherwise(0)).cast("long")


def plan(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` of every row. Texts are read once and never shuffled."""
    sizes = _sizes(docs, seed, id_col, text_col, source_col)
    joined = sizes.join(durable(rates(sizes, **settings), "mix-rates"), F.col("_source").eqNullSafe(F.col("_of")), "left")
    return joined.withColumn("copies", _copies()).select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mixed rows themselves: every column of ``docs``, each row as often as it is taken."""
    goal = durable(rates(_sizes(docs, seed, id_col, text_col, source_col), **settings), "mix-rates").select("_of", "_rate", "_turn")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), draw(seed, F.col(id_col)).alias("_draw"), F.col(source_col).cast("string").alias("_source"))
    joined = rows.join(goal, F.col("_source").eqNullSafe(F.col("_of")), "left")
    repeated = joined.withColumn("copy", F.explode(F.array_repeat(F.lit(0), _copies().cast("int"))))
    return repeated.select(*[F.col(f"row.`{c}`") for c in docs.columns])
