"""Rename inference: a removed and an added member on the same bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.names import rename_kind
from driftlens.operators import inrow
from driftlens.operators.diffing import STEP, Sides, added_removed, kept, listed_rows, member_lengths
from driftlens.operators.ordering import renamed, same_group, top_per_group

SIGNATURE = ["off", "sz", "bit_position", "bit_count"]


def _one_sided(changes: DataFrame) -> DataFrame:
    """Removed and added members with the geometry of the side they are on; the declared type does not count."""
    return changes.filter(~(F.col("in_left") & F.col("in_right"))).select(
        *STEP, "member", F.col("in_left").alias("was"),
        *[F.coalesce(f"{name}_from", f"{name}_to").alias(name) for name in SIGNATURE])


def signatures(changes: DataFrame) -> DataFrame:
    """Per step and signature how many members left and came, and one name of each; a partial aggregate."""
    return _one_sided(changes).groupBy(*STEP, *SIGNATURE).agg(
        F.count_if("was").alias("removed"), F.count_if(~F.col("was")).alias("added"),
        F.max(F.when(F.col("was"), F.col("member"))).alias("old"),
        F.max(F.when(~F.col("was"), F.col("member"))).alias("new")).filter((F.col("removed") > 0) & (F.col("added") > 0))


def one_to_one(at: Callable[[str], Column]) -> Column:
    return (at("removed") == 1) & (at("added") == 1)


def is_confirmed() -> Column:
    return one_to_one(F.col)


def confirmed(groups: DataFrame, more: list[str] | None = None) -> DataFrame:
    """Exactly one left and one came: (step, old, new, geometry, kind), and the columns ``more``."""
    return groups.filter(is_confirmed()).select(*STEP, "old", "new", *SIGNATURE, rename_kind(F.col("old"), F.col("new")).alias("rename_kind"), *(more or []))


def ambiguous(groups: DataFrame) -> DataFrame:
    """Signatures on both sides that do not pair one to one."""
    return groups.filter(~is_confirmed()).select(*STEP, *SIGNATURE, "removed", "added")


def ambiguous_members(changes: DataFrame, groups: DataFrame) -> DataFrame:
    """The candidates of each ambiguous signature in long form; sort by name to read them as lists."""
    rows, asked = _one_sided(changes), ambiguous(groups).withColumnsRenamed({name: f"_{name}" for name in [*STEP, *SIGNATURE]})
    return rows.join(asked, same_group([*STEP, *SIGNATURE])).select(
        *STEP, *SIGNATURE, "member", "removed", "added", F.when(F.col("was"), F.lit("removed")).otherwise(F.lit("added")).alias("side"))


def _inside(lists: DataFrame | Sides, fields: str, work: Callable) -> DataFrame:
    """(step, ``fields``) of the steps that are compared inside the row, from their lists or at once from both sides."""
    if isinstance(lists, Sides):
        return lists.inside(fields.format(geometry=",".join(f"{name}:{lists.kind(name)}" for name in SIGNATURE)), work)
    kinds = {f.name: f.dataType.simpleString() for f in lists.schema["changes"].dataType.elementType}
    fields = fields.format(geometry=",".join(f"{name}:{kinds[f'{name}_from']}" for name in SIGNATURE))
    return lists.filter("whole").select(*STEP, "changes").mapInArrow(inrow.over(work), f"step_a bigint, step_b bigint, {fields}")


def _with_large(lists: DataFrame | Sides, inside: DataFrame, of_rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``inside`` and what ``of_rows`` finds in the rows of steps with a large body."""
    rest = lists.rest if isinstance(lists, Sides) else lists.filter(~F.col("whole"))
    return inside if rest is None else inside.unionByName(of_rows(rest))


def _one_entry(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(*STEP, F.array(F.struct(*names)).alias("changes"))


def signature_lists(lists: DataFrame | Sides) -> DataFrame:
    """(step, changes): what :func:`signatures` finds, as an array. Only steps compared row by row take part in an aggregate."""
    found = _inside(lists, "changes array<struct<{geometry},removed:bigint,added:bigint,old:string,new:string>>", inrow.signatures(STEP, SIGNATURE))
    return _with_large(lists, found, lambda rest: _one_entry(signatures(listed_rows(rest)), *SIGNATURE, "removed", "added", "old", "new"))


def signature_groups(lists: DataFrame | Sides) -> DataFrame:
    """:func:`signature_lists` with the sorted names of either side, ``gone`` and ``came``, where they do not pair one to one."""
    found = _inside(lists, "changes array<struct<{geometry},removed:bigint,added:bigint,old:string,new:string,gone:array<string>,came:array<string>>>",
                    inrow.signatures(STEP, SIGNATURE, named=True))

    def of_rows(rest: DataFrame) -> DataFrame:
        rows = listed_rows(rest)
        groups = signatures(rows)
        names = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("member"))))
        key = [*STEP, *SIGNATURE]
        named = ambiguous_members(rows, groups).groupBy(*key).agg(names("removed").alias("gone"), names("added").alias("came"))
        told = groups.join(renamed(named, key), same_group(key), "left").select(*groups.columns, "gone", "came")
        return _one_entry(told, *SIGNATURE, "removed", "added", "old", "new", "gone", "came")

    return _with_large(lists, found, of_rows)


def one_sided_lists(lists: DataFrame | Sides) -> DataFrame:
    """(step, changes): what :func:`added_removed` leaves of the members after confirmed renames, as an array."""
    def of_rows(rest: DataFrame) -> DataFrame:
        rows = listed_rows(rest)
        return _one_entry(added_removed(rows, confirmed(signatures(rows))).withColumnRenamed("item", "member"), "member", "list")

    return _with_large(lists, _inside(lists, "changes array<struct<member:string,list:string>>", inrow.one_sided(STEP, SIGNATURE)), of_rows)


def ambiguous_lists(lists: DataFrame | Sides) -> DataFrame:
    """(step, changes): what :func:`ambiguous_members` finds, as an array."""
    def of_rows(rest: DataFrame) -> DataFrame:
        rows = listed_rows(rest)
        return _one_entry(ambiguous_members(rows, signatures(rows)), "member", *SIGNATURE, "removed", "added", "side")

    found = _inside(lists, "changes array<struct<member:string,{geometry},removed:bigint,added:bigint,side:string>>", inrow.ambiguous(STEP, SIGNATURE))
    return _with_large(lists, found, of_rows)


LENGTHS = [f"_{name}" for name in ("added", "removed", "moved", "resized", "rebitted", "retyped")]


def step_counts(lists: DataFrame | Sides) -> DataFrame:
    """The length of each member list of a step, before renames are taken off, and how many are confirmed, ``n_renamed``."""
    def of_rows(rest: DataFrame) -> DataFrame:
        totals = rest.select(*STEP, *member_lengths()).groupBy(*STEP).agg(*[F.sum(name).alias(name) for name in LENGTHS])
        certain = confirmed(signatures(listed_rows(rest))).groupBy(*STEP).agg(F.count("*").alias("n_renamed"))
        return totals.join(certain, STEP, "left").fillna(0, ["n_renamed"])

    return _with_large(lists, _inside(lists, ", ".join(f"{name} bigint" for name in [*LENGTHS, "n_renamed"]), inrow.lengths(STEP, SIGNATURE)), of_rows)


def first_items(items: DataFrame, out: str, order: list, shown: Column, n: int) -> DataFrame:
    """The first ``n`` items of one list per step, as a sorted array."""
    picked = top_per_group(items, STEP, order, n)
    return picked.groupBy(*STEP).agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", shown.alias("shown")))), lambda x: x["shown"]).alias(out))


def step_heads(lists: DataFrame | Sides, names: int, pairs: int) -> DataFrame:
    """:func:`step_counts` with the first ``names`` added and removed members after renames and the first ``pairs`` renames, as arrays."""
    def of_rows(rest: DataFrame) -> DataFrame:
        rows = listed_rows(rest)
        certain = confirmed(signatures(rows))
        items, told = added_removed(rows, certain), step_counts(rest)
        for which in ("added", "removed"):
            told = told.join(first_items(items.filter(F.col("list") == which), f"_first_{which}", ["item"], F.col("item"), names), STEP, "left")
        return told.join(first_items(certain, "_first_renamed", SIGNATURE, F.concat_ws(" -> ", "old", "new"), pairs), STEP, "left")

    fields = [*[f"{name} bigint" for name in [*LENGTHS, "n_renamed"]], *[f"_first_{name} array<string>" for name in ("added", "removed", "renamed")]]
    return _with_large(lists, _inside(lists, ", ".join(fields), inrow.heads(STEP, SIGNATURE, names, pairs)), of_rows)


def questions(groups: DataFrame, steps: DataFrame) -> DataFrame:
    """(type, signature, gone, came): every ambiguous question of :func:`signature_groups` once, its candidates as sorted lists."""
    asked = kept(groups, lambda at: at("gone").isNotNull()).join(steps.select(*STEP, F.col("name").alias("type")), STEP)
    return listed_rows(asked, ["type"]).select("type", *SIGNATURE, "gone", "came").distinct()


def question_rows(asked: DataFrame) -> DataFrame:
    """(type, signature, question, side, member): :func:`questions` in the long form of :func:`review_table`."""
    key = F.concat_ws(".", *[mark for names in ("gone", "came") for mark in (
        F.hex(F.size(names)), F.hex(F.xxhash64(F.lit("a"), names)), F.hex(F.xxhash64(F.lit("b"), names)))])
    side = lambda name, names: F.transform(names, lambda member: F.struct(F.lit(name).alias("side"), member.alias("member")))
    return asked.select("type", *SIGNATURE, key.alias("question"), F.inline(F.concat(side("removed", "gone"), side("added", "came"))))


def review_questions(changes: DataFrame, groups: DataFrame, steps: DataFrame) -> DataFrame:
    """(step, signature, type, question): each ambiguous signature with a key of what it asks.

    A question is its type, its signature and its two sets of candidates. The key holds, for either side, the number of
    names and 128 bits from two seeded hashes combined by xor, a partial aggregate over distinct names; so the same
    question asked by several steps has one key, and different ones that share candidates do not.
    """
    open_ = ambiguous_members(changes, groups).join(steps.select(*STEP, F.col("name").alias("type")), STEP)
    marks = []
    for side in ("removed", "added"):
        name = F.when(F.col("side") == side, F.col("member"))
        marks += [F.hex(F.count(name)), *[F.hex(F.coalesce(F.bit_xor(F.when(name.isNotNull(), F.xxhash64(F.lit(seed), "member"))), F.lit(0).cast("bigint"))) for seed in ("a", "b")]]
    return open_.groupBy(*STEP, "type", *SIGNATURE).agg(F.concat_ws(".", *marks).alias("question"))


def review_table(changes: DataFrame, groups: DataFrame, steps: DataFrame) -> DataFrame:
    """(type, signature, question, side, member): the candidates of every distinct ambiguous question, long form."""
    asked = review_questions(changes, groups, steps)
    # one step shows the question for all that ask it
    shown = asked.groupBy("type", *SIGNATURE, "question").agg(F.min(F.struct(*STEP)).alias("_s")).select("type", *SIGNATURE, "question", "_s.*")
    return ambiguous_members(changes, groups).select(*STEP, *SIGNATURE, "side", "member").join(shown, [*STEP, *SIGNATURE]).select("type", *SIGNATURE, "question", "side", "member")


def distinct_questions(changes: DataFrame, groups: DataFrame, steps: DataFrame) -> DataFrame:
    """(type, signature, question), each ambiguous question once."""
    return review_questions(changes, groups, steps).select("type", *SIGNATURE, "question").distinct()


def occurrences(step_rows: DataFrame, step_uses: DataFrame) -> DataFrame:
    """Attach how often each step is taken (``uses``) and the earliest place it is (``first_use``)."""
    return step_rows.join(step_uses, STEP)


def alias_table(used: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Confirmed label changes keyed by (type, old, new), geometry as first seen, observations counted.

    Recomputed from the feed by default. Passing the previous table as ``existing`` adds to its counts,
    once more on every run.
    """
    found = used.filter(F.col("rename_kind") == "rename").groupBy(F.col("name").alias("type"), "old", "new").agg(
        F.sum("uses").alias("observations"), F.min_by(F.struct(*SIGNATURE), "first_use").alias("_g")).select(
        "type", "old", "new", *[F.col(f"_g.{name}").alias(name) for name in SIGNATURE], "observations")
    if existing is None:
        return found
    keys = ["type", "old", "new"]
    previous = existing.select(*keys, *[F.col(name).alias(f"p_{name}") for name in [*SIGNATURE, "observations"]])
    return found.join(previous, keys, "full_outer").select(
        *keys, *[F.coalesce(f"p_{name}", name).alias(name) for name in SIGNATURE],
        (F.coalesce("p_observations", F.lit(0)) + F.coalesce("observations", F.lit(0))).alias("observations"))


def filler_transitions(used: DataFrame) -> DataFrame:
    """Pairs that are not label changes, with their first geometry and count."""
    return used.filter(F.col("rename_kind") != "rename").groupBy(F.col("name").alias("type"), "old", "new", "rename_kind").agg(
        F.sum("uses").alias("observations"), F.min_by(F.struct(*SIGNATURE), "first_use").alias("_g")).select(
        "type", "old", "new", "rename_kind", *[F.col(f"_g.{name}").alias(name) for name in SIGNATURE], "observations")


def distinct_pairs(used: DataFrame) -> DataFrame:
    return used.select(F.col("name").alias("type"), "old", "new", "rename_kind").distinct()
