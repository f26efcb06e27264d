"""The change feed: sequences, transitions with a layout change, and what changed in them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlens.operators import diffing, renames, sequences
from driftlens.runtime import durable


#: How many names and renames a line of text shows.
SHOWN_NAMES, SHOWN_RENAMES = 6, 4


def no_members(spark: SparkSession, builds: DataFrame) -> DataFrame:
    """An empty members table for feeds of enums alone."""
    layout = builds.schema["layout"].dataType.simpleString()
    return spark.createDataFrame([], f"layout {layout}, type_name string, member string, off bigint, sz bigint, bit_position bigint, bit_count bigint, mtype string")


@dataclass
class Feed:
    """Lazy tables of one feed. Tables that several others read are written once below the shared folder."""

    builds: DataFrame
    members: DataFrame | None
    constants: DataFrame | None = None
    types: DataFrame | None = None
    missing: DataFrame | None = None

    @cached_property
    def adjacent(self) -> DataFrame:
        return sequences.adjacency(self.builds)

    @cached_property
    def sequences(self) -> DataFrame:
        return sequences.sequence_stats(self.adjacent, self.missing)

    @cached_property
    def changes(self) -> DataFrame:
        """One row per transition whose layout differs."""
        return sequences.changed(sequences.transitions(self.adjacent))

    @cached_property
    def manifest(self) -> DataFrame:
        if self.members is None and self.constants is None:
            raise ValueError("a feed needs members or constants")
        bodies = None if self.members is None else diffing.type_bodies(self.members, self.types)
        if self.constants is not None:
            enums = diffing.enum_bodies(self.constants)
            bodies = enums if bodies is None else bodies.unionByName(enums)
        return durable(diffing.numbered(durable(bodies, "bodies")), "manifest")

    @cached_property
    def names(self) -> DataFrame:
        """Changed definitions per distinct layout pair."""
        return durable(diffing.changed_names(sequences.layout_pairs(self.changes), self.manifest), "names")

    @cached_property
    def status(self) -> DataFrame:
        return diffing.status(self.names)

    @cached_property
    def resolved(self) -> DataFrame:
        return diffing.resolve_steps(self.names)

    @cached_property
    def steps(self) -> DataFrame:
        return durable(diffing.steps(self.resolved, self.manifest), "steps")

    def sides_of(self, attrs: list[str] | None = None, steps: DataFrame | None = None) -> diffing.Sides:
        """Both bodies of each step for one reader: only ``attrs`` move, and nothing is written."""
        steps = self.steps if steps is None else steps
        members = no_members(steps.sparkSession, self.builds) if self.members is None else self.members
        return diffing.member_sides(steps, members, attrs)

    def lists_of(self, attrs: list[str] | None = None, steps: DataFrame | None = None) -> DataFrame:
        """What differs between members within a step, as arrays, for one reader: only ``attrs`` move, and nothing is written."""
        return self.sides_of(attrs, steps).lists()

    @cached_property
    def member_lists(self) -> DataFrame:
        """What differs between members within a step, as arrays; without ``members`` there are none."""
        return durable(self.lists_of(), "members")

    @cached_property
    def member_changes(self) -> DataFrame:
        """Members that differ within a step."""
        return diffing.listed_rows(self.member_lists)

    @cached_property
    def constant_changes(self) -> DataFrame | None:
        if self.constants is None:
            return None
        return diffing.listed_rows(durable(diffing.constant_lists(self.steps, self.constants), "constants"))

    def _compared(self, attrs: list[str] | None = None) -> DataFrame | diffing.Sides:
        """The written lists, if there are any; else both sides with ``attrs``, compared by the one who reads them."""
        return self.member_lists if "member_lists" in vars(self) else self.sides_of(attrs)

    @cached_property
    def signature_groups(self) -> DataFrame:
        """Members that left and came on the same bytes, with the candidates of ambiguous ones, for several readers."""
        return durable(renames.signature_groups(self._compared(renames.SIGNATURE)), "signatures")

    @cached_property
    def signature_lists(self) -> DataFrame:
        """Members that left and came on the same bytes, as an array per step; of the members only their geometry is moved."""
        return self.signature_groups if "signature_groups" in vars(self) else renames.signature_lists(self._compared(renames.SIGNATURE))

    @cached_property
    def signatures(self) -> DataFrame:
        return diffing.listed_rows(self.signature_groups).drop("gone", "came")

    @cached_property
    def confirmed(self) -> DataFrame:
        return renames.confirmed(self.signatures)

    @cached_property
    def step_counts(self) -> DataFrame:
        """Lengths of the member lists per step, one narrow row each."""
        return self.step_heads if "step_heads" in vars(self) else durable(renames.step_counts(self._compared()), "counts")

    @cached_property
    def step_heads(self) -> DataFrame:
        """The lengths of the member lists per step, and the names that a line of text shows of them."""
        return durable(renames.step_heads(self._compared(), SHOWN_NAMES, SHOWN_RENAMES), "heads")

    @cached_property
    def items(self) -> DataFrame:
        rows = diffing.itemise(self.member_changes, self.confirmed)
        return rows if self.constants is None else rows.unionByName(diffing.itemise_constants(self.constant_changes))

    @cached_property
    def entries(self) -> DataFrame:
        """Changed definitions per layout pair, those on both sides."""
        return diffing.entries(self.resolved, self.step_counts, self.constant_changes)

    def per_pair(self, rows: DataFrame) -> DataFrame:
        """Fan rows keyed by step out to every layout pair that takes the step."""
        return self.resolved.select(*diffing.PAIR, *diffing.STEP, "kind", "name").join(rows, diffing.STEP)

    def per_pair_lists(self, lists: DataFrame, keep: Callable[[Callable[[str], Column]], Column] | None = None) -> DataFrame:
        """Entries of ``lists`` that ``keep`` holds for, for every layout pair that takes the step; they fan out as arrays."""
        keys = [*diffing.PAIR, "kind", "name"]
        return diffing.listed_rows(self.resolved.select(*keys, *diffing.STEP).join(diffing.kept(lists, keep), diffing.STEP), keys)

    @cached_property
    def questions(self) -> DataFrame:
        """Every ambiguous question once."""
        return renames.questions(self.signature_groups, self.steps)

    @cached_property
    def step_uses(self) -> DataFrame:
        """How many transitions take each step, and where first in feed order of sequences."""
        pairs = self.changes.groupBy(*diffing.PAIR).agg(
            F.count("*").alias("_n"), F.min(F.struct(*sequences.SEQUENCE, *sequences.ORDER)).alias("_first"))
        return (self.resolved.filter(F.col("kind") == "type").join(pairs, diffing.PAIR)
                .groupBy(*diffing.STEP, "name").agg(F.sum("_n").alias("uses"), F.min("_first").alias("first_use")))

    @cached_property
    def used_renames(self) -> DataFrame:
        lists = diffing.kept(self.signature_lists, renames.one_to_one)
        used = diffing.listed_rows(renames.occurrences(lists, self.step_uses), [*diffing.STEP, "name", "uses", "first_use"])
        return renames.confirmed(used, ["name", "uses", "first_use"])

    def summary(self) -> DataFrame:
        """Changed types and enums of every transition: the change rows of the feed with their totals."""
        one_sided = self.status.groupBy(*diffing.PAIR).agg(
            F.count_if(F.col("kind") == "type").alias("_ts"), F.count_if(F.col("kind") == "enum").alias("_es"))
        both = self.entries.groupBy(*diffing.PAIR).agg(
            F.count_if(F.col("kind") == "type").alias("_tb"), F.count_if(F.col("kind") == "enum").alias("_eb"),
            *[F.sum(f"n_{name}").alias(f"n_{name}") for name in diffing.LISTS])
        per_pair = one_sided.join(both, diffing.PAIR, "full_outer").fillna(0).select(
            *diffing.PAIR, (F.col("_ts") + F.col("_tb")).alias("types_changed"), (F.col("_es") + F.col("_eb")).alias("enums_changed"),
            *[f"n_{name}" for name in diffing.LISTS])
        counts = ["types_changed", "enums_changed", *[f"n_{name}" for name in diffing.LISTS]]
        return self.changes.join(per_pair, diffing.PAIR, "left").fillna(0, counts)
