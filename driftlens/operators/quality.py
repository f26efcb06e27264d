"""Self-consistency and continuity rules. Every rule yields findings as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from driftlens.functions.text import hex_lower
from driftlens.operators.diffing import STEP
from driftlens.operators.ordering import renamed, same_group, sliced, with_next
from driftlens.runtime import durable

# Widths a bitfield or enum may be stored in, and how far a member may move beyond
# what the size change of its type explains.
STORAGE_SIZES = (1, 2, 4, 8)
CONTINUITY_LIMIT = 0x1000

TYPE = ["layout", "type_name"]
FINDING = ["layout", "severity", "rule", "entity", "message"]


def _finding(when: Column, severity: str, rule: str, message: Column) -> Column:
    return F.when(when, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), message.alias("message")))


def _emit(df: DataFrame, entity: Column, findings: list[Column]) -> DataFrame:
    return df.select("layout", entity.alias("entity"), F.explode(F.array_compact(F.array(*findings))).alias("_f")).select(
        "layout", "_f.severity", "_f.rule", "entity", "_f.message")


def type_summary(members: DataFrame, types: DataFrame) -> DataFrame:
    """Per declared type its size, member count, last offset and whether any member has a union group."""
    grouped = F.coalesce("union_group", F.lit(0)) if "union_group" in members.columns else F.lit(0)
    held = members.groupBy(*TYPE).agg(
        F.count("*").alias("n_members"), F.max("off").alias("last_off"), F.min("off").alias("first_off"),
        F.max(F.col("off") + F.col("sz")).alias("span_end"), F.max(grouped).alias("any_group"))
    return types.join(held, TYPE, "left").fillna(0, ["n_members"])


def check_types(summary: DataFrame) -> DataFrame:
    """Size zero; no members. Such a type is not examined further."""
    name = F.col("type_name")
    zero = F.col("type_size") == 0
    return _emit(summary, name, [
        _finding(zero, "error", "size_zero", F.concat(name, F.lit(": size is zero (unresolved forward reference?)"))),
        _finding(~zero & (F.col("n_members") == 0), "error", "no_members", F.concat(name, F.lit(": no members")))])


def check_members(members: DataFrame, summary: DataFrame) -> DataFrame:
    """Row rules over the members of sound types."""
    sound = summary.filter((F.col("type_size") != 0) & (F.col("n_members") > 0)).select(*TYPE, "type_size", "last_off")
    m = members.join(sound, TYPE)
    where = F.concat_ws(".", "type_name", "member")
    end, bit = F.col("off") + F.col("sz"), F.col("bit_count") != 0
    stored = F.col("sz").isin(*STORAGE_SIZES)
    return _emit(m, where, [
        _finding(end > F.col("type_size"), "error", "past_end", F.concat(
            where, F.lit(": ends at "), hex_lower(end), F.lit(", past the "), hex_lower(F.col("type_size")), F.lit(" byte struct"))),
        _finding((F.col("sz") == 0) & (F.col("off") != F.col("last_off")), "warning", "zero_sized",
                 F.concat(where, F.lit(": zero sized, not the last member"))),
        _finding(bit & ~stored, "error", "bit_storage", F.concat(
            where, F.lit(": bitfield in a "), F.col("sz").cast("string"), F.lit(" byte storage unit"))),
        _finding(bit & stored & (F.col("bit_position") + F.col("bit_count") > F.col("sz") * 8), "error", "bit_overflow", F.concat(
            where, F.lit(": bits "), F.col("bit_position").cast("string"), F.lit(":"), F.col("bit_count").cast("string"),
            F.lit(" overflow a "), F.col("sz").cast("string"), F.lit(" byte unit"))),
        _finding(~bit & (F.col("bit_position") != 0), "error", "bit_geometry", F.concat(where, F.lit(": bit geometry on a non-bitfield member")))])


def _conflicting(spans: DataFrame) -> DataFrame:
    """Of the byte ranges ``lo``..``hi`` of each type those that share a byte with another one.

    A sweep in order of their starts: a range meets an earlier one if it starts before the largest end so far, and a later
    one if it ends after the next start. Largest ends and starts are kept per slice of the order; only those of
    whole slices, a row each, are carried on.
    """
    order = ["lo", "hi", "_span"]

    def work(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({"_reached": F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), "_next": F.lead("lo").over(w)})

    rows = sliced(spans, TYPE, order, work, "sweep")
    in_order = Window.partitionBy(*TYPE).orderBy("_slice")
    edges = rows.groupBy(*TYPE, "_slice").agg(F.max("hi").alias("_hi"), F.min("lo").alias("_lo")).select(
        *TYPE, "_slice", F.max("_hi").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.lead("_lo").over(in_order).alias("_after"))
    edges = durable(renamed(edges.filter("_before is not null or _after is not null"), [*TYPE, "_slice"]), "sweep-edges")
    met = rows.join(edges, same_group([*TYPE, "_slice"]), "left")
    return met.filter((F.col("lo") < F.greatest("_reached", "_before")) | (F.col("hi") > F.coalesce("_next", "_after"))).select(*spans.columns)


def overlaps(members: DataFrame, summary: DataFrame, need_groups: bool = True) -> DataFrame:
    """Members that share bytes without sharing a union, each pair once, the earlier in member order first.

    A union is one byte range and so is every member outside a union. A sweep leaves the ranges that meet another
    one, which sound types do not have. These are put into cells, about as many as there are ranges, so that a range is
    compared with those that start in the cells it covers; members are compared for ranges that meet. Without
    any union group in a type the rule gives no verdict, unless ``need_groups`` is off.

    The tables that meet here grow with the input, and as files they are a hundredth of their size in memory, so
    that Spark would take them for small and send them through the driver: hence the merge hints.
    """
    examined = summary.filter((F.col("n_members") > 0) & ((F.col("any_group") != 0) | F.lit(not need_groups))).select(*TYPE)
    group = F.coalesce("union_group", F.lit(0)).cast("bigint") if "union_group" in members.columns else F.lit(0).cast("bigint")
    order = F.struct("off", "member", "sz", "bit_position", "bit_count", "mtype", "_group")
    plain = (members.filter((F.col("bit_count") == 0) & (F.col("sz") > 0)).join(examined, TYPE).withColumn("_group", group).withColumn("_order", order)
             .withColumn("_span", F.when(F.col("_group") != 0, F.col("_group").cast("string")).otherwise(F.to_json("_order"))))
    plain = durable(plain.select(*TYPE, "member", "off", "sz", "_span", "_order"), "plain")
    spans = durable(_conflicting(plain.groupBy(*TYPE, "_span").agg(F.min("off").alias("lo"), F.max(F.col("off") + F.col("sz")).alias("hi"))), "conflicts")
    width = F.greatest(F.lit(1).cast("bigint"), F.ceil((F.max("hi") - F.min("lo")) / F.count("*")))
    celled = spans.join(spans.groupBy(*TYPE).agg(width.alias("_width")).hint("merge"), TYPE)
    first, final = F.floor(F.col("lo") / F.col("_width")), F.floor((F.col("hi") - 1) / F.col("_width"))
    over = celled.select(*TYPE, F.explode(F.sequence(first, final)).alias("_cell"), F.col("_span").alias("_sa"), F.col("lo").alias("_la"), F.col("hi").alias("_ha"))
    begun = celled.select(*TYPE, first.alias("_cell"), F.col("_span").alias("_sb"), F.col("lo").alias("_lb"))
    earlier = (F.col("_la") < F.col("_lb")) | ((F.col("_la") == F.col("_lb")) & (F.col("_sa") < F.col("_sb")))
    touching = over.join(begun.hint("merge"), [*TYPE, "_cell"]).filter(earlier & (F.col("_lb") < F.col("_ha"))).select(*TYPE, "_sa", "_sb")
    touching = durable(touching.union(touching.select(*TYPE, F.col("_sb").alias("_sa"), F.col("_sa").alias("_sb"))), "touching")
    a = plain.select(*TYPE, F.col("_span").alias("_sa"), F.col("member").alias("earlier"), F.col("off").alias("a_off"), (F.col("off") + F.col("sz")).alias("a_end"), F.col("_order").alias("_a"))
    b = plain.select(*TYPE, F.col("_span").alias("_sb"), F.col("member").alias("later"), F.col("off").alias("b_off"), F.col("_order").alias("_b"))
    return (touching.join(a.hint("merge"), [*TYPE, "_sa"]).join(b.hint("merge"), [*TYPE, "_sb"])
            .filter((F.col("_a") < F.col("_b")) & (F.col("b_off") < F.col("a_end")))
            .select(*TYPE, "earlier", "later", "a_off", "a_end", "b_off"))


def check_overlaps(members: DataFrame, summary: DataFrame) -> DataFrame:
    message = F.concat(F.col("type_name"), F.lit(": "), F.col("earlier"), F.lit(" ["), hex_lower(F.col("a_off")), F.lit(","), hex_lower(F.col("a_end")),
                       F.lit(") overlaps "), F.col("later"), F.lit(" at "), hex_lower(F.col("b_off")), F.lit(" with no shared union"))
    sound = summary.filter(F.col("type_size") != 0)
    return overlaps(members, sound).select("layout", F.lit("error").alias("severity"), F.lit("overlap").alias("rule"),
                                           F.col("type_name").alias("entity"), message.alias("message"))


def check_enums(enums: DataFrame, constants: DataFrame) -> DataFrame:
    """Enum-level rules over (layout, enum_name, enum_size) and its constants."""
    held = constants.groupBy("layout", "enum_name").agg(F.count("*").alias("_n"))
    e = enums.join(held, ["layout", "enum_name"], "left").fillna(0, ["_n"])
    name = F.col("enum_name")
    return _emit(e, name, [
        _finding(F.col("_n") == 0, "warning", "enum_empty", F.concat(name, F.lit(": enumeration with no constants"))),
        _finding((F.col("_n") > 0) & ~F.col("enum_size").isin(*STORAGE_SIZES), "error", "enum_size",
                 F.concat(name, F.lit(": enum size "), F.col("enum_size").cast("string")))])


def check_constant_values(constants: DataFrame) -> DataFrame:
    """A constant name with several values: each repeat that differs from the value before it, in (value, name) order."""
    key = ["layout", "enum_name", "name"]
    repeated = constants.groupBy(*key).agg((F.min("value") != F.max("value")).alias("_several")).filter("_several").drop("_several")
    # read by the sampling of bounds and by the slicing
    values = durable(constants.join(repeated, key).select(*key, "value").distinct(), "repeated")
    linked = with_next(values, key, ["value"], ["value"])
    where = F.concat_ws(".", "enum_name", "name")
    message = F.concat(where, F.lit(": two values, "), F.col("value").cast("string"), F.lit(" and "), F.col("next.value").cast("string"))
    return _emit(linked.filter(F.col("next").isNotNull()), where, [_finding(F.lit(True), "error", "two_values", message)])


def check_constant_width(constants: DataFrame) -> DataFrame:
    """A value outside what its storage width can hold, signed or unsigned."""
    bits = (F.col("enum_size") * 8).cast("int")
    low = -F.expr("shiftleft(cast(1 as bigint), cast(enum_size * 8 - 1 as int))")
    high = F.expr("shiftleft(cast(1 as bigint), cast(enum_size * 8 as int))")
    where = F.concat_ws(".", "enum_name", "name")
    message = F.concat(where, F.lit(" = "), F.col("value").cast("string"), F.lit(" does not fit "), F.col("enum_size").cast("string"), F.lit(" byte(s)"))
    narrow = constants.filter((bits > 0) & (bits < 64))
    return _emit(narrow, where, [_finding((F.col("value") < low) | (F.col("value") >= high), "error", "constant_width", message)])


def self_consistency(members: DataFrame, types: DataFrame, constants: DataFrame | None = None, enums: DataFrame | None = None) -> DataFrame:
    """All rules over one set of readings."""
    summary = durable(type_summary(members, types), "summary")
    found = check_types(summary).unionByName(check_members(members, summary))
    if "union_group" in members.columns:
        found = found.unionByName(check_overlaps(members, summary))
    if constants is not None:
        enums = enums if enums is not None else constants.select("layout", "enum_name", "enum_size").distinct()
        found = (found.unionByName(check_enums(enums, constants)).unionByName(check_constant_values(constants))
                 .unionByName(check_constant_width(constants)))
    return found.select(*FINDING)


def continuity(resolved: DataFrame, member_changes: DataFrame) -> DataFrame:
    """Per layout pair and type: members that moved further than the size change explains.

    Works on the member rows the diff already holds, once per distinct body step, and fans out to pairs.
    """
    sizes = resolved.select(*STEP, F.abs(F.col("size_to") - F.col("size_from")).alias("grew")).distinct()
    far = (member_changes.filter(F.col("in_left") & F.col("in_right") & (F.col("off_from") != F.col("off_to"))).join(sizes, STEP)
           .withColumn("distance", F.abs(F.col("off_to") - F.col("off_from")))
           .filter(F.col("distance") > F.col("grew") + CONTINUITY_LIMIT))
    # Of equally far members the first in member order is named.
    rank = F.struct(-F.col("distance"), "off_to", "member", "sz_to", "bit_position_to", "bit_count_to", "mtype_to")
    found = far.groupBy(*STEP, "grew").agg(
        F.count("*").alias("moved"), F.min_by("member", rank).alias("worst_member"), F.max("distance").alias("worst"))
    return resolved.select("layout_from", "layout_to", *STEP, "name").join(found, STEP).select(
        "layout_from", "layout_to", F.col("name").alias("type_name"), "grew", "moved", "worst_member", "worst")


def continuity_message(findings: DataFrame) -> DataFrame:
    text = F.concat(F.col("type_name"), F.lit(": "), F.col("moved").cast("string"), F.lit(" member(s) moved further than the "), hex_lower(F.col("grew")),
                    F.lit(" byte size change explains, worst "), F.col("worst_member"), F.lit(" by "), hex_lower(F.col("worst")))
    return findings.withColumn("message", text)


def touched(transitions: DataFrame, loaded: DataFrame) -> DataFrame:
    """Transitions with a newly read build (column ``symbol_key``) on either side."""
    new = loaded.select("symbol_key").distinct()
    left = new.select(F.col("symbol_key").alias("from_key"), F.lit(True).alias("_a"))
    right = new.select(F.col("symbol_key").alias("to_key"), F.lit(True).alias("_b"))
    return (transitions.join(left, "from_key", "left").join(right, "to_key", "left")
            .filter(F.col("_a").isNotNull() | F.col("_b").isNotNull()).drop("_a", "_b"))


def group_findings(findings: DataFrame, n: int | None = None) -> DataFrame:
    """Equal messages counted, most common first."""
    grouped = findings.groupBy("severity", "message").agg(F.count("*").alias("times"))
    return grouped if n is None else grouped.orderBy(F.col("times").desc(), "message").limit(n)


def admit(builds: DataFrame, findings: DataFrame, mismatches: DataFrame | None = None, failed: DataFrame | None = None) -> DataFrame:
    """Ledger reason of every build that may not be stored; a null reason means it may.

    ``failed`` (symbol_key, reason) holds builds that never got a reading: ``pdb_404`` or ``parse_failed``. Then come
    layouts that fail a rule (``inconsistent``) or a reconciliation (``oracle_mismatch``).
    """
    bad = findings.filter(F.col("severity") == "error").select("layout").distinct().withColumn("_bad", F.lit(True))
    judged = builds.join(bad, "layout", "left")
    reason = F.when(F.col("_failed").isNotNull(), F.col("_failed")).when(F.col("_bad"), F.lit("inconsistent"))
    if failed is None:
        judged = judged.withColumn("_failed", F.lit(None).cast("string"))
    else:
        first = failed.groupBy("symbol_key").agg(F.max("reason").alias("_failed"))
        judged = judged.join(first, "symbol_key", "left")
    if mismatches is not None:
        apart = mismatches.filter(F.col("severity") == "fatal").select("layout").distinct().withColumn("_apart", F.lit(True))
        judged = judged.join(apart, "layout", "left")
        reason = reason.when(F.col("_apart"), F.lit("oracle_mismatch"))
    return judged.withColumn("reason", reason).drop("_bad", "_apart", "_failed")


