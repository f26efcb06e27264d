"""Quality rules and record tables."""

import random
from collections import Counter

import pytest
from frames import rows
from test_diff import CONSTANT, MEMBER, m

from pyspark.sql import functions as F

from driftlens.operators import hierarchy, quality

TYPE = "layout string, type_name string, type_size bigint"


def summary(spark, members, size=64):
    return quality.type_summary(members, spark.createDataFrame([("A", "_T", size)], TYPE))


def test_overlap_needs_plain_members_and_no_shared_union(spark):
    schema = MEMBER + ", union_group int"
    members = spark.createDataFrame([(*m("A", "a", 0), 1), (*m("A", "b", 4), 1), (*m("A", "c", 4), 0), (*m("A", "zero", 4, 0), 0), (*m("A", "bit", 4, 4, (0, 1)), 0)], schema)
    found = quality.check_overlaps(members, summary(spark, members))
    assert rows(found, "message") == [("_T: a [0x0,0x8) overlaps c at 0x4 with no shared union",), ("_T: b [0x4,0xc) overlaps c at 0x4 with no shared union",)]
    assert quality.check_overlaps(members.withColumn("union_group", members.union_group * 0), summary(spark, members.drop("union_group"))).count() == 0


def test_overlaps_equal_brute_force_in_one_large_type(spark):
    rnd = random.Random(5)
    given = [(f"m{i}", rnd.randrange(0, 20000), rnd.choice([1, 4, 8, 64, 5000 if i % 50 == 0 else 2])) for i in range(600)]
    members = spark.createDataFrame([m("A", *x) for x in given], MEMBER)
    want = sorted((a[0], b[0]) for a in given for b in given if (a[1], a[0]) < (b[1], b[0]) and b[1] < a[1] + a[2])
    assert rows(quality.overlaps(members, summary(spark, members), need_groups=False), "earlier", "later") == want


def test_flexible_array_at_the_end_is_fine(spark):
    members = spark.createDataFrame([m("A", "n", 0), m("A", "Elements", 8, 0)], MEMBER)
    assert quality.check_members(members, summary(spark, members)).count() == 0
    early = spark.createDataFrame([m("A", "Elements", 0, 0), m("A", "n", 8)], MEMBER)
    assert rows(quality.check_members(early, summary(spark, early)), "rule") == [("zero_sized",)]


def test_constant_rules(spark):
    constants = spark.createDataFrame([("A", "E", "x", 1, 1), ("A", "E", "x", 2, 1), ("A", "E", "x", 2, 1), ("A", "E", "big", 256, 1), ("A", "E", "low", -128, 1), ("A", "W", "any", -5, 8)], CONSTANT)
    assert rows(quality.check_constant_values(constants), "message") == [("E.x: two values, 1 and 2",)]
    assert rows(quality.check_constant_width(constants), "message") == [("E.big = 256 does not fit 1 byte(s)",)]


FIELD = "list_id string, ord int, member string, off bigint, kind string, child_list string"


def test_flatten_nested_unions(spark):
    fields = spark.createDataFrame([
        ("r", 0, "head", 0, "leaf", None), ("r", 1, "", 8, "union", "u1"), ("r", 2, "Named", 16, "union", "u2"), ("r", 3, "__unnamed", 24, "union", "u3"),
        ("u1", 0, "a", 0, "leaf", None), ("u1", 1, "", 4, "class", "s1"), ("s1", 0, "b", 1, "leaf", None), ("s1", 1, "", 2, "union", "u2"), ("u2", 0, "c", 0, "leaf", None),
        ("u3", 0, "d", 0, "leaf", None)], FIELD)
    got = hierarchy.flatten(spark.createDataFrame([("R", "r")], "root string, list_id string"), fields)
    assert rows(got, "member", "off", "union_group") == [("Named", 16, 0), ("a", 8, 1), ("b", 13, 1), ("c", 14, 1), ("d", 24, 2), ("head", 0, 0)]


RECORD = ("idx bigint, kind_group string, name string, kind string, is_forward boolean, size bigint, underlying bigint, primitive string, indirection string, "
          "is_const boolean, is_volatile boolean")


def record(idx, kind, name="", size=None, underlying=None, primitive=None, indirection=None, const=False, volatile=False, forward=False):
    return (idx, "s", name, kind, forward, size, underlying, primitive, indirection, const, volatile)


def test_sizes_and_declared_types(spark):
    records = spark.createDataFrame([
        record(1, "primitive", primitive="ULong"), record(2, "pointer", size=8, underlying=1, volatile=True), record(3, "modifier", underlying=1, const=True, volatile=True),
        record(4, "function", underlying=1), record(5, "pointer", size=8, underlying=4), record(6, "array", size=40, underlying=3), record(7, "class", "_T", 0, forward=True),
        record(8, "class", "_T", 24), record(9, "array", size=48, underlying=7), record(10, "primitive", primitive="Void", indirection="Near64"),
        record(11, "pointer", size=8, underlying=99), record(12, "bitfield", underlying=3), record(13, "array", size=None, underlying=1), record(14, "class", "_ONLY", 0, forward=True)], RECORD)
    sizes = hierarchy.resolve_sizes(records)
    got = dict(rows(sizes, "idx", "bytes"))
    assert (got[3], got[7], got[9], got[10], got[12], got[14]) == (4, 24, 48, 8, 4, 0)
    declared = dict(rows(hierarchy.render_types(records, sizes), "idx", "declared"))
    assert declared == {1: "unsigned long", 2: "unsigned long * volatile", 3: "const volatile unsigned long", 4: "unsigned long ()", 5: "unsigned long (*)()",
                        6: "const volatile unsigned long[10]", 7: "_T", 8: "_T", 9: "_T[2]", 10: "void *", 11: "", 12: "const volatile unsigned long", 13: "unsigned long[]", 14: "_ONLY"}


def test_canonical_record_choice(spark):
    records = spark.createDataFrame([(1, "s", "a", True), (2, "s", "a", False), (3, "s", "a", False), (4, "s", "a", True), (5, "s", "b", True), (6, "s", "b", True)],
                                    "idx int, kind_group string, name string, is_forward boolean")
    assert rows(hierarchy.canonical_records(records), "name", "idx") == [("a", 3), ("b", 5)]


def test_mates_of_a_wide_union_never_meet(spark):
    members = spark.range(20_000).select(F.lit("A").alias("layout"), F.lit("_T").alias("type_name"), F.concat(F.lit("m"), "id").alias("member"), F.lit(0).cast("bigint").alias("off"),
                                         F.lit(8).alias("sz"), F.lit(0).alias("bit_position"), F.lit(0).alias("bit_count"), F.lit("").alias("mtype"), F.lit(1).alias("union_group"))
    apart = members.limit(1).withColumns({"member": F.lit("z"), "off": F.lit(4).cast("bigint"), "union_group": F.lit(0)})
    both = members.unionByName(apart)
    assert quality.overlaps(members, summary(spark, members)).count() == 0
    assert quality.overlaps(both, summary(spark, both)).count() == 20_000


def plain_overlaps(members):
    out = []
    for a in members:
        for b in members:
            key = lambda m: (m[2], m[1], m[3], m[6])
            if a[:1] == b[:1] and key(a) < key(b) and b[2] < a[2] + a[3] and a[4] == b[4] == 0 and a[3] > 0 and b[3] > 0 and (a[6] != b[6] or a[6] == 0):
                out.append((a[0], a[1], b[1]))
    return Counter(out)


UNIONS = "type_name string, member string, off bigint, sz bigint, bit_count int, mtype string, union_group int"


def swept(spark, members, **settings):
    df = spark.createDataFrame(members, UNIONS).withColumns({"layout": F.lit("L"), "bit_position": F.lit(0)})
    types = df.select("layout", "type_name").distinct().withColumn("type_size", F.lit(1 << 40))
    return quality.overlaps(df, quality.type_summary(df, types), **settings)


@pytest.mark.parametrize("spread", [4, 60, 2000])
def test_overlaps_equal_all_pairs(spark, spread):
    rnd = random.Random(spread)
    members = [(rnd.choice("TTTU"), f"m{i}", rnd.randrange(spread), rnd.choice([0, 1, 4, 8, 8, 40]), rnd.choice([0, 0, 0, 3]), "", rnd.choice([0, 0, 1, 2, 3])) for i in range(160)]
    got = Counter((r.type_name, r.earlier, r.later) for r in swept(spark, members).collect())
    assert got == plain_overlaps(members)


def test_many_unions_of_one_type_stay_linear(spark, monkeypatch):
    """20,000 unions side by side, each with two members of the same bytes; one of them reaches into the next."""
    seen = {}
    was = quality.durable
    monkeypatch.setattr(quality, "durable", lambda df, label: (lambda made: (seen.__setitem__(label, made.count()), made)[1])(was(df, label)))
    made = spark.range(40_000).select(F.lit("T").alias("type_name"), F.concat(F.lit("m"), "id").alias("member"), (F.floor(F.col("id") / 2) * 16).alias("off"),
                                      F.when(F.col("id") == 777, 20).otherwise(16).cast("bigint").alias("sz"), F.lit(0).alias("bit_count"), F.lit("").alias("mtype"), (F.floor(F.col("id") / 2) + 1).cast("int").alias("union_group"))
    df = made.withColumns({"layout": F.lit("L"), "bit_position": F.lit(0)})
    types = df.select("layout", "type_name").distinct().withColumn("type_size", F.lit(1 << 40))
    got = quality.overlaps(df, quality.type_summary(df, types)).collect()
    assert sorted((r.earlier, r.later) for r in got) == [("m777", "m778"), ("m777", "m779")]
    assert seen["conflicts"] == 2 and seen["touching"] == 2 and seen["sweep-edges"] < 100


def counting(monkeypatch, label):
    made = []
    was = hierarchy.durable
    monkeypatch.setattr(hierarchy, "durable", lambda df, name: (made.append(name) if name == label else None, was(df, name))[1])
    return made


RECORD = "idx long, kind_group string, name string, kind string, is_forward boolean, size long, underlying long, primitive string, indirection string, is_const boolean, is_volatile boolean"


def test_a_thousand_pointers_take_few_rounds(spark, monkeypatch):
    chain = [(i, "g", f"#{i}", "pointer" if i else "primitive", False, 8, i - 1 if i else None, "Void" if not i else None, None, False, False) for i in range(1001)]
    circle = [(5000 + i, "g", f"#{5000 + i}", "pointer", False, 8, 5000 + (i + 1) % 7, None, None, False, False) for i in range(7)]
    leads = [(6000, "g", "#6000", "modifier", False, 0, 5003, None, None, True, False), (6001, "g", "#6001", "pointer", False, 8, 99999, None, None, False, False)]
    records = spark.createDataFrame(chain + circle + leads, RECORD)
    rounds = counting(monkeypatch, "render")
    got = {r.idx: r.declared for r in hierarchy.render_types(records, hierarchy.resolve_sizes(records)).collect()}
    assert len(rounds) <= 13 and got[1000] == "void" + " *" * 1000 and got[3] == "void * * *"
    assert all(got[i] == "" for i in [*range(5000, 5007), 6000, 6001])


def test_long_and_circular_continuations_take_few_rounds(spark, monkeypatch):
    lists = spark.createDataFrame([(i, i + 1 if i < 499 else None) for i in range(500)] + [(1000 + i, 1000 + (i + 1) % 5) for i in range(5)], "list_id long, continuation long")
    constants = lists.select("list_id", F.concat(F.lit("C"), "list_id").alias("name"), F.col("list_id").alias("value"))
    enums = spark.createDataFrame([("long", 0), ("circle", 1002), ("end", 499), ("nowhere", 7777)], "enum_name string, list_id long")
    rounds = counting(monkeypatch, "continuation")
    got = Counter(r.enum_name for r in hierarchy.enum_constants(enums, lists, constants).collect())
    assert got == {"long": 500, "circle": 5, "end": 1} and len(rounds) <= 22


def test_overlaps_send_nothing_that_grows_through_the_driver(spark):
    """Tables of conflicting ranges compress so well that their files look small: they are merged, never broadcast."""
    members = spark.range(200).selectExpr("'A' as layout", "'_T' as type_name", "concat('M', id) as member", "id * 4 as off", "8L as sz",
                                          "0 as bit_position", "0 as bit_count", "'' as mtype", "id % 2 as union_group")
    found = quality.overlaps(members, summary(spark, members))
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
