"""What batches of rows are compared and grouped to equals what joins and aggregates over rows give."""

import random

from frames import rows
from pyspark.sql import functions as F
from test_diff import MEMBER, feed, m

from driftlens.functions import version
from driftlens.operators import diffing, renames, sequences

STEP = "step_a long, step_b long, kind string, name string, rep_from string, rep_to string"
GROUP = [*renames.SIGNATURE, "removed", "added", "old", "new", "gone", "came"]


def test_batches_equal_rows_on_odd_members(spark, monkeypatch):
    """Missing names, offsets and types, empty and one-sided bodies; every list of a step, either way."""
    draw = random.Random(4)
    pick = lambda *of: draw.choice(of)
    members = [m(layout, name, pick(0, 0, 0, -1, None), pick(8, 8, 8, 8, None), (pick(0, 0, 0, 0, None), 0), pick("", "void *", "int", None), t)
               for layout in "ABCD" for t in ("_T", "_S", "_E") if (layout, t) not in (("A", "_E"), ("D", "_S"))
               for name in draw.sample(["a", "b", "c", "d", "e", "é", "F", "", None, "Reserved1"], 7)]
    members.append(m("A", "alone", None, None, (None, None), None))  # nothing but a name
    members = spark.createDataFrame(members, MEMBER)
    steps = spark.createDataFrame([(i, j, "type", t, a, b) for i, a in enumerate("ABCD") for j, (b, t) in enumerate((b, t) for b in "BCD" for t in ("_T", "_S", "_E")) if a != b], STEP)
    told = {}
    for most in (1024, 0):
        monkeypatch.setattr(diffing, "SIDE_BY_SIDE", most)
        sides = diffing.member_sides(steps, members)
        lists = sides.lists()
        assert [r.whole for r in lists.select("whole").distinct().collect()] == [most > 0]
        key = ["step_a", "step_b"]
        of = lambda found, *names: rows(diffing.listed_rows(found), *key, *names)
        told[most] = [of(lists, "member", "off_from", "off_to", "mtype_from", "in_left", "in_right"),
                      *[[of(renames.signature_groups(x), *GROUP), of(renames.signature_lists(x), *GROUP[:-2]), of(renames.one_sided_lists(x), "member", "list"),
                         of(renames.ambiguous_lists(x), "member", *renames.SIGNATURE, "removed", "added", "side"),
                         [r for r in rows(renames.step_heads(x, 2, 1), *key, "_first_added", "_first_removed", "_first_renamed", "n_renamed") if any(r[2:])],
                         [r for r in rows(renames.step_counts(x), *key, "_added", "_removed", "_moved", "_resized", "_rebitted", "_retyped", "n_renamed") if any(r[2:])]]
                        for x in (sides, lists)]]
    assert told[1024] == told[0] and told[0][1] == told[0][2]
    assert all(map(len, told[0][1])) and any(r[2] == "alone" for r in told[0][0])


def test_a_reader_compares_at_once_and_without_lambdas(spark):
    """Lists are not built, sorted and grouped by lambdas, which are interpreted value by value; one pass over a batch does it all."""
    f = feed(spark, [("A1", 0), ("A2", 0), ("Old", 8)], [("B1", 0), ("New", 8)])
    for found in (f.signature_lists, renames.one_sided_lists(f.sides_of(renames.SIGNATURE))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "lambda" not in plan and "mtype" not in plan
    assert rows(f.questions, "type", "off", "gone", "came") == [("_T", 0, ["A1", "A2"], ["B1"])]
    assert rows(renames.question_rows(f.questions), "type", "off", "side", "member") == [("_T", 0, "added", "B1"), ("_T", 0, "removed", "A1"), ("_T", 0, "removed", "A2")]


def test_layouts_meet_as_arrays_and_large_ones_row_by_row(spark, monkeypatch):
    """Either way gives the same names, with any content id, and a pair carries a row per layout instead of a row per name."""
    draw = random.Random(7)
    pairs = spark.createDataFrame([(a, b) for a in "ABCDX" for b in "ABCD" if a != b] * 2, "layout_from string, layout_to string")
    manifest = spark.createDataFrame([(layout, kind, name, draw.choice([8, 16, None]), draw.choice("12")) for layout in "ABCD" for kind in ("type", "enum") for name in draw.sample("abcdef", 2 + 3 * (layout == "C"))],
                                     "layout string, kind string, name string, size long, blob string")
    columns = ["layout_from", "layout_to", "kind", "name", "size_from", "size_to", "in_left", "in_right"]
    held = {r.layout: {(k.kind, k.name): k for k in manifest.collect() if k.layout == r.layout} for r in manifest.collect()}
    want = [(r.layout_from, r.layout_to, *key, *[getattr(side.get(key), "size", None) for side in (was, now)], key in was, key in now)
            for r in pairs.distinct().collect() for was, now in [(held.get(r.layout_from, {}), held.get(r.layout_to, {}))] for key in was.keys() | now.keys()
            if getattr(was.get(key), "blob", None) != getattr(now.get(key), "blob", None)]
    for most in (8192, 5):
        monkeypatch.setattr(diffing, "NAMES_SIDE_BY_SIDE", most)
        for held_by in (manifest, diffing.numbered(manifest)):
            names = diffing.changed_names(pairs, held_by)
            assert rows(names, *columns) == sorted(want, key=str)
            plan = names._jdf.queryExecution().optimizedPlan().toString()
            assert "MapInArrow" in plan and ("Generate" in plan) == (most == 5)


def test_the_order_of_versions_is_one_short_text(spark):
    """It sorts as the key of four decimals does, and sequences are ordered by it."""
    texts = ["10.0.19041.1", "10.0.19041.10", "10.0.9.1", "9.0.1.1", "10", "", None, "1.x.3", "x", "007.0.1", "7.0.1", "1.2.3.4.5", "0.0.0.0", "9" * 50 + ".1", "9" * 38, "1" + "0" * 37, "1\n.2"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(version.version_key(F.col("v")).alias("k"), version.version_order(F.col("v")).alias("o")).collect()
    assert all((a.k < b.k) == (a.o < b.o) and (a.k == b.k) == (a.o == b.o) for a in df for b in df)
    placed = spark.createDataFrame([("c", "m", "10.0.1", None, "k")], "label string, machine string, file_version string, release_date string, symbol_key string")
    assert {sequences.ordered(placed).schema[name].dataType.simpleString() for name in sequences.ORDER} == {"string"}
