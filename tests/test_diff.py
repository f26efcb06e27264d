"""Structural diff and rename inference on small layouts."""

from frames import rows
from pyspark.sql import functions as F
from test_ordering import BUILD, build

from driftlens.operators import diffing, renames
from driftlens.plans.feed import Feed
from driftlens.plans import publish

MEMBER = "layout string, type_name string, member string, off bigint, sz bigint, bit_position int, bit_count int, mtype string"
CONSTANT = "layout string, enum_name string, name string, value bigint, enum_size int"


def m(layout, member, off, sz=8, bits=(0, 0), mtype="", type_name="_T"):
    return (layout, type_name, member, off, sz, *bits, mtype)


def feed(spark, before, after, constants=None):
    builds = spark.createDataFrame([build("k1", "1.0.1.1", "2024-01-01", layout="A"), build("k2", "1.0.1.2", "2024-02-01", layout="B")], BUILD)
    members = spark.createDataFrame([m("A", *x) if not isinstance(x, dict) else m("A", **x) for x in before] + [m("B", *x) if not isinstance(x, dict) else m("B", **x) for x in after], MEMBER)
    return Feed(builds, members, spark.createDataFrame(constants, CONSTANT) if constants else None)


def test_lists(spark):
    f = feed(spark, [("Keep", 0), ("Moves", 8), ("Wider", 24, 4), ("Bits", 32, 4, (0, 1)), ("Typed", 40, 8, (0, 0), "void *"), ("Gone", 48)],
             [("Keep", 0), ("Moves", 16), ("Wider", 24, 8), ("Bits", 32, 4, (1, 2)), ("Typed", 40, 8, (0, 0), "_T *"), ("New", 56)])
    assert rows(f.items, "item", "list", "was", "now") == sorted([
        ("Moves", "moved", "8", "16"), ("Wider", "resized", "4", "8"), ("Bits", "rebitted", "0:1", "1:2"), ("Typed", "retyped", "void *", "_T *"),
        ("Gone", "removed", None, None), ("New", "added", None, None)], key=str)
    entry = f.entries.head()
    assert (entry.size_from, entry.size_to, entry.n_added, entry.n_removed, entry.n_moved) == (56, 64, 1, 1, 1)


def test_unresolved_type_is_no_retype(spark):
    f = feed(spark, [("X", 0, 8, (0, 0), "")], [("X", 0, 8, (0, 0), "void *")])
    assert f.items.count() == 0
    assert f.entries.count() == 0
    assert f.names.count() == 1


def test_confirmed_rename_leaves_both_lists(spark):
    f = feed(spark, [("MitigationFlags", 0), ("Keep", 8)], [("MitigationFlags2", 0), ("Keep", 8)])
    assert rows(f.confirmed, "old", "new", "rename_kind") == [("MitigationFlags", "MitigationFlags2", "rename")]
    assert rows(f.items, "item", "list") == [("MitigationFlags", "renamed")]
    assert rows(renames.alias_table(f.used_renames), "type", "old", "new", "observations") == [("_T", "MitigationFlags", "MitigationFlags2", 1)]
    again = renames.alias_table(f.used_renames, renames.alias_table(f.used_renames))
    assert rows(again, "observations") == [(2,)]


def test_two_by_two_is_ambiguous_and_stays_listed(spark):
    f = feed(spark, [("A1", 0), ("A2", 0)], [("B1", 0), ("B2", 0)])
    assert f.confirmed.count() == 0
    assert rows(renames.ambiguous_members(f.member_changes, f.signatures), "member", "side") == [("A1", "removed"), ("A2", "removed"), ("B1", "added"), ("B2", "added")]
    assert rows(f.items, "item", "list") == [("A1", "removed"), ("A2", "removed"), ("B1", "added"), ("B2", "added")]


def test_added_and_removed_types(spark):
    f = feed(spark, [dict(member="X", off=0, type_name="_OLD"), ("Keep", 0)], [dict(member="X", off=0, type_name="_NEW"), ("Keep", 0)])
    assert rows(f.status, "name", "status") == [("_NEW", "added"), ("_OLD", "removed")]
    assert f.summary().head().types_changed == 2


def test_enums_and_description(spark):
    constants = [("A", "E", "One", 1, 4), ("A", "E", "Two", 2, 4), ("B", "E", "One", 5, 4), ("B", "E", "Three", 3, 4)]
    f = feed(spark, [("X", 0)], [("X", 8)], constants)
    assert sorted(r.line for r in publish.definition_lines(f).collect()) == [
        "E: added: Three; removed: Two; renumbered: One 1->5", "_T: size 0x8 -> 0x10; moved: 1"]
    entry = publish.entries(f, "http://localhost", "now").head()
    assert entry.title == "c amd64 1.0.1.1 -&gt; 1.0.1.2: _T, E"
    assert entry.updated == "2024-02-01T00:00:00Z"


def test_written_feed(spark, tmp_path):
    f = feed(spark, [("X", 0)], [("X", 8)])
    publish.write_feed(f, str(tmp_path), "http://localhost", "2026-01-01T00:00:00Z")
    text = "\n".join(p.read_text() for p in (tmp_path / "changes.xml").glob("part-*"))
    assert text.startswith("<?xml") and text.rstrip().endswith("</feed>") and text.count("<entry>") == 1
    import xml.etree.ElementTree as tree
    tree.fromstring(text.encode())


def test_questions_stay_apart_and_count_once(spark):
    """{a,b}->{c} and {a}->{c,d} share names but are two questions; the same question of two steps is one."""
    changes = spark.createDataFrame(
        [(step, 0, name, left, not left, *[8 if left else None] * 2, *[None if left else 8] * 2) for step, names in
         ((1, [("a", True), ("b", True), ("c", False)]), (2, [("a", True), ("c", False), ("d", False)]), (3, [("a", True), ("b", True), ("c", False)]), (4, [("x", True), ("y", False)]))
         for name, left in names],
        "step_a long, step_b long, member string, in_left boolean, in_right boolean, off_from long, sz_from long, off_to long, sz_to long")
    changes = changes.withColumns({f"{name}{side}": F.when(F.col("in_left") == (side == "_from"), F.lit(0)) for name in ("bit_position", "bit_count") for side in ("_from", "_to")})
    steps = changes.select("step_a", "step_b", F.lit("_T").alias("name")).distinct()
    groups = renames.signatures(changes)
    table = renames.review_table(changes, groups, steps)
    by_question = {}
    for r in table.collect():
        by_question.setdefault(r.question, []).append((r.side, r.member))
    assert sorted(map(sorted, by_question.values())) == [[("added", "c"), ("added", "d"), ("removed", "a")], [("added", "c"), ("removed", "a"), ("removed", "b")]]
    assert renames.distinct_questions(changes, groups, steps).count() == 2


def test_pruning_is_one_aggregate_without_outer_join(spark):
    pairs = spark.createDataFrame([("A", "B"), ("A", "B"), ("B", "C")], "layout_from string, layout_to string")
    manifest = spark.createDataFrame([(layout, "type", name, 8, blob) for layout, name, blob in
                                      [("A", "same", "1"), ("B", "same", "1"), ("C", "same", "1"), ("A", "gone", "2"), ("B", "new", "3"), ("C", "new", "4")]],
                                     "layout string, kind string, name string, size long, blob string")
    names = diffing.changed_names(pairs, manifest)
    assert rows(names, "layout_from", "layout_to", "name", "in_left", "in_right") == [
        ("A", "B", "gone", True, False), ("A", "B", "new", False, True), ("B", "C", "new", True, True)]
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Outer" not in plan and plan.count("Aggregate") == 1


def test_bodies_meet_as_arrays_and_large_ones_row_by_row(spark, monkeypatch):
    """Either way gives the same changes, and only steps with a large body are compared row by row."""
    step = "step_a long, step_b long, kind string, name string, rep_from string, rep_to string"
    steps = spark.createDataFrame([(1, 1, "type", "_T", "A", "B"), (2, 2, "type", "_S", "A", "B"), (3, 3, "type", "_GONE", "A", "B"), (4, 4, "enum", "_T", "A", "B")], step)
    members = spark.createDataFrame(
        [m("A", "X", 0), m("B", "X", 8), m("A", "Y", 8), m("B", "Z", 8), m("A", "Same", 16), m("B", "Same", 16), m("A", "Twice", 24), m("A", "Twice", 32), m("B", "Twice", 32),
         m("A", "X", 0, type_name="_S"), m("B", "X", 0, 4, type_name="_S"), m("A", "Left", 0, type_name="_GONE"), m("A", "Not", 0, type_name="_U"), m("B", "Not", 8, type_name="_U")], MEMBER)
    columns = ["step_a", "member", "off_from", "off_to", "sz_from", "sz_to", "in_left", "in_right"]
    want = sorted([(1, "X", 0, 8, 8, 8, True, True), (1, "Y", 8, None, 8, None, True, False), (1, "Z", None, 8, None, 8, False, True),
                   (2, "X", 0, 0, 8, 4, True, True), (3, "Left", 0, None, 8, None, True, False)], key=str)
    seen, was = [], diffing._row_by_row
    monkeypatch.setattr(diffing, "_row_by_row", lambda wanted, *rest: (seen.append(rows(wanted, "name")), was(wanted, *rest))[1])
    assert rows(diffing.member_changes(steps, members), *columns) == want and not seen
    monkeypatch.setattr(diffing, "SIDE_BY_SIDE", 2)
    assert rows(diffing.member_changes(steps, members), *columns) == want and seen == [[("_T",)]]


def test_members_travel_to_steps_once_per_body(spark):
    """No shuffle carries a member row per step: the bodies meet as arrays, and the plan has no outer join on members."""
    f = feed(spark, [("X", 0), ("Y", 8)], [("X", 8), ("Z", 8)])
    plan = diffing.member_lists(f.steps, f.members)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Aggregate" not in plan


def test_pruning_moves_numbers_for_names_and_contents(spark):
    """The aggregate that every definition of every pair takes part in holds no text, and numbered contents give the same rows."""
    pairs = spark.createDataFrame([("A", "B"), ("B", "C")], "layout_from string, layout_to string")
    manifest = spark.createDataFrame([("A", "type", "same", 8, "1"), ("B", "type", "same", 8, "1"), ("C", "type", "same", 16, "5"), ("A", "type", "gone", 8, "2"), ("B", "enum", "new", 4, "3")],
                                     "layout string, kind string, name string, size long, blob string")
    columns = ["layout_from", "kind", "name", "size_from", "size_to", "in_left", "in_right"]
    names = diffing.changed_names(pairs, diffing.numbered(manifest))
    assert rows(names, *columns) == rows(diffing.changed_names(pairs, manifest), *columns) == sorted([
        ("A", "type", "gone", 8, None, True, False), ("A", "enum", "new", None, 4, False, True),
        ("B", "type", "same", 8, 16, True, True), ("B", "enum", "new", 4, None, True, False)], key=str)
    aggregate = [line for line in names._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert len(aggregate) == 1 and "name" not in aggregate[0].replace("_n#", "")


def test_only_asked_attributes_move_and_lists_are_read_inside_the_row(spark, monkeypatch):
    """Arrays grouped inside the row, and rows of bodies too large for it, give what an aggregate over change rows gives."""
    f = feed(spark, [("A1", 0), ("A2", 0), ("Old", 8), ("Moves", 16), ("Gone", 64), ("Typed", 40, 8, (0, 0), "void *")],
             [("B1", 0), ("New", 8), ("Moves", 24), ("Came", 72), ("Typed", 40, 8, (0, 0), "_T *")])
    groups = ["off", "removed", "added", "old", "new"]
    want = [(0, 2, 1, "A2", "B1"), (8, 1, 1, "Old", "New")]
    for most in (1024, 2):
        monkeypatch.setattr(diffing, "SIDE_BY_SIDE", most)
        moved = f.lists_of(["off"])
        assert {c.name for c in moved.schema["changes"].dataType.elementType} == {"member", "off_from", "off_to", "in_left", "in_right"}
        assert rows(diffing.listed_rows(diffing.kept(moved, diffing.is_moved)), "member", "off_from", "off_to") == [("Moves", 16, 24)]
        lists = f.lists_of()
        assert rows(diffing.listed_rows(renames.signature_lists(lists)), *groups) == rows(renames.signatures(diffing.listed_rows(lists)), *groups) == want
        assert rows(diffing.listed_rows(renames.ambiguous_lists(lists)), "member", "side") == [("A1", "removed"), ("A2", "removed"), ("B1", "added")]
        assert rows(renames.step_counts(lists), "_added", "_removed", "_moved", "_retyped", "n_renamed") == [(3, 4, 1, 1, 1)]
        plan = renames.signature_lists(lists)._jdf.queryExecution().optimizedPlan().toString()
        assert ("LocalRelation <empty>" in plan) == (most == 1024)  # without large bodies there is nothing to aggregate


def test_entries_compare_only_steps_they_tell(spark, tmp_path):
    """The entries of some pairs do not write what changed in all of them, and tables are written compressed."""
    f = feed(spark, [("X", 0), ("Old", 8)], [("X", 16), ("New", 8)])
    assert [r.content for r in publish.entries(f, "http://localhost", "now").collect()] == ["_T: size 0x10 -&gt; 0x18; moved: 1; renamed: Old -&gt; New"]
    assert "member_lists" not in vars(f)
    publish.write_feed(f, str(tmp_path), "http://localhost", "now")
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "items").glob("part-*"))
    assert rows(spark.read.json(f"{tmp_path}/items"), "item", "list") == [("Old", "renamed"), ("X", "moved")]


def test_steps_are_keyed_by_numbers_of_bodies(spark):
    """No hash travels with a step: its key is the numbers of its two bodies, also where two names have equal contents."""
    f = feed(spark, [("X", 0), dict(member="X", off=0, type_name="_S")], [("X", 8), dict(member="X", off=8, type_name="_S")])
    assert rows(f.resolved, "step_a", "step_b") == rows(f.resolved, "blob_from", "blob_to") == rows(f.steps, "step_a", "step_b")
    assert rows(f.steps, "kind", "name", "rep_from", "rep_to") == [("type", "_S", "A", "B"), ("type", "_T", "A", "B")]
    assert len({r.step_a for r in f.steps.collect()}) == 2
    assert "xxhash64" not in f.resolved._jdf.queryExecution().optimizedPlan().toString()
