"""Chains of any length, cycles, checks that did not run, malformed input."""

import pytest
from frames import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from driftlens.operators import hierarchy, selection, verify
from driftlens.sources import index

RECORD = "idx long, kind_group string, name string, kind string, is_forward boolean, size long, underlying long, primitive string, indirection string, is_const boolean, is_volatile boolean"


def pointers(spark, n, last):
    chain = [(i, "g", f"#{i}", "pointer", False, 8, i + 1, None, None, False, False) for i in range(n)]
    return spark.createDataFrame([*chain, last], RECORD)


def test_a_long_pointer_chain_renders(spark):
    records = pointers(spark, 20, (20, "g", "_T", "class", False, 4, None, None, None, False, False))
    declared = {r.idx: r.declared for r in hierarchy.render_types(records, hierarchy.resolve_sizes(records)).collect()}
    assert declared[0] == "_T " + "*" * 20 or declared[0] == "_T" + " *" * 20
    assert len(declared) == 21


def test_a_cycle_of_types_ends_and_renders_as_nothing(spark):
    records = pointers(spark, 3, (3, "g", "#3", "modifier", False, None, 0, None, None, True, False))
    assert {r.declared for r in hierarchy.render_types(records, hierarchy.resolve_sizes(records)).collect()} == {""}


def test_sizes_on_a_cycle_are_nothing_and_end(spark):
    loop = [(i, "g", f"#{i}", "modifier", False, None, (i + 1) % 3, None, None, True, False) for i in range(3)]
    chain = [(10 + i, "g", f"#{10 + i}", "modifier", False, None, 11 + i, None, None, True, False) for i in range(100)]
    records = spark.createDataFrame([*loop, *chain, (110, "g", "_T", "class", False, 24, None, None, None, False, False)], RECORD)
    sizes = {r.idx: r.bytes for r in hierarchy.resolve_sizes(records).collect()}
    assert [sizes[i] for i in (0, 1, 2)] == [0, 0, 0] and {sizes[i] for i in range(10, 111)} == {24}


@pytest.mark.parametrize("last", [None, 3])
def test_an_enum_over_twelve_lists_keeps_all_constants(spark, last):
    lists = spark.createDataFrame([(i, i + 1 if i < 11 else last) for i in range(12)], "list_id long, continuation long")
    constants = spark.createDataFrame([(i, f"C{i}", i) for i in range(12)], "list_id long, name string, value long")
    enums = spark.createDataFrame([("E", 0)], "enum_name string, list_id long")
    assert hierarchy.enum_constants(enums, lists, constants).count() == 12


FIELD = "list_id string, ord int, member string, off long, kind string, child_list string"


def test_unions_inside_unions_count_as_the_outer_one_and_duplicates_once(spark):
    fields = spark.createDataFrame([("r", 1, "", 0, "union", "u"), ("r", 2, "z", 16, "leaf", None), ("r", 3, "z", 16, "leaf", None), ("r", 4, "", 24, "union", "w"),
                                    ("u", 1, "", 0, "union", "v"), ("u", 2, "b", 0, "leaf", None), ("v", 1, "a", 4, "leaf", None), ("w", 1, "c", 0, "leaf", None)], FIELD)
    roots = spark.createDataFrame([("r", "r")], "root string, list_id string")
    assert rows(hierarchy.flatten(roots, fields), "member", "off", "union_group") == [("a", 4, 1), ("b", 0, 1), ("c", 24, 2), ("z", 16, 0)]


def test_a_list_that_contains_itself_is_reported(spark):
    fields = spark.createDataFrame([("r", 1, "", 0, "class", "u"), ("u", 1, "", 0, "class", "r")], FIELD)
    with pytest.raises(PySparkException, match="contains itself"):
        hierarchy.flatten(spark.createDataFrame([("r", "r")], "root string, list_id string"), fields).count()


def test_one_label_gives_as_many_as_asked_for(spark):
    entries = spark.range(6000).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("symbol_key"), F.concat(F.lit("10.0.1."), F.col("id")).alias("file_version"),
                                       F.array(F.lit("a")).alias("channel"), F.lit("amd64").alias("machine"), F.lit("2026-01-01").alias("release_date"), F.array(F.lit("KB1")).alias("kb"))
    assert selection.stratified(entries, 5000).count() == 5000


def test_a_build_that_was_not_rederived_is_an_error(spark):
    hashes = spark.createDataFrame([("b1", "h1"), ("b2", "h2"), ("b3", "h3")], "symbol_key string, hash string")
    gate = verify.layout_gate(hashes, spark.createDataFrame([("b1", "h1"), ("b3", "other")], "symbol_key string, hash string"))
    verdicts, _ = verify.summary(hashes, gate, verify.gate_problems(gate))
    assert rows(verdicts, "symbol_key", "verdict") == [("b1", "PASS"), ("b2", "ERROR"), ("b3", "FAIL")]
    never, _ = verify.summary(spark.createDataFrame([("b4",)], "symbol_key string"), gate, verify.gate_problems(gate))
    assert rows(never, "verdict") == [("ERROR",)]


def test_a_broken_index_is_reported(spark):
    texts = spark.createDataFrame([('{"aa": {"fileInfo": {"timestamp": 1}}}',), ('{"bb": {"fileInfo": {"time',), (None,)], "value string")
    assert index.rejected_texts(texts).count() == 2
    with pytest.raises((PySparkException, Py4JJavaError)):
        index.parse_index(texts).collect()
