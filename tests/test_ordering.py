"""Order-dependent operators against plain windows, with one group holding most rows."""

import random
from collections import Counter

import pytest
from frames import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftlens.operators import catalogue, ordering
from driftlens.operators import sequences as seq
from driftlens.operators.ordering import positions, positions_within, slice_number, with_next


def skewed(spark):
    """Group 0 holds two thirds of the rows."""
    return spark.range(3000).select(F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 50).alias("g"), F.xxhash64("id").alias("o"), "id")


def test_with_next_equals_lead(spark):
    df = skewed(spark)
    want = df.withColumn("n", F.lead("id").over(Window.partitionBy("g").orderBy("o")))
    got = with_next(df, ["g"], ["o"], ["id"]).withColumn("n", F.col("next.id"))
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_with_next_spans_slices(spark):
    """A single group is cut into several slices and still links up completely."""
    df = spark.range(5000).select(F.lit("one").alias("g"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = df.repartitionByRange("g", "o").select(F.spark_partition_id().alias("p")).distinct().count()
        got = with_next(df, ["g"], ["o"], ["o"])
        assert sliced > 1
        assert got.filter(F.col("next.o") == F.col("o") + 1).count() == 4999
        assert got.count() == 5000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_descending_and_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, o int").withColumn("back", -F.col("o"))
    got = with_next(df, ["g"], ["back"], ["o"])
    assert rows(got.select("o", F.col("next.o").alias("n")), "o", "n") == [(1, None), (2, 1), (3, None)]


def test_slices_keep_order_and_even_out(spark):
    """Numbers follow the order of the keys, missing values first, whatever their types; no slice holds much more than its share."""
    df = spark.range(6000).select(F.when(F.col("id") % 7 > 0, F.concat(F.lit("g'\""), (F.col("id") % 3).cast("string"))).alias("g"),
                                  F.array(F.col("id") % 11, F.lit(None).cast("bigint")).alias("v"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("o"), "id")
    got = df.withColumn("s", slice_number(df, ["g", "v", "o"], 50)).orderBy("g", "v", "o").collect()
    numbers = [r.s for r in got]
    assert numbers == sorted(numbers) and len(set(numbers)) > 30
    assert max(numbers.count(n) for n in set(numbers)) < 1000  # one seventh has no g, of that a fifth no o
    assert {r.s for r in df.limit(1).withColumn("s", slice_number(df.limit(0), ["g", "o"], 9)).collect()} == {0}


def test_neighbours_take_one_exchange_of_the_rows(spark, monkeypatch):
    plans = []
    was = ordering.durable
    monkeypatch.setattr(ordering, "durable", lambda df, label: (plans.append((label, df._jdf.queryExecution().executedPlan().toString())), was(df, label))[1])
    df = skewed(spark)
    linked = with_next(df, ["g"], ["o"], ["id"])
    (_, whole), (_, edges) = plans
    assert whole.count("Exchange") == 1 and "hashpartitioning(_slice" in whole and whole.count("Window") == 1
    assert "_nth" in edges and "hashpartitioning(g" in edges  # the first rows of slices only
    assert "Window" not in linked._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_layout_runs_equal_plain_version(spark, partitions):
    rnd = random.Random(partitions)
    made, layout = [], "0"
    for i in range(400):
        layout = layout if rnd.random() < 0.8 else rnd.choice([None, "A", "B", "C"])
        made.append(build(f"k{i:04d}", f"10.0.1.{i}", "", ["c"] if i % 9 else ["c", "d"], layout))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = Counter((r.label, r.layout, r.builds, r.first_version, r.last_version, r["at"]) for r in catalogue.layout_runs(spark.createDataFrame(made, BUILD)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want = Counter()
    for label in "cd":
        run = [b for b in made if label in b[4]]
        begin = 0
        for i, b in enumerate(run):
            if i + 1 == len(run) or run[i + 1][6] != b[6]:
                want[(label, b[6], i + 1 - begin, run[begin][1], b[1], i)] += 1
                begin = i + 1
    assert got == want


def test_positions(spark):
    df = skewed(spark)
    want = df.withColumn("pos", F.row_number().over(Window.orderBy(F.col("o").desc())) - 1)
    assert rows(positions(df, [F.col("o").desc()]), "id", "pos") == rows(want, "id", "pos")
    within = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert rows(positions_within(df, ["g"], ["o"]), "id", "pos") == rows(within, "id", "pos")


BUILD = "symbol_key string, file_version string, machine string, release_date string, channel array<string>, kb array<string>, layout string"


def build(key, version, date, channels=("c",), layout="L", machine="amd64"):
    return (key, version, machine, date, list(channels), ["KB1"], layout)


def test_mixed_channel_splits_and_drops_the_unplaceable(spark):
    builds = spark.createDataFrame([build("a", "10.0.19041.1", "", ["builds"]), build("b", "10.0.28000.1", "", ["builds"]), build("c", None, "2024", ["builds"]),
                                    build("d", None, "2024", [])], BUILD)
    assert rows(seq.place(builds), "symbol_key", "label") == [("a", "builds/19041"), ("b", "builds/28000"), ("d", "unknown")]


def test_undated_build_keeps_its_version_place(spark):
    builds = spark.createDataFrame([build("a", "10.0.26100.1", "2024-01-01"), build("b", "10.0.26100.9", None), build("c", "10.0.26100.5", "2024-02-01")], BUILD)
    pairs = seq.transitions(seq.adjacency(builds))
    assert rows(pairs, "from_key", "to_key") == [("a", "c"), ("c", "b")]


def test_date_leads_when_a_version_is_missing(spark):
    builds = spark.createDataFrame([build("a", "10.0.26100.9", "2024-01-01"), build("b", None, "2024-02-01"), build("c", "10.0.26100.5", "2024-03-01")], BUILD)
    assert rows(seq.transitions(seq.adjacency(builds)), "from_key", "to_key") == [("a", "b"), ("b", "c")]


def test_single_build_is_no_signal(spark):
    builds = spark.createDataFrame([build("a", "1.0.1.1", "x"), build("b", "1.0.1.1", "y", machine="x86"), build("c", "1.0.1.2", "z", machine="x86")], BUILD)
    stats = seq.sequence_stats(seq.adjacency(builds))
    assert rows(seq.verdict(stats), "machine", "verdict") == [("amd64", "nothing to compare"), ("x86", "0 changes")]
    counts = seq.verdict_counts(stats).head()
    assert (counts.quiet, counts.single) == (1, 1)


def test_positions_within_number_rows_once(spark):
    """The rows are numbered in the one write; afterwards only the counts of slices are summed up."""
    df = spark.range(100).selectExpr("id % 3 as g", "id as o")
    plan = positions_within(df, ["g"], ["o"])._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.strip(" :+-").startswith("Window ") for line in plan.splitlines()) == 1
