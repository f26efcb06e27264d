"""Fences of rates that are 0 in most documents, and of groups of any size."""

from pyspark.sql import functions as F

from driftlens.llm import quality

WORDS = "word another thing here and so on until there are enough of them to pass the rule of twenty words today"
SCHEMA = "doc_id long, text string, lang string, source string"


def lined(k, repeated):
    """Ten lines, ``repeated`` of which are copies of the first one, all too short to make repeated windows."""
    return "\n".join([f"{WORDS} {k}"] + ["same line"] * (repeated + 1) + [f"line {i} of {k}" for i in range(8 - repeated)])


def kept(spark, rows, **settings):
    return {r.doc_id for r in quality.judge(spark.createDataFrame(rows, SCHEMA), **settings).where("kept").collect()}


def test_rates_that_are_mostly_zero_adapt(spark):
    rows = [(i, lined(i, 0), "en", "a") for i in range(400)] + [(400, lined(400, 2), "en", "a")]  # 200 in a thousand
    rows += [(1000 + i, lined(i, 2 * (i % 10 == 0)), "de", "b") for i in range(400)]
    got = kept(spark, rows)
    assert 400 not in got and set(range(400)) <= got and set(range(1000, 1400)) <= got


def test_group_sizes_do_not_switch_fences(spark):
    highs = []
    for n in (199, 200):
        rows = [(i, lined(i, 0), "en", "a") for i in range(n)] + [(1000 + i, lined(i, 3), "en", "b") for i in range(900)]
        measured = quality.with_base(quality.measures(spark.createDataFrame(rows, SCHEMA)))
        highs.append(quality.fences(measured).where((F.col("source") == "a") & (F.col("rate") == "dup_lines")).first().high)
    assert 0 < highs[1] < highs[0] < 1.02 * highs[1]
