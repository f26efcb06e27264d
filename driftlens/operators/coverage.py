"""What is known, held, missing and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.functions.version import filled

# The reason that is no absence, and the reasons that are our own faults.
COVERED_ELSEWHERE = "duplicate_key"
DEFECT_REASONS = ("pe_parse_failed", "parse_failed", "inconsistent", "oracle_mismatch")


def _channels(column: str = "channel") -> Column:
    """Channel list with ``unknown`` for none."""
    return F.explode(F.when(F.size(F.coalesce(column, F.array())) > 0, F.col(column)).otherwise(F.array(F.lit("unknown"))))


def reason_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("reason").agg(F.count("*").alias("entries"))


def defects(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("reason").isin(*DEFECT_REASONS))


def channel_totals(entries: DataFrame, column: str = "channel") -> DataFrame:
    """Entries per channel, whether or not they can be fetched."""
    return (entries.select(F.explode(column).alias("channel"))
            .groupBy("channel").agg(F.count("*").alias("known")))


def census(entries: DataFrame) -> DataFrame:
    """Listed and distinct entry hashes over all datasets, and how many are listed more than once."""
    per_hash = entries.groupBy("sha256").agg(F.count("*").alias("n"))
    return per_hash.agg(F.sum("n").alias("listed"), F.count("*").alias("distinct_entries"),
                        (F.sum("n") - F.count("*")).alias("listed_again"))


def dataset_census(entries: DataFrame, usable: Column) -> DataFrame:
    """Known and downloadable entries per dataset."""
    return entries.groupBy("dataset").agg(
        F.count("*").alias("known"), F.count_if(usable).alias("downloadable"))


def missing_by_channel(ledger: DataFrame) -> DataFrame:
    return (ledger.filter(F.col("reason") != COVERED_ELSEWHERE).select(_channels().alias("channel"))
            .groupBy("channel").agg(F.count("*").alias("missing")))


def by_channel(known: DataFrame, builds: DataFrame, ledger: DataFrame) -> DataFrame:
    """Known, resolved, missing and unattempted per channel. ``known`` is (channel, known) per dataset."""
    seeded = known.groupBy("channel").agg(F.sum("known").alias("known"))
    resolved = builds.select(_channels().alias("channel")).groupBy("channel").agg(F.count("*").alias("resolved"))
    return (seeded.join(resolved, "channel", "full_outer").join(missing_by_channel(ledger), "channel", "full_outer")
            .fillna(0, ["known", "resolved", "missing"])
            .withColumn("unattempted", F.greatest(F.col("known") - F.col("resolved") - F.col("missing"), F.lit(0).cast("bigint"))))


def by_machine(builds: DataFrame) -> DataFrame:
    return builds.groupBy("machine").agg(
        F.count("*").alias("builds"), F.count_if(filled(F.col("file_version")).isNull()).alias("no_version"))


def totals(known: DataFrame, builds: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row of totals. ``known`` holds one row with column ``known``: the distinct count where a census
    ran, otherwise the sum over datasets."""
    resolved = builds.agg(F.count("*").alias("resolved"),
                          F.count_if(filled(F.col("file_version")).isNull()).alias("no_version_metadata"))
    gaps = ledger.agg(F.count_if(F.col("reason") != COVERED_ELSEWHERE).alias("accounted_missing"),
                      F.count_if(F.col("reason") == COVERED_ELSEWHERE).alias("duplicate_entries"),
                      F.count_if(F.col("reason").isin(*DEFECT_REASONS)).alias("defects"))
    one = F.lit(1)
    joined = (known.withColumn("_k", one).join(resolved.withColumn("_k", one), "_k").join(gaps.withColumn("_k", one), "_k").drop("_k"))
    rest = F.col("known") - F.col("resolved") - F.col("accounted_missing") - F.col("duplicate_entries")
    return joined.withColumn("unattempted", F.greatest(rest, F.lit(0).cast("bigint")))


def known_entries(datasets: DataFrame, distinct: int | None = None) -> DataFrame:
    """The denominator: the recorded distinct count if there is one, else the sum of the dataset sizes."""
    summed = datasets.agg(F.coalesce(F.sum("known"), F.lit(0)).cast("bigint").alias("known"))
    return summed if not distinct else summed.select(F.lit(distinct).cast("bigint").alias("known"))
