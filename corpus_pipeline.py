"""A pipeline over ``documents``: toxic texts go, repeated line chunks go, of near copies one stays, sources are mixed, the rest is encoded.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from driftlens.llm import lines, mixing, nearcopies, pieces, toxicity
from driftlens.runtime import scope, scratch_path

#: SQL has no gradient steps, no rolling hashes and no piece encoder; the tests hold each stage against a plain version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the line chunks that an earlier document has; ``n_chars`` follows the text."""
    return lines.remove(docs).selectExpr(*[f"cast(length(text) as bigint) as {c}" if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose 5-word shingles have a Jaccard similarity of 0.8 or more."""
    return nearcopies.keep_first(docs, words=5, least=(4, 5), seed=42, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mix(docs, seed=42, weights=(3, 1, 2), share=(3, 2), most=2)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids, digests of ids and decoded text, for every copy of every document."""
    return pieces.digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("SentencePiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage writes for itself is deleted as soon as its result is written; the last one is read lazily."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        if k + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{k}")
        with scope(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
