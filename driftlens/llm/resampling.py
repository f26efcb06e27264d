"""Importance resampling towards a target distribution, by hashed n-grams from overlapped regex scanning.

A text's separators are collapsed to single spaces. One pattern then walks it with ``overlapped=True``: every match starts
at the space before a word, its nested groups span the runs of 1 to ``longest`` words from there, and a lookahead holds the
end to a word's end. The spans go to CRC-32, whose remainder is the feature's bucket. So each text is scanned once and
its buckets are written; counts of the corpus, weights and scores come from that table.

1. *Scan*: per document the buckets of all its features, as packed numbers, two bytes each. No shuffle.
2. *Count*: each task adds up its documents, so at most one row per bucket and task is shuffled, whatever is frequent.
3. *Weigh*: a bucket's gain compares its share in the target with its share in the corpus. The gains, one number per
   bucket, are a broadcast of fixed size. A document's weight is the sum over its features.
4. *Draw*: the weight plus seeded Gumbel noise is the score; the highest scores are found by a range-partitioned numbering
   of small rows, so neither a window nor the driver holds all documents.

Defined results: a null text, an empty one or one of separators only has no features and weight 0; repeated rows count
and are ranked each; rows that share an id share their noise; a missing id takes its noise from the empty string and comes
last among equal scores; extra columns are ignored. An empty corpus gives an empty result, an empty target is one
without features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.operators.ordering import positions
from driftlens.runtime import durable

LONGEST, BUCKETS = 3, 10_000
#: Only texts of so many words are drawn.
LEAST_WORDS = 20
#: What is not a word's byte becomes a space, A-Z become small; bytes of other characters belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


@cache
def runs(longest: int) -> regex.Pattern:
    """Pattern whose groups are the runs of ``longest`` words to one word that start at a place."""
    inside = rb"([^ ]++)"
    for _ in range(longest - 1):
        inside = rb"(" + inside + rb"(?: [^ ]++)?+)"
    return regex.compile(rb" " + inside + rb"(?![^ ])")


def buckets_of(text: str | None, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``longest`` words."""
    words = text.encode("utf-8").translate(_FOLD).split() if text else []
    n = len(words)
    if not n:
        return 0, np.array([], np.uint32)
    flat = b" " + b" ".join(words)
    del words
    groups = tuple(range(1, longest + 1))
    spans = (part for m in runs(longest).finditer(flat, overlapped=True) for part in m.group(*groups)) if longest > 1 else (m[1] for m in runs(1).finditer(flat, overlapped=True))
    found = np.fromiter(map(crc32, spans), np.uint32, n * longest).reshape(n, longest)
    # near the end the outer groups have no further word to take and repeat shorter runs
    whole = np.arange(n)[:, None] + np.arange(longest, 0, -1)[None, :] <= n
    return n, found[whole] % np.uint32(buckets)


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scanned(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, features`` of every row; ``features`` packs the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            made = [(n, len(f), f.astype(_kind(buckets)).tobytes()) for n, f in (buckets_of(t, longest, buckets) for t in batch.column(1).to_pylist())]
            kinds = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds))], names=["doc_id", "n_words", "n_features", "features"])

    key = F.lit(None).cast("long") if id_col is None else F.col(id_col)
    rows = texts.select(key.alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, features binary")


def counted(scans: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces_of(batches):
            for packed in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(packed, _kind(buckets)), minlength=buckets)
        (some,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    return scans.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and in the corpus."""
    s_all, t_all = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((corpus.get(b, 0) + 1.0) * t_all))) for b in range(buckets)], np.int64)


def _weighed(scans: DataFrame, learnt: np.ndarray) -> DataFrame:
    shared = scans.sparkSession.sparkContext.broadcast(learnt)  # a number per bucket
    kind = _kind(len(learnt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            weights = [int(shared.value[np.frombuffer(packed, kind)].sum()) for packed in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(weights, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return scans.mapInArrow(run, f"doc_id {scans.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def ranked(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), seed: int = 42, least_words: int = LEAST_WORDS, longest: int = LONGEST,
           buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; rank is null for what is not drawn.

    Of the documents of at least ``least_words`` words the given share is drawn, by score, then by smaller id.
    """
    scans = durable(scanned(docs, longest, buckets, id_col, text_col), "resampling-scans")
    held = {r["bucket"]: r["n"] for r in counted(scans, buckets).collect()}  # at most a row per bucket
    wanted = {r["bucket"]: r["n"] for r in counted(scanned(target, longest, buckets, None, target_col), buckets).collect()}
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = _weighed(scans, gains(held, wanted, buckets)).withColumn("score", F.col("weight") + noise).withColumn("_open", F.col("n_words") >= least_words)
    placed = positions(scored, [F.col("_open").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "_at", start=1)
    drawn = share[0] * scans.where(F.col("n_words") >= least_words).count() // share[1]
    return placed.select("doc_id", "n_features", "weight", "score", F.when(F.col("_open") & (F.col("_at") <= drawn), F.col("_at")).cast("long").alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns; rows that repeat a drawn id are drawn with it."""
    chosen = ranked(docs, target, id_col=id_col, **settings).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(chosen, docs[id_col].eqNullSafe(chosen["_drawn"]), "left_semi")
