"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has one bit per bit position of the shingles' hashes, set where more than half of them have it. Two
fingerprints that differ in at most three bits are found without comparing all: cut in two halves, one half differs in
at most one bit. So each distinct half is indexed once as it is and once with each of its bits taken out; equal
variants join. A variant with a bit taken out can be shared by two halves only, so this index has no hot key. The
fingerprints below a pair of halves are then compared by their number of differing bits.

Where a pair of halves has many fingerprints below it, the same is done again with the halves of the other half, down
to eight bits, so that very many near copies of one text never meet as all pairs. No candidate is dropped.

Defined results: a null or empty text, or one of separators only, has fingerprint zero and links like any other; fewer
words than a shingle make one shingle of what there is; a null id keeps its row and counts as larger than any other
when components are named; repeated rows share their component; other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.llm.components import components
from driftlens.runtime import durable

#: Shingles are voted in blocks of so many, so a very long text needs no more memory than a short one.
BLOCK = 1 << 15
#: Pairs of halves with more candidate pairs below them are cut again.
DENSE = 256


def shingle_hashes(text: str | None, words: int = 3, seed: int = 42) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles in order, in blocks; only A-Z are lower-cased, words end at ASCII white space."""
    parts = text.encode("utf-8").lower().split() if text else []
    if parts:
        k, digest = min(words, len(parts)), xxhash.xxh64_intdigest
        total = len(parts) - k + 1
        for at in range(0, total, BLOCK):
            block = parts[at:min(at + BLOCK, total) + k - 1]
            yield np.array([digest(b" ".join(s), seed) for s in zip(*(block[j:] for j in range(k)), strict=False)], np.uint64)


def voted(blocks: Iterable[np.ndarray]) -> int:
    """64-bit fingerprint of hashes: the bits that more than half of them have."""
    total, votes = 0, np.zeros(64, np.int64)
    for hashes in blocks:
        total += len(hashes)
        votes += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big", signed=True)


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit fingerprint of one text; a text without words has 0."""
    return voted(shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed 64 bits) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            made = [fingerprint(t, words, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def bits(value: Column, low: int, width: int) -> Column:
    """``width`` bits of a long from bit ``low`` on."""
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _halves(rows: DataFrame, spans: list[tuple[int, int]]) -> DataFrame:
    """A row for each half: ``seg`` its number, ``val`` its bits."""
    made = F.array(*[F.struct(F.lit(k).alias("seg"), bits(F.col("fp"), low, width).alias("val")) for k, (low, width) in enumerate(spans)])
    return rows.withColumn("_h", F.explode(made)).select("*", "_h.seg", "_h.val").drop("_h")


def _near_values(values: DataFrame, width: int) -> DataFrame:
    """``ctx, seg, va, vb``: values of one context and segment that are equal, or differ in one bit (then va < vb).

    The one-wildcard variants meet in an aggregate: with one bit taken out only two values are left to share a key.
    """
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = values.repartition(parts, "ctx", "seg", "val")  # few bytes become many rows next
    keys = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    mask = F.expr("shiftleft(1L, bit)")
    wild = values.select("ctx", "seg", "val", keys.alias("bit")).select("ctx", "seg", "bit", F.col("val").bitwiseAND(F.bitwise_not(mask)).alias("rest"))
    met = wild.groupBy("ctx", "seg", "bit", "rest").agg(F.count("*").alias("n")).where("n > 1")
    return met.select("ctx", "seg", F.col("rest").alias("va"), F.col("rest").bitwiseOR(mask).alias("vb")).union(values.select("ctx", "seg", F.col("val").alias("va"), F.col("val").alias("vb")))


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """``a, b`` (a < b): pairs of distinct fingerprints of ``fps(fp)`` that differ in at most ``distance`` bits.

    Two halves find pairs of up to three bits, so larger distances are refused.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves find pairs that differ in at most three bits")
    rows = durable(fps.select("fp").distinct(), "fingerprints").select(F.lit(0).cast("long").alias("ctx"), F.lit(0).alias("side"), "fp")
    found, width, low_of = None, 32, None
    while True:
        # the halves of the bits that are still free; after the first cut these depend on the context
        if low_of is None:
            spans = [(32, 32), (0, 32)]
            cut = durable(_halves(rows, spans), "halves")
        else:
            cut = durable(rows.withColumn("_h", F.explode(F.array(*[F.struct(F.lit(k).alias("seg"), F.expr(f"shiftrightunsigned(fp, cast(free + {k * width} as int)) & {(1 << width) - 1}L").alias("val"), F.expr(f"free + {(1 - k) * width}").alias("next")) for k in (0, 1)]))).select("ctx", "side", "fp", "_h.seg", "_h.val", "_h.next"), "halves")
        sizes = cut.groupBy("ctx", "side", "seg", "val").agg(F.count("*").alias("n"))
        sizes = durable(sizes, "halves")
        near = _near_values(sizes.select("ctx", "seg", "val").distinct(), width)
        # sides of a context hold what may be paired with each other; the first context pairs with itself
        left, right = (sizes.where("side = 0"), sizes.where("side = 0" if low_of is None else "side = 1"))
        both = near if low_of is None else near.union(near.where("va <> vb").select("ctx", "seg", F.col("vb").alias("va"), F.col("va").alias("vb")))
        pairs = both.join(left.select("ctx", "seg", F.col("val").alias("va"), F.col("n").alias("na")), ["ctx", "seg", "va"]).join(right.select("ctx", "seg", F.col("val").alias("vb"), F.col("n").alias("nb")), ["ctx", "seg", "vb"])
        if low_of is None:
            pairs = pairs.where("na > 1 or va <> vb")  # a fingerprint alone in the first context would meet itself only
        pairs = durable(pairs, "cells")
        dense = F.col("na") * F.col("nb") > DENSE if width > 8 else F.lit(False)
        lefts = cut.where("side = 0").select("ctx", "seg", F.col("val").alias("va"), F.col("fp").alias("a"))
        rights = (cut.where("side = 0") if low_of is None else cut.where("side = 1")).select("ctx", "seg", F.col("val").alias("vb"), F.col("fp").alias("b"))
        some = pairs.where(~dense).select("ctx", "seg", "va", "vb").join(lefts, ["ctx", "seg", "va"]).join(rights, ["ctx", "seg", "vb"])
        near_enough = F.bit_count(F.expr("a ^ b")).between(1, distance)
        some = some.where(near_enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        found = some if found is None else found.union(some)
        if width == 8:
            break
        cells = pairs.where(dense).select("ctx", "seg", "va", "vb", F.xxhash64("ctx", "seg", "va", "vb").alias("cell"))
        if cells.isEmpty():
            break
        free = F.when(F.col("seg") == 0, 0).otherwise(32) if low_of is None else F.col("next")
        cut = cut.withColumn("_free", free.cast("int"))
        side_a = cells.join(cut.where("side = 0").withColumnRenamed("val", "va"), ["ctx", "seg", "va"]).select(F.col("cell").alias("ctx"), F.lit(0).alias("side"), "fp", F.col("_free").alias("free"))
        other = cut.where("side = 0" if low_of is None else "side = 1")
        side_b = cells.join(other.withColumnRenamed("val", "vb"), ["ctx", "seg", "vb"]).select(F.col("cell").alias("ctx"), F.lit(1).alias("side"), "fp", F.col("_free").alias("free"))
        rows, low_of, width = side_a.union(side_b), True, width // 2
    return durable(found.distinct(), "fingerprint-links")


def roots(prints: DataFrame, distance: int = 3) -> DataFrame:
    """``fp, root`` of every distinct fingerprint of ``prints(fp)``: the smallest fingerprint that links lead to."""
    linked = components(links(prints, distance))
    return prints.select("fp").distinct().join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def groups(docs: DataFrame, words: int = 3, seed: int = 42, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, fingerprint, component_id`` of every row: 16 hex digits, and the smallest id that links lead to."""
    prints = durable(fingerprints(docs, words, seed, id_col, text_col), "simhash")
    heads = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = durable(heads.join(roots(prints, distance), "fp"), "simhash-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp"), "left").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
