"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of neighbouring lines decides where chunks begin and end: a chunk may begin before a line if
the hash of that line and the next one says so, and ends after the first later line for which the hash of that line and the
one before says so. Both hashes lie inside the chunk, so what stands around a passage moves nothing in it: a copied
passage has the same chunks wherever it stands. Several seeds give chunks that overlap; a passage of two lines holds a chunk
of one of ``SEEDS`` seeds with probability 1 - (1 - p^2)^SEEDS (0.95), longer ones nearly always, and their first and last lines
likewise. Only lines that hold words count; blank lines between them belong to the chunk.

A chunk's key is the sequence of its lines' hashes. Chunks of at least two lines whose key occurs twice are candidates; of
each the occurrence in the smallest document (there the first one) stays and all others are removed; a line goes if one
chunk over it does. Before anything is removed the lines of all candidates are compared by their bytes: a hash that two
different lines share takes its chunks out.

Each text is chunked once; keys, document numbers and places are written. Keys are counted with partial aggregates, so a
chunk that a third of all documents share costs a row per task. Texts are shuffled once, to their ranges.

Defined results: a null text stays null with no lines; an empty text is one line without words; line ends are ``\\n``
alone, other bytes of a line count; a chunk that repeats within a document is removed there too; rows that repeat an id
and text get the same result; rows that share an id but not the text count as one document, each keeping its first
occurrence; ids are whole numbers (others fail the job), null ids come last and count as one id. Extra columns are kept by
``remove`` and ignored elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.runtime import durable

#: Lines with words that the rolling hash looks at; also the fewest lines of a chunk.
WINDOW = 2
#: Independent choices of boundaries, and the share of places that each takes (numerator, denominator).
SEEDS, SHARE = 5, (2, 3)
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Stands for a missing id: the largest one.
NO_ID = (1 << 63) - 1
_WORD = re.compile(r"[^ \t-\r]")


def line_hash(line: str) -> int:
    """Signed 64-bit hash of a line's bytes, as ``xxhash64`` gives it in SQL."""
    h = xxhash.xxh64_intdigest(line.encode("utf-8"), 42)
    return h - (1 << 64) if h >> 63 else h


def rolling(hashes: list[int], window: int = WINDOW) -> list[int]:
    """Hash of each run of ``window`` neighbouring values, each from the one before."""
    power, rolled, out = pow(_BASE, window, _MASK + 1), 0, []
    for i, h in enumerate(hashes):
        rolled = (rolled * _BASE + h) & _MASK
        if i >= window:
            rolled = (rolled - hashes[i - window] * power) & _MASK
        if i + 1 >= window:
            out.append(rolled)
    return out


def _marks(rolled: int, seeds: int, share: tuple[int, int]) -> tuple[int, int]:
    """For which seeds a run of lines may begin a chunk, and for which its end may end one; bit sets."""
    begins = ends = 0
    for seed in range(seeds):
        x = ((rolled ^ seed * 0xD6E8FEB86659FD93) * 0xBF58476D1CE4E5B9) & _MASK
        x ^= x >> 31
        begins |= ((x & 0xFFFFFF) % share[1] < share[0]) << seed
        ends |= ((x >> 24 & 0xFFFFFF) % share[1] < share[0]) << seed
    return begins, ends


def ranges(hashes: list[int], seeds: int = SEEDS, share: tuple[int, int] = SHARE, window: int = WINDOW) -> list[tuple[int, int]]:
    """First and last line of each chunk, as places in the sequence of lines with words; chunks overlap."""
    marks = [_marks(r, seeds, share) for r in rolling(hashes, window)]
    found = []
    for first, (begins, _) in enumerate(marks):
        # run k covers the lines k .. k + window - 1; a chunk of a seed ends with the first run whose end is marked
        at = first
        while begins and at < len(marks):
            if begins & marks[at][1]:
                found.append((first, at + window - 1))
                begins &= ~marks[at][1]
            at += 1
    return found


def chunked(text: str | None, **settings) -> list[tuple[int, int, list[int]]]:
    """First line, number of lines and key of each chunk that may be removed, by place."""
    if not text or "\n" not in text:
        return []
    lines = text.split("\n")
    full = [i for i, line in enumerate(lines) if _WORD.search(line)]
    if len(full) < WINDOW:
        return []
    hashes = [line_hash(line) for line in lines]
    out = []
    for first, last in ranges([hashes[i] & _MASK for i in full], **settings):
        a, b = full[first], full[last] + 1
        out.append((a, b - a, hashes[a:b]))
    return out


def _id(docs: DataFrame, id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def occurrences(docs: DataFrame, id_col: str, text_col: str, **settings) -> DataFrame:
    """``id, th, key, first, n, again`` of every chunk; ``again``: its key stands earlier in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            rows: list[list] = [[] for _ in range(6)]
            for key, text_hash, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                seen = set()
                for first, n, lines in chunked(text, **settings):
                    known = tuple(lines)
                    for column, value in zip(rows, (key, text_hash, lines, first, n, known in seen), strict=True):
                        column.append(value)
                    seen.add(known)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["id", "th", "key", "first", "n", "again"])

    rows = docs.select(_id(docs, id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, th long, key array<long>, first int, n int, again boolean")


def _numbers(places: str) -> Column:
    """The numbers of the lines in an array of (first, n), each once."""
    return F.array_distinct(F.flatten(F.transform(places, lambda r: F.sequence(r["first"], r["first"] + r["n"] - 1))))


def _shared_hashes(placed: DataFrame) -> DataFrame:
    """``h``: hashes that different lines of the candidates have, by their bytes."""
    lines = placed.where("_places is not null").select(F.split("text", "\n").alias("lines"), _numbers("_places").alias("at"))
    flat = lines.select(F.explode(F.transform("at", lambda i: F.get("lines", i))).alias("line"))
    return flat.select(F.xxhash64("line").alias("h"), "line").distinct().groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1").select("h")


def _placed(docs: DataFrame, id_col: str, text_col: str, **settings) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), ``text``, ``_places`` of all its candidates and ``_gone`` of those to be removed."""
    chunks = durable(occurrences(docs, id_col, text_col, **settings), "line-chunks")
    repeated = durable(chunks.groupBy("key").agg(F.count("*").alias("times"), F.min("id").alias("least")).where("times > 1").select(F.col("key").alias("_key"), "least"), "line-repeats")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), _id(docs, id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    while True:
        met = chunks.join(repeated, F.col("key") == F.col("_key"))
        place = F.struct("first", "n")
        by_text = met.groupBy(F.col("id").alias("_rid"), F.col("th").alias("_rth")).agg(F.collect_set(place).alias("_places"), F.collect_set(F.when(F.col("again") | (F.col("id") > F.col("least")), place)).alias("_gone"))
        placed = durable(keyed.join(by_text, (F.col("id") == F.col("_rid")) & (F.col("th") == F.col("_rth")), "left").select("row", "text", "_places", "_gone"), "line-places")
        shared = durable(_shared_hashes(placed), "line-collisions")
        if shared.isEmpty():
            return placed
        unsafe = repeated.select("_key", F.explode("_key").alias("h")).join(shared, "h").select("_key").distinct()
        repeated = durable(repeated.join(unsafe, "_key", "left_anti"), "line-repeats")


def _cut(docs: DataFrame, id_col: str, text_col: str, **settings) -> DataFrame:
    """``row`` (the columns of ``docs`` but the text), ``n_lines``, ``n_removed`` (lines) and ``kept`` (the text that is left)."""
    placed = _placed(docs, id_col, text_col, **settings)
    touched = F.size("_gone") > 0
    lost, lines = _numbers("_gone"), F.split("text", "\n")
    # the lines are split once and picked by number, as overlapping ranges may be as many as the lines
    kept = F.element_at(F.transform(F.array(lines), lambda all_: F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), lost), lambda i: F.get(all_, i))), 1)
    return placed.select(
        "row", F.when(F.col("text").isNotNull(), F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.when(touched, F.size(lost)).otherwise(0).cast("long").alias("n_removed"),
        F.when(touched, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("kept"))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with repeated chunks taken out of the text. A text of which no word is left loses its row."""
    cut = _cut(docs, id_col, text_col, **settings).where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^ \t\n\x0B\f\r]"))
    return cut.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` of every row (a null text keeps a null digest)."""
    cut = _cut(docs.select(id_col, text_col), id_col, text_col, **settings)
    return cut.select(F.col(f"row.`{id_col}`").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
