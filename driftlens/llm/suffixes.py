"""Removal of repeated byte strings with a distributed, sparse suffix array.

A byte goes if a string of ``length`` bytes over it also starts earlier in the corpus. Sorting every suffix of a corpus
would move each byte many times, so suffixes are sparse: of the k-byte starts inside each string of ``length`` bytes the
one with the smallest hash is its anchor. Equal strings have the same anchor, so it is enough to compare suffixes that
start at anchors, each with the few bytes before it that its strings can reach (its context).

1. *Filter by hash.* Anchors meet by the hash of their first k bytes. An anchor alone in the corpus is done. If its whole
   context occurred before, all its strings did. Only the first of each distinct context that shares its beginning with
   another one goes on: in long repeated passages these are the anchors near their ends. Contexts that repeat inside one
   batch are settled on the map side, so a passage that a third of all documents share sends a few rows per batch.
2. *Suffix array.* The suffixes that are left are range-partitioned by their leading bytes with sampled splitters and
   sorted in each bucket by multikey quicksort. Suffixes that begin alike stand together; their strings are compared in
   the bucket, first by hash and then byte by byte, each with the earliest one at the same distance from its anchor.
3. *Boundaries.* Splitters part beginnings, so a run of suffixes that begin alike ends inside its bucket. Runs too long
   for a bucket are cut anywhere, and their strings are compared across the cuts by a shuffle on the strings' hashes,
   again combined on the map side.

Covered ranges are joined back to the texts, merged and cut. Steps 1 and 3 rely on 128 bits of hash, step 2 on bytes.

Defined results: a null text counts as empty; texts shorter than ``length`` bytes lose nothing; rows that repeat an id
and text are one document and get one result; rows that share an id with different texts are documents of their own, in
the order of their text's hash; null ids come last, as one id; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.runtime import durable

LENGTH, GRAM = 100, 24
#: Bytes that are hashed at a time; longer texts are taken in overlapping pieces.
CHUNK = 1 << 20
#: Anchors of one beginning that a batch sends to meet others; further ones go on at once.
HEADS = 4
#: Suffixes of a bucket whose strings are compared at a time, and wished for in a bucket.
SLAB, BUCKET = 20_000, 40_000
#: Suffixes with the same beginning that one bucket compares; beginnings that more of them share are split.
FREQUENT = 40_000
NO_ID = (1 << 63) - 1
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_BYTES2 = np.random.default_rng(21).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        with np.errstate(over="ignore"):
            for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(29))
        h *= _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(32)
        return h


class _Hashes:
    """Hashes of any ranges of a buffer, from running sums."""

    def __init__(self, data: np.ndarray, table: np.ndarray = _BYTES):
        up, self.down = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * up[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def grams(self, k: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k])


def anchors(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Places of anchors of the strings that start in the ranges ``first[i]:last[i]`` of a buffer, ascending."""
    span = length - gram + 1
    place = np.arange(len(data) - gram + 1, dtype=np.uint64)
    low = (_Hashes(data).grams(gram) & ~_U((1 << 24) - 1)) | place
    step = 1
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[:len(low) - (span - step)], low[span - step:])
    starts = np.concatenate([low[a:b] for a, b in zip(first, last, strict=True)]) & _U((1 << 24) - 1)
    return starts[np.concatenate([[True], starts[1:] != starts[:-1]])].astype(np.int64) if len(starts) else starts.astype(np.int64)


def _pieces(texts: list[bytes], length: int, gram: int):
    """Buffers of about ``CHUNK`` bytes: data, and per piece (text, begin in text, begin in buffer, bytes, first and last start)."""
    reach, buffer, parts, used = length - gram, [], [], 0
    for k, text in enumerate(texts):
        starts = len(text) - length + 1
        for s in range(0, max(starts, 0), CHUNK):
            e = min(s + CHUNK, starts)
            a, b = max(0, s - reach), min(len(text), e + length + reach)
            buffer.append(text[a:b])
            parts.append((k, a, used, b - a, used + s - a, used + e - a))
            used += b - a
            if used >= CHUNK:
                yield np.frombuffer(b"".join(buffer), np.uint8), np.array(parts, np.int64)
                buffer, parts, used = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(buffer), np.uint8), np.array(parts, np.int64)


def _found(texts: list[bytes], length: int, gram: int):
    """``text, place, core, context`` of all anchors; a text's anchors are ascending."""
    reach = length - gram
    for data, parts in _pieces(texts, length, gram):
        at = anchors(data, parts[:, 4], parts[:, 5], length, gram)
        of = np.searchsorted(parts[:, 2], at, side="right") - 1
        begin = np.maximum(at - reach, parts[of, 2])
        end = np.minimum(at + length, parts[of, 2] + parts[of, 3])
        one = _Hashes(data)
        context = one.of(begin, end) + ((at - begin).astype(np.uint64) << _U(8)) * _U(_BASE) + (end - at).astype(np.uint64)
        yield parts[of, 0], at - parts[of, 2] + parts[of, 1], one.of(at, at + gram), _mixed(context ^ _Hashes(data, _BYTES2).of(begin, end))


def _keyed(docs: DataFrame, id_col: str, text_col: str, *extra: Column) -> DataFrame:
    """``doc, th, text``: the id or the largest number, 31 bits of the text's hash, the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)).alias("th"), text.alias("text"), *extra)


def _as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


#: What becomes of an anchor: meets others, goes on to the suffix array, has all its strings elsewhere before.
MEET, SORT, COVERED = 0, 1, 2


def _sent(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """``core, context, doc, at, kind`` of the anchors of all texts; ``at`` is the text's hash and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            got = [np.concatenate(c) for c in zip(*_found(_as_bytes(batch.column(2)), length, gram), strict=True)] or [np.array([], np.int64)] * 4
            text, place, core, context = got
            core, context, doc, at = core.astype(np.int64), context.astype(np.int64), doc[text], (th[text] << 32) | place
            order = np.lexsort((at, doc, context, core))
            core, context, doc, at = core[order], context[order], doc[order], at[order]
            new_core = np.concatenate([[True], core[1:] != core[:-1]]) if len(core) else np.array([], bool)
            new = new_core | np.concatenate([[True], context[1:] != context[:-1]]) if len(core) else new_core
            same = np.zeros(len(core), bool)
            if len(core):
                head = np.maximum.accumulate(np.where(new, np.arange(len(core)), 0))
                same = ~new & (doc == doc[head]) & (at == at[head])  # a repeated row
                nth = np.cumsum(new) - np.cumsum(new)[np.maximum.accumulate(np.where(new_core, np.arange(len(core)), 0))]
                kind = np.where(~new, COVERED, np.where(nth < HEADS, MEET, SORT))
                settled = kind != MEET
                core = np.where(settled, context ^ at, core)  # nothing more to meet: anywhere
            else:
                kind = core
            use = ~same
            yield pa.RecordBatch.from_arrays([pa.array(c[use]) for c in (core, context, doc, at)] + [pa.array(kind[use].astype(np.int8))], names=["core", "context", "doc", "at", "kind"])

    return keyed.mapInArrow(run, "core long, context long, doc long, at long, kind byte")


def _settled(sent: DataFrame) -> DataFrame:
    """``doc, at, kind``: anchors that are covered or go on. Rows of a partition are sorted, so beginnings are runs."""

    def decide(table: pa.Table) -> pa.RecordBatch:
        core, context, doc, at, kind = (table.column(k).to_numpy() for k in ("core", "context", "doc", "at", "kind"))
        n = len(core)
        meet = kind == MEET
        new_core = np.concatenate([[True], core[1:] != core[:-1]])
        new = new_core | np.concatenate([[True], (context[1:] != context[:-1]) | (kind[1:] != kind[:-1])])
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        group = np.cumsum(new_core) - 1
        contexts = np.bincount(group, weights=new & meet)
        kind = np.where(~meet, kind, np.where(new, np.where(contexts[group] > 1, SORT, MEET), np.where((doc == doc[head]) & (at == at[head]), MEET, COVERED)))
        use = kind != MEET
        return pa.RecordBatch.from_arrays([pa.array(doc[use]), pa.array(at[use]), pa.array(kind[use].astype(np.int8))], names=["doc", "at", "kind"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            core = batch.column(0).to_numpy()
            cut = int(np.nonzero(core != core[-1])[0][-1]) + 1 if core[0] != core[-1] else 0
            if held and not cut and held[-1].column(0)[-1].as_py() == core[-1]:
                held.append(batch)
                continue
            held.append(batch.slice(0, cut))
            yield decide(pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks()) if any(b.num_rows for b in held) else pa.RecordBatch.from_pylist([], schema=out)
            held = [batch.slice(cut)]
        if any(b.num_rows for b in held):
            yield decide(pa.Table.from_batches([b for b in held if b.num_rows]).combine_chunks())

    out = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("kind", pa.int8())])
    return sent.repartition("core").sortWithinPartitions("core", "kind", "context", "doc", "at").mapInArrow(run, "doc long, at long, kind byte")


def _contexts(keyed: DataFrame, going: DataFrame, length: int, gram: int) -> DataFrame:
    """``suffix, before, doc, at``: the bytes from each anchor on and those before it."""
    places = going.groupBy(F.col("doc").alias("d"), F.expr("at >> 32").alias("t")).agg(F.collect_set(F.expr("at & 4294967295")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = length - gram
        for batch in batches:
            suffix, before, docs, ats = [], [], [], []
            for doc, th, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _as_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                for p in places:
                    suffix.append(text[p:p + length])
                    before.append(text[max(0, p - reach):p])
                    docs.append(doc)
                    ats.append(th << 32 | p)
            yield pa.RecordBatch.from_arrays([pa.array(suffix, pa.binary()), pa.array(before, pa.binary()), pa.array(docs, pa.int64()), pa.array(ats, pa.int64())], names=["suffix", "before", "doc", "at"])

    joined = keyed.join(places, (F.col("doc") == F.col("d")) & (F.col("th") == F.col("t"))).select("doc", "th", "text", "places")
    return joined.mapInArrow(run, "suffix binary, before binary, doc long, at long")


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte rows by multikey quicksort, eight bytes to a character.

    Rows are parted by their first character; only parts whose rows agree in it are sorted by the next one.
    """
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, :rows.shape[1]] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.arange(len(rows))
    parts = [(0, len(rows), 0)]
    while parts:
        a, b, k = parts.pop()
        own = order[a:b]
        key = words[own, k]
        by = np.argsort(key, kind="quicksort")
        order[a:b], key = own[by], key[by]
        if k + 1 < words.shape[1]:
            edges = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1, [b - a]])
            sizes = np.diff(edges)
            parts += [(a + int(e), a + int(e + s), k + 1) for e, s in zip(edges[:-1][sizes > 1], sizes[sizes > 1], strict=True)]
    return order


def _matrix(suffix: list[bytes], before: list[bytes], length: int, reach: int) -> np.ndarray:
    """Contexts as rows with the anchor at column ``reach``; bytes that a text does not have are 0."""
    return np.frombuffer(b"".join([p.rjust(reach, b"\0") + s.ljust(length, b"\0") for p, s in zip(before, suffix, strict=True)]), np.uint8).reshape(len(suffix), reach + length)


def _strings(rows: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, reach: int, table: np.ndarray):
    """Hashes of the strings that start ``0..reach`` bytes before each anchor, and which of them the text has."""
    up, down = _powers(rows.shape[1] + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
        np.cumsum(table[rows] * up[:-1], axis=1, out=sums[:, 1:])
        begin = reach - np.arange(reach + 1)
        hashes = _mixed((sums[:, begin + length] - sums[:, begin]) * down[begin])
    back = np.arange(reach + 1)
    return hashes, (back[None, :] <= left[:, None]) & (length - back[None, :] <= right[:, None])


def _compared(rows, left, right, doc, at, length: int, reach: int):
    """Ranges (doc, th, begin, end) of contexts whose strings an earlier context of the slab has, verified by bytes."""
    order = np.lexsort((at, doc))
    rows, left, right, doc, at = rows[order], left[order], right[order], doc[order], at[order]
    hashes, there = _strings(rows, left, right, length, reach, _BYTES)
    who, back = np.nonzero(there)
    with np.errstate(over="ignore"):  # equal strings meet where they stand alike to their anchors: only those are aligned
        h = hashes[who, back] ^ _mixed(back.astype(np.uint64) * _U(_BASE))
    by = np.argsort(h, kind="stable")  # equal strings follow each other, the earliest first
    h, who = h[by], who[by]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.array([], bool)
    head = who[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))] if len(h) else who
    n = len(rows)
    pairs = np.unique(who[~new] * n + head[~new])
    q, p = pairs // n, pairs % n
    other = (doc[q] != doc[p]) | (at[q] != at[p])
    q, p = q[other], p[other]
    out = []
    for a in range(0, len(q), 1 << 16):
        x, y = q[a:a + (1 << 16)], p[a:a + (1 << 16)]
        differ = rows[x] != rows[y]
        col = np.arange(reach + length)
        differ |= (col < reach - np.minimum(left[x], left[y])[:, None]) | (col >= reach + np.minimum(right[x], right[y])[:, None])
        r = np.where(differ[:, reach:].any(axis=1), differ[:, reach:].argmax(axis=1), length)
        back = differ[:, :reach][:, ::-1]
        lefts = np.where(back.any(axis=1), back.argmax(axis=1), reach)
        use = lefts + r >= length
        place = at[x] & 0xFFFFFFFF
        out.append(np.stack([doc[x], at[x] >> 32, place - lefts, place + r], axis=1)[use])
    return np.concatenate(out) if out else np.empty((0, 4), np.int64)


def _bucketed(contexts: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """``doc, th, begin, end`` of covered ranges. Equal beginnings share a bucket: the splitters part beginnings only."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        suffix, before = table.column("suffix").to_pylist(), table.column("before").to_pylist()
        doc, at = table.column("doc").to_numpy(), table.column("at").to_numpy()
        rows = _matrix(suffix, before, length, reach)
        left, right = np.array([len(b) for b in before]), np.array([len(s) for s in suffix])
        order = multikey_order(rows[:, reach:])
        lead = rows[order][:, reach:reach + gram]
        edges = np.concatenate([[0], np.nonzero((lead[1:] != lead[:-1]).any(axis=1))[0] + 1, [len(order)]])
        begin = 0
        while begin < len(edges) - 1:
            end = max(begin + 1, int(np.searchsorted(edges, edges[begin] + SLAB, side="right")) - 1)
            use = order[edges[begin]:edges[end]]
            got = _compared(rows[use], left[use], right[use], doc[use], at[use], length, reach)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, k]) for k in range(4)], names=["doc", "th", "begin", "end"])
            begin = end

    dealt = contexts.select("lead", "suffix", "before", "doc", "at").repartitionByRange(parts, "lead")
    return dealt.mapInArrow(run, "doc long, th long, begin long, end long")


def _across(hot: DataFrame, length: int, gram: int) -> DataFrame:
    """Covered ranges of contexts whose beginning is too frequent for a bucket, by a shuffle on their strings."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLAB):
                part = batch.slice(a, SLAB)
                suffix, before = part.column(0).to_pylist(), part.column(1).to_pylist()
                doc, at = part.column(2).to_numpy(), part.column(3).to_numpy()
                rows, left, right = _matrix(suffix, before, length, reach), np.array([len(b) for b in before]), np.array([len(s) for s in suffix])
                one, there = _strings(rows, left, right, length, reach, _BYTES)
                two, _ = _strings(rows, left, right, length, reach, _BYTES2)
                who, back = np.nonzero(there)
                w1, w2, d, s = one[who, back].astype(np.int64), two[who, back].astype(np.int64), doc[who], at[who] - back
                by = np.lexsort((s, d, w2, w1))
                w1, w2, d, s = w1[by], w2[by], d[by], s[by]
                new = np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])])
                head = np.maximum.accumulate(np.where(new, np.arange(len(w1)), 0))
                later = ~new & ((d != d[head]) | (s != s[head]))  # an earlier one is in this very batch
                ld, ls = d[later], s[later]
                by = np.lexsort((ls, ld))
                ld, ls = ld[by], ls[by]
                run_ = np.concatenate([[True], (ld[1:] != ld[:-1]) | (ls[1:] > ls[:-1] + length)])[:len(ld)]
                first = np.nonzero(run_)[0]
                last = np.concatenate([first[1:], [len(ld)]])[:len(first)] - 1
                none = pa.nulls(len(first), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c[new]) for c in (w1, w2, d, s, s + length))], names=names)
                yield pa.RecordBatch.from_arrays([none, none, pa.array(ld[first]), pa.array(ls[first]), pa.array(ls[last] + length)], names=names)

    names = ["w1", "w2", "doc", "at", "upto"]
    strings = durable(hot.select("suffix", "before", "doc", "at").mapInArrow(run, "w1 long, w2 long, doc long, at long, upto long"), "suffix-strings")
    heads = strings.where("w1 is not null")
    first = heads.groupBy("w1", "w2").agg(F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").select(F.col("w1").alias("f1"), F.col("w2").alias("f2"), "first")
    others = heads.join(first, (F.col("w1") == F.col("f1")) & (F.col("w2") == F.col("f2"))).where(F.struct("doc", "at") != F.col("first"))
    found = strings.where("w1 is null").select("doc", "at", "upto").union(others.select("doc", "at", "upto"))
    return found.select("doc", F.expr("at >> 32").alias("th"), F.expr("at & 4294967295").alias("begin"), F.expr("upto & 4294967295").alias("end"))


def covered(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, th, begin, end``: byte ranges made of strings that start earlier too; they may overlap and repeat."""
    keyed = _keyed(docs, id_col, text_col)
    marks = durable(_settled(_sent(keyed, length, gram)), "suffix-marks")
    contexts = durable(_contexts(keyed, marks.where(f"kind = {SORT}").select("doc", "at"), length, gram), "suffix-contexts")
    leads = contexts.withColumn("lead", F.expr(f"substring(suffix, 1, {gram})"))
    frequent = durable(leads.groupBy("lead").agg(F.count("*").alias("n")).where(F.col("n") > most), "suffix-frequent").select(F.col("lead").alias("often"))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-contexts.count() // BUCKET))
    rare, hot = leads.join(frequent, F.col("lead") == F.col("often"), "left_anti"), leads.join(frequent, F.col("lead") == F.col("often"), "left_semi")
    whole = marks.where(f"kind = {COVERED}").select("doc", F.expr("at >> 32").alias("th"), F.expr(f"greatest((at & 4294967295) - {length - gram}, 0)").alias("begin"), F.expr(f"(at & 4294967295) + {length}").alias("end"))
    return whole.union(durable(_bucketed(rare, parts, length, gram), "suffix-ranges")).union(_across(hot, length, gram))


def merged(ranges: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        b = min(b, n)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, ranges in zip(_as_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                spans = merged([(r["a"], r["b"]) for r in ranges or []], len(text))
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                made.append((len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    ranges = covered(docs, length, gram, most, id_col, text_col).groupBy(F.col("doc").alias("d"), F.col("th").alias("t")).agg(F.collect_set(F.struct(F.col("begin").alias("a"), F.col("end").alias("b"))).alias("ranges"))
    rows = _keyed(docs, id_col, text_col, F.col(id_col).alias("doc_id"))
    joined = rows.join(ranges, (F.col("doc") == F.col("d")) & (F.col("th") == F.col("t")), "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
