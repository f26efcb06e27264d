"""Near copies by exact Jaccard similarity of word shingles, with SimHash components and min-hash bands as candidates.

Texts of 0.8 similarity in 5-word shingles differ in up to about 14 of 64 SimHash bits, too many for an index of bit
variants whose size does not grow with the square of the table. So two texts are candidates if SimHash puts them into
one component or if they agree in one of ``BANDS`` bands of ``ROWS`` minimal hashes: a pair at 0.8 is missed with
probability (1 - 0.8^5)^30, about 7 in a million. Every link is verified on the whole shingle sets (64-bit hashes).

What is wanted are components, so a bucket of many near copies needs no pair of all:

1. *Heads.* Each bucket's head is its member that shares buckets with most others, which in a family of altered copies is the
   text nearest to all. Every member is compared with its head. Groups that then span several components are compared in
   pairs if they have few members; larger ones are put together where their heads are in one component, below the
   head that meets most, and compared with it.
2. *Edits.* What is left are members of a group in different components. Write E(x) for the shingles that x and the head do
   not share. Two texts are similar if and only if |E(x) - E(y)| + |E(y) - E(x)| is at most a fixed part of their sizes, and of
   two texts in different components at least one is not similar to the head. So E(x) and E(y) must have a known
   number s of edits in common, hence one among the |E| - s + 1 rarest of each, with enough edits after it. Members meet by
   such an edit only; edits that one member has alone cost nothing.

No candidate is dropped: each step keeps every pair that can still be a link between two components.

Defined results: as in ``simhash``, and texts without words are copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm import simhash
from driftlens.llm.batches import pieces_of
from driftlens.llm.components import components
from driftlens.runtime import durable

BANDS, ROWS = 30, 5
#: Shingles whose minimal hashes are taken at a time.
BLOCK = 1 << 12
#: Groups of so many members are compared in pairs, larger ones by their edits.
FEW = 16
_DRAW = np.random.default_rng(22)
_XOR = _DRAW.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64, endpoint=False)
_TIMES = _DRAW.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64, endpoint=False) | np.uint64(1)


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending; words as in ``simhash.fingerprint``."""
    return np.unique(np.concatenate([np.array([], np.uint64), *simhash.shingle_hashes(text, words)]))


def sketch(hashes: np.ndarray) -> list[int]:
    """A key for each band; sets that agree in the minimal hashes of a band share its key."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), BLOCK):
            np.minimum(least, ((hashes[at:at + BLOCK] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes(), k) - (1 << 63) for k, band in enumerate(least.reshape(BANDS, ROWS))]


def _sketched(docs: DataFrame, words: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, node, n, fp, keys`` of every row; ``node`` is a hash of the shingle set, ``n`` its size, ``fp`` its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            node, size, print_, keys = [], [], [], []
            for text in batch.column(2).to_pylist():
                blocks = list(simhash.shingle_hashes(text, words, seed))
                hashes = np.unique(np.concatenate([np.array([], np.uint64), *blocks]))
                node.append(xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63))
                size.append(len(hashes))
                print_.append(simhash.voted(blocks))
                keys.append(sketch(hashes))
            columns = [pa.array(node, pa.int64()), pa.array(size, pa.int32()), pa.array(print_, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "th", "node", "n", "fp", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, th long, node long, n int, fp long, keys array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``node, hashes`` of the rows ``wanted(doc_id, th, node)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            sets = [shingles(t, words).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    wanted = wanted.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "node")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    joined = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["_id"]) & (rows["th"] == wanted["_th"])).select("node", "text")
    return joined.mapInArrow(run, "node long, hashes array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, parts_of: tuple[int, int]) -> DataFrame:
    """The ``pairs(a, b, na, nb)`` whose similarity is at least ``parts_of[0] / parts_of[1]``."""
    up, down = parts_of
    near = pairs.where(down * F.least("na", "nb") >= up * F.greatest("na", "nb")).distinct()
    left, right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    both = near.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("x", "y")).alias("i"))
    return both.where(down * F.col("i") >= up * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return nodes.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _headed(groups: DataFrame) -> DataFrame:
    """``head, nh, node, n``: members of ``groups(key, node, n)`` below the head of their group, groups of one head together."""
    sizes = groups.groupBy("key").agg(F.count("*").alias("members"))
    known = groups.join(sizes.where("members > 1"), "key")
    shown = durable(known.join(known.groupBy("node").agg(F.sum("members").alias("met")), "node"), "near-groups")
    heads = shown.groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("h")).select("key", F.col("h.node").alias("head"), F.col("h.n").alias("nh"))
    return durable(shown.join(heads, "key").where("node <> head").select("head", "nh", "node", "n").distinct(), "near-heads")


def _ceil(over: Column, under: int) -> Column:
    """A quotient of whole numbers, rounded up."""
    return -F.floor(-over / F.lit(float(under))).cast("long")


def _by_edits(members: DataFrame, sets: DataFrame, parts_of: tuple[int, int]) -> DataFrame:
    """Pairs ``a, b, na, nb`` of members of one ``head`` in different components that may be similar, by an edit that they share.

    Of two similar ones the one nearer to the head has such an edit among its rarest few (``main``), and from the first one
    that they share on both have enough edits left.
    """
    up, down = parts_of
    both, less = down + up, down - up
    held = sets.select("node", "hashes")
    apart = members.select("head", "nh", "node", "n", "root").join(held, "node").join(held.select(F.col("node").alias("head"), F.col("hashes").alias("base")), "head").select(
        "head", "nh", "node", "n", "root", F.array_union(F.array_except("hashes", "base"), F.array_except("base", "hashes")).alias("edits"))
    apart = durable(apart, "near-edits")
    rows = apart.select("head", "nh", "node", "n", "root", F.size("edits").alias("e"), F.explode("edits").alias("edit"))
    rare = durable(rows.groupBy("head", "edit").agg(F.count("*").alias("times")), "near-rare")
    sorted_ = rows.join(rare, ["head", "edit"]).groupBy("head", "nh", "node", "n", "root", "e").agg(F.sort_array(F.collect_list(F.struct("times", "edit"))).alias("by_rarity"))
    # x and y are similar exactly if 2 * both * |E(x) and E(y)| >= a(x) + a(y); the head itself is the nearest possible partner
    a, top = both * F.col("e") - less * F.col("n"), less * F.col("nh")
    nearer = F.col("e") + 1 - F.greatest(F.lit(1), _ceil(F.greatest(2 * a, a + top + 1), 2 * both))  # the partner has the larger a
    farther = F.when(a > top, F.col("e") + 1 - F.greatest(F.lit(1), _ceil(a - top, 2 * both))).otherwise(0)  # the partner has the smaller a
    placed = sorted_.select("head", "node", "n", "root", "e", a.alias("apart"), nearer.alias("nearer"), farther.alias("farther"), F.posexplode("by_rarity").alias("at", "r"))
    kept = placed.where((F.col("at") < F.greatest("nearer", "farther")) & (F.col("r.times") > 1))
    split = durable(kept.select("head", F.col("r.edit").alias("edit"), "node", "n", "root", "apart", (F.col("e") - F.col("at")).alias("left"), (F.col("at") < F.col("nearer")).alias("main")), "near-split")
    side = lambda k: [F.col(name).alias(f"{name}_{k}") for name in ("node", "n", "root", "apart", "left", "main")]
    met = split.where("main").select("head", "edit", *side("x")).join(split.select("head", "edit", *side("y")), ["head", "edit"])
    met = met.where((F.col("root_x") != F.col("root_y")) & (~F.col("main_y") | (F.col("node_x") < F.col("node_y"))))
    met = met.where(2 * both * F.least("left_x", "left_y") >= F.col("apart_x") + F.col("apart_y"))
    return _ordered(met, "node_x", "n_x", "node_y", "n_y")


def _ordered(pairs: DataFrame, x: str, nx: str, y: str, ny: str) -> DataFrame:
    """``a, b, na, nb`` with a < b."""
    low = F.col(x) < F.col(y)
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.when(low, F.col(nx)).otherwise(F.col(ny)).alias("na"), F.when(low, F.col(ny)).otherwise(F.col(nx)).alias("nb"))


def _across(members: DataFrame) -> DataFrame:
    """Pairs of members of one ``head`` in different components."""
    one, two = (members.select("head", *[F.col(name).alias(f"{name}_{k}") for name in ("node", "n", "root")]) for k in "xy")
    met = one.join(two, "head").where((F.col("node_x") < F.col("node_y")) & (F.col("root_x") != F.col("root_y")))
    return _ordered(met, "node_x", "n_x", "node_y", "n_y")


def _compared(groups: DataFrame, nodes: DataFrame, links: DataFrame | None, sets: DataFrame, least: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links with those of members to their heads, components by them, and the members of groups that still span several."""
    headed = _headed(groups)
    found = durable(_verified(_ordered(headed, "node", "n", "head", "nh"), sets, least), "near-links")
    links = found if links is None else links.union(found)
    rooted = durable(_rooted(nodes, links), "near-rooted")
    members = headed.join(rooted, "node")
    sizes = members.groupBy("head").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")).where("low <> high")
    return links, rooted, durable(members.join(sizes.select("head", "members"), "head"), "near-open")


def linked(buckets: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """``a, b``: links that join all members of ``buckets(key, node, n)`` that are similar, directly or by others."""
    nodes = buckets.select("node").distinct()
    links, rooted, members = _compared(buckets, nodes, None, sets, least)
    links = links.union(durable(_verified(_across(members.where(F.col("members") <= FEW)), sets, least), "near-links"))
    many = members.where(F.col("members") > FEW)
    if many.isEmpty():
        return links
    # groups whose heads are in one component become one group, below the head that meets most
    homes = many.join(rooted.select(F.col("node").alias("head"), F.col("root").alias("key")), "head")
    merged = durable(homes.select("key", "node", "n").union(homes.select("key", F.col("head").alias("node"), F.col("nh").alias("n"))).distinct(), "near-merged")
    links, _, members = _compared(merged, nodes, links, sets, least)
    few = _across(members.where(F.col("members") <= FEW))
    return links.union(durable(_verified(few.union(_by_edits(members.where(F.col("members") > FEW), sets, least)), sets, least), "near-links"))


def groups(docs: DataFrame, words: int = 5, least: tuple[int, int] = (4, 5), seed: int = 42, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, th, component_id`` of every row: the hash of its text, and the smallest id that links lead to."""
    rows = durable(_sketched(docs, words, seed, id_col, text_col), "near-sketches")
    # rows of one shingle set are one node, shown by one of its rows
    shown = durable(rows.groupBy("node").agg(F.min(F.struct("doc_id", "th", "n", "keys")).alias("row"), F.min("doc_id").alias("least")), "near-nodes")
    alike = rows.select("node", "n", "fp").distinct().join(simhash.roots(rows.select("fp"), distance), "fp").select("node", "n", F.xxhash64(F.lit("simhash"), F.col("root")).alias("key"))
    keyed = durable(shown.select("node", "row.n", F.explode("row.keys").alias("key")).union(alike).distinct(), "near-keys")
    many = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    buckets = durable(keyed.join(many, "key").select("key", "node", "n"), "near-buckets")
    wanted = shown.join(buckets.select("node").distinct(), "node", "left_semi").select("row.doc_id", "row.th", "node")
    sets = durable(_sets(docs, wanted, words, id_col, text_col), "near-sets")
    rooted = durable(_rooted(shown.select("node", "least"), linked(buckets, sets, least)), "near-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    return rows.select("doc_id", "th", "node").join(named, "node").select("doc_id", "th", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the rows with its smallest id stay."""
    placed = groups(docs, id_col=id_col, text_col=text_col, **settings)
    gone = placed.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone"), F.col("th").alias("_gone_th")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]) & (F.xxhash64(docs[text_col]) == gone["_gone_th"]), "left_anti")
