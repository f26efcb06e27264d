"""Ranked lexical search over a length-stratified index with integer impacts.

A document's length enters the score only through its normaliser m, a whole number. Documents of equal m are a stratum.
Within a stratum the score of a term depends on its frequency tf alone, so postings are grouped by tf and each impact is
computed once per (stratum, term, tf), not once per posting. The impact of a term's largest tf in a stratum bounds what any of its
documents can gain from it; the sum over a query's terms bounds the stratum, and strata are visited from the highest
bound down. A query leaves out a stratum whose bound is below its k-th best score so far; equal bounds are visited, as equal
scores are ranked by id.

1. Documents become (document, length, term, tf) rows in one scan, only for terms that some query holds; the join with the
   queries' terms is a broadcast where they are measured small. A row without a term carries each document's length.
2. Corpus totals, document frequencies and strata come from partial aggregates of that table.
3. A stratum of many postings is cut into blocks by the hash of the document, so neither a common length nor a frequent term
   meets in one task. Blocks are sorted by (term, tf); a task holds a few blocks at a time and visits them by their bounds.
4. Each task yields at most k documents a query; these few are ranked once more.

Queries are taken in blocks of at most ``PAIRS`` (query, term) pairs, each a broadcast of bounded size. No posting is
dropped and no list capped: what the bounds leave out can't be among the k best.

Defined results: a null or empty text has no terms and is never found; a query without known terms has no rows; repeated
documents are ranked each; queries that repeat id and text are one query, those that share an id only are ranked
apart below that id; ids are whole numbers, null ids come last among equal scores; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.operators.ordering import positions
from driftlens.runtime import durable

K = 50
#: Postings of a block (a document is never cut), held by a task at a time, and scores computed at a time.
BLOCK, HELD, CELLS = 200_000, 1_000_000, 4_000_000
#: Pairs of a query and a term that one pass takes.
PAIRS = 500_000
NO_ID = (1 << 63) - 1
#: What belongs to no term becomes a space, A-Z become small; bytes of other characters belong to terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, repeats included."""
    return text.encode("utf-8").translate(_FOLD).split() if text else []


def counted(texts: DataFrame, key: str, text_col: str) -> DataFrame:
    """``uid, id, n, term, tf``: a row without a term for every text, and one for each distinct term of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            lengths, sizes, terms, tfs = [], [], [], []
            for text in batch.column(2).to_pylist():
                found = Counter(terms_of(text))
                lengths.append(found.total())
                sizes.append(len(found) + 1)
                terms += [None, *found]
                tfs += [0, *found.values()]
            row = np.repeat(np.arange(batch.num_rows), sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(np.repeat(np.array(lengths, np.int64), sizes)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(tfs, pa.int64())], names=["uid", "id", "n", "term", "tf"])

    rows = texts.select(F.monotonically_increasing_id().alias("uid"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "uid long, id long, n long, term string, tf long")


def normaliser(n, documents: int, words: int):
    """m of a document of ``n`` terms in a corpus of so many documents and terms; a column or a number."""
    if isinstance(n, int):
        return 50 + 50 * n * documents // words
    return (F.lit(50) + F.expr(f"(50L * n * {documents}L) div {words}L")).cast("long")


def impact(tf, m):
    """What an occurrence count adds for a term of weight 1; numbers or arrays."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Postings of one block after the other: m, and arrays of term, tf, uid and id."""
    held: list[list[np.ndarray]] = []
    open_ = None
    for batch in batches:
        if not batch.num_rows:
            continue
        m, block, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        edges = [0, *(np.nonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1]))[0] + 1), len(m)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = int(m[a]), int(block[a])
            if held and key != open_:
                yield open_[0], [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            open_ = key
            held.append([c[a:b] for c in rest])
    if held:
        yield open_[0], [np.concatenate(c) for c in zip(*held, strict=True)]


def _expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + counts[i] - 1``, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Queries:
    """Queries of a pass: for each term its weight and the queries that hold it."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        """``pairs`` of (query, term, weight)."""
        table = np.array(sorted(set(pairs)), np.int64).reshape(-1, 3)
        self.names, query = np.unique(table[:, 0], return_inverse=True)
        self.terms, term = np.unique(table[:, 1], return_inverse=True)
        order = np.argsort(term, kind="stable")
        self.of_term = query[order]
        self.counts = np.bincount(term, minlength=len(self.terms))
        self.starts = np.cumsum(self.counts) - self.counts
        self.weights = np.zeros(len(self.terms), np.int64)
        self.weights[term] = table[:, 2]


class Block:
    """Postings of one block, sorted by term and tf, and their impacts."""

    def __init__(self, m: int, columns: list[np.ndarray], queries: Queries):
        term, tf, uid, ids = columns
        local = np.minimum(np.searchsorted(queries.terms, term), len(queries.terms) - 1)
        known = queries.terms[local] == term
        local, tf, uid, ids = local[known], tf[known], uid[known], ids[known]
        _, first, self.doc = np.unique(uid, return_index=True, return_inverse=True)
        self.ids, self.queries = ids[first], queries
        new = np.concatenate([[True], (local[1:] != local[:-1]) | (tf[1:] != tf[:-1])])[:len(local)]
        runs = np.nonzero(new)[0]  # one impact per term and tf
        gain = queries.weights[local[runs]] * impact(tf[runs], m)
        self.sizes = np.diff(np.append(runs, len(local)))
        self.local, self.gain = local, np.repeat(gain, self.sizes)
        held = local[runs]
        final = np.nonzero(np.concatenate([held[1:] != held[:-1], [True]])[:len(held)])[0]  # the largest tf of each term
        most = held[final]
        by_query = _expanded(queries.starts[most], queries.counts[most])
        self.bounds = np.bincount(queries.of_term[by_query], weights=np.repeat(gain[final], queries.counts[most]).astype(np.float64), minlength=len(queries.names)).astype(np.int64)

    def visit(self, best: Best) -> None:
        """Scores of all documents for the queries that this block may still improve."""
        q, documents = self.queries, len(self.ids)
        (alive,) = np.nonzero((self.bounds > 0) & (self.bounds >= best.least))
        step = max(1, CELLS // max(documents, 1))
        for at in range(0, len(alive), step):
            some = alive[at:at + step]
            place = np.full(len(q.names), -1)
            place[some] = np.arange(len(some))
            pairs = _expanded(q.starts[self.local], q.counts[self.local])
            row = place[q.of_term[pairs]]
            posting = np.repeat(np.arange(len(self.local)), q.counts[self.local])
            use = row >= 0
            cell = row[use] * documents + self.doc[posting[use]]
            # sums stay far below 2^53, so they are exact in doubles
            scores = np.bincount(cell, weights=self.gain[posting[use]].astype(np.float64), minlength=len(some) * documents).reshape(len(some), documents).astype(np.int64)
            floor = np.maximum(best.least[some], 1)
            if documents > best.k:
                floor = np.maximum(floor, np.partition(scores, documents - best.k, axis=1)[:, documents - best.k])
            which, doc = np.nonzero(scores >= floor[:, None])
            best.add(some[which], scores[which, doc], self.ids[doc])


class Best:
    """The k best documents of every query so far, by score and then id; ``least`` is what a further one must reach."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.zeros(queries, np.int64)
        self.query, self.score, self.id = (np.array([], np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = np.append(self.query, query), np.append(self.score, score), np.append(self.id, ids)
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, query, side="left")
        nth = np.arange(len(query)) - first
        keep = nth < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        full = nth == self.k - 1
        self.least[query[full]] = score[full]


def _evaluated(index: DataFrame, pairs: list[tuple[int, int, int]], k: int) -> DataFrame:
    """``query, score, id``: of each task the k best documents of every query."""
    shared = index.sparkSession.sparkContext.broadcast(pairs)  # at most PAIRS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(shared.value)
        best = Best(len(queries.names), k)
        held: list[Block] = []

        def visit_all():
            for block in sorted(held, key=lambda b: -int(b.bounds.sum())):
                block.visit(best)
            held.clear()

        for m, columns in _blocks(batches):
            held.append(Block(m, columns, queries))
            if sum(len(b.local) for b in held) >= HELD:
                visit_all()
        visit_all()
        yield pa.RecordBatch.from_arrays([pa.array(queries.names[best.query]), pa.array(best.score), pa.array(best.id)], names=["query", "score", "id"])

    return index.mapInArrow(run, "query long, score long, id long")


def stratified(hits: DataFrame, documents: int, words: int, block: int = BLOCK) -> DataFrame:
    """``m, block, term_id, tf, uid, id``: postings dealt by stratum and sorted; strata of many postings are cut."""
    placed = hits.where("term_id is not null").withColumn("m", normaliser(F.col("n"), documents, words))
    sizes = durable(placed.groupBy("m").agg(F.ceil(F.count("*") / block).alias("blocks")), "ranking-strata")
    dealt = placed.join(sizes, "m").select("m", F.pmod(F.xxhash64("uid"), "blocks").cast("int").alias("block"), "term_id", "tf", "uid", "id")
    return dealt.repartition("m", "block").sortWithinPartitions("m", "block", "term_id", "tf", "uid")


def search(docs: DataFrame, items: DataFrame, k: int = K, pairs: int = PAIRS, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents that score highest for each item, scores above 0 only."""
    asked = counted(items.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_text")).distinct(), "_item", "_text")
    asked = durable(asked.where("term is not null").select(F.col("uid").alias("query"), F.col("id").alias("item"), "term"), "ranking-items")
    vocabulary = durable(positions(asked.select("term").distinct(), ["term"], "term_id"), "ranking-vocabulary")
    rows = counted(docs, id_col, text_col).join(vocabulary.withColumnRenamed("term", "_term"), F.col("term") == F.col("_term"), "left").where("term is null or term_id is not null")
    hits = durable(rows.select("uid", "id", "n", "term_id", "tf"), "ranking-hits")
    documents, words = hits.where("term_id is null and n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = F.floor(1000 * F.ln((2 * F.lit(documents).cast("double") + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = hits.where("term_id is not null").groupBy("term_id").agg(F.count("*").alias("df")).select("term_id", weight.alias("w"))
    weighed = durable(asked.join(vocabulary, "term").join(weights, "term_id").select("query", "item", "term_id", "w"), "ranking-queries")
    passes = max(1, -(-weighed.count() // pairs))
    index = stratified(hits, documents, max(words, 1), block)
    found = None
    for part in range(passes):
        wanted = [(r["query"], r["term_id"], r["w"]) for r in weighed.where(F.pmod(F.xxhash64("query"), F.lit(passes)) == part).select("query", "term_id", "w").collect()]
        made = _evaluated(index, wanted, k) if wanted else None
        found = made if found is None else found if made is None else found.union(made)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query long, score long, id long")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id")))
    names = weighed.select(F.col("query").alias("_query"), "item").distinct()
    best = found.withColumn("rank", nth).where(F.col("rank") <= k).join(names, F.col("query") == F.col("_query"))
    return best.select(_known("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), _known("id").alias("doc_id"), "score")


def _known(column: str):
    return F.when(F.col(column) != NO_ID, F.col(column))
