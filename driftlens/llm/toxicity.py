"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is a bag of sentences. Each sentence has a logistic score over its words and their beginnings; a document is
toxic if at least one sentence is (noisy-or of the sentence scores). Weights are trained on document labels through the
noisy-or, so the sentences that carry the label are found without sentence labels, and ``offending`` names them.

Training reads a bounded sample of the labelled rows: of each class the documents with the smallest hashes of their ids,
at most ``sample`` of them, and whole texts of at most ``sample_bytes`` together, so the driver's share is bounded however
long texts are and the same on every run. Scoring reads every whole text.

Defined results: a null or empty text has no sentence and gets the score of an empty bag, 0; labels that are null or
other than 0 and 1 are not learnt from; a document with several labels counts as toxic if one of them says so; without
positive or negative examples every score is 0; repeated rows each get their own row; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.runtime import durable

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
#: Labelled documents of each class that are trained on at most.
SAMPLE = 2000
#: Bytes of the texts of each class that are trained on at most (the first text is taken whatever its length).
SAMPLE_BYTES = 24 << 20
#: Lengths of word beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6)
#: Words whose weight a task remembers.
ROOM = 200_000
#: A feature must occur in so many documents of the sample.
LEAST_DOCS = 3
ROUNDS = 200
START = -11.0
#: Step, and the mean slope below which a weight stays 0 (weights that only fit noise).
RATE, SPARSE = 1.0, 1e-3


def features(word: str) -> list[str]:
    """Names of a word's features: the word itself, and its beginnings with a mark."""
    return [word, *(f"{word[:k]}*" for k in BEGINNINGS if len(word) > k)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Begin and end of every sentence that has a word."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m[0])]


def train(texts: list[str], labels: list[int]) -> tuple[float, dict[str, float]]:
    """Bias and weights that are not 0, by gradient steps on the likelihood of document labels under the noisy-or."""
    if len(set(labels)) < 2:
        return -math.inf, {}
    number: dict[str, int] = {}
    docs_with: list[int] = []
    bag_of, sent_of, feat_of, n_sent = [], [], [], 0
    for d, text in enumerate(texts):
        in_doc: set[int] = set()
        for a, b in sentences(text):
            here: set[int] = set()
            for w in set(WORD.findall(text[a:b].lower())):
                for f in features(w):
                    k = number.setdefault(f, len(number))
                    if k == len(docs_with):
                        docs_with.append(0)
                    here.add(k)
            in_doc |= here
            bag_of.append(d)
            feat_of.extend(here)
            sent_of.extend([n_sent] * len(here))
            n_sent += 1
        for k in in_doc:
            docs_with[k] += 1
    keep = np.array(docs_with) >= LEAST_DOCS
    dense = np.cumsum(keep) - 1
    feat, sent = np.array(feat_of, np.int64), np.array(sent_of, np.int64)
    use = keep[feat]
    feat, sent, bag, y = dense[feat[use]], sent[use], np.array(bag_of, np.int64), np.array(labels, float)
    n_feat = int(keep.sum())
    w, bias = np.zeros(n_feat), START
    drift, spread = np.zeros(n_feat), np.zeros(n_feat)
    mb, vb = 0.0, 0.0
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(sent, weights=w[feat], minlength=n_sent)
        none = -np.bincount(bag, weights=np.logaddexp(0, z), minlength=len(y))  # log of: no sentence is toxic
        some = np.maximum(-np.expm1(none), 1e-12)
        slope = np.where(y > 0, -np.exp(none) / some, 1.0) * weight
        gz = slope[bag] / (1 + np.exp(-z))
        g = np.bincount(feat, weights=gz[sent], minlength=n_feat)
        drift += g
        spread += g * g
        w = -np.sign(drift) * np.maximum(np.abs(drift) - step * SPARSE, 0) * RATE / (np.sqrt(spread) + 1e-9)  # 0 where the mean slope is small
        gb = gz.sum()
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        bias -= 0.05 * (mb / (1 - 0.9**step)) / (math.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    names = [f for f, k in number.items() if keep[k]]
    return float(bias), {f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 1e-3}


class _Weights(dict):
    """Weight of a whole word from the weights of its features, remembered while there is room."""

    def __init__(self, learnt: dict[str, float]):
        super().__init__()
        self.learnt, self.room = learnt, ROOM

    def __missing__(self, word: str) -> float:
        get = self.learnt.get
        total = get(word, 0.0) + sum([get(word[:k] + "*", 0.0) for k in BEGINNINGS if len(word) > k])
        if len(word) <= 32:
            if not self.room:
                self.clear()
                self.room = ROOM
            self[word] = total
            self.room -= 1
        return total


def sentence_scores(text: str, bias: float, weights: _Weights) -> list[tuple[int, int, float]]:
    """Begin, end and score of each sentence."""
    out, low, weight = [], text.lower(), weights.__getitem__
    same = len(low) == len(text)
    for m in SENTENCE.finditer(low if same else text):
        words = set(WORD.findall(m[0] if same else m[0].lower()))
        if words:
            z = bias + sum(sorted(map(weight, words)))
            out.append((m.start(), m.end(), 1 / (1 + math.exp(-z)) if z > -700 else 0.0))
    return out


def noisy_or(scores: list[float]) -> float:
    return -math.expm1(sum(math.log1p(-min(s, 1 - 1e-15)) for s in scores)) if scores else 0.0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[float, dict[str, float]]:
    """Bias and weights from rows whose crc32(id as text) mod 5 is not 0. Only ids pass through the choice of the sample."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    known = known.groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("id"))
    chosen = [known.where(f"y = {y}").orderBy("h", "id").limit(sample) for y in (0, 1)]
    # at most 2 * sample ids: small enough to send to every task
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").join(F.broadcast(chosen[0].union(chosen[1])), "id")
    texts = durable(texts.groupBy("id", "y", "h").agg(F.min("text").alias("text")), "toxicity-sample")
    upto = F.expr("sum(octet_length(text)) over (partition by y order by h, id)")  # at most ``sample`` rows a class
    ahead = texts.select("id", "y", "h", F.octet_length("text").alias("n"), upto.alias("upto"))
    fits = ahead.where((F.col("upto") <= sample_bytes) | (F.col("upto") == F.col("n"))).select("id")
    rows = texts.join(fits, "id", "left_semi").orderBy("h", "id").select("text", "y").collect()
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def _scored(docs: DataFrame, model: tuple[float, dict[str, float]], id_col: str, text_col: str, columns: str, make) -> DataFrame:
    bias, learnt = model
    shared = docs.sparkSession.sparkContext.broadcast(learnt)  # features of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(shared.value)
        for batch in pieces_of(batches):
            made = [make(sentence_scores(t, bias, weights) if t else []) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in made], kind) for k, kind in enumerate(kinds))], names=names)

    types = {"double": pa.float64(), "int": pa.int32(), "array<struct<begin:int,end:int,score:double>>": pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))}
    fields = [c.split(" ") for c in columns.split(", ")]
    kinds, names = [types[k] for _, k in fields], ["doc_id", *(n for n, _ in fields)]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")


def score(docs: DataFrame, model: tuple[float, dict[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the worst sentence's characters ``worst_begin, worst_end`` (null: none)."""

    def make(found):
        worst = max(found, key=lambda s: (s[2], -s[0])) if found else (None, None, 0.0)
        return noisy_or([s for _, _, s in found]), worst[0], worst[1]

    made = _scored(docs, model, id_col, text_col, "score double, worst_begin int, worst_end int", make)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return made.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_begin", "worst_end")


def offending(docs: DataFrame, model: tuple[float, dict[str, float]], least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sentences``: begin, end and score of every sentence that scores ``least`` or more."""
    return _scored(docs, model, id_col, text_col, "sentences array<struct<begin:int,end:int,score:double>>",
                   lambda found: ([{"begin": a, "end": b, "score": s} for a, b, s in found if s >= least],))


def keep_clean(docs: DataFrame, model: tuple[float, dict[str, float]], least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``, with their columns as they are."""
    bias, learnt = model
    shared = docs.sparkSession.sparkContext.broadcast(learnt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(shared.value)
        for batch in pieces_of(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([noisy_or([s for _, _, s in sentence_scores(t or "", bias, weights)]) < least for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
