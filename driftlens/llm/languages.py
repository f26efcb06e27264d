"""Language identification by cross-parsing entropy with suffix automata.

A suffix automaton of labelled text accepts exactly the strings that occur in that text. A new text is parsed against it
from left to right into phrases, each the longest match that starts where the one before ended (a symbol that the language
never shows is a phrase of its own). Text of the same language needs few, long phrases. Each phrase costs the logarithm of
the labelled text's length, so languages with less text are comparable; the fewest bits win.

The automata are fitted on a bounded sample: per language whole texts, chosen by hash, of together at most ``SAMPLE_BYTES``
divided by the number of languages. They are tables of fixed width over the bytes that occur, so a step is one lookup.
Everything after that is one pass over the documents without a shuffle; whole texts are parsed.

Texts are lower-cased and reduced to their letters with single spaces around words, in UTF-8.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text if nothing was
learnt; ties go to the smaller name; rows with a null id are held out by definition of their remainder (they have none), so
they are neither learnt from nor marked as held out; repeated rows get the same result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of
from driftlens.operators.ordering import top_per_group
from driftlens.runtime import durable

#: Labelled text that is learnt from, all languages together, and texts looked at per language.
SAMPLE_BYTES, SAMPLE_TEXTS = 120_000, 200
#: A text of the sample may be no longer than this part of its language's share.
LONGEST_PART = 4
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters with single spaces around them; nothing if there is no letter."""
    words = " ".join(_WORD.findall(text.lower())) if text else ""
    return f" {words} ".encode() if any(map(str.isalpha, words)) else b""


@dataclass
class Automaton:
    """``table[state + symbol]`` is the next state or 0; states are multiples of the number of symbols, the first is 0."""

    name: str
    table: list[int]
    cost: float

    def phrases(self, data: bytes) -> int:
        """Number of phrases of a text of symbols."""
        table, state, n = self.table, 0, 0
        for symbol in data:
            following = table[state + symbol]
            if following:
                state = following
            else:  # the phrase ends before this symbol; a symbol that never starts a phrase is one by itself
                begins = table[symbol]
                n += 1 if begins or not state else 2
                state = begins
        return n + 1 if state else n


def automaton(name: str, data: bytes, width: int) -> Automaton:
    """Suffix automaton of a text of symbols 1 to ``width - 1``; symbol 0 stands for all that never occurs.

    States are classes of substrings with the same ends; ``link`` leads to the class of the longest suffix outside.
    """
    following: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in data:
        new = len(following)
        following.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at != -1:
            met = following[at][symbol]
            if longest[met] != longest[at] + 1:  # only the shorter strings of that class end here too: split it
                copy = len(following)
                following.append(dict(following[met]))
                longest.append(longest[at] + 1)
                link.append(link[met])
                while at != -1 and following[at].get(symbol) == met:
                    following[at][symbol] = copy
                    at = link[at]
                link[met] = link[new] = copy
            else:
                link[new] = met
        last = new
    table = np.zeros((len(following), width), np.int32)
    for state, steps in enumerate(following):
        for symbol, to in steps.items():
            table[state, symbol] = to * width
    return Automaton(name, table.reshape(-1).tolist(), math.log2(len(data) + 1))


class Languages:
    """Automata of several languages over one set of symbols."""

    def __init__(self, texts: dict[str, bytes]):
        used = sorted(set().union(*texts.values())) if texts else []
        self.fold = bytearray(256)
        for k, byte in enumerate(used):
            self.fold[byte] = k + 1
        self.all = [automaton(name, data.translate(self.fold), len(used) + 1) for name, data in sorted(texts.items())]

    def costs(self, text: str | None) -> list[float]:
        """Bits that each language needs for the text, or nothing if it has no letter."""
        data = letters(text).translate(self.fold)
        return [one.phrases(data) * one.cost for one in self.all] if data else []

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the fewest bits, and its share if every bit less is twice as likely."""
        costs = self.costs(text)
        if not costs:
            return UNKNOWN, 0.0
        best = min(range(len(costs)), key=costs.__getitem__)
        return self.all[best].name, 1 / sum(2.0 ** max(costs[best] - c, -1000.0) for c in costs)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES, sample_texts: int = SAMPLE_TEXTS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Letters of the sample of each language, from rows with a language whose crc32(id as text) mod 4 is not 2.

    Rows are chosen by the hash of their id. Only ids and lengths pass through the choice.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    names = known.select("lang").distinct().count()
    share = max(sample_bytes // max(names, 1), 1)
    short = known.where(F.octet_length("text") <= max(share // LONGEST_PART, 1)).where(F.col("text").rlike(r"\p{L}"))
    rows = short.select("lang", "id", F.xxhash64("id", "text").alias("h"), F.octet_length("text").alias("n"))
    chosen = durable(top_per_group(rows, ["lang"], ["h", "id"], sample_texts), "language-sample")
    upto = chosen.withColumn("upto", F.expr("sum(n) over (partition by lang order by nth)")).where(F.col("upto") <= share).select(F.col("lang").alias("_lang"), F.col("id").alias("_id"), "h").distinct()
    texts = short.join(upto, (F.col("id") == F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.xxhash64("id", "text") == F.col("h")))
    found: dict[str, bytes] = {}
    for r in texts.select("lang", "h", "text").distinct().orderBy("lang", "h", "text").collect():  # at most ``sample_bytes``
        found[r["lang"]] = found.get(r["lang"], b"") + letters(r["text"])
    return found


def identify(docs: DataFrame, learnt: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt)  # the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in pieces_of(batches):
            made = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    made = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


_BUILT: dict[int, Languages] = {}


def _model(shared) -> Languages:
    """The automata of a broadcast sample, built once in a worker and kept for its next task."""
    key = hash(tuple(sorted(shared.value.items())))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Languages(shared.value)
    return _BUILT[key]
