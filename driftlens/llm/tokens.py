"""Token counts by a two-tier lookup on the map side.

Tier one is a table of pre-token lengths built from the vocabulary itself: a byte-level vocabulary lists the
pre-tokens that are frequent, so the table holds at most one entry for each of its ids, however large the corpus.
It is broadcast. Tier two encodes what the table misses and remembers it in a bounded cache of the Python worker.
No pre-token is shuffled.

Defined results: a null text counts as empty (0 tokens); repeated rows each get their own row; other columns of the
input are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of

#: Fixed value: the split pattern of the byte-level vocabulary.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_ENTRIES = 300_000
CACHED_CHARS = 48


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _vocabulary(path: str) -> tuple[dict, dict[bytes, int]]:
    """The model file and its tokens as bytes with their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    letters, special = _byte_letters(), {t["content"] for t in model["added_tokens"]}
    return model, {bytes(letters[c] for c in k): i for k, i in model["model"]["vocab"].items() if k not in special}


def _encoder(path: str):
    """Function from one pre-token to its number of tokens.

    Where ids follow the order of the merges, as a byte-level vocabulary has them, pairs can be merged by id, which is
    several times as fast for single pre-tokens; else the library itself encodes them.
    """
    model, ids = _vocabulary(path)
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
    ranks = [model["model"]["vocab"].get(a + b, -1) for a, b in merges]
    if len({*range(256)} & {i for t, i in ids.items() if len(t) == 1}) == 256 and ranks == list(range(256, 256 + len(ranks))):
        import tiktoken

        whole = tiktoken.Encoding("pairs", pat_str=r"[\s\S]+", mergeable_ranks=ids, special_tokens={})
        return lambda part: len(whole.encode_ordinary(part))
    library = _library(path)
    return lambda part: len(library.encode(part, add_special_tokens=False).ids)


def pre_token_patterns(path: str) -> tuple[str, str]:
    """A set of characters, and the pattern for texts that have one of them.

    Versions of Unicode differ: characters that only the newer tables call letters or digits are found by asking the
    library, and count as other characters in these texts. All other texts are split by ``PRE_TOKEN``.
    """
    split, both, letter = _library(path).pre_tokenizer.pre_tokenize_str, regex.compile(r"[\p{L}\p{N}]"), regex.compile(r"\p{L}")
    odd = [c for c in map(chr, (*range(0x250, 0xD800), *range(0xE000, 0x110000))) if both.match(c) and len(split(("a" if letter.match(c) else "1") + c)) > 1]
    if not odd:
        return "", PRE_TOKEN
    ranges = [[odd[0], odd[0]]]
    for c in odd[1:]:
        if ord(c) == ord(ranges[-1][1]) + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    held = "".join(f"{a}-{b}" for a, b in ranges)
    return f"[{odd[0]}-{odd[-1]}]", r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\P{L}%s]+| ?[^\P{N}%s]+| ?(?:[^\s\p{L}\p{N}]|[%s])+|\s+(?!\S)|\s+""" % (held, held, held)


def frequent_lengths(path: str) -> dict[str, int]:
    """Pre-token -> number of tokens, for each vocabulary entry that is one pre-token. At most one entry per id."""
    whole, count, found = regex.compile(PRE_TOKEN), _encoder(path), {}
    for token in _vocabulary(path)[1]:
        try:
            text = token.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if whole.findall(text) == [text]:
            found[text] = count(text)
    return found


class _Lengths(dict):
    """Known lengths; what is missing is encoded and, while there is room, kept."""

    def __init__(self, table: dict[str, int], count):
        super().__init__(table)
        self.count, self.room = count, CACHE_ENTRIES

    def __missing__(self, part: str) -> int:
        n = self.count(part)
        if len(part) <= CACHED_CHARS and self.room:
            self[part] = n
            self.room -= 1
        return n


class _Counter:
    """The worker's side: the broadcast table, the cache of misses, the encoder for what neither has."""

    def __init__(self, path: str, table: dict[str, int], odd: str, exact: str):
        added = [t["content"] for t in _vocabulary(path)[0]["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.split, self.split_odd = regex.compile(PRE_TOKEN).findall, regex.compile(exact).findall
        self.odd = re.compile(odd).search if odd else lambda text: None
        self.table, self.encode = table, _encoder(path)
        self.known = _Lengths(table, self.encode)

    def count(self, text: str) -> int:
        if not self.known.room:  # a full cache starts anew
            self.known = _Lengths(self.table, self.encode)
        pieces = self.special.split(text) if self.special is not None else [text]
        split = self.split_odd if self.odd(text) else self.split
        return len(pieces) - 1 + sum(sum(map(self.known.__getitem__, split(p))) for p in pieces)


_COUNTERS: dict[str, _Counter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text, as the library counts without added special tokens."""
    table, (odd, exact) = docs.sparkSession.sparkContext.broadcast(frequent_lengths(path)), pre_token_patterns(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, _Counter(path, table.value, odd, exact))
        for batch in pieces_of(batches):
            counts = [counter.count(t) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
