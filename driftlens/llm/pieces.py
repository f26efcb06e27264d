"""SentencePiece BPE encoding and decoding without a merge queue.

A text is cut where no piece of the vocabulary can reach across (before a run of spaces, around a newline). Each part
is encoded by backtracking: one Aho-Corasick pass lists the pieces that start at each position, the longest one is
tried first, a piece is accepted only if it stays beside its left neighbour when both are merged again from
characters, and a bit per position remembers where no encoding can go on. Merging again ranks pairs by piece score,
leftmost first, as the vocabulary's training did, so the encoding that is found is the only one whose neighbours are
all compatible: the exact one.

Defined results: a null or empty text has no ids and decodes to the empty text (a text of spaces has ids); characters
outside the vocabulary become one id per byte; repeated rows each get their own row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.batches import pieces_of

SPACE = "▁"
CACHE_ENTRIES = 100_000
PAIR_ENTRIES = 200_000
CACHED_CHARS = 48


class PieceCodec:
    """Encoder and decoder of one model file. Caches are bounded and never change a result."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.ids = {self.piece[i]: i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.byte_piece = {int(self.piece[i][3:5], 16): self.piece[i] for i in range(n) if model.is_byte(i)}
        self.byte_of = {p: b for b, p in self.byte_piece.items()}
        self.decimal = {p: str(i) for p, i in self.ids.items()} | {self.piece[i]: str(i) for i in range(n) if model.is_byte(i)}
        self.standing = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}  # others are never the result of merging
        self.automaton = ahocorasick.Automaton()
        for p in self.standing:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        longer = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            raise ValueError("pieces with a space inside need another cut")
        line = "" if any("\n" in p for p in longer) else "\n"
        self.parts = re.compile(f" *[^ {line}]+| +" + (f"|{line}" if line else ""))
        self.beginning: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, tuple[str, int, str]] = {}
        self.former: dict[str, tuple[str, int, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Pair merging by score, leftmost first. Only pieces and pairs of pieces are merged this way, so texts are short."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _beside(self, left: str, right: str) -> bool:
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            got = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return got

    def _shorter(self, piece: str) -> str | None:
        """The longest piece that is a proper beginning of ``piece``."""
        got = self.beginning.get(piece, "")
        if got == "":
            got = self.beginning[piece] = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.standing), None)
        return got

    def _run(self, text: str) -> list[str]:
        """Pieces of a text whose characters are all in the vocabulary."""
        n, pairs, shorter, match = len(text), self.pairs, self.beginning, self.automaton.iter_long
        longest = {end - len(p) + 1: p for end, p in match(text)}  # where the longest ones follow each other
        tokens: list[str] = []
        failed, pos, p, last = 0, 0, longest[0], ""
        while True:
            while p is not None:
                if not failed >> (pos + len(p)) & 1:
                    if not last:
                        break
                    fits = pairs.get((last, p))
                    if fits or fits is None and self._beside(last, p):
                        break
                p = self._shorter(p) if p not in shorter else shorter[p]
            if p is not None:
                tokens.append(p)
                pos += len(p)
                if pos == n:
                    return tokens
                last, p = p, longest.get(pos)
                if p is None:
                    p = longest[pos] = next(match(text, pos))[1]
            else:
                failed |= 1 << pos
                p = tokens.pop()
                pos -= len(p)
                last, p = tokens[-1] if tokens else "", self._shorter(p)

    def encode_part(self, part: str) -> list[str]:
        """Pieces of a part; a character outside the vocabulary gives the pieces of its bytes."""
        part = part.replace(" ", SPACE)
        if self.alphabet.issuperset(part):
            return self._run(part)
        out, begin = [], 0
        for i, c in enumerate(part):
            if c not in self.alphabet:
                out += self._run(part[begin:i]) if i > begin else []
                out += [self.byte_piece[b] for b in c.encode("utf-8")]
                begin = i + 1
        return out + (self._run(part[begin:]) if begin < len(part) else [])

    def decode_part(self, pieces: list[str]) -> str:
        if not self.byte_of.keys().isdisjoint(pieces):
            out = b"".join(bytes([self.byte_of[p]]) if p in self.byte_of else p.encode("utf-8") for p in pieces)
            return out.decode("utf-8", "replace").replace(SPACE, " ")
        return "".join(pieces).replace(SPACE, " ")

    def _new(self, part: str) -> tuple[str, int, str]:
        if part in self.former:
            got = self.known[part] = self.former[part]
            return got
        pieces = self.encode_part(part)
        got = ",".join(map(self.decimal.__getitem__, pieces)), len(pieces), self.decode_part(pieces)
        if len(part) <= CACHED_CHARS:
            if len(self.known) >= CACHE_ENTRIES:  # the words in use come back at once from the former half
                self.former, self.known = self.known, {}
            self.known[part] = got
        return got

    def convert(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids as decimal text joined by commas, the decoded text."""
        if not text:
            return 0, "", ""
        known, new = self.known, self._new
        got = [known.get(p) or new(p) for p in self.parts.findall(" " + text.replace(SPACE, " "))]
        return sum([g[1] for g in got]), ",".join([g[0] for g in got]), "".join([g[2] for g in got])[1:]


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    return _CODECS.get(path) or _CODECS.setdefault(path, PieceCodec(path))


def _mapped(docs: DataFrame, path: str, id_col: str, text_col: str, columns: str, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in pieces_of(batches):
            made = [make(*own.convert(t or "")) for t in batch.column(1).to_pylist()]
            arrays = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    fields = [c.strip().split(" ") for c in columns.split(", ")]
    kinds, names = [types[k] for _, k in fields], ["doc_id", *(n for n, _ in fields)]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of every whole text and what they decode to."""
    return _mapped(docs, path, id_col, text_col, "ids array<int>, decoded string", lambda n, ids, decoded: ([int(i) for i in ids.split(",")] if n else [], decoded))


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: as ``encode``, with digests in place of ids and text."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    return _mapped(docs, path, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda n, ids, decoded: (n, sha(ids), sha(decoded)))
