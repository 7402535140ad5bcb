"""SentencePiece encoding of the merge type by backtracking (operator 11).

A sequence of pieces is the merge encoding of a text exactly if every two
neighbours, joined and merged anew, come apart at the same place.  So the
encoder need not merge whole texts:

1. an Aho-Corasick automaton over the pieces gives the longest piece that
   starts at each place;
2. from left to right the longest piece is taken that is compatible with the
   one before it; compatibility is found by merging the two again, as far as
   the place where they meet is concerned, and remembered;
3. if neither it nor a shorter prefix fits, the place is marked in a bitfield
   of failed positions, the last piece is given back and a shorter one tried.
   The last piece of a prefix's encoding is unique, so a place that has failed
   once has failed for good, and the work is linear in the text.

Characters that are no piece become their UTF-8 bytes, as the library does.
Texts are cut where no piece of the vocabulary reaches over (as a rule, before
spaces and between letters and punctuation; derived from the pieces), so a word
that was encoded once is looked up the next time.  Both memories are bounded and
only save time.

Nulls: a null text is an empty one and gives no ids; rows without an id stay.
Repeated rows stay as often as they come, an empty table gives an empty table,
and texts of any length are encoded whole.  Other columns are not carried.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from featurejudge.llm.common import Memo

SPACE = "▁"          # stands for a space
MEMO_CHUNKS = 120_000     # encoded chunks of a generation; a worker remembers two
MEMO_CHARS = 64           # longest chunk that is remembered
MEMO_PAIRS = 400_000      # pairs of pieces whose compatibility a worker remembers
SLICE = 256               # texts that are Python objects at once
CONTROLS = "\n\r\t"


class Encoder:
    """The encoder of one model (the bytes of a SentencePiece model file)."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        # a normaliser that does more than mark spaces would have to run first
        if library.normalize(" a  b\téＡ ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b\téＡ{SPACE}":
            raise ValueError("the model normalises texts beyond marking spaces")
        size = library.vocab_size()
        special = {i for i in range(size) if library.is_control(i) or library.is_unknown(i) or library.is_byte(i)}
        if any(library.is_unused(i) for i in range(size)):
            raise ValueError("the model has unused pieces")
        self.ids = {library.id_to_piece(i): i for i in range(size) if i not in special}
        self.scores = {p: library.get_score(i) for p, i in self.ids.items()}
        bytes_of = {int(library.id_to_piece(i)[3:5], 16): i for i in special if library.is_byte(i)}
        self.bytes = [bytes_of.get(b, library.unk_id()) for b in range(256)]
        # a piece that its own characters do not merge to never comes out
        self.splits: dict[str, tuple[str, str]] = {}
        reached = [p for p in self.ids if self.merge(p, self.splits) == [p]]
        # the next shorter piece that starts a piece; at the end of each chain one character, piece or not
        there = set(reached)
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in there), p[0] if len(p) > 1 else None) for p in reached}
        self.automaton = ahocorasick.Automaton()
        for p in reached:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.chunk = re.compile(self._cuts())
        self.borders: dict[tuple[str, int], list | None] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.memo = Memo(self.chunk_ids, MEMO_CHUNKS, MEMO_CHARS)

    def _cuts(self) -> str:
        """Pattern of the chunks of a text.  Characters that stand together in
        some piece are of one class; no piece reaches from one class into
        another, or over a space mark, so neither does a merge."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return "(?s:.+)"
        root: dict[str, str] = {}

        def find(c: str) -> str:
            while root.setdefault(c, c) != c:
                c = root[c]
            return c
        for p in self.ids:
            body = p.lstrip(SPACE)
            for c in body[1:]:
                root[find(c)] = find(body[0])
        classes: dict[str, list[str]] = {}
        for c in list(root):
            classes.setdefault(find(c), []).append(c)
        # characters of the largest class and unknown ones are the rest; ASCII ones that never join are chunks of
        # their own (others would be too, but the pattern stays short)
        *small, _ = sorted(classes.values(), key=len)
        groups = ["".join(map(re.escape, c)) for c in small]
        alone = "".join(re.escape(c) for c in sorted({*CONTROLS, *(p for p in self.ids if len(p) == 1 and p.isascii())} - set(root) - {SPACE}))
        known = alone + "".join(groups)
        parts = [f"{SPACE}*[^{SPACE}{known}]+", *(f"{SPACE}*[{g}]+" for g in groups), *([f"{SPACE}*[{alone}]"] if alone else []), f"{SPACE}+"]
        return "|".join(parts)

    def merge(self, text: str, splits: dict | None = None) -> list[str]:
        """The definition, for short texts: the pair that makes the best piece
        is merged first, of equal ones the leftmost.  ``splits`` gets the last
        merge of what the text becomes, if that is one piece."""
        parts, last = list(text), None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                if splits is not None and last and len(parts) == 1:
                    splits[text] = last
                return parts
            last = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def border(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """The symbols that stand at one end of a piece (0 left, 1 right) while
        it is merged, first to last, each with the score of the merge that takes
        it up.  None if scores do not fall from merge to merge."""
        key = piece, side
        if key not in self.borders:
            out, taker = [], -math.inf
            while True:
                out.append((piece, taker))
                if piece not in self.splits:
                    break
                if self.scores[piece] <= taker:
                    out = None
                    break
                taker = self.scores[piece]
                piece = self.splits[piece][side]
                if len(piece) > 1 and piece not in self.splits:      # merged otherwise than alone
                    out = None
                    break
            self.borders[key] = out[::-1] if out else None
        return self.borders[key]

    def apart(self, a: str, b: str) -> bool:
        """Merged anew, the two pieces come apart at the same place.  Only the
        symbols at the place where they meet matter: both sides are merged step
        by step, and no merge over the place may come first."""
        left, right = self.border(a, 1), self.border(b, 0)
        if left is None or right is None:
            return self.merge(a + b) == [a, b]
        i = j = 0
        scores = self.scores
        while True:
            (x, x_taken), (y, y_taken) = left[i], right[j]
            over = scores.get(x + y)
            # at equal scores the leftmost merge comes first: in the left piece, then over the place
            if over is not None and over > x_taken and over >= y_taken:
                return False
            if x_taken == -math.inf and y_taken == -math.inf:
                return True
            if x_taken >= y_taken:
                i += 1
            else:
                j += 1

    def compatible(self, a: str, b: str) -> bool:
        after = self.pairs.get(a)
        if after is None:
            after = self.pairs[a] = {}
        known = after.get(b)
        if known is None:
            self.n_pairs += 1
            if self.n_pairs > MEMO_PAIRS:
                self.pairs, self.n_pairs = {}, 0
            known = after[b] = self.apart(a, b)
        return known

    def pieces(self, text: str) -> list[str]:
        """Pieces of one chunk by longest matches and backtracking."""
        longest = list(text)
        for end, piece in self.automaton.iter(text):      # of one start, longer pieces end later
            longest[end + 1 - len(piece)] = piece
        n, out = len(text), []
        last, piece = None, longest[0]
        if len(piece) == n:
            return [piece]
        shorter, compatible = self.shorter.get, self.compatible
        failed = bytearray((n >> 3) + 1)
        pos = 0
        while pos < n:
            while piece is not None:
                end = pos + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (last is None or compatible(last, piece)):
                    break
                piece = shorter(piece)
            if piece is not None:
                out.append(piece)
                pos, last = end, piece
                piece = longest[pos] if pos < n else None
            elif out:
                failed[pos >> 3] |= 1 << (pos & 7)
                piece = out.pop()
                pos -= len(piece)
                last = out[-1] if out else None
            else:
                raise ValueError("the vocabulary's merges have no left-to-right form")
        return out

    def chunk_ids(self, text: str) -> bytes:
        """Ids of a chunk as 32-bit integers."""
        out = array("i")
        for p in self.pieces(text):
            i = self.ids.get(p)
            if i is None:
                out.extend([self.bytes[b] for b in p.encode("utf-8")])
            else:
                out.append(i)
        return out.tobytes()

    def packed(self, text: str | None) -> bytes:
        """All ids of a whole text, no begin or end id, as 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.memo.__getitem__, self.chunk.findall(SPACE + text.replace(" ", SPACE))))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> Encoder:
    return Encoder(model)


@lru_cache(maxsize=2)
def _library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def encode(docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) of every row of ``docs``; ``model`` is the content
    of a SentencePiece model file (about half a MB; it travels with the task)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = [encoder.packed(t) for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=[key, "ids"])

    source = docs.select(F.col(key), F.col(text).alias("__text"))
    return source.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(ids: Column, model: bytes) -> Column:
    """Text of an array of ids by the library's decode; null and empty: empty."""
    @arrow_udf("string")
    def text_of(batch: pa.Array) -> pa.Array:
        library = _library(model)
        numbers, offsets = batch.values.to_numpy(), batch.offsets.to_numpy()
        # a null row has no ids between its offsets, or ids that do not count
        texts = (library.decode(numbers[a:b].tolist()) if ok and b > a else "" for a, b, ok in zip(offsets[:-1], offsets[1:], batch.is_valid().to_pylist()))
        return pa.array(texts, pa.string(), size=len(batch))
    return text_of(ids)


def read_model(path: str) -> bytes:
    """Content of a tokenizer file of the machine that plans the query."""
    with open(path, "rb") as f:
        return f.read()
