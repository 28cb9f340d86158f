"""SentencePiece encoding and decoding with a model that was trained for merges (BPE).

A text is cut into units, which no piece crosses, so units are encoded on their own and joined exactly, a
stretch of a text at a time. In a unit the neighbouring symbols whose joint piece has the highest score are
merged, the leftmost of equals, until no two neighbours form a piece. Candidates lie in a heap, so a
long unit costs its length times a logarithm. Characters no piece has are spelled in bytes.
"""

from __future__ import annotations

import re
from array import array
from heapq import heapify, heappop, heappush
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

GAP = "▁"
#: Stretches that every segmentation begins and ends at: pieces have gaps at their start only, and no line feeds.
UNITS = re.compile(f"{GAP}+[^{GAP}\n]*|[^{GAP}\n]+|\n")
#: Units a worker remembers; only its speed depends on it.
REMEMBERED = 400_000


class Vocabulary:
    """Pieces with their scores as a model file lists them, and the bytes of characters no piece has."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int]) -> None:
        self.ids = {piece: (i, score) for i, (piece, score) in enumerate(pieces) if piece}
        if any(GAP in p.lstrip(GAP) or "\n" in p for p in self.ids):
            raise ValueError("pieces must have gaps at their start only, and no line feeds")
        self.byte_ids = byte_ids
        self.raw = [piece.encode() for piece, _ in pieces]
        for value, i in byte_ids.items():
            self.raw[i] = bytes([value])
        self.unknown = min(score for _, score in self.ids.values()) - 10
        self.longest = max(map(len, self.ids))
        self.starts = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.single = {p for p in self.ids if len(p) == 1}
        self.known: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton"} | {"known": {}}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """All pieces, to find those that end at each place of a text, longer ones first."""
        found = ahocorasick.Automaton()
        for piece, (i, score) in self.ids.items():
            found.add_word(piece, (len(piece), score, i))
        found.make_automaton()
        return found

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file. Its scores are used as they are, whatever the model was trained for."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = [], {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            usable = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            pieces.append((piece if usable else "", model.get_score(i)))
        if len(byte_ids) != 256:
            raise ValueError("the model has no pieces for single bytes")
        return cls(pieces, byte_ids)

    def matches(self, text: str, at: int) -> list[tuple[int, float, int]]:
        """(end, score, id) of the pieces that start at a place; id -1 for a character without a piece."""
        found = []
        starts, ids = self.starts, self.ids
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            part = text[at:end]
            if part not in starts:
                break
            if part in ids:
                i, score = ids[part]
                found.append((end, score, i))
        if not found or found[0][0] != at + 1:
            found.append((at + 1, self.unknown, -1))
        return found

    def best(self, text: str) -> tuple[float, bytes]:
        """Score and ids (as 32-bit bytes) of the segmentation with the highest sum of scores, the longer last piece
        of equals: not what merges give, but the bound that tests hold their scores against.
        """
        size = len(text)
        score = [0.0] + [-np.inf] * size
        back: list[tuple[int, int]] = [(0, 0)] * (size + 1)
        if self.single.issuperset(text):
            for last, (length, value, i) in self.automaton.iter(text):
                start = last + 1 - length
                value += score[start]
                if value > score[last + 1]:
                    score[last + 1], back[last + 1] = value, (start, i)
        else:  # some characters are spelled in bytes
            for at in range(size):
                for end, value, i in self.matches(text, at):
                    if score[at] + value > score[end]:
                        score[end], back[end] = score[at] + value, (at, i)
        ids: list[int] = []
        at = size
        while at:
            start, i = back[at]
            ids += (i,) if i >= 0 else [self.byte_ids[b] for b in reversed(text[start:at].encode())]
            at = start
        return score[size], array("i", ids[::-1]).tobytes()

    def merged(self, text: str) -> bytes:
        """Ids (as 32-bit bytes) of a unit by merges."""
        ids = self.ids
        symbols: list[str] = list(text)
        size = len(symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))

        def candidate(i: int, j: int) -> tuple[float, int, int, str] | None:
            piece = symbols[i] + symbols[j]
            return (-ids[piece][1], i, j, piece) if piece in ids else None

        heap = [x for i in range(size - 1) if (x := candidate(i, i + 1))]
        heapify(heap)
        while heap:
            _, i, j, piece = heappop(heap)
            if not symbols[i] or not symbols[j] or after[i] != j or len(symbols[i]) + len(symbols[j]) != len(piece):
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = piece, ""
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                if x := candidate(i, after[i]):
                    heappush(heap, x)
            if before[i] >= 0 and (x := candidate(before[i], i)):
                heappush(heap, x)
        found: list[int] = []
        for symbol in symbols:
            if symbol:
                found += (ids[symbol][0],) if symbol in ids else [self.byte_ids[b] for b in symbol.encode()]
        return array("i", found).tobytes()

    def unit(self, text: str) -> bytes:
        found = self.known.get(text)
        if found is None:
            found = self.merged(text)
            if len(text) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[text] = found
        return found

    def encode(self, stream: str, chunk: int = 16_384) -> bytes:
        """Ids of a stream whose spaces are gaps, as 32-bit bytes; about `chunk` characters are cut into units at a time."""
        get, unit = self.known.get, self.unit
        found, at = [], 0
        while at < len(stream):
            end = min(at + chunk, len(stream))
            while end < len(stream) and not cut_at(stream, end):
                end += 1
            found.append(b"".join([get(x) or unit(x) for x in UNITS.findall(stream, at, end)]))
            at = end
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(GAP, " ").removeprefix(" ")


def cut_at(stream: str, at: int) -> bool:
    """Whether a unit begins at this place of a stream, whatever lies further away."""
    here, last = stream[at], stream[at - 1]
    return "\n" in (here, last) or (here == GAP and last != GAP)


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = 16_384) -> DataFrame:
    """doc_id, text and ids of every document.

    A gap is put before the text and for every space; nothing else is normalised. Empty and null texts
    have no ids. Repeated rows stay. Texts are dealt with `chunk` characters at a time, or a whole unit if
    it is longer; the ids are the same for any size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    docs = docs.select("doc_id", "text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts:
            rows = [own.encode(GAP + t.replace(" ", GAP), chunk) if t else b"" for t in part.column(1).to_pylist()]
            ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), np.int32)))
            yield pa.record_batch([part.column(0), part.column(1), ids], ["doc_id", "text", "ids"])

    return docs.mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add `decoded` to rows that have `ids`. Null ids decode to null; other columns pass through."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    names, place = rows.columns, rows.columns.index("ids")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in parts:
            column = part.column(place)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)), dtype=np.int64).tolist()
            starts = [0, *ends[:-1]]
            found = [own.decode(flat[a:b]) if ok else None for a, b, ok in zip(starts, ends, column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*names, "decoded"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", StringType())]))
