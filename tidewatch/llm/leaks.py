"""Benchmark decontamination: n-gram seeds join training passages to test items, and a Smith-Waterman
alignment over words scores each pair.

The texts are read once. A bit map of the items' n-grams, of at most `MAP_BITS` bits whatever the number
of items, lets through the n-grams that may be seeds; runs of them become passages with the longest
item's length of words around. All that follows handles passages only: equal ones are combined, and their
n-grams are joined to the items exactly. A passage that shares any n-gram with an item, however frequent, is
aligned with it once; only pairs with too few words in common to reach the score are passed over.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import cut_lineage

WORDS = re.compile(r"[^\W_]+")
MAP_BITS = 1 << 24
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words a task remembers the hashes of; only its speed depends on it.
REMEMBERED = 1 << 19


@dataclass(frozen=True)
class Seeds:
    """`words` per n-gram. A pair is a leak from a score of `least`: alignment score (1 a match, -1 a mismatch
    or gap) by the item's number of words.
    """

    words: int = 4
    least: float = 0.5


class Grams:
    """Hashes of word n-grams."""

    def __init__(self, words: int) -> None:
        self.words, self.known = words, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(words) < self.words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        hashes = np.empty(len(words), np.uint64)
        for i, word in enumerate(words):
            h = known.get(word)
            if h is None:
                h = known[word] = xxhash.xxh64_intdigest(word.encode())
            hashes[i] = h
        n = len(words) - self.words + 1
        grams = np.zeros(n, np.uint64)
        for k in range(self.words):
            grams = (grams ^ hashes[k : k + n]) * _MIX
            grams ^= grams >> np.uint64(29)
        return grams


def probes(grams: np.ndarray) -> list[np.ndarray]:
    """Two places of each n-gram in the bit map."""
    return [(grams >> np.uint64(shift)) & np.uint64(MAP_BITS - 1) for shift in (0, 32)]


def item_grams(items: DataFrame, seeds: Seeds) -> DataFrame:
    """item_id, gram, n (words of the item): one row for each distinct n-gram of an item."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of = Grams(seeds.words)
        for part in parts:
            ids, grams, sizes = [], [], []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = WORDS.findall((text or "").lower())
                own = np.unique(grams_of(words)).view(np.int64).tolist()
                ids += [item] * len(own)
                grams += own
                sizes += [len(words)] * len(own)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(grams, pa.int64()), pa.array(sizes, pa.int32())], ["item_id", "gram", "n"])

    return items.select("item_id", "text").mapInArrow(run, "item_id long, gram long, n int")


def bit_map(grams: DataFrame) -> bytes:
    """The bit map of all n-grams, or-ed together by Spark in pieces of 32,768 bits: MAP_BITS / 8 bytes at most."""
    places = grams.select(
        F.explode(F.expr(f"array(gram & {MAP_BITS - 1}L, shiftrightunsigned(gram, 32) & {MAP_BITS - 1}L)")).alias("p")
    )
    pieces = places.groupBy(F.expr("p DIV 32768 AS piece")).agg(F.expr("bitmap_construct_agg(p % 32768) AS bits"))
    whole = bytearray(MAP_BITS // 8)
    for row in pieces.collect():
        whole[row["piece"] * 4096 : (row["piece"] + 1) * 4096] = row["bits"]
    return bytes(whole)


def passages(docs: DataFrame, bits: bytes, margin: int, seeds: Seeds) -> DataFrame:
    """doc_id, text_md5, start (word), key, words and grams of every passage with n-grams on the bit map."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of = Grams(seeds.words)
        marked = np.frombuffer(shared.value, np.uint8)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.string(), pa.list_(pa.int64())]
        for part in parts:
            rows = []
            for doc, text in zip(part.column(0), part.column(1)):
                text = text.as_py() or ""
                words = WORDS.findall(text.lower())
                grams = grams_of(words)
                hit = np.ones(len(grams), bool)
                for p in probes(grams):
                    hit &= (marked[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                digest = hashlib.md5(text.encode()).digest()
                for run_at in np.split(at, np.flatnonzero(np.diff(at) > margin) + 1):
                    start = max(int(run_at[0]) - margin, 0)
                    held = " ".join(words[start : int(run_at[-1]) + seeds.words + margin])
                    own = np.unique(grams[run_at]).view(np.int64).tolist()
                    rows.append((doc.as_py(), digest, start, xxhash.xxh3_128_digest(held.encode()), held, own))
            for i in range(0, len(rows), 1000):
                yield pa.record_batch(
                    [pa.array(x, kind) for x, kind in zip(zip(*rows[i : i + 1000]), kinds)],
                    ["doc_id", "text_md5", "start", "key", "words", "grams"],
                )

    schema = "doc_id long, text_md5 binary, start int, key binary, words string, grams array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def align(item: list[str], passage: list[str]) -> tuple[int, int, int]:
    """Best local alignment: score, first and one past the last word in the passage."""
    number: dict[str, int] = {}
    a, b = (np.array([number.setdefault(w, len(number)) for w in words]) for words in (item, passage))

    def best(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
        places = np.arange(len(b) + 1)
        row, top, end = np.zeros(len(b) + 1, np.int64), 0, 0
        for word in a:
            new = np.zeros(len(b) + 1, np.int64)
            new[1:] = np.maximum(row[:-1] + np.where(b == word, 1, -1), row[1:] - 1)
            row = np.maximum(np.maximum.accumulate(np.maximum(new, 0) + places) - places, 0)
            at = int(row.argmax())
            if row[at] > top:
                top, end = int(row[at]), at
        return top, end

    score, end = best(a, b)
    if not score:
        return 0, 0, 0
    _, length = best(a[::-1], b[:end][::-1])
    return score, end - length, end


def find(docs: DataFrame, items: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """doc_id, text_md5, item_id, score, start and end (words of the text) of every leak found.

    One row per document row, item and passage. Null and empty texts and items of fewer words than an
    n-gram have no leaks; equal texts have the same ones; an empty table of either kind gives no rows.
    """
    grams = cut_lineage(item_grams(items, seeds))
    longest = grams.agg(F.max("n")).first()[0] or 0
    found = cut_lineage(passages(docs, bit_map(grams), longest, seeds))
    distinct = cut_lineage(found.groupBy("key").agg(F.first("words").alias("words"), F.first("grams").alias("grams")))
    seeds_of = distinct.select("key", F.explode("grams").alias("gram"))
    pairs = seeds_of.join(grams.select("gram", "item_id"), "gram").select("key", "item_id").distinct()
    both = pairs.join(distinct.select("key", "words"), "key").join(items.select("item_id", F.col("text").alias("item")), "item_id")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for key, item_id, words, item in zip(*(part.column(i).to_pylist() for i in range(4))):
                own = WORDS.findall((item or "").lower())
                held = words.split(" ")
                if (Counter(own) & Counter(held)).total() < seeds.least * len(own):
                    continue  # a score is at most the number of matches
                score, a, b = align(own, held)
                if score >= seeds.least * len(own):
                    rows.append((key, item_id, score / len(own), a, b))
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["key", "item_id", "score", "a", "b"])

    scored = both.select("key", "item_id", "words", "item").mapInArrow(run, "key binary, item_id long, score double, a int, b int")
    return found.select("doc_id", "text_md5", "start", "key").join(scored, "key").select(
        "doc_id", "text_md5", "item_id", "score", F.expr("start + a AS start"), F.expr("start + b AS end")
    )


def decontaminate(docs: DataFrame, items: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """The documents without those that hold a leak; a null text stays."""
    leaked = find(docs, items, seeds).select(F.col("text_md5").alias("_md5")).distinct()
    packed = docs.select(F.struct("*").alias("_row"), F.expr("unhex(md5(text)) AS _md5"))
    kept = packed.join(leaked, "_md5", "left_anti")
    return kept.select(*(F.col("_row")[name].alias(name) for name in docs.columns))
