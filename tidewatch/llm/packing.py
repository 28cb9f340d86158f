"""Token sequences of fixed length filled from patterns of a few document lengths.

Only the histogram of piece lengths decides the plan, so the driver holds one number per length. Patterns
are all sets of up to `depth` lengths that fill a sequence exactly. How often each is used is a non-negative
least squares fit of their lengths to the histogram, by block coordinate descent on an active set: the patterns
that lessen the misfit most come in as a layer without a common length, and all layers are solved for in
turns. Counts are rounded and held to the pieces there are, what is left is fitted again, and when rounding
leaves nothing the residual pieces are packed by best fit, again by counts alone. Pieces of one length are
then numbered in parallel, and a piece finds its sequence and place by its number.
"""

from __future__ import annotations

import functools
import json
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidewatch.settings import cut_lineage

#: How a byte-level vocabulary parts a text before it merges bytes. Fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of ids handed to Spark at a time.
HANDED = 1 << 22


@dataclass(frozen=True)
class Packing:
    """`capacity` tokens a sequence; patterns of at most `depth` pieces.

    There are about capacity ** (depth - 1) / depth! / (depth - 1)! patterns, whatever the number of documents.
    """

    capacity: int = 2048
    depth: int = 3
    #: Patterns looked at to make a layer, layers of a fit, sweeps over them for each, and fits of what rounding left.
    looked: int = 1 << 14
    steps: int = 24
    sweeps: int = 20
    fits: int = 4
    #: Pieces of one length that are numbered in one group, about.
    numbered: int = 20_000


def patterns(lengths: np.ndarray, packing: Packing) -> np.ndarray:
    """Rows of `depth` lengths in falling order, padded with 0, that add up to the capacity."""
    present = np.zeros(packing.capacity + 1, bool)
    present[lengths] = True
    present[0] = False
    falling = np.flatnonzero(present)[::-1]
    partial = falling[:, None]  # falling lengths whose sum is below the capacity
    found = []
    for depth in range(1, packing.depth + 1):
        left = packing.capacity - partial.sum(axis=1)
        full = partial[left == 0]
        found.append(np.pad(full, ((0, 0), (0, packing.depth - depth))))
        partial, left = partial[left > 0], left[left > 0]
        if depth + 1 == packing.depth:  # the last length follows from the others
            fits = (left <= partial[:, -1]) & present[left]
            found.append(np.column_stack([partial[fits], left[fits]]))
            break
        grown = [np.column_stack([partial[fit], np.full(fit.sum(), x)]) for x in falling for fit in [(left >= x) & (partial[:, -1] >= x)]]
        partial = np.concatenate([np.zeros((0, depth + 1), np.int64), *grown])
    return np.concatenate(found).astype(np.int64)


def fit(counts: np.ndarray, sets: np.ndarray, packing: Packing) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the patterns used and how often, not rounded: non-negative least squares of their lengths to `counts`.

    The patterns of a layer have no length in common, so their counts are solved for at once.
    """
    same = (sets[:, :, None] == sets[:, None, :]) & (sets > 0)[:, :, None]
    weight = same.sum(axis=(1, 2)).astype(float)  # squared norm of a pattern's lengths
    misfit = counts.copy()
    misfit[0] = 0  # the padding
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(packing.steps):
        gain = misfit[sets].sum(axis=1) / np.sqrt(weight)
        best = np.argpartition(-gain, min(packing.looked, len(gain) - 1))[: packing.looked]
        best = best[gain[best] > 1e-3]
        busy, entering = np.zeros(len(counts), bool), []
        for j, row in zip((order := best[np.argsort(-gain[best], kind="stable")]).tolist(), sets[order].tolist()):
            if not any(busy[x] for x in row if x):
                busy[row] = True
                entering.append(j)
        if not entering:
            break
        layers.append((np.array(entering, np.int64), np.zeros(len(entering))))
        for _ in range(packing.sweeps):
            moved = 0.0
            for some, times in layers:
                rows = sets[some]
                step = np.maximum(misfit[rows].sum(axis=1) / weight[some], -times)
                times += step
                np.subtract.at(misfit, rows, step[:, None])
                misfit[0] = 0
                moved = max(moved, float(np.abs(step).max()))
            if moved < 1e-3:
                break
    if not layers:
        return np.zeros(0, np.int64), np.zeros(0)
    used, where = np.unique(np.concatenate([some for some, _ in layers]), return_inverse=True)
    return used, np.bincount(where, np.concatenate([times for _, times in layers]))


@dataclass
class Plan:
    """Which sequences the pieces of a length go to, by their number in the length.

    Entry i takes pieces first[i] up to the next entry of the length: `each[i]` to a sequence from `sequence[i]`
    on, at `place[i]` and after one another.
    """

    sequences: int = 0
    entries: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    _used: Counter = field(default_factory=Counter)

    def add(self, lengths: list[int], times: int) -> None:
        """`times` sequences that hold these lengths."""
        place = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            self.entries.append((length, self._used[length], each, self.sequences, place))
            self._used[length] += each * times
            place += each * length
        self.sequences += times

    def columns(self) -> list[np.ndarray]:
        return list(np.array(sorted(self.entries), np.int64).reshape(-1, 5).T)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Longest first, each into the fullest sequence it fits; equal sequences are kept as one with a number."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by space left
    spaces: list[int] = []
    done: list[tuple[list[int], int]] = []

    def put(held: tuple[int, ...], space: int, times: int) -> None:
        if not space:
            done.append((list(held), times))
            return
        if space not in groups:
            groups[space] = []
            insort(spaces, space)
        groups[space].append((held, times))

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                each = min(capacity // length, left)
                put((length,) * each, capacity - each * length, left // each)
                left %= each
                continue
            space = spaces[at]
            held, times = groups[space].pop()
            if not groups[space]:
                del groups[space], spaces[at]
            each = min(space // length, left)
            full = min(times, left // each)
            if full < times:
                put(held, space, times - full)
            put(held + (length,) * each, space - each * length, full)
            left -= each * full
    return done + [(list(held), times) for some in groups.values() for held, times in some]


def plan(histogram: dict[int, int], packing: Packing = Packing()) -> Plan:
    """The plan for so many pieces of each length, from 1 to the capacity."""
    counts = np.zeros(packing.capacity + 1, np.int64)
    for length, number in histogram.items():
        counts[length] = number
    out = Plan()
    for _ in range(packing.fits):
        sets = patterns(np.flatnonzero(counts), packing)
        if not len(sets):
            break
        used, times = fit(counts.astype(float), sets, packing)
        whole = np.rint(times).astype(np.int64)
        for j in np.argsort(-whole, kind="stable").tolist():
            row = Counter(x for x in sets[used[j]].tolist() if x)
            number = min(int(whole[j]), *(int(counts[x]) // k for x, k in row.items()))
            if number > 0:
                out.add(list(row.elements()), number)
                for x, k in row.items():
                    counts[x] -= k * number
        if not whole.any():
            break
    for lengths, number in best_fit(counts, packing.capacity):
        out.add(lengths, number)
    return out


@dataclass(frozen=True)
class Tokens:
    """A byte-level vocabulary: the content of its file, as the tokenizers library writes it."""

    content: bytes

    @classmethod
    def load(cls, path: str) -> Tokens:
        with open(path, "rb") as file:
            return cls(file.read())

    def encoding(self) -> tiktoken.Encoding:
        return _encoding(self.content)

    def ids(self, text: str) -> np.ndarray:
        """The ids the tokenizers library gives without adding special ones; strings of special tokens count as these."""
        return self.encoding().encode_to_numpy(text, allowed_special="all")


@functools.lru_cache(maxsize=2)
def _encoding(content: bytes) -> tiktoken.Encoding:
    """Merges in order of their ids. A byte that prints stands for itself in the file, the others for 256 and on."""
    parsed = json.loads(content)
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in prints}
    byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(prints)))}
    special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in parsed["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


def pieces(docs: DataFrame, tokens: Tokens, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length and ids (unsigned 32-bit numbers, little-endian) of every piece of every row.

    A text (null: empty) is its ids and the id `end` after them, so every row has a piece. Only a longer one is
    cut, into pieces of `capacity` and a first one of what remains. Repeated rows and null ids stay; other
    columns are not read.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            owner, piece, start, length, data = [], [], [], [], []
            held = 0

            def batch() -> pa.RecordBatch:
                columns = [part.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary())]
                return pa.record_batch(columns, schema.names)

            for row, text in enumerate(part.column(1)):
                ids = np.append(tokens.ids(text.as_py() or ""), np.uint32(end)).astype("<u4")
                edges = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
                for number, (a, b) in enumerate(zip(edges, edges[1:])):
                    owner.append(row)
                    piece.append(number)
                    start.append(a)
                    length.append(b - a)
                    data.append(ids[a:b].tobytes())
                    held += 4 * (b - a)
                    if held > HANDED:
                        yield batch()
                        for column in (owner, piece, start, length, data):
                            column.clear()
                        held = 0
            if owner:
                yield batch()

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(found: DataFrame, packing: Packing = Packing()) -> DataFrame:
    """Every row of `found` with its sequence_id and offset; `length` says how much room a row takes.

    The rows of a sequence lie one after the other from 0. Lengths outside 1 to the capacity, nulls among them,
    raise. Columns named sequence_id and offset are replaced, all others stay; repeated rows get places of
    their own.
    """
    spark = found.sparkSession
    own = [name for name in found.columns if name not in ("sequence_id", "offset")]
    rows = found.select(F.struct(*(F.col(f"`{name}`") for name in own)).alias("_row"), F.col("length").cast("long").alias("_length"))
    rows = cut_lineage(rows.withColumn("_place", F.monotonically_increasing_id()))
    fits = f"IF(_length BETWEEN 1 AND {packing.capacity}, _length, NULL)"
    counted = {r["n"]: r["count"] for r in rows.groupBy(F.expr(fits).alias("n")).count().collect()}
    if None in counted:
        raise ValueError(f"{counted[None]} rows have no length from 1 to {packing.capacity}")
    length, first, each, sequence, place = plan(counted, packing).columns()
    key = (length << 42) + first

    @F.arrow_udf("struct<sequence_id long, offset long>")
    def put(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lengths, numbers in parts:
            length, number = lengths.to_numpy(), numbers.to_numpy()
            entry = np.searchsorted(key, (length << 42) + number, side="right") - 1
            nth = number - (key[entry] & ((1 << 42) - 1))
            columns = [sequence[entry] + nth // each[entry], place[entry] + nth % each[entry] * length]
            yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in columns], ["sequence_id", "offset"])

    groups = [(length, number // packing.numbered + 1) for length, number in counted.items()]
    # One row for each length at most, whatever the number of pieces.
    groups = F.broadcast(spark.createDataFrame(groups, "_length long, _groups long"))
    dealt = rows.join(groups, "_length").withColumn("_group", F.expr("pmod(xxhash64(_place), _groups)"))
    sizes = dealt.groupBy("_length", "_group").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("_length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_length", "_group", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_length", "_group").orderBy("_place"))
    numbered = dealt.withColumn("_inside", inside).join(sizes, ["_length", "_group"])
    placed = numbered.select("_row", put("_length", F.expr("_before + _inside - 1")).alias("_put"))
    return placed.select(*(F.col("_row")[name].alias(name) for name in own), "_put.sequence_id", "_put.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of a whole sequence, from packed pieces with their ids; at most the capacity of each."""
    parts = F.expr("array_sort(collect_list(struct(offset, ids)))")
    whole = "aggregate(parts, CAST('' AS BINARY), (held, p) -> concat(held, p.ids))"
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.expr(whole).alias("ids"))
