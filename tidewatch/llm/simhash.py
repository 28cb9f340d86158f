"""SimHash fingerprints, their links within a few bits, and one document per linked group.

Fingerprints within `radius` bits agree on at least `blocks - radius` of `blocks` bit blocks, so every
choice of that many blocks deals the distinct fingerprints out to small groups that share those bits. In
a task the rows come sorted by group and Gray rank, in which neighbours differ in few bits. Each group is
indexed bottom up: sixteen neighbours form a node that holds the bit pattern they share, sixteen nodes
form the node above. Two nodes whose shared patterns already differ in more than `radius` bits are pruned
with all below them, and so are two below which all is in one component by now; so a dense group costs
less than all its pairs. Links are joined to stars inside the task, which leave as many rows as a group has
members.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import cut_lineage

FANOUT = 16
#: Node pairs that are compared at a time; only memory depends on it.
STEP = 1 << 17
#: Shingles whose bits are unpacked at a time.
BITS_STEP = 1 << 15
#: Links of a node that share a home while components are found, about.
HOME = 512


@dataclass(frozen=True)
class Sketch:
    """`words` per shingle, the hash seed, and the bits linked fingerprints may differ in."""

    words: int = 3
    seed: int = 42
    radius: int = 2
    blocks: int = 6

    def masks(self) -> list[int]:
        """A mask of shared bits for every choice of blocks, as signed 64-bit numbers."""
        edges = [round(i * 64 / self.blocks) for i in range(self.blocks + 1)]
        block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(self.blocks)]
        found = [sum(some) for some in combinations(block, self.blocks - self.radius)]
        return [mask - (1 << 64) if mask >> 63 else mask for mask in found]


def shingle_hashes(text: bytes | None, size: int, seed: int) -> bytes:
    """64-bit hashes of all shingles, one after the other; a text of fewer words is one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return b""
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    n = max(len(words) - size + 1, 1)
    if n == 1:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    return b"".join([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())])


def fingerprint_of(text: bytes | None, sketch: Sketch) -> int:
    """The fingerprint as a signed number: bits set in over half of the shingles' hashes; 0 without words."""
    hashes = shingle_hashes(text, sketch.words, sketch.seed)
    n = len(hashes) // 8
    if not n:
        return 0
    raw = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    ones = sum(np.unpackbits(raw[i : i + BITS_STEP], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, n, BITS_STEP))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, sketch: Sketch = Sketch()) -> Column:
    @F.arrow_udf("long")
    def udf(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([fingerprint_of(t, sketch) for t in pc.cast(texts, pa.binary()).to_pylist()], pa.int64())

    return udf(text)


def gray_rank(fp: str) -> Column:
    """Place of a fingerprint in Gray order, as a signed number in the same order."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = f"transform(array({rank}), g -> g ^ shiftrightunsigned(g, {shift}))[0]"
    return F.expr(f"({rank}) ^ (-9223372036854775807L - 1L)")


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the smallest node of its component; the smallest itself has none."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for side in (u, v, label[u], label[v]):
            np.minimum.at(new, side, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


class Index:
    """All groups of sorted rows, each a tree of its own.

    `first[level]` is where a node's FANOUT children or fewer start on the level below, and `pattern[level]`
    has the bits, those of `mask[level]`, that all fingerprints below a node share.
    """

    def __init__(self, fp: np.ndarray, starts: np.ndarray) -> None:
        self.pattern, self.mask = [fp], [np.full(len(fp), ~np.uint64(0))]
        self.first: list[np.ndarray] = [np.zeros(0, np.int64)]
        sizes = np.diff(np.append(starts, len(fp)))
        while len(self.pattern[-1]) > len(sizes):
            pattern, mask = self.pattern[-1], self.mask[-1]
            place = np.arange(len(pattern)) - np.repeat(np.cumsum(sizes) - sizes, sizes)  # in the group
            cuts = np.flatnonzero(place % FANOUT == 0)
            lead = np.repeat(pattern[cuts], np.diff(np.append(cuts, len(pattern))))
            shared = np.bitwise_and.reduceat(mask & ~(pattern ^ lead), cuts)
            self.first.append(np.append(cuts, len(pattern)))
            self.pattern.append(pattern[cuts] & shared)
            self.mask.append(shared)
            sizes = -(-sizes // FANOUT)

    def ranges(self, a: np.ndarray, b: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Smallest and largest component under every node, where `a` are the rows whose components are `b`."""
        label = np.arange(len(self.pattern[0]))
        label[a] = b
        low, high = [label], [label]
        for first in self.first[1:]:
            low.append(np.minimum.reduceat(low[-1], first[:-1]))
            high.append(np.maximum.reduceat(high[-1], first[:-1]))
        return low, high

    def links(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of one group within `radius` bits of each other, all pairs or a chain between them."""
        if len(self.first) == 1:
            return self.first[0], self.first[0]
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        low, high = self.ranges(left[0], right[0])
        roots = np.arange(len(self.pattern[-1]))
        open_pairs = [(len(self.first) - 1, roots, roots)]
        kids = np.arange(FANOUT)
        while open_pairs:
            level, i, j = open_pairs.pop()
            pattern, mask = self.pattern[level], self.mask[level]
            joined = (low[level][i] == high[level][i]) & (low[level][j] == high[level][j]) & (low[level][i] == low[level][j])
            near = ~joined & (bits((pattern[i] ^ pattern[j]) & mask[i] & mask[j]) <= radius)
            i, j = i[near], j[near]
            if level == 0:
                left.append(i)
                right.append(j)
                if sum(map(len, left)) > STEP:
                    a, b = stars(np.concatenate(left), np.concatenate(right))
                    left, right = [a], [b]
                    low, high = self.ranges(a, b)
                continue
            some = STEP // FANOUT**2
            if len(i) > some:
                open_pairs.append((level, i[some:], j[some:]))
            i, j, first = i[:some], j[:some], self.first[level]
            x, y = first[i, None] + np.repeat(kids, FANOUT), first[j, None] + np.tile(kids, FANOUT)
            there = (x < first[i + 1, None]) & (y < first[j + 1, None]) & ((x < y) | ((level > 1) & (x == y)))
            open_pairs.append((level - 1, x[there], y[there]))
        return np.concatenate(left), np.concatenate(right)


def group_links(table: np.ndarray, group: np.ndarray, fp: np.ndarray, sketch: Sketch) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of fingerprints, as signed numbers, for the groups in sorted rows; a group of one has none."""
    starts = np.flatnonzero(np.append(True, (table[1:] != table[:-1]) | (group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(fp)))
    fp, sizes = fp[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
    a, b = Index(fp, np.cumsum(sizes) - sizes).links(sketch.radius)
    node = fp.view(np.int64)
    return stars(node[a], node[b])


def links(prints: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints linked within the radius.

    `prints` has distinct `fp`. A group of a sketch that deals by k bits has at most 2 ** (64 - k) of them.
    """
    masks = ", ".join(f"{mask}L" if mask > -(1 << 63) else "(-9223372036854775807L - 1L)" for mask in sketch.masks())
    dealt = (
        prints.select("fp", F.posexplode(F.expr(f"array({masks})")).alias("t", "mask"))
        .select("t", F.expr("fp & mask AS k"), "fp")
        .repartition("t", "k")
        .withColumn("rank", gray_rank("fp"))
        .sortWithinPartitions("t", "k", "rank")
        .drop("rank")
    )

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.int32, np.int64, np.uint64)
        held: list[list[np.ndarray]] = []

        def edges(cut: int | None = None) -> pa.RecordBatch:
            rows = [np.concatenate(x) for x in zip(*held)]
            cut = len(rows[0]) if cut is None else len(rows[0]) - cut
            held[:] = [[x[cut:].copy() for x in rows]]
            a, b = group_links(*(x[:cut] for x in rows), sketch)
            return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for part in parts:
            if not part.num_rows:
                continue
            last = [part.column(i).to_numpy().view(kind) for i, kind in enumerate(kinds)]
            held.append(last)
            changed = np.flatnonzero((last[0] != last[0][-1]) | (last[1] != last[1][-1]))
            if len(changed):  # else the group goes on
                yield edges(len(last[0]) - int(changed[-1]) - 1)
        if held:
            yield edges()

    return dealt.mapInArrow(find, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """fp -> root, the smallest fingerprint of its component, for those with an edge.

    Every round links each node to the smallest node it knows of, that node's other links to it, and
    whatever hangs on a node to that node's parent; it ends when no root hangs on another node. An edge
    goes to the homes of its ends, sorted so that a home meets its parents first and then what hangs on
    it, and needs only the smallest parent in memory. A hub has as many homes as its links need.
    """

    def relink(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = parent = last = None
        for part in parts:
            rows = []
            for v, salt, hangs, other in zip(*(part.column(i).to_pylist() for i in range(4))):
                if (v, salt) != home:
                    home, parent, last = (v, salt), None, None
                if (hangs, other) == last:
                    continue
                last = (hangs, other)
                if not hangs and parent is None:
                    parent = other
                    if not salt:
                        rows.append((v, other, False))
                elif not hangs:
                    if not salt:
                        rows.append((other, parent, True))
                elif parent is not None:
                    rows.append((other, parent, True))
            if rows:
                yield pa.record_batch([pa.array(x) for x in zip(*rows)], ["a", "b", "open"])

    homes = F.expr(
        "concat(transform(sequence(0, coalesce(own, 1) - 1), s -> struct(a AS v, s AS salt, false AS hangs, b AS other)), "
        "array(struct(b AS v, CAST(pmod(xxhash64(a), coalesce(far, 1)) AS INT) AS salt, true AS hangs, a AS other)))"
    )
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    while True:
        hubs = edges.groupBy("b").agg(F.count("*").alias("n")).where(f"n > {HOME}")
        hubs = hubs.select("b", F.expr(f"CAST(n DIV {HOME} + 1 AS INT) AS far"))
        known = edges.join(hubs.select(F.col("b").alias("a"), F.col("far").alias("own")), "a", "left").join(hubs, "b", "left")
        sent = known.select(F.explode(homes).alias("e")).select("e.*")
        dealt = sent.repartition("v", "salt").sortWithinPartitions("v", "salt", "hangs", "other")
        edges = cut_lineage(dealt.mapInArrow(relink, "a long, b long, open boolean"))
        if not edges.agg(F.max("open")).first()[0]:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def prints_of(docs: DataFrame, sketch: Sketch, *more: Column) -> DataFrame:
    """`more` columns with fp of every text; checkpointed, as it costs one pass over the texts."""
    return cut_lineage(docs.select(*more, fingerprint(F.col("text"), sketch).alias("fp")))


def grouped(distinct: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """`distinct` fingerprints with `root`, the same for all that are linked directly or by a chain."""
    roots = components(links(distinct.select("fp"), sketch))
    return distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id of the group) of every row.

    Texts without words, nulls among them, have fingerprint 0 and are linked like others. Repeated rows
    stay. A null doc_id is never a component's id, unless the group has no other.
    """
    prints = prints_of(docs, sketch, F.col("doc_id"))
    found = grouped(cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("low"))), sketch)
    least = found.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = found.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, sketch: Sketch = Sketch()) -> DataFrame:
    """One row of every group of `near_duplicates`, in the columns of `docs`: the smallest doc_id (nulls last),
    of equals the row with the smallest hash. Texts without words are one group, with those of fingerprints
    close to 0. Columns may have any name; the hash leaves out those of types that cannot be hashed.
    """
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    row_hash = F.xxhash64(*hashed)
    prints = prints_of(docs, sketch, F.col("doc_id"), row_hash.alias("_hash"))
    best = F.expr("min(struct(doc_id IS NULL AS late, doc_id, _hash)) AS best")
    groups = grouped(cut_lineage(prints.groupBy("fp").agg(best)), sketch)
    stay = groups.groupBy("root").agg(F.min("best").alias("best"))
    stay = stay.select(F.expr("coalesce(best.doc_id, 0L) AS _id"), F.expr("best._hash AS _hash")).distinct()
    packed = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"), F.expr("coalesce(doc_id, 0L) AS _id"), row_hash.alias("_hash"))
    kept = packed.join(stay, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"])
    return kept.select(*(F.col("_row")[name].alias(name) for name in docs.columns))
