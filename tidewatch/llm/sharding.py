"""Shards from a weighted hash tree: regions hold racks, racks hold shards.

A row descends from the root. At each level every child draws `-ln(u) / weight`, where `u` in (0, 1)
comes from a hash of the row's key and the child's name, and the smallest draw wins, so a child gets
its share of the weights below the parent. Raising one child's weight only moves rows into it, and
only parents whose weights change are affected: a shard added in a region of its own takes rows into
itself alone; one added to an existing rack also shifts rows inside the racks and regions above it.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import literal


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """Shards with their places. Weights of racks and regions are the sums below them."""

    leaves: tuple[Leaf, ...]

    def __post_init__(self) -> None:
        if not self.leaves or min(leaf.weight for leaf in self.leaves) <= 0:
            raise ValueError("a tree needs shards of positive weight")
        if len({leaf.shard for leaf in self.leaves}) < len(self.leaves):
            raise ValueError("a shard has one place")

    def children(self) -> dict[str, dict[str, float]]:
        below: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
        for leaf in self.leaves:
            rack = f"{leaf.region}/{leaf.rack}"
            below[""][leaf.region] += leaf.weight
            below[leaf.region][rack] += leaf.weight
            below[rack][f"{rack}/{leaf.shard}"] += leaf.weight
        return below

    def grown(self, shard: int, weight: float = 1.0) -> Tree:
        """The tree with one more shard, in a region of its own."""
        return Tree((*self.leaves, Leaf(f"only-{shard}", "0", shard, weight)))


def even_tree(regions: int, racks: int, shards: int) -> Tree:
    """Regions x racks x shards of equal weight, numbered from 0."""
    return Tree(
        tuple(
            Leaf(str(region), str(rack), (region * racks + rack) * shards + shard)
            for region in range(regions)
            for rack in range(racks)
            for shard in range(shards)
        )
    )


def shard_of(key: str, tree: Tree) -> Column:
    """The shard of SQL expression `key`; a null key is a key like any other."""
    below = ", ".join(
        f"{literal(parent)}, array({', '.join(f'struct({literal(name)} AS name, {weight!r}D AS weight)' for name, weight in kids.items())})"
        for parent, kids in tree.children().items()
    )
    node = "''"
    for _ in range(3):
        draw = f"-ln((shiftrightunsigned(xxhash64({key}, c.name), 11) + 0.5D) / 9007199254740992D) / c.weight"
        node = f"array_min(transform(element_at(map({below}), {node}), c -> struct({draw} AS draw, c.name AS name))).name"
    return F.expr(f"CAST(element_at(split({node}, '/'), -1) AS INT)")


def assign(docs: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id") -> DataFrame:
    """Add `shard`, and `grown_shard` under the grown tree (else null). No shuffle."""
    return docs.withColumns(
        {"shard": shard_of(key, tree), "grown_shard": shard_of(key, grown) if grown else F.lit(None).cast("int")}
    )


def number(docs: DataFrame, tree: Tree, order: tuple[str, ...], buckets: int = 256, key: str = "doc_id") -> DataFrame:
    """Add `slot`: 0, 1, 2, ... without gaps inside each `shard`.

    Each shard is cut into `buckets` by a hash of the key; rows are numbered inside a bucket, and a
    bucket starts where the buckets before it end. The starts come from a pass over the key column
    alone and are at most shards x buckets rows, which bounds their broadcast. Rows that are equal in
    `order` get their numbers in any order.
    """
    bucket = F.expr(f"CAST(pmod(xxhash64({key}, 'bucket'), {int(buckets)}) AS INT)")
    counts = docs.select(shard_of(key, tree).alias("shard"), bucket.alias("_bucket")).groupBy("shard", "_bucket").count()
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(*order)
    return (
        docs.withColumn("_bucket", bucket)
        .withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "_bucket"])
        .withColumn("slot", F.expr("CAST(_start + _place - 1 AS BIGINT)"))
        .drop("_bucket", "_start", "_place")
    )


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard and slot of each document.

    A null text has no bytes and the checksum of none (0). Repeated rows share a shard and get slots of
    their own; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        "doc_id",
        F.expr("CAST(coalesce(octet_length(text), 0) + 16 AS BIGINT) AS size"),
        F.expr("coalesce(crc32(CAST(text AS BINARY)), 0L) AS text_crc32"),
    )
    return number(assign(rows, tree, grown), tree, ("doc_id", "text_crc32", "size"))
