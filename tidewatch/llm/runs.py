"""Periodic runs of words: stretches that repeat with a period, found while a suffix automaton reads the text.

The automaton takes one word at a time. Its suffix links form a tree; every node stands for phrases that
end at the same places. Nodes on the path of the newest prefix up to the root take the newest place as
their last occurrence, and the paths of equal last occurrence are kept as splay trees (link-cut access).
So an appended word meets a segment of the path for each earlier place that shares a longer phrase with
it: the lower end of the segment says how many words both places have in common, and the difference of
the places is the distance. A distance of no more than that many words is a square, and its words spread
to the run that has the distance as its smallest period. The number of segments met is within a
logarithm of the number of words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Shape:
    """The fewest words of a run; it also has twice its period at least."""

    least: int = 12

    @property
    def shared(self) -> int:
        """Words that the last place of a run and the one a period before it have in common at least."""
        return max((self.least + 1) // 2, 1)


def _raise(x: int, left: list[int], right: list[int], up: list[int], color: list[int]) -> None:
    """Splay x to the root of its path's tree; the last occurrence of the path moves with the root."""
    while True:
        p = up[x]
        if not p or (left[p] != x and right[p] != x):
            return
        g = up[p]
        on_left = left[p] == x
        top = not g or (left[g] != p and right[g] != p)
        if not top and (left[g] == p) == on_left:  # p goes above g before x goes above p
            if on_left:
                b = left[g] = right[p]
                right[p] = g
            else:
                b = right[g] = left[p]
                left[p] = g
            if b:
                up[b] = g
            gg = up[g]
            up[g] = p
            up[p] = gg
            if gg:
                if left[gg] == g:
                    left[gg] = p
                elif right[gg] == g:
                    right[gg] = p
                else:
                    color[p] = color[g]
            else:
                color[p] = color[g]
            g, top = gg, not gg or (left[gg] != p and right[gg] != p)
        if on_left:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b:
            up[b] = p
        up[p] = x
        up[x] = g
        if top:
            color[x] = color[p]
            return
        if left[g] == p:
            left[g] = x
        else:
            right[g] = x


def squares(words: list[int], shared: int = 1) -> Iterator[tuple[int, int, int]]:
    """(place, distance, words in common) of every segment an appended word meets that makes a square.

    Phrases of fewer than `shared` words are left out of the tree.
    """
    # Node 0 stands for no node and node 1 for the empty phrase.
    follow: list[dict[int, int]] = [{}, {}]
    size, link = [0, 0], [0, 0]
    left, right, up, color = [0, 0], [0, 0], [0, 0], [-1, -1]
    last = 1
    for place, word in enumerate(words):
        new = len(size)
        follow.append({})
        size.append(place + 1)
        left.append(0)
        right.append(0)
        up.append(0)
        color.append(place)
        p = last
        last = new
        while p and word not in follow[p]:
            follow[p][word] = new
            p = link[p]
        if not p:
            link.append(1)
            continue
        q = follow[p][word]
        long = size[p] + 1
        if size[q] == long:
            link.append(q)
        else:
            copy = new + 1
            link.append(copy)
            follow.append(follow[q].copy())
            size.append(long)
            link.append(link[q])
            link[q] = copy
            left.append(0)
            right.append(0)
            up.append(0)
            color.append(-1)
            while p and follow[p].get(word) == q:
                follow[p][word] = copy
                p = link[p]
            if long >= shared:  # the copy comes right above q, on the same path
                _raise(q, left, right, up, color)
                above = left[q]
                left[q] = copy
                up[copy] = q
                left[copy] = above
                if above:
                    up[above] = copy
            q = copy
        if long < shared:
            continue
        up[new] = q
        low = new
        while q:
            _raise(q, left, right, up, color)
            distance = place - color[q]
            if distance <= size[q]:
                yield place, distance, size[q]
            below = right[q]
            if below:
                color[below] = color[q]
            right[q] = low
            low = q
            q = up[q]
        color[low] = place


def runs_of(words: list[int], shape: Shape = Shape()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    found = []
    ends: dict[int, int] = {}  # of the latest run of a period
    n = len(words)
    for place, period, common in squares(words, shape.shared):
        if ends.get(period, -1) >= place:
            continue
        start = place - common - period + 1
        end = place + 1
        while end < n and words[end] == words[end - period]:
            end += 1
        ends[period] = end - 1
        if end - start >= shape.least:
            found.append((start, end - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those a run repeats after its first period."""
    if runs:
        steps = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            steps[start + period] += 1
            steps[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return b" ".join(words)


def find(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and collapsed of every row.

    Words are what white space (space, U+0009 to U+000D) parts; a null text has none. A text without runs is
    collapsed to its words joined by one space. Repeated rows and null ids stay; other columns are not read.
    A text is worked on as a whole, in memory of about 1 KB a word.
    """

    kind = docs.schema["doc_id"].dataType
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_words", T.LongType())])
    schema = schema.add("runs", T.ArrayType(run)).add("collapsed", T.StringType())

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, ends, flat, kept = [], [0], [], []
            for text in pc.cast(part.column(1), pa.binary()):
                words = (text.as_py() or b"").split()
                names: dict[bytes, int] = defaultdict(count().__next__)
                runs = runs_of([names[word] for word in words], shape)
                sizes.append(len(words))
                flat += runs
                ends.append(len(flat))
                kept.append(collapse(words, runs))
            columns = [pa.array(x, pa.int64()) for x in (zip(*flat) if flat else ((), (), ()))]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, run.names))
            yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), lists, pc.cast(pa.array(kept, pa.binary()), pa.string())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(search, schema)


def digest(found: DataFrame) -> DataFrame:
    """One row for each of `find`: the number of runs, the longest one, and digests of all runs and of the kept words."""
    rows = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'), '')"
    return found.withColumn("best", F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")).select(
        "doc_id",
        F.expr("CAST(size(runs) AS BIGINT) AS n_runs"),
        F.expr("-best.start AS start"),
        F.expr("best.length AS length"),
        F.expr("-best.period AS period"),
        F.expr("1000 * best.length DIV -best.period AS exponent_milli"),
        F.expr(f"sha2({rows}, 256) AS runs_sha256"),
        F.expr("sha2(collapsed, 256) AS collapsed_sha256"),
    )
