"""Runs, packed sequences and whitened embeddings against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import CLASHING, EDGES, documents
from tidewatch.llm import packing, queries, runs, whitening
from tidewatch.llm.common import text_settings


@pytest.fixture(autouse=True)
def batches(spark):
    text_settings(spark)


# Runs -----------------------------------------------------------------------------


def brute_runs(words, least=12):
    """Every stretch with a period that no neighbour extends, if the period is its smallest."""
    found = []
    n = len(words)
    for period in range(1, n // 2 + 1):
        i = period
        while i < n:
            if words[i] != words[i - period]:
                i += 1
                continue
            start = i - period
            while i < n and words[i] == words[i - period]:
                i += 1
            length = i - start
            smaller = any(all(words[start + k] == words[start + k - q] for k in range(q, length)) for q in range(1, period))
            if length >= max(least, 2 * period) and not smaller:
                found.append((start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(1, 14))
def test_runs_match_brute_force(words, least):
    assert runs.runs_of(words, runs.Shape(least)) == brute_runs(words, least)


def test_runs_of_repeating_texts_match_brute_force():
    draw = random.Random(4)
    for _ in range(400):
        words = [draw.randrange(draw.choice([1, 2, 3, 9])) for _ in range(draw.randrange(120))]
        for _ in range(draw.randrange(3)):  # some stretch repeats, perhaps around an earlier one
            start, period = draw.randrange(len(words) + 1), draw.randrange(1, 40)
            for i in range(start + period, min(start + period * draw.randrange(2, 6), len(words))):
                words[i] = words[i - period]
        assert runs.runs_of(words) == brute_runs(words)


def test_squares_tell_what_two_places_share():
    """The segment of the last earlier place that shares more words than the period covers is always met."""
    draw = random.Random(5)
    for _ in range(200):
        words = [draw.randrange(3) for _ in range(draw.randrange(40))]
        met = defaultdict(set)
        for place, distance, common in runs.squares(words):
            shared = 0
            while place - distance - shared >= 0 and words[place - shared] == words[place - distance - shared]:
                shared += 1
            assert shared == common >= distance
            met[place].add(distance)
        for start, length, period in brute_runs(words, 2):
            assert all(period in met[place] for place in range(start + 2 * period - 1, start + length))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected_digest(words):
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    row = (len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4))
    return (*row, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_of_runs_matches_brute_force(spark, tmp_path):
    draw = random.Random(6)
    texts = [t for t in EDGES if t is None or len(t) < 9000]
    texts += [" ".join(draw.choice("ab cd ef".split()) for _ in range(draw.randrange(60))) for _ in range(60)]
    texts += ["a b\x0bc d e f " * 9, "one two three four five six seven " * 2, *["x"] * 200]
    documents(spark, texts, extra=CLASHING).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.registered()["op11_suffix_runs"](spark, str(tmp_path)).collect()
    want = Counter((None if t is None and i % 2 else i, *expected_digest(planted(None if t is None and i % 2 else i, t))) for i, t in enumerate(texts))
    assert Counter(tuple(r) for r in rows) == want
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert list(rows[0].asDict()) == names
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 20


def test_runs_of_odd_tables(spark):
    docs = documents(spark, EDGES, extra=(*CLASHING, "runs", "r"))
    rows = {r["doc_id"]: r for r in runs.find(docs).collect()}
    assert [tuple(x) for x in rows[EDGES.index("word " * 3000)]["runs"]] == [(0, 3000, 1)]
    assert rows[EDGES.index("word " * 3000)]["collapsed"] == "word"
    assert rows[4]["n_words"] == 1 and rows[2]["collapsed"] == rows[3]["collapsed"] == ""
    assert runs.find(docs.union(docs)).count() == 2 * len(EDGES) and runs.find(docs.limit(0)).count() == 0
    assert runs.digest(runs.find(docs.limit(0))).count() == 0


# Packed sequences -----------------------------------------------------------------


def held(plan, counts):
    """The lengths of every sequence of a plan."""
    out = defaultdict(list)
    entries = sorted(plan.entries)
    for (length, first, each, sequence, place), after in zip(entries, [*entries[1:], None]):
        end = after[1] if after and after[0] == length else counts[length]
        for number in range(first, end):
            out[sequence + (number - first) // each].append((place + (number - first) % each * length, length))
    return out


def gapless(sequences, capacity):
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.sampled_from([1, 2, 3, 4]))
def test_plans_hold_every_piece_once(lengths, depth):
    counts = Counter(lengths)
    made = packing.plan(counts, packing.Packing(capacity=40, depth=depth))
    sequences = held(made, counts)
    assert Counter(x for parts in sequences.values() for _, x in parts) == counts
    assert set(sequences) == set(range(made.sequences))
    gapless(sequences, 40)
    assert made.sequences <= sum(times for _, times in packing.best_fit(np.bincount(lengths, minlength=41), 40)) + 1


def test_patterns_are_all_sets_that_fill_a_sequence():
    lengths = np.array([1, 2, 3, 5, 8, 12])
    for depth in (1, 2, 3, 4):
        got = Counter(tuple(x for x in row if x) for row in packing.patterns(lengths, packing.Packing(capacity=12, depth=depth)).tolist())
        grown = {()}
        want = set()
        for _ in range(depth):
            grown = {(*some, x) for some in grown for x in lengths.tolist() if not some or x <= some[-1]}
            want |= {some for some in grown if sum(some) == 12}
        assert got == Counter(want)


def test_fit_is_the_least_squares_of_nonnegative_counts():
    """No single pattern's count can be changed to lessen the misfit."""
    draw = np.random.default_rng(3)
    shape = packing.Packing(capacity=60, sweeps=400, steps=200, looked=10_000)
    counts = draw.integers(0, 50, 61).astype(float)
    counts[0] = 0
    sets = packing.patterns(np.flatnonzero(counts), shape)
    used, times = packing.fit(counts, sets, shape)
    assert (times >= 0).all()
    misfit = counts.copy()
    np.subtract.at(misfit, sets[used], times[:, None])
    misfit[0] = 0
    gain = misfit[sets].sum(axis=1)
    assert gain.max() < 0.1 and np.abs(gain[used][times > 0.01]).max() < 0.1


def test_plan_of_a_large_histogram_is_tight():
    draw = np.random.default_rng(9)
    lengths = np.minimum(draw.lognormal(6.3, 0.9, 40_000).astype(int) + 1, 2048)
    made = packing.plan(Counter(lengths.tolist()))
    assert made.sequences <= 1.001 * lengths.sum() / 2048 + 1


def test_packed_documents(spark, tmp_path):
    library = Tokenizer.from_file(queries.TOKENS)
    draw = random.Random(12)
    words = "tide watch order late ware house 12 % é 日本 😀 <|endoftext|>".split()
    texts = [*EDGES, *(" ".join(draw.choice(words) for _ in range(draw.randrange(900))) for _ in range(80)), *["same text"] * 50, " \n " * 5000]
    docs = documents(spark, texts, extra=(*CLASHING, "piece", "offset", "length"))
    tokens = packing.Tokens.load(queries.TOKENS)
    cut = packing.pieces(docs, tokens, 256)
    packed = packing.pack(cut.withColumn("offset", packing.F.lit("old")), packing.Packing(capacity=256, numbered=7))
    rows = packed.collect()
    want = Counter()
    for i, t in enumerate(texts):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % 256 + 1
        edges = [0, *range(first, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[None if t is None and i % 2 else i, k, a, b - a, ids[a:b].tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    gapless(sequences, 256)
    assert len(sequences) <= math.ceil(sum(r["length"] for r in rows) / 256) + 2
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    again = defaultdict(bytes)
    for r in sorted(packed.collect(), key=lambda r: r["offset"]):
        again[r["sequence_id"]] += bytes(r["ids"])
    assert sorted(map(len, whole.values())) == sorted(map(len, again.values()))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.registered()["op12_pattern_packing"](spark, str(tmp_path))
    assert found.columns == "doc_id piece start length ids_crc32 sequence_id offset".split()
    row = found.where(f"doc_id = {texts.index('same text')}").first()
    assert row["ids_crc32"] == zlib.crc32(np.array([*library.encode("same text").ids, 0], "<u4").tobytes())


def test_packing_of_odd_tables(spark):
    docs = documents(spark, EDGES).limit(0)
    tokens = packing.Tokens.load(queries.TOKENS)
    assert packing.pack(packing.pieces(docs, tokens)).count() == 0
    for bad in (0, 2049, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad), (2, 5)], "a int, length long"))
    extra = spark.createDataFrame([(i, 7 + i % 3, "x", 1.5) for i in range(50)], "`a.b` int, length int, _row string, _place double")
    got = packing.pack(extra)
    assert got.columns == ["a.b", "length", "_row", "_place", "sequence_id", "offset"] and got.count() == 50


# Whitened embeddings --------------------------------------------------------------


def exact_covariance(x):
    n = len(x)
    sums = x.sum(axis=0)
    apart = [[n * int(v) - int(s) for v, s in zip(row, sums)] for row in x]
    dims = x.shape[1]
    return np.array([[float(Fraction(sum(r[i] * r[j] for r in apart), n**3)) for j in range(dims)] for i in range(dims)]), apart


def test_whitened_rows_match_exact_sums(spark, tmp_path):
    draw = np.random.default_rng(1)
    base = draw.normal(0, 1, (60, 40)) * np.linspace(0.1, 9, 40) + draw.normal(0, 50, 40)
    vectors = base.astype(np.float32).tolist()
    bad = [None, [None] * 40, [float("nan")] * 40, [1.0] * 39 + [float("inf")], [1.0] * 39 + [None]]
    rows = [(i if i % 9 else None, v, 0) for i, v in enumerate([*vectors, vectors[3], *bad, vectors[3]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened int")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.registered()["op13_refined_whitening"](spark, str(tmp_path)).collect()
    x = np.floor(64 * np.array([*vectors, vectors[3], vectors[3]], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n = len(x)
    covariance, apart = exact_covariance(x)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:32]
    values, axes = values[order], axes[:, order]
    assert len(got) == 32 * n and {r["n"] for r in got} == {n}
    deviations = Counter(sum(v * v for v in r) for r in apart)
    assert Counter(r["deviation"] for r in got) == Counter({k: 32 * v for k, v in deviations.items()})
    for k in range(32):
        some = [r for r in got if r["component"] == k + 1]
        assert all(abs(r["explained"] / (values[k] / np.trace(covariance)) - 1) < 1e-9 for r in some)
        mine = np.array(sorted(r["whitened"] for r in some))
        want = np.array(apart, float) / n @ axes[:, k] / np.sqrt(values[k])
        assert min(np.abs(mine - np.sort(w)).max() for w in (want, -want)) < 1e-7
    by_row = np.zeros((n, 32))
    whole = whitening.whiten(table, whitening.fit(table)).collect()
    assert whole[0].asDict().keys() == {"vec_id", "embedding", "whitened", "deviation"}
    by_row = np.array([r["whitened"] for r in whole])
    spread = np.abs(by_row.T @ by_row / n - np.eye(32)).max()
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and abs(errors.pop() - spread) < 1e-9 and spread < 1e-9


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "tiny", "flat"])
def test_eigenvectors_are_refined(kind):
    draw = np.random.default_rng(7)
    size = 64
    axes = np.linalg.qr(draw.normal(size=(size, size)))[0]
    values = {
        "spread": 10.0 ** np.linspace(3, -3, size),
        "clusters": np.repeat([9.0, 4.0, 1.0, 0.5], 16) + np.tile(np.arange(16) * 1e-9, 4),
        "equal": np.repeat([5.0, 2.0], 32),
        "tiny": np.repeat([1e-30, 3e-30], 32) * (1 + 1e-6 * np.arange(64)),
        "flat": np.zeros(size),
    }[kind]
    matrix = (axes * values) @ axes.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.eigenvectors(matrix)
    scale = max(values.max(), 1e-300)
    assert (np.diff(got) <= 0).all() and np.abs(np.sort(got) - np.sort(values)).max() < 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-15 * 8
    wide = matrix.astype(np.longdouble)
    assert np.abs(wide @ vectors - vectors * got).max() < 1e-15 * 8 * scale
    inside = np.abs(vectors.T.astype(np.longdouble) @ wide @ vectors)
    assert (inside - np.diag(np.diag(inside))).max() < 1e-15 * 8 * scale


def test_clustered_vectors_are_as_exact_as_the_gaps_allow():
    """Against a solution with many digits: a small matrix of exact clusters, turned by an exact rotation."""
    third = np.longdouble(1) / 3
    house = np.eye(9, dtype=np.longdouble) - 2 * np.full((9, 9), third * third, np.longdouble)  # a reflection
    values = np.array([4, 4 + 2.0**-30, 4 + 2.0**-29, 1, 1 + 2.0**-28, 0.5, 0.25, 0.25 + 2.0**-31, 0.125], np.longdouble)
    matrix = (house * values @ house.T).astype(np.float64)
    got, vectors = whitening.eigenvectors(matrix)
    order = np.argsort(-values.astype(float), kind="stable")
    apart = 1 - np.abs((house[:, order] * vectors).sum(axis=0))
    assert apart.max() < 1e-12 and np.abs(got - values[order].astype(float)).max() < 1e-15 * 8


def test_whitening_of_odd_tables(spark):
    shape = "vec_id long, embedding array<float>"
    assert whitening.fit(spark.createDataFrame([], shape)) is None
    assert whitening.fit(spark.createDataFrame([(1, None), (2, [float("nan")])], shape)) is None
    equal = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(9)], shape)
    found = whitening.fit(equal)
    assert found.n == 9 and not len(found.values)
    assert [(r["deviation"], r["whitened"]) for r in whitening.whiten(equal, found).collect()] == [(0, [])] * 9
    with pytest.raises(ValueError):
        whitening.fit(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], shape))
    line = spark.createDataFrame([(i, [1.0 * i, 2.0 * i, 0.0]) for i in range(9)], shape)
    found = whitening.fit(line)
    assert len(found.values) == 1 and found.error < 1e-9 and abs(found.explained[0] - 1) < 1e-12
    empty = whitening.fit(spark.createDataFrame([(1, [])], shape))
    assert empty.n == 1 and not len(empty.values)
    far = spark.createDataFrame([(i, [float(2**40) * i, 1.0]) for i in range(5)], shape)
    assert [r["deviation"] for r in whitening.whiten(far, whitening.fit(far)).collect()] == [None] * 2 + [0] + [None] * 2
