"""Toxicity after noisy-channel deobfuscation.

Words written in leetspeak, with spaced-out letters or with repeated ones become lattices of the letters
they may stand for. A character language model of the whole corpus scores the paths, Viterbi decoding
picks the likeliest restored word, and a word model learned from labelled documents scores the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.settings import cut_lineage

# Letters that digits and signs commonly stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
#: Letters of the language model: a to z, the Latin letters with accents, and one class for all others.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
OTHER, EDGE = len(LETTERS), len(LETTERS) + 1
SIZE = len(LETTERS) + 2
#: Letters that are counted at a time.
STEP = 1 << 20
_NUMBER = {c: i for i, c in enumerate(LETTERS)}

_PLAIN = re.compile(r"[^\W\d_]+")
_SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[ .\-_*][^\W_](?![^\W_])){2,}")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
#: Signs behind a word that are punctuation or noise, not letters.
_TAIL = re.compile(r"[$@|+(!]{2,}$|!+$")
#: Cost of reading a sign as the edge between two words. Of words spaced out in runs of twelve 34 % are found again at 0, 25 % at -1
#: and 28 % at 1 (sf0.01).
WORD_EDGE = 0.0
#: Tokens up to this length are remembered with what they were restored to; only the speed depends on it.
KEPT_LENGTH = 64
_LEETISH = re.compile("[" + re.escape("".join(LEET)) + "]")


@dataclass(frozen=True)
class Training:
    """What the word model is fitted on: at most `rows` labelled rows, those with the smallest hashes. A word or
    stem is a feature if it is in `support` labelled documents and `ratio` times likelier in toxic ones; of more
    than `features` the strongest stay, which bounds the model (it is broadcast). Of 1,064,647 words and stems in
    30,000 rows of the 0.51 GB check data 1,106 are features, so the bound leaves out none. `stems` are lengths
    of word beginnings.
    """

    rows: int = 30_000
    support: int = 8
    ratio: float = 8.0
    features: int = 20_000
    stems: tuple[int, ...] = (4, 5, 6, 7)
    rounds: int = 60


def char_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams, word edges included, over all words of all documents.

    Tasks count in a table of fixed size; Spark adds the tables up by trigram, so SIZE ** 3 numbers at most
    reach the driver.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(0x110000, OTHER, np.int32)
        for low, high in ((0, 65), (91, 97), (123, 170)):
            table[low:high] = EDGE
        for c, i in _NUMBER.items():
            table[ord(c)] = i
            if len(c.upper()) == 1:
                table[ord(c.upper())] = i
        total = np.zeros(SIZE**3, np.int64)
        for part in parts:
            joined = "\n\n".join(x for x in part.column(0).to_pylist() if x)
            codes = table[np.frombuffer(f"\n\n{joined}\n\n".encode("utf-32-le"), np.uint32)]
            for i in range(0, len(codes) - 2, STEP):
                a, b, c = (codes[i + k : min(i + k + STEP, len(codes) - 2 + k)] for k in range(3))
                total += np.bincount((a * SIZE + b) * SIZE + c, minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["gram", "n"])

    sums = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3)
    for row in sums.collect():
        counts[row["gram"]] = row["n"]
    return counts.reshape(SIZE, SIZE, SIZE)


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a letter after two, each order smoothed by the next lower."""
    one = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + SIZE)
    two = (counts.sum(axis=0) + 8 * one) / (counts.sum(axis=(0, 2))[:, None] + 8)
    three = (counts + 8 * two[None]) / (counts.sum(axis=2)[:, :, None] + 8)
    return np.log(three)


def restore(token: str, model: np.ndarray, edge: float | None = None) -> str:
    """The likeliest plain word behind a token, by Viterbi decoding of its lattice.

    Channel: a letter stands for itself; a repeated one may also be left out; a digit or sign stands for
    one of its letters or, at a cost, for nothing; any other sign stands for nothing or, with `edge` as its
    cost, for the edge between two words. The lattice has a few states a step, each with a link to its past,
    so a token may have any length.
    """
    states = {(EDGE, EDGE, ""): (0.0, None)}
    last = ""
    for c in token.lower():
        if c.isalpha():
            step = [(c, 0.0)] + ([("", -0.5)] if c == last else [])
        elif c in LEET:
            step = [(x, -0.7) for x in LEET[c]] + [("", -1.5)]
        else:
            step = [("", 0.0), (" ", edge)] if edge is not None else []
        last = c
        if not step:
            continue
        new: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}
        for (a, b, end), (score, past) in states.items():
            for c, cost in step:
                if c == " ":
                    if b == EDGE:
                        continue
                    at, value = (b, EDGE, c), (score + cost + model[a, b, EDGE], (past, c))
                elif c:
                    n = _NUMBER.get(c, OTHER)
                    at, value = (b, n, c), (score + cost + model[a, b, n], (past, c))
                else:
                    at, value = (a, b, end), (score + cost, past)
                if at not in new or value[0] > new[at][0]:
                    new[at] = value
        states = new
    past = max(((score if b == EDGE else score + model[a, b, EDGE], past) for (a, b, _), (score, past) in states.items()), key=lambda x: x[0])[1]
    letters = []
    while past:
        past, c = past
        letters.append(c)
    return "".join(reversed(letters)).strip()


def words_of(text: str | None, model: np.ndarray, known: dict[str, str]) -> set[str]:
    """Plain words of a text, and the restored ones of suspicious tokens."""
    text = (text or "").lower()
    found = set(_PLAIN.findall(text))
    odd = set()
    if _LEETISH.search(text):
        for token in set(text.split()):
            core = _TAIL.sub("", token.strip(".,;:?\"'"))
            if _LEETISH.search(core) and len(_PLAIN.sub("", core)) < len(core):
                odd.add(core)
    odd.update(m[0] for m in _SPACED.finditer(text))
    if _REPEATED.search(text):
        odd.update(w for w in found if _REPEATED.search(w))
    for token in odd:
        if len(token) < 3:
            continue
        restored = known.get(token)
        if restored is None:
            restored = [restore(token, model)]
            if any(not c.isalpha() and c not in LEET for c in token):
                restored += (w for w in restore(token, model, WORD_EDGE).split(" ") if len(w) > 2)
            if len(token) <= KEPT_LENGTH:
                if len(known) > 200_000:
                    known.clear()
                known[token] = restored
        found.update(restored)
    return found


def features_of(words: set[str], stems: tuple[int, ...]) -> set[str]:
    """The words, and their beginnings marked by a star."""
    return words | {w[:n] + "*" for w in words for n in stems if len(w) >= n}


def feature_counts(labelled: DataFrame, model: np.ndarray, training: Training) -> DataFrame:
    """feature, toxic and clean: labelled documents of either kind that have it. Each is counted once for a
    document, and summed in Spark; within a task a table is emptied when it is full.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}
        counts = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            names = list(counts[0].keys() | counts[1].keys())
            for i in range(0, len(names), 10_000):
                some = names[i : i + 10_000]
                columns = [pa.array(some), *(pa.array([c[x] for x in some], pa.int64()) for c in (counts[1], counts[0]))]
                yield pa.record_batch(columns, ["feature", "toxic", "clean"])
            for c in counts:
                c.clear()

        for part in parts:
            for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts[label].update(features_of(words_of(text, shared.value, known), training.stems))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield from flush()
        yield from flush()

    rows = labelled.select("text", F.col("label").cast("int")).mapInArrow(run, "feature string, toxic long, clean long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


@dataclass(frozen=True)
class WordModel:
    """Log odds of the features and the line that turns a text's strongest evidence into a probability."""

    odds: dict[str, float]
    stems: tuple[int, ...]
    slope: float
    offset: float

    def evidence(self, words: set[str]) -> float:
        """Log odds of the features found, each weighted by one over its rank, strongest first."""
        found = words & self.odds.keys()
        for n, some in self._by_length.items():
            found |= {w[:n] + "*" for w in words if w[:n] in some}
        hits = sorted((self.odds[f] for f in found), reverse=True)
        return sum(x / (i + 1) for i, x in enumerate(hits))

    @cached_property
    def _by_length(self) -> dict[int, set[str]]:
        stems = {n: {f[:-1] for f in self.odds if f[-1] == "*" and len(f) == n + 1} for n in self.stems}
        return {n: some for n, some in stems.items() if some}

    def score(self, words: set[str]) -> float:
        return 1 / (1 + math.exp(-max(min(self.slope * self.evidence(words) + self.offset, 30), -30)))


def train(labelled: DataFrame, model: np.ndarray, training: Training = Training()) -> WordModel:
    """Fit the word model on the rows of `labelled` (text, label). Without rows of both labels every text
    scores by the share of toxic ones, 0.5 for none.
    """
    total = labelled.groupBy("label").count().collect()
    n = {row["label"]: row["count"] for row in total}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return WordModel({}, training.stems, 0.0, 4.0 if toxic else -4.0 if clean else 0.0)
    counted = feature_counts(labelled, model, training)
    odds = F.expr(f"ln(((toxic + 0.1D) / {toxic + 1}) / ((clean + 0.5D) / {clean + 1}))")
    strong = counted.where(F.col("toxic") >= training.support).withColumn("odds", odds).where(F.col("odds") >= math.log(training.ratio))
    top = strong.orderBy(F.desc(F.expr("odds * sqrt(toxic)")), "feature").limit(training.features).collect()
    unfitted = WordModel({row["feature"]: row["odds"] for row in top}, training.stems, 1.0, 0.0)
    points = evidence_table(labelled, model, unfitted)
    slope, offset = fit_line(points, training.rounds)
    return WordModel(unfitted.odds, training.stems, slope, offset)


def evidence_table(labelled: DataFrame, model: np.ndarray, words: WordModel) -> list[tuple[float, int, int]]:
    """Evidence, rounded to a tenth, with the number of labelled documents of either kind: a bounded table."""
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast((model, words))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, own = shared.value
        known: dict[str, str] = {}
        for part in parts:
            found = [round(10 * own.evidence(words_of(t, lm, known))) for t in part.column(0).to_pylist()]
            yield pa.record_batch([pa.array(found, pa.int32()), part.column(1)], ["e", "label"])

    rows = labelled.select("text", F.col("label").cast("int")).mapInArrow(run, "e int, label int")
    rows = rows.groupBy("e").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    return sorted((row["e"] / 10, row["toxic"], row["clean"]) for row in rows.collect())


def fit_line(points: list[tuple[float, int, int]], rounds: int) -> tuple[float, float]:
    """Logistic regression of the label on the evidence, by Newton steps with a small ridge."""
    x = np.array([[p[0], 1.0] for p in points])
    pos, neg = (np.array([p[i] for p in points], float) for i in (1, 2))
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ ((pos + neg) * p - pos) + 0.01 * w
        hess = (x.T * ((pos + neg) * p * (1 - p))) @ x + 0.01 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(w[0]), float(w[1])


def score(text: Column, model: np.ndarray, words: WordModel, spark) -> Column:
    """Probability that a text is toxic. Null and empty texts have no words and score as texts without evidence."""
    shared = spark.sparkContext.broadcast((model, words))

    @F.arrow_udf("double")
    def udf(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lm, own = shared.value
        known: dict[str, str] = {}
        for texts in parts:
            yield pa.array([own.score(words_of(t, lm, known)) for t in texts.to_pylist()], pa.float64())

    return udf(text)


def score_documents(docs: DataFrame, labels: DataFrame, training: Training = Training()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Labels are learned only from rows whose crc32 of the id, as text, is not divisible by 5. A document
    with several label rows counts for each; rows without a label are scored alike. Repeated rows stay.
    """
    fold = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5"
    model = language_model(char_counts(docs))
    known = labels.where("toxic IS NOT NULL").where(f"{fold} <> 0").select("doc_id", F.expr("CAST(toxic > 0 AS INT) AS label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(training.rows)
    labelled = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label"))
    words = train(labelled, model, training)
    scored = docs.select("doc_id", F.expr(f"coalesce({fold} = 0, false) AS held_out"), score(F.col("text"), model, words, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", F.expr("CAST(score >= 0.5 AS INT)"))
