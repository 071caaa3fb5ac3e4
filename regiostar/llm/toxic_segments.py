"""Toxicity by maximum-scoring segments.

Training. A bounded sample of labelled documents (``SAMPLE`` rows, the smallest hashes of their ids) gives document
counts of features per class. Features of a word are its prefixes of ``PREFIXES`` characters and the whole word; the
block rate of a feature has a Beta prior (a Dirichlet prior over two classes) centred on the rate of the next shorter
prefix, the shortest on the overall rate. A word's log-odds are those of its longest known feature; a constant is
subtracted, so that ordinary text scores below zero. The model keeps only features that matter: those whose chain of
prefixes shows evidence.

Scoring. One linear pass per document finds every maximal scoring segment: positive words are rare, so the scan runs
over them and the ordinary words between two of them count as a gap with a fixed cost. Segments are calibrated by
extreme-value statistics: with lambda the root of sum p(s) exp(lambda s) = 1 over the scores of clean text and K
fitted on clean documents of the calibration share, a segment of score S in n words has an expected number
K n exp(-lambda S) of equals by chance. A passage is significant up to ``SIGNIFICANT``. The document's score is the
share of toxic documents among calibration documents of like evidence, by isotonic regression.

Defined results: null and empty texts score as texts without evidence; labels with null ids or null values are not
used, repeated labels of a document count as toxic if one is; without any labelled rows all scores are 0; an empty table gives an
empty result; other columns, clashing names of the label table included, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import WORD, crc_class, small_batches, words
from regiostar.session import materialize

SAMPLE = 40_000
CALIBRATION = 3  # one of so many sampled documents calibrates, the others give counts
PREFIXES = (3, 4, 5, 6, 7)
PRIOR = 4.0
LEAST_COUNT = 3
EVIDENCE = 1.0
DRIFT = 0.05
SIGNIFICANT = 0.01
THRESHOLD = 0.3
HELD_OUT = 2
FEATURES_HELD = 200_000
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


def features(word: str) -> list[str]:
    """From general to special; the whole word ends with a mark."""
    return [word[:k] for k in PREFIXES if len(word) >= k] + [word + "$"]


@dataclass
class Model:
    """Log-odds of features, the extreme-value parameters, and scores by evidence."""

    odds: dict[str, float] = field(default_factory=dict)
    rate: float = 0.0
    lam: float = 1.0
    log_k: float = 0.0
    evidence: list[float] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)

    def score_of(self, evidence: float) -> float:
        return float(np.interp(evidence, self.evidence, self.scores)) if self.evidence else 0.0


class WordScores(dict):
    """Scores of words, remembered up to a bound."""

    def __init__(self, odds: dict[str, float], limit: int = 400_000):
        super().__init__()
        self.odds, self.limit = odds, limit

    def __missing__(self, word: str) -> float:
        if len(self) > self.limit:
            self.clear()
        found = 0.0
        for feature in features(word):
            found = self.odds.get(feature, found)
        self[word] = value = found - DRIFT if found >= EVIDENCE else -DRIFT
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) of a sequence, in linear time.

    Only positive items can start or end a segment, so runs of others are jumped over by their sum. Each stack entry
    is a candidate with the cumulative sums before its start and at its end.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    after = np.cumsum(scores)
    stack: list[list] = []  # first, last, sum before, sum after, index of the nearest entry that starts lower
    for place, right in zip(places.tolist(), after[places].tolist(), strict=True):
        entry = [place, place, right - float(scores[place]), right]
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= entry[2]:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= entry[3]:
                stack.append([*entry, at])
                break
            entry = [stack[at][0], entry[1], stack[at][2], entry[3]]
            del stack[at:]
            at -= 1
    return [(a, b + 1, right - left) for a, b, left, right, _ in stack]


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic, part of at most ``sample`` labelled documents outside the held-out class; part 0 calibrates."""
    known = labels.select(F.col("doc_id").alias("label_id"), "toxic").where("label_id is not null and toxic is not null")
    known = known.where(crc_class(F.col("label_id")) != HELD_OUT).groupBy("label_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)  # bounded, so it may be broadcast
    part = F.pmod(F.xxhash64(F.lit(5), "label_id"), F.lit(CALIBRATION)).alias("part")
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    return materialize(joined.select("text", "toxic", part), "toxic-sample")


def feature_counts(sample: DataFrame) -> DataFrame:
    """feature, toxic and clean documents that have it; tasks count their own rows first, a bounded number at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            keys = list(held[0].keys() | held[1].keys())
            out = pa.RecordBatch.from_pydict({"feature": keys, "toxic": [held[1][k] for k in keys], "clean": [held[0][k] for k in keys]})
            held[0].clear()
            held[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held[int(toxic > 0)].update({f for w in set(words(text.as_py())) for f in features(w)})
                if len(held[0]) + len(held[1]) > FEATURES_HELD:
                    yield flush()
        if held[0] or held[1]:
            yield flush()

    counted = sample.select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fitted_odds(counts: list[tuple[str, int, int]], rate: float) -> dict[str, float]:
    """Smoothed log-odds against the overall rate, from short features to long ones; kept where evidence is near."""
    base = math.log(rate / (1 - rate))
    known: dict[str, float] = {}
    odds: dict[str, float] = {}
    for feature, toxic, clean in sorted(counts, key=lambda c: (c[0].endswith("$"), len(c[0]))):
        word = feature.removesuffix("$")
        chain = [f for f in features(word) if f != feature and len(f) < len(feature) and f in known] if feature.endswith("$") else [word[:k] for k in PREFIXES if k < len(word) and word[:k] in known]
        towards = known[chain[-1]] if chain else rate
        known[feature] = p = min(1 - 1e-6, max(1e-6, (toxic + PRIOR * towards) / (toxic + clean + PRIOR)))
        value = math.log(p / (1 - p)) - base
        if value >= EVIDENCE or any(f in odds for f in chain):
            odds[feature] = value
    return odds


def _lambda(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1."""
    p = counts / counts.sum()
    if not (scores > 0).any() or (p * scores).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * scores, 600))).sum() < 1 and high < 50:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * scores, 600))).sum() < 1 else (low, middle)
    return max(low, 0.05)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Rising step means of y over x (pool adjacent violators), as knots for interpolation."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first x, last x
    values, starts = np.unique(x[order], return_index=True)
    sums = np.add.reduceat(y[order], starts)
    sizes = np.diff(np.append(starts, len(x)))
    for v, s, n in zip(values.tolist(), sums.tolist(), sizes.tolist(), strict=True):
        blocks.append([s, n, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], last]
    knots, means = [], []
    for s, n, first, last in blocks:
        for at in dict.fromkeys((first, last)):
            knots.append(at)
            means.append((s + 0.5 * y.mean()) / (n + 0.5))
    return knots, np.maximum.accumulate(means).tolist() if means else []


def _evidence(model: Model, n: int, best: float) -> float:
    """Log of how unlikely the best segment is by chance; 0 without a segment."""
    return max(0.0, model.lam * best - model.log_k - math.log(max(n, 1))) + 1.0 if best > 0 else 0.0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    small_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, sample)
    size = rows.where("part <> 0").agg(F.count("*"), F.sum((F.col("toxic") > 0).cast("int"))).first()
    if not size[0] or not size[1] or size[1] == size[0]:
        return Model()
    rate = size[1] / size[0]
    counts = feature_counts(rows.where("part <> 0")).where(F.col("toxic") + F.col("clean") >= LEAST_COUNT)
    model = Model(odds=fitted_odds([tuple(r) for r in counts.toArrow().to_pandas().itertuples(index=False, name=None)], rate), rate=rate)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model.odds)
        for batch in batches:
            out = {"toxic": batch.column(1), "n": [], "best": [], "positive": []}
            for text in batch.column(0):
                scores = np.array([known[w] for w in words(text.as_py())])
                out["n"].append(len(scores))
                out["best"].append(max((s for _, _, s in segments(scores)), default=0.0))
                out["positive"].append(scores[scores > 0].round(1).tolist() if len(scores) else [])
            yield pa.RecordBatch.from_arrays([out["toxic"], pa.array(out["n"], pa.int64()), pa.array(out["best"], pa.float64()), pa.array(out["positive"], pa.list_(pa.float64()))], ["toxic", "n", "best", "positive"])

    seen = rows.where("part = 0").select("text", "toxic").mapInArrow(measure, "toxic int, n long, best double, positive array<double>").toArrow().to_pandas()
    if not len(seen):
        return Model()
    clean = seen[seen.toxic <= 0]
    positive = Counter(x for found in clean.positive for x in found)
    ordinary = int(clean.n.sum()) - sum(positive.values())
    values = np.array([-DRIFT, *positive], float)
    model.lam = _lambda(values, np.array([max(ordinary, 1), *positive.values()], float))
    hit = clean[clean.best > 0]
    if len(hit):
        model.log_k = float((model.lam * hit.best - np.log(hit.n.clip(lower=1))).mean()) - 0.5772156649
    evidence = np.array([_evidence(model, n, s) for n, s in zip(seen.n, seen.best, strict=True)])
    model.evidence, model.scores = isotonic(evidence, (seen.toxic > 0).to_numpy(float))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` that are read here, doc_id and text, replaced by: doc_id, score, passages.

    A passage is [start, end) in characters of the text, with its score and the number of equals expected by chance.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model.odds)
        lookup = known.__getitem__
        for batch in batches:
            scores, passages = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = words(text)
                weights = np.fromiter(map(lookup, found), float, len(found))
                parts = segments(weights)
                scores.append(model.score_of(_evidence(model, len(found), max((s for _, _, s in parts), default=0.0))))
                expected = [(a, b, s, math.exp(min(50.0, model.log_k + math.log(len(found)) - model.lam * s))) for a, b, s in parts]
                passages.append(_spans(text, found, [x for x in expected if x[3] <= SIGNIFICANT]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, f"doc_id long, score double, passages {PASSAGES}")


def _spans(text: str, found: list[str], parts: list[tuple[int, int, float, float]]) -> list[dict]:
    if not parts:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    if len(places) != len(found):  # lower-casing changed the number of words; offsets then cover the text
        return [{"start": 0, "end": len(text), "score": s, "expected": e} for _, _, s, e in parts]
    return [{"start": places[a][0], "end": places[b - 1][1], "score": s, "expected": e} for a, b, s, e in parts]


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, passages of every document."""
    found = scored(docs, fit(docs, labels, sample))
    held_out = F.coalesce(crc_class(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were."""
    model, place = fit(docs, labels, sample), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model.odds)
        for batch in batches:
            clean = []
            for value in batch.column(place):
                weights = np.array([known[w] for w in words(value.as_py())])
                best = max((s for _, _, s in segments(weights)), default=0.0)
                clean.append(model.score_of(_evidence(model, len(weights), best)) < threshold)
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
