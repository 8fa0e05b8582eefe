"""Operator 8: toxic passages as maximum-scoring segments.

Training counts the labelled documents of each class that hold a token (in Spark, over a bounded, documented
sample of labelled rows) and gives each the log-odds ratio of the classes under an informative
Dirichlet prior drawn from both classes together.  A token is counted as the word and as its longer
prefixes (once a document, so that bursts carry no weight); it scores as whichever of these has the most significant ratio.  Words without a significant
ratio cost a small constant, so that a text scores below zero on average.

A document is scanned once, in linear time, for all of its maximal-scoring segments (disjoint, as
defined by Ruzzo and Tompa).  Segment scores are brought to one scale by the extreme-value
(Karlin-Altschul) normalisation ``lambda * s - log(K * n)``; the best segment before and after it and the
number of significant ones feed a small logistic calibration fitted on the same sample.

Defined results: null and empty texts have no segment and get the calibrated score of "nothing
found"; repeated rows get equal scores; without labels of both classes every score is 0; labels that
are null are ignored; a document with labels of both kinds counts with each of them, and of several texts of one labelled
document the smallest is learned from; an empty table gives no rows; other columns are ignored (``keep_clean`` passes
them through).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import alone, crc32_of, kept_by, read

#: At most so many labelled rows are learned from (those with the smallest hashes).
SAMPLE_ROWS = 12_000
#: A token of the sample is scored if its log-odds ratio, standardised, is as large as this; nothing else decides.
SIGNIFICANT_Z = 4.0
#: Weight of the prior as a share of all tokens counted.
PRIOR_SHARE = 0.05
#: Lengths of the word prefixes that are counted beside whole words.
PREFIXES = (4, 5, 6, 7)
#: Words whose score one worker remembers.
CACHE_WORDS = 200_000
#: Normalised score from which a segment counts as significant: -log of its expected number by chance.
SIGNIFICANT_SEGMENT = 3.0

#: Largest scale of the extreme-value law (reached where toxic tokens never stand in clean texts).
MOST_LAMBDA = 4.0
#: Random walks, and their steps, that the size of that law is taken from.
WALKS, WALK_STEPS = 4000, 2000
#: Segment scores above this are equally certain.
SATURATED = 12.0

TOKEN = r"[^\W_]+(?:'[^\W_]+)?"


def tokens_of(text: str) -> list[str]:
    import re

    return re.findall(TOKEN, text.lower())


def units_of(word: str) -> list[str]:
    """The word, then the prefixes that leave at least two letters, marked by a trailing star."""
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k + 1]]


def maximal_segments(scores) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(begin, end, score)`` of ``(position, score)`` runs in linear time.

    ``scores`` is an iterable of (begin, end, score); neighbours are merged through a stack of
    candidate segments with the running sums at their ends.
    """
    stack: list[list] = []  # begin, end, sum before, sum after, index of the nearest candidate with a smaller sum before
    total = 0.0
    for begin, end, s in scores:
        before, total = total, total + s
        if s <= 0:
            continue
        now = [begin, end, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= now[3]:
                now[4] = j
                stack.append(now)
                break
            now = [stack[j][0], now[1], stack[j][2], now[3], -1]
            del stack[j:]
    return [(b, e, after - before) for b, e, before, after, _ in stack]


@dataclass
class Model:
    weights: dict[str, tuple[float, float]] = field(default_factory=dict)
    rest: float = -0.05
    lam: float = 1.0
    k: float = 0.1
    calibration: tuple[float, float, float, float] = (-30.0, 0.0, 0.0, 0.0)

    def word_score(self, word: str) -> float | None:
        """The log-odds of the unit of ``word`` with the largest absolute z; None if none is significant."""
        found = [x for u in units_of(word) if (x := self.weights.get(u))]
        return max(found, key=lambda x: abs(x[1]))[0] if found else None

    def _scores(self, words: list[str]) -> list:
        alone(None)  # the cache goes with the model
        cache = self.__dict__.setdefault("_cache", {})
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = self.word_score(w)
        return [(i, s) for i, s in enumerate(map(cache.__getitem__, words)) if s is not None]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_cache"}

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """The significant-or-not maximal segments in token positions, with normalised scores, and the token count."""
        words = tokens_of(text) if text else []
        runs, last = [], 0
        for i, s in self._scores(words):
            if i > last:
                runs.append((last, i, self.rest * (i - last)))
            runs.append((i, i + 1, s))
            last = i + 1
        n = max(len(words), 1)
        return [(b, e, self.lam * s - math.log(self.k * n)) for b, e, s in maximal_segments(runs)], len(words)

    def features(self, text: str | None) -> tuple[float, float, float]:
        found, n = self.segments(text)
        best = max((s for *_, s in found), default=0.0)
        raw = best + math.log(self.k * max(n, 1)) if found else 0.0
        return min(max(best, 0.0), SATURATED), math.log1p(sum(s >= SIGNIFICANT_SEGMENT for *_, s in found)), min(max(raw, 0.0), SATURATED)

    def score(self, text: str | None) -> float:
        bias, *slopes = self.calibration
        odds = bias + sum(a * x for a, x in zip(slopes, self.features(text)))
        return 1 / (1 + math.exp(-min(max(odds, -500), 500)))


def karlin(weights: np.ndarray, p: np.ndarray) -> tuple[float, float]:
    """Scale and size of the extreme-value law: a text of n tokens has ``K * n * exp(-lambda * x)`` segments above x by chance.

    ``lambda`` solves ``sum p * exp(lambda * s) = 1``.  For scores of no common step
    ``K = exp(-2 * sum over k of (P(S_k >= 0) + P*(S_k < 0)) / k) / (lambda * E*[s])``, where ``S_k`` is the sum of k scores and the star means scores
    weighed by ``exp(lambda * s)``; both chances are those of seeded random walks.
    """
    if not (weights > 0).any() or (weights * p).sum() >= 0:
        return 1.0, 0.1
    low, high = 1e-6, MOST_LAMBDA
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * weights, 700))).sum() < 1 else (low, mid)
    lam = (low + high) / 2
    tilted = p * np.exp(np.minimum(lam * weights, 700))
    plain, tilted = np.cumsum(p / p.sum()), tilted / tilted.sum()
    entropy, raised, rng = float((tilted * lam * weights).sum()), np.cumsum(tilted), np.random.default_rng(8)
    up, down, chances = np.zeros(WALKS), np.zeros(WALKS), 0.0
    for k in range(1, WALK_STEPS + 1):
        for walk, chance in ((up, plain), (down, raised)):
            walk += weights[np.minimum(np.searchsorted(chance, rng.random(WALKS), side="right"), len(weights) - 1)]
        chances += ((up >= 0).mean() + (down < 0).mean()) / k
    return lam, max(math.exp(-2 * chances) / entropy, 1e-6)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 0.5) -> np.ndarray:
    """Damped Newton steps for a ridge logistic regression with an intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, keep = np.zeros(x.shape[1]), np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    loss = lambda v: float(np.logaddexp(0, x @ v).sum() - y @ (x @ v) + v @ keep @ v / 2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if abs(size * step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most ``sample_rows`` rows of ``labels`` (``key``, ``label`` 0 or 1)."""
    picked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).cast("int").alias("_y")).distinct()
    picked = picked.orderBy(F.xxhash64(F.col(key)), F.col(key), "_y").limit(sample_rows)  # bounded, hence fit to broadcast
    rows = docs.select(key, text).where(F.col(text).isNotNull()).join(F.broadcast(picked), key)
    if not rows.groupBy(key, "_y").count().where("count > 1").isEmpty():
        rows = rows.groupBy(key, "_y").agg(F.min(text).alias(text))  # so the sample is bounded though ids repeat

    def count(batches):
        from collections import Counter

        seen = (Counter(), Counter())
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1)):
                seen[y.as_py()].update({u for w in set(tokens_of(t.as_py())) for u in units_of(w)})
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(seen[y].keys(), pa.string()), pa.array([y] * len(seen[y]), pa.int32()), pa.array(seen[y].values(), pa.int64())], ["w", "y", "n"])

    counts = rows.select(text, "_y").mapInArrow(count, "w string, y int, n long").groupBy("w").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")
    )
    whole = ~F.col("w").endswith("*")
    total = counts.where(whole).agg(F.sum("a"), F.sum("b")).first()
    if not total or not total[0] or not total[1]:
        return Model()
    na, nb = float(total[0]), float(total[1])
    weight = PRIOR_SHARE * (na + nb)
    prior = F.lit(PRIOR_SHARE) * (F.col("a") + F.col("b"))
    ya, yb = F.col("a") + prior, F.col("b") + prior
    odds = F.log(ya / (na + weight - ya)) - F.log(yb / (nb + weight - yb))
    z = odds / F.sqrt(1 / ya + 1 / yb)
    lexicon = counts.select("w", odds.alias("odds"), z.alias("z"), ((F.col("b") + 0.5) / nb).alias("p")).where(F.abs("z") >= SIGNIFICANT_Z).orderBy(F.abs("z").desc(), "w").collect()  # of the bounded sample's tokens
    model = Model({r.w: (float(r.odds), float(r.z)) for r in lexicon})
    if not any(v > 0 for v, _ in model.weights.values()):
        return Model()
    known = np.array([[r.odds, r.p] for r in lexicon if not r.w.endswith("*")] or [[lexicon[0].odds, lexicon[0].p]])
    model.lam, model.k = karlin(np.append(known[:, 0], model.rest), np.append(known[:, 1], max(1 - known[:, 1].sum(), 1e-9)))

    def measure(batches):
        for batch in batches:
            f = [model.features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *[pa.array([x[i] for x in f], pa.float64()) for i in range(3)]], ["y", "f", "g", "h"])

    seen = np.array([tuple(r) for r in rows.select(text, "_y").mapInArrow(measure, "y int, f double, g double, h double").collect()])
    if len(seen) and 0 < seen[:, 0].sum() < len(seen):
        model.calibration = tuple(float(x) for x in logistic(seen[:, 1:], seen[:, 0]))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``score double`` and ``predicted int`` to the key."""

    def run(batches):
        for batch in batches:
            s = [model.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], [key, "score", "predicted"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double, predicted int")


def passages(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each significant passage: ``key, begin, end`` (token positions) and its normalised ``score``."""

    def run(batches):
        for batch in batches:
            out = [(k.as_py(), b, e, s) for k, t in zip(batch.column(0), batch.column(1)) for b, e, s in model.segments(t.as_py())[0] if s >= SIGNIFICANT_SEGMENT]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((batch.schema.field(0).type, pa.int64(), pa.int64(), pa.float64()))], [key, "begin", "end", "score"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, begin long, end long, score double")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns."""

    return kept_by(docs, text, lambda: lambda t: model.score(t) < 0.5)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc32_of("doc_id") % 5 == 0
    model = fit(docs, read(spark, sf_dir, "labels").where(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
