"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms: words and their beginnings. The score is a
bias, a weight for each term and an inner product of latent vectors for each
two terms, so a term can count more beside another one than alone.

Learning: from a bounded sample of labelled documents the hashed terms that
tell most about the label are selected by one aggregation; the machine over
these is fitted by numpy on the driver. Scoring maps over all documents.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .batches import map_rows, texts_of
from .labelled import remainder, sample

SAMPLE = 6_000  # labelled documents of each label at most
TERMS = 6_000  # selected hashed terms
LEAST_DOCS = 4  # sampled documents that hold a selected term
FACTORS = 8
EPOCHS = 25
FOLDS = 5  # documents whose remainder is 0 are held out
HASH_BITS = 28
BEGINNINGS = (4, 5, 6, 7)
CACHED_WORDS = 1_000_000

WORD = re.compile(r"[^\W\d_]+")


def hashed(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << HASH_BITS) - 1)


def word_terms(word: str) -> tuple[int, ...]:
    """Hashed terms of a word: itself, and its beginnings of several lengths."""
    return (hashed(word), *[hashed(f"{word[:n]}-") for n in BEGINNINGS if len(word) > n])


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass
class Machine:
    """Fitted model; ``place`` maps a hashed term to its row in the arrays."""

    bias: float = -50.0
    place: dict[int, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))

    def score(self, places: np.ndarray) -> float:
        v = self.latent[places]
        sums = v.sum(axis=0)
        z = self.bias + self.weights[places].sum() + 0.5 * float((sums * sums).sum() - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(rows: list[np.ndarray], labels: np.ndarray, terms: list[int], prior: float, seed: int = 3) -> Machine:
    """Logistic loss by AdaGrad over minibatches; the bias is moved to the label's true share."""
    rng = np.random.default_rng(seed)
    n, m = len(rows), len(terms)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    # A padded place m stands for no term.
    width = max([len(r) for r in rows] + [1])
    padded = np.full((n, width), m)
    for i, r in enumerate(rows):
        padded[i, : len(r)] = r
    bias, w, v = float(np.log(share / (1 - share))), np.zeros(m + 1), rng.normal(0, 0.02, (m + 1, FACTORS))
    v[m] = 0
    gw, gv, gb = np.full(m + 1, 1e-2), np.full((m + 1, FACTORS), 1e-2), 1e-2
    decay = 2e-4
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        for start in range(0, n, 128):
            batch = order[start : start + 128]
            x = padded[batch]
            x = x[:, : max(1, int((x < m).sum(axis=1).max()))]
            vx = v[x]
            sums = vx.sum(axis=1)
            z = bias + w[x].sum(axis=1) + 0.5 * ((sums**2).sum(axis=1) - (vx**2).sum(axis=(1, 2)))
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels[batch]) / len(batch)
            flat = x.ravel()
            grad_w = np.bincount(flat, np.repeat(error, x.shape[1]), minlength=m + 1) + decay * w / n * len(batch)
            grad = (error[:, None, None] * (sums[:, None, :] - vx)).reshape(-1, FACTORS)
            grad_v = np.stack([np.bincount(flat, grad[:, f], minlength=m + 1) for f in range(FACTORS)], axis=1) + decay * v / n * len(batch)
            grad_b = error.sum()
            gw += grad_w**2
            gv += grad_v**2
            gb += grad_b**2
            w -= 0.1 * grad_w / np.sqrt(gw)
            v -= 0.05 * grad_v / np.sqrt(gv)
            bias -= 0.1 * grad_b / np.sqrt(gb)
            w[m], v[m] = 0, 0
    prior = float(np.clip(prior, 1e-3, 1 - 1e-3))
    bias += np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Machine(bias, {t: i for i, t in enumerate(terms)}, w[:m], v[:m])


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Machine:
    """Fit on a sample of at most ``SAMPLE`` documents of each label (column ``toxic``).

    Without documents of both labels the machine scores everything near 0.
    """
    drawn = stage(sample(labels, "toxic", usable, SAMPLE), "toxic-sample")
    counts = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Machine()
    total = labels.where(usable).agg(F.avg(F.col("toxic").cast("double"))).first()[0]

    def make():
        return lambda batch: [
            (label, sorted({t for w in words_of(text) for t in word_terms(w)}))
            for label, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))
        ]

    # The sample is bounded, so its ids may be broadcast.
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("label", "text")
    sets = stage(map_rows(chosen, "label int, terms array<int>", make), "toxic-terms")
    pos, neg = float(counts.get(1, 0)) or 1.0, float(counts.get(0, 0)) or 1.0
    held = sets.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("a"), F.count(F.lit(1)).alias("n")
    ).where(F.col("n") >= LEAST_DOCS)
    p, q = (F.col("a") + 0.5) / (pos + 1), (F.col("n") - F.col("a") + 0.5) / (neg + 1)
    # How much the term tells: the gain in log likelihood over one rate for both labels.
    r = (F.col("n") + 1.0) / (pos + neg + 2)
    gain = (F.col("a") + 0.5) * F.log(p / r) + (F.col("n") - F.col("a") + 0.5) * F.log(q / r)
    best = held.select("term", F.round(gain, 6).alias("gain")).orderBy(F.desc("gain"), "term").limit(TERMS)
    terms = sorted(row["term"] for row in best.collect())
    known = F.array_intersect("terms", F.array(*[F.lit(t) for t in terms])) if terms else F.array().cast("array<int>")
    data = sets.select("label", known.alias("terms")).toPandas()
    place = {t: i for i, t in enumerate(terms)}
    data["key"] = [(int(x), *sorted(t)) for x, t in zip(data["label"], data["terms"])]
    data = data.sort_values("key", kind="stable")  # the order of rows must not depend on tasks
    rows = [np.array([place[t] for t in sorted(ts)], np.int64) for ts in data["terms"]]
    return fit(rows, data["label"].to_numpy(float), terms, float(total or 0.0))


def score(text: Column, machine: Machine) -> Column:
    """Score of each text between 0 and 1; null text as empty."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        cache: dict[str, tuple[int, ...]] = _cache(machine)
        found = []
        for text in texts:
            places: set[int] = set()
            for w in words_of(text or ""):
                known = cache.get(w)
                if known is None:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    cache[w] = known = tuple(machine.place[t] for t in word_terms(w) if t in machine.place)
                if known:
                    places.update(known)
            found.append(machine.score(np.array(sorted(places), np.int64)))
        return pd.Series(found, dtype="float64")

    return run(text)


_CACHES: dict[tuple, dict] = {}


def _cache(machine: Machine) -> dict:
    """The word cache of a machine in this worker; that of another machine goes."""
    key = (machine.bias, len(machine.place), float(machine.weights.sum()))
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = {}
    return _CACHES[key]


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``; repeated rows score alike."""
    machine = train(docs, labels, remainder(F.col("doc_id"), FOLDS) != 0)
    scored = docs.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), score(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
