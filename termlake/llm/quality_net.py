"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Every word form has a sparse random index vector. A form's context vector is
the sum of the index vectors of its neighbours over the whole corpus; forms
share ``BUCKETS`` rows, so the table has a fixed size at any scale. A document is
the mean of its forms' vectors, the mean product of neighbouring vectors and
three counts; a two-layer network reads that, and its logits are divided by a
temperature fitted on labelled rows it was not trained on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .batches import map_rows, texts_of
from .labelled import remainder, sample

BUCKETS = 1 << 14
DIM = 48
NONZERO = 4
REACH = 2
SAMPLE = 15_000  # labelled documents of each label at most
HIDDEN = 24
EPOCHS = 60
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
PIECE = 1 << 17  # forms worked on at a time
CACHED_FORMS = 500_000

_RUNS = re.compile(r"(.)\1+")


def form_bucket(token: str) -> int:
    """Bucket of a token's form: the pattern of its characters, runs as one, and a three-letter stem."""
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in token[:24])
    shape = _RUNS.sub(r"\1", shape)
    stem = "".join(c for c in token[:12].lower() if c.isalpha())[:3]
    return zlib.crc32(f"{shape[:6]}:{stem}".encode()) % BUCKETS


class Forms(dict):
    """Cache token -> bucket."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_FORMS:
            self.clear()
        self[token] = bucket = form_bucket(token)
        return bucket


FORMS = Forms()


def forms(text: str) -> np.ndarray:
    return np.fromiter(map(FORMS.__getitem__, text.split()), np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector."""
    rng = np.random.default_rng(11)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice(np.array([-1.0, 1.0]), (BUCKETS, NONZERO))


def context_sums(docs: DataFrame) -> DataFrame:
    """``(bucket, c0 .. )``: context vectors over all texts.

    Every task adds up a table of fixed size and hands out its rows once; Spark
    sums them with partial aggregation.
    """
    names = [f"c{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        table = np.zeros(BUCKETS * DIM)

        def add(ids: np.ndarray, doc: np.ndarray) -> None:
            for k in range(1, REACH + 1):
                same = doc[k:] == doc[:-k]
                a, b = ids[:-k][same], ids[k:][same]
                for x, y in ((a, b), (b, a)):
                    at = (x[:, None] * DIM + places[y]).ravel()
                    table[:] += np.bincount(at, signs[y].ravel(), minlength=BUCKETS * DIM)

        held, size = [], 0
        for batch in batches:
            for text in texts_of(batch.column(0)):
                ids = forms(text)
                for start in range(0, max(len(ids), 1), PIECE):
                    held.append(ids[max(0, start - REACH) : start + PIECE])
                    size += len(held[-1])
                    if size >= PIECE:
                        add(np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held]))
                        held, size = [], 0
        if held:
            add(np.concatenate(held), np.repeat(np.arange(len(held)), [len(h) for h in held]))
        rows = table.reshape(BUCKETS, DIM).astype(np.int64)
        used = np.flatnonzero(rows.any(axis=1))
        for start in range(0, len(used), 2048):
            part = used[start : start + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *[pa.array(rows[part, i]) for i in range(DIM)]], ["bucket", *names])

    schema = "bucket int, " + ", ".join(f"{n} bigint" for n in names)
    return docs.select("text").mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors by bucket: ``BUCKETS`` rows at most, whatever the corpus."""
    got = context_sums(docs).toPandas()
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    if len(got):
        raw = got.drop(columns="bucket").to_numpy(float)
        vectors[got["bucket"].to_numpy(int)] = raw / np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
    return vectors


FEATURES = 2 * DIM + 3


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of one document from its forms."""
    n = len(ids)
    out = np.zeros(FEATURES)
    if not n:
        return out
    for start in range(0, n, PIECE):
        part = vectors[ids[start : start + PIECE + 1]]
        out[:DIM] += part[:PIECE].sum(axis=0)
        out[DIM : 2 * DIM] += np.einsum("ij,ij->j", part[:-1], part[1:])
    out[:DIM] /= n
    out[DIM : 2 * DIM] /= max(n - 1, 1)
    out[2 * DIM] = np.log1p(n) / 10
    out[2 * DIM + 1] = np.count_nonzero(ids[1:] == ids[:-1]) / n
    out[2 * DIM + 2] = len(np.unique(ids)) / n
    return out


@dataclass
class Network:
    mean: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, u, c = self.layers
        return np.tanh((x - self.mean) / self.spread @ w + b) @ u + c

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Adam on four fifths of the rows, temperature by least log loss on the rest."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    rest, own = order[: len(x) // 5], order[len(x) // 5 :]
    mean, spread = x[own].mean(axis=0), x[own].std(axis=0) + 1e-3
    z, t = (x[own] - mean) / spread, y[own]
    share = np.clip(t.mean(), 1e-3, 1 - 1e-3)
    params = [rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.array(np.log(share / (1 - share)))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(z))
        for start in range(0, len(z), 128):
            i = shuffled[start : start + 128]
            w, b, u, c = params
            h = np.tanh(z[i] @ w + b)
            error = (1 / (1 + np.exp(-(h @ u + c))) - t[i]) / len(i)
            back = error[:, None] * u * (1 - h * h)
            grads = [z[i].T @ back + 1e-4 * w, back.sum(axis=0), h.T @ error + 1e-4 * u, error.sum()]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                params[k] = params[k] - 2e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, spread, (params[0], params[1], params[2], float(params[3])))
    if len(rest):
        logits, truth = net.logits(x[rest]), y[rest]

        def loss(temperature: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -50, 50))), 1e-9, 1 - 1e-9)
            return float(-(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean())

        net.temperature = min(np.geomspace(0.25, 8, 60).tolist(), key=loss)
    return net


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> tuple[np.ndarray, Network | None]:
    """Vectors from all documents, network from at most ``SAMPLE`` documents of each label."""
    vectors = word_vectors(docs)
    drawn = stage(sample(labels, "quality", usable, SAMPLE), "quality-sample")
    held_by_workers = docs.sparkSession.sparkContext.broadcast(vectors)

    def make():
        v = held_by_workers.value
        return lambda batch: [
            (doc, label, pooled(forms(t), v).tolist())
            for doc, label, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)))
        ]

    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text")
    rows = map_rows(chosen, "doc_id bigint, label int, x array<double>", make).toPandas().sort_values("doc_id", kind="stable")
    if rows["label"].nunique() < 2:
        return vectors, None
    return vectors, fit(np.stack(rows["x"].to_list()), rows["label"].to_numpy(float))


def score(text: Column, docs: DataFrame, vectors: np.ndarray, net: Network | None) -> Column:
    """Probability of label 1; 0.5 throughout when there was nothing to learn from."""
    held = docs.sparkSession.sparkContext.broadcast((vectors, net))

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        v, n = held.value
        if n is None:
            return pd.Series(np.full(len(texts), 0.5))
        found = [float(n.score(pooled(forms(t or ""), v)[None, :])[0]) for t in texts]
        return pd.Series(found, dtype="float64")

    return run(text)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``; null text as empty, repeated rows alike."""
    left = remainder(F.col("doc_id"), FOLDS)
    vectors, net = train(docs, labels, left != HELD_OUT)
    scored = docs.select("doc_id", (left == HELD_OUT).alias("held_out"), score(F.col("text"), docs, vectors, net).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
