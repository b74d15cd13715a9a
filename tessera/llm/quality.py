"""Quality classifier: random-indexing word vectors and a two-layer network.

Each word has a sparse ternary index vector that its hash determines. A word's
context vector is the sum of its neighbours' index vectors over the whole corpus
(words share VOCABULARY hashed rows). A word also counts as its shape: letter
case, digits and marks, with repeats shortened. A document is the mean of its
words' context vectors and of its shapes' index vectors beside a few ratios. A
two-layer network in numpy learns labels from these, and a temperature fitted on
rows kept from training calibrates its probabilities.

The context vectors are statistics of all documents: each task sums its own, and
sums of equal blocks are added up. They have a fixed size, as has the network.
The network is fitted on labelled rows, TRAIN_ROWS of them at most (those with
the least hash of doc_id), that fold() lets learn.

Edge cases: a null or empty text has zero vectors and still gets a score; with
no labels, or labels of one kind only, the score is the share of ones among them
(0.5 for none); repeated rows get equal scores; a document with several labels
learns from each; other columns are never inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import hashes, map_arrow, words_of

VOCABULARY, DIM, NONZERO, BLOCKS, FAN = 8192, 64, 4, 16, 256
SHAPES = 1024
TRAIN_ROWS = 20_000
HIDDEN, EPOCHS, SEED = 32, 300, 11
_SHAPE = bytes(ord("A") if 65 <= i <= 90 else ord("a") if 97 <= i <= 122 or i >= 128 else ord("0") if 48 <= i <= 57 else i for i in range(256))


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3; rows where it is 1 are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def _index(rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each row's index vector."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (rows, NONZERO)), rng.choice([-1.0, 1.0], (rows, NONZERO))


def _dense(index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.zeros((len(index[0]), DIM), np.float32)
    for j in range(NONZERO):
        np.add.at(out, (np.arange(len(out)), index[0][:, j]), index[1][:, j])
    return out


def _ids(words: list[bytes]) -> np.ndarray:
    return (hashes(words) % np.uint64(VOCABULARY)).astype(np.int64)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sum of neighbours' index vectors for each word row, in BLOCKS rows."""
    place, sign = _index(VOCABULARY, SEED)
    total = np.zeros(VOCABULARY * DIM)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            ids = _ids(words_of(text))
            if len(ids) < 2:
                continue
            word, other = np.r_[ids[1:], ids[:-1]], np.r_[ids[:-1], ids[1:]]
            if len(word) < VOCABULARY:
                np.add.at(total, (word[:, None] * DIM + place[other]).ravel(), sign[other].ravel())
            else:
                total += np.bincount((word[:, None] * DIM + place[other]).ravel(), sign[other].ravel(), len(total))
    parts = total.reshape(BLOCKS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array([zlib.compress(p.astype(np.float32).tobytes(), 1) for p in parts], pa.binary())], names=["block", "sums"])


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A group's sums added up, batch by batch, as one row of the same form."""
    total = None
    for batch in batches:
        for sums in batch.column("sums").to_pylist():
            part = np.frombuffer(zlib.decompress(sums), np.float32).astype(np.float64)
            total = part if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.astype(np.float32).tobytes(), 1)], pa.binary())], names=["block", "sums"])


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of the hashed words, from all documents: VOCABULARY x DIM numbers, whatever the input."""
    parts = map_arrow(docs.select(F.col("text").cast("binary").alias("text")), _contexts, "block int, sums binary")
    # In two levels: a group adds up the sums of one in FAN of the tasks, then those of FAN groups.
    some = parts.withColumn("some", F.spark_partition_id() % FAN).groupBy("block", "some").applyInArrow(_summed, "block int, sums binary")
    rows = some.groupBy("block").applyInArrow(_summed, "block int, sums binary").collect()
    out = np.zeros((BLOCKS, VOCABULARY * DIM // BLOCKS), np.float32)
    for block, sums in rows:
        out[block] = np.frombuffer(zlib.decompress(sums), np.float32)
    out = out.reshape(VOCABULARY, DIM)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)


def features(text: bytes | None, contexts: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """The pooled vectors of a text and a few ratios."""
    words = words_of(text)
    if not words:
        return np.zeros(2 * DIM + 6, np.float32)
    ids = _ids(words)
    seen = text.translate(_SHAPE).split()
    forms = (hashes([w[:1] + w[-2:] + b"-" * (len(w) > 12) for w in seen]) % np.uint64(SHAPES)).astype(np.int64)
    n = len(words)
    letters = np.bincount(np.frombuffer(text.translate(_SHAPE), np.uint8), minlength=256) / len(text)
    rest = [np.log1p(n) / 10, len(set(words)) / n, len(text) / n / 10, letters[65], letters[48], 1 - letters[65] - letters[97] - letters[48] - letters[32]]
    pooled = contexts[ids].mean(0) if n <= 4096 else (np.bincount(ids, minlength=VOCABULARY) / n).astype(np.float32) @ contexts
    return np.concatenate([pooled, (np.bincount(forms, minlength=SHAPES) / n) @ shapes, rest]).astype(np.float32)


class Network:
    """Inputs scaled, one hidden layer of tanh, one output, a temperature; trained by Adam."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> None:
        self.share = float(y.mean()) if len(y) else 0.5
        self.flat = len(set(y.tolist())) < 2
        if self.flat:
            return
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        kept, learn = order[: max(1, len(y) // 5)], order[max(1, len(y) // 5) :]
        if len(set(y[learn].tolist())) < 2:
            kept = learn = order
        self.mid, self.scale = x[learn].mean(0), x[learn].std(0) + 1e-3
        z = self._scaled(x)
        self.w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(p) for p in self.w], [np.zeros_like(p) for p in self.w], 0
        size = min(256, len(learn))
        for _ in range(max(20, EPOCHS * 2000 // max(2000, len(learn)))):
            for at in np.array_split(rng.permutation(learn), max(1, len(learn) // size)):
                a, b = z[at], y[at]
                h = np.tanh(a @ self.w[0] + self.w[1])
                d = (self._sigmoid(h @ self.w[2] + self.w[3]) - b) / len(at)
                back = np.outer(d, self.w[2]) * (1 - h * h)
                grads = [a.T @ back + 1e-4 * self.w[0], back.sum(0), h.T @ d + 1e-4 * self.w[2], np.array([d.sum()])]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        logits = self._logits(z[kept])
        loss = lambda t: float(np.mean(np.logaddexp(0, logits / t) - y[kept] * logits / t))
        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mid) / self.scale, -8, 8).astype(np.float64)

    def _logits(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    @staticmethod
    def _sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.flat:
            return np.full(len(x), self.share)
        return self._sigmoid(self._logits(self._scaled(x)) / self.temperature)


def _featured(batches: Iterator[pa.RecordBatch], contexts: np.ndarray) -> Iterator[pa.RecordBatch]:
    shapes = _dense(_index(SHAPES, SEED + 1))
    for batch in batches:
        rows = [features(t, contexts, shapes).tobytes() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "y", "x"])


def _scored(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    contexts, network = shared.value
    shapes = _dense(_index(SHAPES, SEED + 1))
    for batch in batches:
        x = [features(t, contexts, shapes) for t in batch.column("text").to_pylist()]
        p = network.probability(np.array(x)) if x else np.zeros(0)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(p, pa.float64())], names=[*names, "score"])


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """Context vectors of all the documents and the network learnt from labelled rows of the learning folds."""
    contexts = context_vectors(docs)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null").filter(fold(F.col("doc_id")) != 1)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(TRAIN_ROWS)  # TRAIN_ROWS of 12 bytes: small enough to broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    train = map_arrow(texts.join(F.broadcast(rows), "doc_id").select("doc_id", "y", "text"), partial(_featured, contexts=contexts), "doc_id long, y int, x binary")
    train = train.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(TRAIN_ROWS).collect()
    x = np.array([np.frombuffer(r.x, np.float32) for r in train]).reshape(len(train), 2 * DIM + 6)
    return contexts, Network(x, np.array([r.y for r in train], float))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    out = map_arrow(rows, partial(_scored, shared=shared), "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score `least` or more, as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("text").cast("binary").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return map_arrow(rows, partial(_scored, shared=shared), schema).filter(F.col("score") >= least).select("row.*")
