"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line) hashes to a wide vector of LANES 64-bit lanes (BLAKE2b in
counter mode) and SKETCH 32-bit lanes, the signed count sketch of its three-word
shingles; of a paragraph of fewer than SHORT words its words and pairs as well, and
of one of fewer than three, beyond LONG bytes, its runs of eight bytes. A document's fingerprint is the sum of its paragraphs' vectors, modulo
2^64 and 2^32. Sums don't depend on order, and `plus` and `minus` insert and
delete a paragraph without the rest of the text. The wide lanes decide equality;
the cosine of the sketch lanes estimates how much of two texts is common.

Edge cases: a null text counts as empty and has the fingerprint of no paragraphs
(zero); any other text has its lines as paragraphs, empty ones too, so that equal
fingerprints mean equal multisets of lines. The next
document is taken by (doc_id, text), null doc_id first; a table of one document
has itself as the next. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hashes, map_arrow, mixed, words_of

LANES, SKETCH = 16, 128
#: Words from which a paragraph counts by its three-word shingles alone.
SHORT = 8
#: Bytes beyond which a paragraph of one or two words counts by its runs of bytes as well.
LONG = 32
#: Rows that a task reads in order of doc_id.
RUN = 2_000
#: Runs at most; beyond it they get longer, and a task still holds two texts at a time.
MOST_RUNS = 20_000


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of a text: wide lanes modulo 2^64, sketch lanes modulo 2^32."""
    wide, sketch = np.zeros(LANES, np.uint64), np.zeros(SKETCH, np.int32)
    if not text:
        return wide, sketch
    digests, words, lengths, features = [], [], [], []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        digests += [hashlib.blake2b(line, salt=b"\x00").digest(), hashlib.blake2b(line, salt=b"\x01").digest()]
        own = words_of(line)
        words += own
        lengths.append(len(own))
        if len(own) < 3 and len(line) > LONG:
            features.append(_octets(line))
    wide = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, LANES).sum(0, dtype=np.uint64)
    h = hashes(words)
    line = np.repeat(np.arange(len(lengths)), lengths)
    short = (np.array(lengths) < SHORT)[line]
    features.append(mixed((h[:-2] * np.uint64(3) + h[1:-1]) * np.uint64(0x9E3779B97F4A7C15) + h[2:])[line[:-2] == line[2:]])
    features.append(mixed(h[short] + np.uint64(1)))
    features.append(mixed(h[:-1] * np.uint64(3) + h[1:])[short[1:] & (line[:-1] == line[1:])])
    f = np.concatenate(features)
    counts = np.bincount((f & np.uint64(SKETCH - 1)).astype(np.int64), 1.0 - 2.0 * ((f >> np.uint64(40)) & np.uint64(1)), SKETCH)
    return wide, counts.astype(np.int64).astype(np.int32)


def _octets(line: bytes) -> np.ndarray:
    """A hash of each run of eight bytes."""
    x = np.frombuffer(line, np.uint8).astype(np.uint64)
    out = np.zeros(len(x) - 7, np.uint64)
    for i in range(8):
        out |= x[i : len(x) - 7 + i] << np.uint64(8 * i)
    return mixed(mixed(out))


def paragraphs(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The sum of a text's lines as they are inserted or deleted: an empty one is a paragraph as well."""
    if text:
        return vector(text)
    return np.frombuffer(b"".join(hashlib.blake2b(b"", salt=s).digest() for s in (b"\x00", b"\x01")), np.uint64), np.zeros(SKETCH, np.int32)


def plus(x: tuple[np.ndarray, np.ndarray], text: str) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint with a paragraph more, or with all those of a text of several lines."""
    return tuple(a + b for a, b in zip(x, paragraphs(text), strict=True))  # type: ignore[return-value]


def minus(x: tuple[np.ndarray, np.ndarray], text: str) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint without one of its paragraphs, or without those of a text of several lines."""
    return tuple(a - b for a, b in zip(x, paragraphs(text), strict=True))  # type: ignore[return-value]


def as_hex(x: tuple[np.ndarray, np.ndarray]) -> str:
    return x[0].astype("<u8").tobytes().hex() + x[1].astype("<i4").tobytes().hex()


def from_hex(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(text)
    return np.frombuffer(raw[: 8 * LANES], "<u8").astype(np.uint64), np.frombuffer(raw[8 * LANES :], "<i4").astype(np.int32)


def likeness(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """1 for equal fingerprints; else the cosine of the sketches, from 0 up."""
    if (x[0] == y[0]).all() and (x[1] == y[1]).all():
        return 1.0
    a, b = x[1].astype(float), y[1].astype(float)
    size = float(np.sqrt((a * a).sum() * (b * b).sum()))
    return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (run, doc_id, text, last) in order, each run closed by the first row of the next run."""
    before: tuple | None = None
    for batch in batches:
        out = []
        for run, doc_id, text, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            x = vector(text)
            if before and before[0] == run:
                _, key, own, y = before
                changed = edited(own, text)
                z = vector(changed)
                out.append((key, len(own), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), as_hex(y), as_hex(z), likeness(y, z), likeness(y, x)))
            before = None if last else (run, doc_id, text, x)
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([as_hex(vector(t or "")) for t in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of each text."""
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _single, "doc_id long, fingerprint string")


def _changed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of a document's fingerprint (sign 0) and of its inserted (1) and deleted (-1) paragraphs, batch by batch."""
    x = np.zeros(LANES, np.uint64), np.zeros(SKETCH, np.int32)
    known = False
    for batch in batches:
        for sign, text in zip(batch.column("sign").to_pylist(), batch.column("text").to_pylist(), strict=True):
            known |= sign == 0
            part = from_hex(text) if sign == 0 else paragraphs(text or "")
            x = tuple(a - b if sign < 0 else a + b for a, b in zip(x, part, strict=True))
    if known:
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([as_hex(x)])], names=["doc_id", "fingerprint"])


def changed(prints: DataFrame, changes: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) after changes (doc_id, paragraph, sign: 1 inserted, -1 deleted), without the texts; doc_id names a document once.

    Changes of documents that have no fingerprint are left out.
    """
    rows = prints.select("doc_id", F.lit(0).alias("sign"), F.col("fingerprint").alias("text"))
    rows = rows.unionByName(changes.select(F.col("doc_id").cast("long").alias("doc_id"), F.signum("sign").cast("int").alias("sign"), F.col("paragraph").alias("text")))
    return rows.groupBy("doc_id").applyInArrow(_changed, "doc_id long, fingerprint string")


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside its edited text's and the next document's.

    Texts are shuffled once, by runs of neighbouring doc_id; the first document of
    each run also closes the run before. Run bounds are quantiles of doc_id, as
    many numbers as there are runs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    runs = min(MOST_RUNS, max(1, n // RUN))
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / runs for i in range(1, runs)], 0.1 / runs))) if runs > 1 and low is not None and low < high else []
    bounds = [x for x in bounds if low < x <= high]
    if bounds:
        splits = [float("-inf"), *bounds, float("inf")]
        rows = Bucketizer(splits=splits, inputCol="d", outputCol="b", handleInvalid="keep").transform(rows.withColumn("d", F.col("doc_id").cast("double")))
        rows = rows.select(F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("b").cast("int")).alias("run"), "doc_id", "text")
    else:
        rows = rows.select(F.lit(0).alias("run"), "doc_id", "text")
    # The first row of each run by (doc_id, text) also closes the run before: MOST_RUNS rows at most.
    key = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    heads = rows.groupBy("run").agg(F.min(key).alias("head"))
    held = sorted(tuple(r) for r in heads.collect())
    place = {x: held[i - 1][0] for i, (_, x) in enumerate(held)}
    names = rows.sparkSession.createDataFrame([(x, run) for x, run in place.items()], "head long, to int")
    closing = rows.join(F.broadcast(names), key == F.col("head")).groupBy("to").agg(F.min(F.struct("doc_id", "text")).alias("f"))
    closing = closing.select(F.col("to").alias("run"), "f.doc_id", "f.text", F.lit(True).alias("last"))
    ordered = rows.withColumn("last", F.lit(False)).union(closing).repartition("run").sortWithinPartitions("run", "last", F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return map_arrow(ordered, _compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
