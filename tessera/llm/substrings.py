"""Removal of repeated passages by fixed-block anchors.

A passage is a window of WINDOW words. Non-overlapping blocks of BLOCK words of
every document are the reference; every rolling window of BLOCK words probes
them. As WINDOW >= 2 * BLOCK - 1, each window holds a whole block, so a window
that stands in two documents has an anchor in both: the block in one, the probe
that hit it in the other. Hits are extended to whole windows, of which each
document learns the least doc_id that starts the same one: runs of windows held
by a smaller doc_id are the maximal repeats, and their words go.

Probes are shuffled packed, a row for each chunk of documents and bucket, at
about five bytes a probe. What a chunk holds often is settled before the
shuffle: a probe met in HOT places of a chunk is a hit at once and goes on as one
reference block, and of a window only the chunk's least doc_id goes on. So a
passage in a third of all documents sends a row or two for each chunk.

Edge cases: a null or empty text has no words; a text under WINDOW words keeps
all of them. Rows with equal doc_id don't remove from each other; rows without a
doc_id are neither cut nor held against others. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hashes, map_arrow, mixed, words_of

WINDOW, BLOCK = 50, 25
#: Words of a chunk, bytes of text that a bucket stands for, places of a chunk from which a probe counts as hot.
CHUNK, BUCKET_BYTES, HOT = 1_200_000, 16_000_000, 8
PACK = "kind int, bucket int, ids binary, counts binary, at binary, h binary, more binary"
FLAGS, BY_DOCUMENT = "part int, ids binary, counts binary, at binary", "doc_id long, th long, flags binary"
R1, R2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def rolling(h: np.ndarray, width: int, r: np.uint64) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each run of `width` word hashes: Horner's rule over all runs at once."""
    n = len(h) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for i in range(width):
            out = out * r + h[i : i + n]
    return mixed(out)


def planes(x: np.ndarray, kind: str = "<u4") -> bytes:
    """The bytes of numbers by significance: the high ones are mostly zero and compress away."""
    return np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(len(x), -1).T).tobytes()


def unplanes(b: bytes, kind: str = "<u4") -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return planes(keys[:, 0], "<i8") + keys[:, 1].astype("<i4").tobytes()


def unpacked_keys(b: bytes) -> np.ndarray:
    n = len(b) // 12
    return np.stack([unplanes(b[: 8 * n], "<i8"), np.frombuffer(b[8 * n :], "<i4").astype(np.int64)], axis=1)


def _pack(keys: np.ndarray, doc: np.ndarray, at: np.ndarray, h: np.ndarray, bucket: np.ndarray, kind: int, more: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of PACK: entries by bucket, document and place; keys: (doc_id, th) of each document."""
    if not len(h):
        return
    order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 65536 else bucket, kind="stable")
    doc, at, h, bucket = doc[order], at[order], h[order], bucket[order]
    more = None if more is None else more[order]
    run = np.r_[True, (doc[1:] != doc[:-1]) | (bucket[1:] != bucket[:-1])]
    starts = np.flatnonzero(run)
    counts = np.diff(np.r_[starts, len(doc)])
    step = np.where(run, at, at - np.r_[0, at[:-1]])
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[cuts[1:], len(doc)]
    first = np.searchsorted(starts, cuts)
    last = np.searchsorted(starts, ends)
    columns: list[list] = [[] for _ in range(7)]
    for s, e, f, t in zip(cuts, ends, first, last, strict=True):
        for c, x in zip(columns, (kind, int(bucket[s]), packed_keys(keys[doc[starts[f:t]]]), planes(counts[f:t]), planes(step[s:e]), h[s:e].tobytes(), b"" if more is None else more[s:e].tobytes()), strict=True):
            c.append(x)
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=["kind", "bucket", "ids", "counts", "at", "h", "more"])


def _unpack(table: pa.Table, kind: int, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keys, doc, at, h, more of the packs of a kind."""
    keys, docs, ats, hs, mores, base = [], [], [], [], [], 0
    for k, ids, counts, at, h, more in zip(*(table.column(n).to_pylist() for n in ("kind", "ids", "counts", "at", "h", "more")), strict=True):
        if k != kind:
            continue
        own, counts, step = unpacked_keys(ids), unplanes(counts).astype(np.int64), unplanes(at).astype(np.int64)
        place = np.cumsum(step)
        starts = np.cumsum(counts) - counts
        place -= np.repeat(place[starts] - step[starts], counts)
        keys.append(own)
        docs.append(np.repeat(np.arange(base, base + len(own), dtype=np.int32), counts))
        ats.append(place.astype(np.int32))
        hs.append(np.frombuffer(h, dtype))
        mores.append(np.frombuffer(more, np.uint16))
        base += len(own)
    if not keys:
        none = np.zeros(0, np.int32)
        return np.zeros((0, 2), np.int64), none, none, np.zeros(0, dtype), np.zeros(0, np.uint16)
    return tuple(np.concatenate(x) for x in (keys, docs, ats, hs, mores))  # type: ignore[return-value]


def _spread(keys: np.ndarray, parts: int) -> np.ndarray:
    """A part for each document: by doc_id as well, so that copies of one text don't meet in one part."""
    return (mixed(mixed(keys[:, 0].astype(np.uint64)) + keys[:, 1].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _flags(keys: np.ndarray, doc: np.ndarray, at: np.ndarray, parts: int) -> pa.Table:
    """Rows of FLAGS: the places of each document, those of many documents in a row."""
    spread = _spread(keys, parts)
    order = np.lexsort((at, doc, spread[doc])) if len(doc) else np.zeros(0, np.int64)
    doc, at = doc[order], at[order]
    part, n = spread[doc], len(doc)
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]][:n])
    counts = np.diff(np.r_[starts, n])
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][:n])
    rows = []
    for s, e in zip(cuts, np.r_[cuts[1:], n][: len(cuts)], strict=True):
        f, t = np.searchsorted(starts, (s, e))
        rows.append((int(part[s]), packed_keys(keys[doc[starts[f:t]]]), planes(counts[f:t]), at[s:e].astype("<i4").tobytes()))
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["part", "ids", "counts", "at"])


def _by_document(group: pa.Table) -> pa.Table:
    """The flags of a part's documents, a row for each."""
    own: dict[tuple[int, int], list[bytes]] = {}
    for ids, counts, at in zip(*(group.column(n).to_pylist() for n in ("ids", "counts", "at")), strict=True):
        ends = 4 * np.cumsum(unplanes(counts).astype(np.int64))
        for key, s, e in zip(unpacked_keys(ids).tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            own.setdefault(tuple(key), []).append(at[s:e])
    return pa.table([pa.array([k[0] for k in own], pa.int64()), pa.array([k[1] for k in own], pa.int64()), pa.array([_places(v).tobytes() for v in own.values()], pa.binary())], names=["doc_id", "th", "flags"])


def _thinned(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of runs of neighbouring hits the ends and every BLOCK-th: any window that holds a hit of the run holds one of these."""
    ends = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)]
    return ends | np.r_[ends[1:], True] | (at % BLOCK == 0)


class _Chunk:
    """Documents' entries until there are enough to send."""

    def __init__(self) -> None:
        self.keys: list[tuple[int, int]] = []
        self.parts: list[tuple] = []
        self.n = 0

    def add(self, doc_id: int, th: int, at: np.ndarray, *hs: np.ndarray) -> None:
        self.parts.append((np.full(len(at), len(self.keys), np.int32), at.astype(np.int32), *hs))
        self.keys.append((doc_id, th))
        self.n += len(at)

    def taken(self) -> tuple[np.ndarray, ...]:
        out = (np.array(self.keys, np.int64), *(np.concatenate(x) for x in zip(*self.parts, strict=True)))
        self.__init__()
        return out


def _probe(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    def sent(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
        keys, doc, at, h = chunk.taken()
        ordered = np.sort(h)
        often = np.unique(ordered[: -HOT + 1][ordered[HOT - 1 :] == ordered[: -HOT + 1]]) if len(h) >= HOT else ordered[:0]
        place = lambda h: ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        hot = np.isin(h, often) if len(often) else np.zeros(len(h), bool)
        if hot.any():
            d, p, x = doc[hot], at[hot], h[hot]
            _, one = np.unique(x, return_index=True)
            yield from _pack(keys, d[one], p[one], x[one].astype(np.uint32), place(x[one]), 1)
            keep = _thinned(d, p)
            yield from _pack(keys, d[keep], p[keep], np.zeros(keep.sum(), np.uint32), _spread(keys, buckets)[d[keep]], 2)
        cold = ~hot
        yield from _pack(keys, doc[cold], at[cold], h[cold].astype(np.uint32), place(h[cold]), 0)

    chunk = _Chunk()
    for batch in batches:
        for doc_id, th, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            if len(words) >= WINDOW and doc_id is not None:
                h = rolling(hashes(words), BLOCK, R1)
                chunk.add(doc_id, th, np.arange(len(h)), h)
                if chunk.n >= CHUNK:
                    yield from sent(chunk)
    if chunk.n:
        yield from sent(chunk)


def _hits(group: pa.Table, parts: int) -> pa.Table:
    """Probes whose hash is also a reference block's elsewhere, and those blocks."""
    a, b, c = _unpack(group, 0, np.uint32), _unpack(group, 1, np.uint32), _unpack(group, 2, np.uint32)
    keys = np.concatenate([a[0], b[0], c[0]])
    doc, at, h = np.concatenate([a[1], b[1] + len(a[0])]), np.concatenate([a[2], b[2]]), np.concatenate([a[3], b[3]])
    block = np.r_[a[2] % BLOCK == 0, np.ones(len(b[1]), bool)]
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]]) if len(h) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(h)])
    hit = np.zeros(len(h), bool)
    if len(h):
        met = np.logical_or.reduceat(block[order], starts) & (sizes > 1)
        hit[order] = np.repeat(met, sizes)
    return _flags(keys, np.concatenate([doc[hit], c[1] + len(a[0]) + len(b[0])]), np.concatenate([at[hit], c[2]]), parts)


def _places(flags: list[bytes]) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(flags), np.int32))


def _extend(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Windows that hold a hit: the least document of each in a chunk goes on, the others are settled."""

    def sent(chunk: _Chunk) -> Iterator[pa.RecordBatch]:
        keys, doc, at, h, h2 = chunk.taken()
        order = np.lexsort((at, keys[doc, 0], h2, h))
        x, y, d = h[order], h2[order], keys[doc[order], 0]
        first = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        least = np.repeat(d[first], np.diff(np.r_[np.flatnonzero(first), len(d)]))
        gone = order[d > least]
        gone = gone[np.lexsort((at[gone], doc[gone]))]
        yield from _pack(keys, doc[gone], at[gone], np.zeros(len(gone), np.uint64), _spread(keys, buckets)[doc[gone]], 2, np.zeros(len(gone), np.uint16))
        one = np.sort(order[first])
        yield from _pack(keys, doc[one], at[one], h[one], ((h[one] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), 0, h2[one])
        same = np.sort(order[~first & (d == least)])  # the least document's own repeats, settled with its first
        yield from _pack(keys, doc[same], at[same], h[same], ((h[same] >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), 0, h2[same])

    chunk = _Chunk()
    for batch in batches:
        for doc_id, th, text, flags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, hit = words_of(text), np.frombuffer(flags, np.int32)
            n = len(words) - WINDOW + 1
            edge = np.zeros(n + 1, np.int64)  # starts f - (WINDOW - BLOCK) to f hold the hit at f
            np.add.at(edge, np.clip(hit - (WINDOW - BLOCK), 0, n), 1)
            np.add.at(edge, np.minimum(hit + 1, n), -1)
            at = np.flatnonzero(np.cumsum(edge[:n]))
            if len(at):
                h = hashes(words)
                chunk.add(doc_id, th, at, rolling(h, WINDOW, R1)[at], rolling(h, WINDOW, R2)[at].astype(np.uint16))
                if chunk.n >= CHUNK // 2:
                    yield from sent(chunk)
    if chunk.n:
        yield from sent(chunk)


def _repeats(group: pa.Table, parts: int) -> pa.Table:
    """Windows that a smaller doc_id also has."""
    a, c = _unpack(group, 0, np.uint64), _unpack(group, 2, np.uint64)
    keys, doc, at, h, h2 = a
    gone = np.zeros(0, np.int64)
    if len(h):
        order = np.lexsort((keys[doc, 0], h2, h))
        x, y, d = h[order], h2[order], keys[doc[order], 0]
        first = np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])]
        least = np.repeat(d[first], np.diff(np.r_[np.flatnonzero(first), len(d)]))
        gone = order[d > least]
    return _flags(np.concatenate([keys, c[0]]), np.concatenate([doc[gone], c[1] + len(keys)]), np.concatenate([at[gone], c[2]]), parts)


def _cut(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, _, text, flags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, n = words_of(text), 0
            total = len(words)
            if flags and doc_id is not None:
                at = np.frombuffer(flags, np.int32)
                edge = np.zeros(total + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge[:total]) > 0
                n = int(gone.sum())
                words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            kept = b" ".join(words)
            out.append((doc_id, total, n, kept.decode("utf-8", "replace") if with_text else hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept is the text of what stays, words joined by a space, or its SHA-256."""
    # A bare column where no cast is needed: an alias would keep the two exchanges of texts from being one.
    doc_id = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.hash("text").cast("long").alias("th"), F.col("text").cast("binary").alias("text"))
    # Both joins read one and the same exchange of the texts, so both leave out rows without a doc_id.
    known, nameless = rows.filter("doc_id is not null"), rows.filter("doc_id is null")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, total // BUCKET_BYTES + 1)

    def hits(group: pa.Table) -> pa.Table:
        return _hits(group, buckets)

    def repeats(group: pa.Table) -> pa.Table:
        return _repeats(group, buckets)

    packs = map_arrow(known, partial(_probe, buckets=buckets), PACK)
    flags = packs.groupBy("bucket").applyInArrow(hits, FLAGS).groupBy("part").applyInArrow(_by_document, BY_DOCUMENT)
    near = known.join(flags, ["doc_id", "th"]).select("doc_id", "th", "text", "flags")
    windows = map_arrow(near, partial(_extend, buckets=buckets), PACK)
    gone = windows.groupBy("bucket").applyInArrow(repeats, FLAGS).groupBy("part").applyInArrow(_by_document, BY_DOCUMENT)
    final = known.join(gone, ["doc_id", "th"], "left").select("doc_id", "th", "text", "flags")
    final = final.union(nameless.select("doc_id", "th", "text", F.lit(None).cast("binary")))
    return map_arrow(final, partial(_cut, with_text=with_text), "doc_id long, n_words long, n_removed long, kept string")
