"""Token ids as length-delimited binary records, with an offset index.

A record frames one document's sequence: its payload's length (unsigned 64 bits,
little-endian), the masked checksum of these 8 bytes (32 bits), the payload, the
payload's masked checksum. The payload is one byte (1 if there is no doc_id, plus 2
if ids are wide), the doc_id (signed 64 bits) and the ids, unsigned, of 16 bits each
or, of a vocabulary that needs it, wide ones of 32. A checksum is zlib's
CRC-32, rotated right by 15 bits plus MASK, so that a checksum stored in data isn't
taken for one over it.

Documents are dealt to parts by range of doc_id and written in order, a file a part,
by tasks in the shared folder. The index is a table of its own, written by Spark:
a row a record with its file, offset and length. A task that is tried again writes
a file of another name, and only files that the index names count, so a lost
executor leaves nothing wrong. `read` goes through files in order, `shuffled` goes
by the index in a seeded order.

The tokenizer is applied to runs of text that its own splitting keeps apart: it
parts text before white space that follows anything else, and between a letter and
a sign. So a text is cut before runs of spaces and line ends and between a Latin
letter and an ASCII sign, a batch at a time by Arrow, and the library encodes each
distinct piece that a worker doesn't hold yet. A text where such a run follows
other white space, or that holds a special token, is encoded whole.

Edge cases: a null text counts as empty and has the end id alone; a null doc_id
comes first and is read back as null; documents of one doc_id stand in order of
their text; repeated rows are records of their own; an empty table gives no files
and an empty index. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow, shared_folder

END = 0
MASK = 0xA282EAD8
#: Characters of the pieces that a worker holds newest; as many older ones are held besides.
CACHE = 3_000_000
#: Bytes that a reader takes from a file at once.
BLOCK = 1 << 20

#: Layouts of a length, of a checksum or an id, of what stands before the ids.
HEAD, CHECK, OWN = "<Q", "<I", "<Bq"
INDEX = "part int, file string, doc_id long, number long, offset long, length long, n_tokens long"
READ = "part int, doc_id long, start long, n_tokens long, ids array<long>, ids_crc32 long"

#: Where texts are cut, NUL in between.
_CUT, _PARTED = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])|([ \n]+)", "\\1\x00\\2\\3"
#: White space of any kind, or what some tables count as such, before a cut; and NUL.
_ODD = r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}][ \n]|\x00"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = struct.pack(HEAD, len(payload))
    return b"".join((head, struct.pack(CHECK, masked(head)), payload, struct.pack(CHECK, masked(payload))))


class _Known(dict):
    """Ids of pieces as bytes, encoded when first asked for; of those held longest, what isn't asked for again is let go."""

    def __init__(self, encode) -> None:
        self.encode, self.before, self.held = encode, {}, 0

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.before.get(piece) or self.encode(piece)
        self.held += len(piece)
        return ids

    def aged(self) -> None:
        if self.held > CACHE:
            self.before, self.held = dict(self), 0
            self.clear()


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library, given as its JSON, each with the end id, if any."""

    def __init__(self, definition: str, end: int | None = END) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are what runs side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.kind = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), (end or 0) + 1) <= 1 << 16 else "<u4")
        self.known = _Known(self._ids)
        self.whole = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([] if end is None else [end], self.kind)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _ODD)
        for token in self.whole:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        parts = pc.split_pattern(pc.replace_substring_regex(pc.if_else(odd, "", texts), _CUT, _PARTED), "\x00")
        pieces = pc.dictionary_encode(parts.flatten())
        self.known.aged()
        ids = [self.known[p] if p else b"" for p in pieces.dictionary.to_pylist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        flat, start = np.frombuffer(b"".join(ids), self.kind), np.cumsum(size) - size
        which = pieces.indices.to_numpy()
        many = size[which]
        upto = np.cumsum(many)
        out = flat[np.arange(many.sum()) + np.repeat(start[which] - (upto - many), many)]
        at = np.asarray(parts.offsets)
        ends = np.concatenate([[0], upto])[at - at[0]].tolist()
        for i, whole in enumerate(odd.to_pylist()):
            own = np.frombuffer(self._ids(texts[i].as_py()), self.kind) if whole else out[ends[i] : ends[i + 1]]
            yield np.concatenate([own, self.end])


_encoders: dict[tuple, Encoder] = {}


def encoder(definition: str, end: int | None) -> Encoder:
    """A worker's encoder, kept from task to task."""
    key = (hashlib.sha256(definition.encode()).digest(), end)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition, end)
    return _encoders[key]


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(docs: DataFrame, folder: str, tokenizer: str, end: int | None = END) -> None:
    """Write docs (doc_id, text) to `folder`: records/ in ascending doc_id order over the files' parts, index/ as Parquet.

    tokenizer: path of the tokenizer's JSON on the driver; tasks get its content (a
    few MB). folder: one that driver and executors share.
    """
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    _store(folder)[0].create_dir(f"{_store(folder)[1]}/records", recursive=True)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out, name, part = None, None, "", TaskContext.get().partitionId()
        offset = number = 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    encode = encoder(definition.value, end)
                    store, place = _store(folder)
                    name = f"{part:06d}-{uuid.uuid4().hex}.bin"
                    out = store.open_output_stream(f"{place}/records/{name}", buffer_size=BLOCK)
                rows = []
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                    record = framed(struct.pack(OWN, (doc_id is None) + 2 * (ids.itemsize == 4), doc_id or 0) + ids.tobytes())
                    out.write(record)
                    rows.append((part, name, doc_id, number, offset, len(record), len(ids)))
                    offset += len(record)
                    number += 1
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(dealt, written, INDEX).write.parquet(f"{folder}/index")


def _records(stream: pa.NativeFile, where: str) -> Iterator[bytes]:
    """The payloads of a file, read in blocks; a frame that is cut off or whose checksum is wrong is an error."""

    def exactly(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError(f"{where} ends within a record")
        return data

    while head := stream.read(struct.calcsize(HEAD)):
        if len(head) != struct.calcsize(HEAD) or struct.unpack(CHECK, exactly(struct.calcsize(CHECK)))[0] != masked(head):
            raise ValueError(f"{where}: a length is damaged")
        payload = exactly(struct.unpack(HEAD, head)[0])
        if struct.unpack(CHECK, exactly(struct.calcsize(CHECK)))[0] != masked(payload):
            raise ValueError(f"{where}: a record is damaged")
        yield payload


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of a payload."""
    kind, doc_id = struct.unpack_from(OWN, payload)
    return None if kind & 1 else doc_id, np.frombuffer(payload, "<u4" if kind & 2 else "<u2", offset=struct.calcsize(OWN)).astype("<u4")


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(part, file, records, bytes, tokens, start): the files that count; start: ids of all files before. One row a file."""
    rows = index(spark, folder).groupBy("part", "file").agg(F.count(F.lit(1)).alias("records"), F.sum("length").alias("bytes"), F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(part, doc_id, start, n_tokens, ids, ids_crc32) of all records, each file read by one task in order.

    start: ids of all records before. A file that has other records than the index says is an error.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of in batch.to_pylist():
                store, place = _store(folder)
                where, at, seen, out, held = f"{place}/records/{of['file']}", of["start"], 0, [], 0
                with store.open_input_stream(where, buffer_size=BLOCK) as stream:
                    for payload in _records(stream, where):
                        doc_id, ids = parsed(payload)
                        out.append((of["part"], doc_id, at, len(ids), ids if with_ids else None, zlib.crc32(ids)))
                        at += len(ids)
                        seen += 1
                        held += len(ids) if with_ids else 1
                        if held >= BLOCK or len(out) >= 10_000:
                            yield _batch(out)
                            out, held = [], 0
                if out:
                    yield _batch(out)
                if (seen, at - of["start"]) != (of["records"], of["tokens"]):
                    raise ValueError(f"{where} holds other records than its index")

    listed = files(spark, folder).select("part", "file", "records", "tokens", "start")
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(listed.repartition(many, "file"), rows, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [c.split()[0] for c in READ.split(", ")])


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """(place, doc_id, ids) in a seeded order over all records: the index is put in order, and tasks fetch their records by offset."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            store, place = _store(folder)
            open_: dict[str, pa.NativeFile] = {}
            out = []
            for of in batch.to_pylist():
                if of["file"] not in open_:
                    if len(open_) >= 64:
                        open_.pop(next(iter(open_))).close()
                    open_[of["file"]] = store.open_input_file(f"{place}/records/{of['file']}")
                stream = open_[of["file"]]
                stream.seek(of["offset"])
                payload = next(_records(stream, of["file"]))
                if len(payload) + struct.calcsize(HEAD) + 2 * struct.calcsize(CHECK) != of["length"]:
                    raise ValueError(f"{of['file']} holds other records than its index")
                out.append((of["place"], *parsed(payload)))
            for stream in open_.values():
                stream.close()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.list_(pa.int64())], strict=True)], ["place", "doc_id", "ids"])

    order = index(spark, folder).select("file", "offset", "length", F.xxhash64(F.lit(seed), "part", "number").alias("place"))
    return map_arrow(order.orderBy("place", "file", "offset"), rows, "place long, doc_id long, ids array<long>")


def round_trip(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of docs written to a folder and read back."""
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    write(docs, folder, tokenizer)
    return read(spark, folder, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
