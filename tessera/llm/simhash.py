"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint's bits are dealt to the non-zero vectors of {0,1}^(r+1). For each
non-zero vector v of that space one table keeps the bits whose vector has an odd
inner product with v. Any r differing bits leave some v orthogonal to all of
them, so two fingerprints within r bits agree on all the bits of some table:
2^(r+1) - 1 tables miss no pair within the radius.

A table's bucket gets its members together only up to BUCKET of them. The rows
of a larger one stream on to a finer table: its free bits are cut into r + 1
blocks of which one must agree as well. Each pass fixes more bits, and as the
members of a bucket are distinct fingerprints, f free bits hold 2^f of them at
most: the recursion ends, and no link is lost. Within a bucket only a spanning
forest of the links is given out, closest pairs first, not all the pairs.

Edge cases: a null or empty text has no words and the fingerprint zero, linked
like any other; rows with equal doc_id are rows of one document; a null doc_id
takes part in links but never names a component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, components, hashes, map_arrow, release, words_of

BITS = 64
#: Members of a bucket that one task compares at once.
BUCKET = 1500
#: Word shingles and similarity of near-duplicates.
SHINGLE, SIMILARITY = 5, 0.8


def shingles(words: list[bytes], k: int) -> list[bytes]:
    """Runs of k words; the whole sequence where there are fewer, nothing for no words."""
    if not words:
        return []
    if len(words) <= k:
        return [b" ".join(words)]
    if k == 1:
        return words
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def majority(h: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the hashes."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65536):
        part = h[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(h)).view(">u8")[0])


def _fingerprint(batches: Iterator[pa.RecordBatch], k: int, distinct: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, same = [], []
        for text in batch.column(1).to_pylist():
            words = words_of(text and text.lower())
            parts = shingles(words, k)
            if distinct:
                parts = list(dict.fromkeys(parts))
                same.append(hashes([b" ".join(words), b"\n".join(words[::-1])]).tobytes())
            fps.append(majority(hashes(parts)))
        columns = [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(same, pa.binary())] if distinct else columns, names=["doc_id", "fp", "same"][: 2 + distinct])


def fingerprints(docs: DataFrame, k: int = 3, distinct: bool = False) -> DataFrame:
    """(doc_id, fp): 64-bit SimHash of the lower-cased words' shingles by XXH64.

    distinct: each shingle counts once, and a column `same` (128 bits) tells equal word sequences.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, partial(_fingerprint, k=k, distinct=distinct), "doc_id long, fp long" + ", same binary" * distinct)


def masks(radius: int, seed: int = 7) -> list[int]:
    """The bit mask of each table: position i is kept where <m(i), v> is odd."""
    n = 2 ** (radius + 1)
    dealt = np.random.default_rng(seed).permutation(BITS)
    vector = {int(p): 1 + i % (n - 1) for i, p in enumerate(dealt)}
    return [sum(1 << p for p in range(BITS) if (vector[p] & v).bit_count() % 2) for v in range(1, n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fp: np.ndarray, node: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest of the members within `reach` bits (Prim)."""
    n = len(fp)
    left = np.ones(n, bool)
    best, via, out = np.full(n, 255, np.uint8), np.zeros(n, np.int64), []
    for _ in range(n):
        i = int(np.argmin(np.where(left, best, 255)))
        if not left[i]:
            i = int(np.argmax(left))
        if best[i] <= reach:
            out.append((int(node[i]), int(node[via[i]])))
        left[i] = False
        d = np.bitwise_count(fp ^ fp[i]).astype(np.uint8)
        closer = left & (d < best)
        best[closer], via[closer] = d[closer], i
    return out


def _buckets(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, mask, fp, node) to edges, and the rows of buckets over BUCKET to the next pass (kind 1)."""
    kept: list[np.ndarray] = []
    names = ["kind", "a", "b", "mask"]

    def rows(kind: int, a, b, mask) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (a, b, mask))], names=names)

    def settled(block: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole buckets."""
        key, mask, fp, node = block
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (mask[1:] != mask[:-1])])
        sizes = np.diff(np.r_[starts, len(key)])
        two = starts[sizes == 2]
        close = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= reach]
        edges = [np.stack([node[close], node[close + 1]])]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            if n > BUCKET:
                yield rows(1, fp[s : s + n], node[s : s + n], mask[s : s + n])
            elif found := forest(fp[s : s + n].view(np.uint64), node[s : s + n], reach):
                edges.append(np.array(found, np.int64).T)
        edges = np.unique(np.sort(np.concatenate(edges, axis=1), axis=0), axis=1)
        yield rows(0, edges[0], edges[1], np.zeros(edges.shape[1]))

    over: tuple | None = None
    for batch in batches:
        block = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if over:  # the rest of a bucket that is too large already streams on
            n = int(np.argmax(np.r_[(block[0] != over[0]) | (block[1] != over[1]), True]))
            if n:
                yield rows(1, block[2][:n], block[3][:n], block[1][:n])
            block = block[:, n:]
            if not block.shape[1]:
                continue
            over = None
        kept.append(block)
        block = np.concatenate(kept, axis=1)
        last = int(np.argmax((block[0] == block[0][-1]) & (block[1] == block[1][-1])))
        if last:
            yield from settled(block[:, :last])
        kept = [block[:, last:]]
        if kept[0].shape[1] > BUCKET:
            over = (kept[0][0][0], kept[0][1][0])
            yield rows(1, kept[0][2], kept[0][3], kept[0][1])
            kept = []
    if kept and kept[0].shape[1]:
        yield from settled(np.concatenate(kept, axis=1))


def _finer(mask: int, blocks: int) -> list[int]:
    free = [p for p in range(BITS) if not mask >> p & 1]
    cut = [free[i::blocks] for i in range(blocks)]
    return [mask | sum(1 << p for p in part) for part in cut if part]


def _keyed(rows: DataFrame, of: dict[int | None, list[int]]) -> DataFrame:
    """A row for each mask that follows a row's own: (key, mask, fp, node)."""
    arrays = [(m, F.array(*[F.struct(F.col("fp").bitwiseAND(F.lit(_signed(x)).cast("long")).alias("key"), F.lit(_signed(x)).cast("long").alias("mask")) for x in to])) for m, to in of.items()]
    if None in of:
        tables = arrays[0][1]
    else:
        tables = F.when(F.lit(False), arrays[0][1])
        for m, a in arrays:
            tables = tables.when(F.col("mask") == F.lit(_signed(m)).cast("long"), a)
    return rows.select("fp", "node", F.explode(tables).alias("t")).select("t.key", "t.mask", "fp", "node")


def links(nodes: DataFrame, radius: int, reach: int | None = None) -> DataFrame:
    """Edges (a, b) that connect all nodes (fp, node) within `radius` bits, and more up to `reach` where met.

    Nodes with equal fingerprints beyond BUCKET in number are first joined to the
    least of them, which alone goes on; so a bucket's members that recursion has
    to part differ in their bits.
    """
    reach = radius if reach is None else reach
    first = nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    crowded = nodes.join(first.filter(F.col("n") > BUCKET // 10), "fp")
    out = crowded.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    rows = nodes.join(first.filter(F.col("n") > BUCKET // 10), "fp", "left").filter("first is null or node = first").select("fp", "node")
    of: dict[int | None, list[int]] = {None: masks(radius)}
    level = {x for x in of[None]}
    for _ in range(12):
        keyed = _keyed(rows, of).repartition("key", "mask").sortWithinPartitions("key", "mask", "fp", "node")
        met = checkpointed(map_arrow(keyed, partial(_buckets, reach=reach), "kind int, a long, b long, mask long"))
        out = out.union(met.filter("kind = 0").select("a", "b"))
        rows = met.filter("kind = 1").select(F.col("a").alias("fp"), F.col("b").alias("node"), "mask")
        if rows.isEmpty():
            return out.distinct()
        used = {r[0] & (2**64 - 1) for r in rows.select("mask").distinct().toLocalIterator()}  # masks, not rows: at most as many as there are tables
        of = {m: _finer(m, radius + 1) for m in sorted(used & level)}
        level = {x for to in of.values() for x in to}
    raise RuntimeError("a bucket could not be parted")


def groups(docs: DataFrame, k: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked at `radius` or fewer differing bits."""
    fps = checkpointed(fingerprints(docs, k))
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(nodes.select("fp", F.col("fp").alias("node")), radius))
    named = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.unique(hashes(shingles(words_of(t and t.lower()), SHINGLE))).view(np.int64) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "parts"])


def _similar(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= least * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _checked(pairs: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that share `least` of their shingles."""
    held = pairs.join(parts.select(F.col("node").alias("a"), F.col("parts").alias("x")), "a").join(parts.select(F.col("node").alias("b"), F.col("parts").alias("y")), "b")
    return checkpointed(map_arrow(held.select("a", "b", "x", "y"), partial(_similar, least=least), "a long, b long"))


def _joined(table: pa.Table, least: float) -> pa.Table:
    """Links (a, b) that join the roots of a block's rows (node, root, mine, parts) which share `least` of their shingles."""
    node, mine = table.column("node").to_numpy(), table.column("mine").to_numpy()
    root = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
    parts = table.column("parts").combine_chunks()
    sizes = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.r_[0, np.cumsum(sizes)]
    ids = np.unique(parts.flatten().to_numpy(), return_inverse=True)[1]
    holders = np.repeat(np.arange(len(node)), sizes)[np.argsort(ids, kind="stable")]
    starts = np.r_[0, np.cumsum(np.bincount(ids))]
    apart = len(np.unique(mine)) > 1  # two blocks: pairs within one are met where it is alone
    most = root[np.argmax(np.bincount(root)[root])]
    out = []
    for i in range(len(node)):
        if root[i] == most:  # its pairs with others are met from their side
            continue
        own = ids[ends[i] : ends[i + 1]]
        both = np.bincount(np.concatenate([holders[starts[x] : starts[x + 1]] for x in own]), minlength=len(node))
        near = (both >= least * (sizes + sizes[i] - both)) & (root != root[i])
        for j in np.flatnonzero(near & (mine != mine[i]) if apart else near):
            if root[j] != root[i]:
                out.append((node[i], node[j]))
                to, gone = (root[i], root[j]) if root[i] == most else (root[j], root[i])
                root[root == gone] = to
    ends_of = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ends_of[:, 0]), "b": pa.array(ends_of[:, 1])})


def completed(labels: DataFrame, parts: DataFrame, least: float, spare: int = 32, block: int = 1 << 20) -> DataFrame:
    """labels (node, root), joined where nodes of different roots share `least` of their shingles.

    Of n shingles, rarest first, two sets that share `least` of them have one in
    common among the first n - ceil(least * n) + 1. A shingle's holders outside its
    largest root are held against all of its holders: as pairs where they are
    `spare` or fewer; else the holders meet in tasks, dealt to blocks of some
    `block` shingles and each block with each, and only links that join roots come out.
    """
    rows = parts.join(labels.select("node"), "node", "left_semi").select("node", F.size("parts").alias("n"), F.explode("parts").alias("s"))
    rows = rows.join(rows.groupBy("s").agg(F.count(F.lit(1)).alias("df")), "s")
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("node").orderBy("df", "s")))
    prefix = rows.filter((F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1) & (F.col("df") > 1)).select("s", "node", "n")
    rooted = checkpointed(prefix.join(labels, "node").select("s", "node", "n", "root"))
    mixed = rooted.groupBy("s", "root").agg(F.count(F.lit(1)).alias("of"), F.sum("n").alias("size"))
    mixed = mixed.groupBy("s").agg(F.sum("of").alias("df"), F.max("of").alias("most"), F.max_by("root", F.struct("of", "root")).alias("major"), F.sum("size").alias("size")).filter("df > most")
    mixed = checkpointed(mixed.withColumn("few", F.col("df") - F.col("most") <= spare))
    other = rooted.select("s", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("far"))
    met = rooted.join(mixed.filter("few").select("s", "major"), "s").filter("root <> major").join(other, "s")
    met = met.filter((F.col("root") != F.col("far")) & (F.least("n", "m") >= F.greatest("n", "m") * least - 1e-9))
    good = _checked(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), parts, least)
    many = rooted.join(mixed.filter("not few").select("s", F.ceil(F.col("size") / block).alias("blocks")), "s")
    many = many.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks"))).select("s", "node", "root", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("with"))
    many = many.join(parts.select("node", "parts"), "node").withColumns({"lo": F.least("mine", "with"), "hi": F.greatest("mine", "with")})
    spread = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number given: little data but much work, not to be put together
    many = many.repartition(spread, "s", "lo", "hi").groupBy("s", "lo", "hi")
    good = checkpointed(good.union(many.applyInArrow(lambda table: _joined(table, least), "a long, b long")))
    release(parts.sparkSession)
    above = components(_between(good, labels)).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return labels.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) as pairs of different roots."""
    ends = pairs.join(labels.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(labels.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
    return ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def near_copies(docs: DataFrame, radius: int = 5, reach: int = 8, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, group_id) of documents in groups of two or more near copies.

    Near copies share `least` of their five-word shingles (Jaccard). A SimHash of
    those shingles lies about ten bits apart at that similarity, beyond any
    radius that covering tables reach, so candidates come from a SimHash of the
    distinct words, where nearly all such pairs lie within five bits; each
    candidate edge is then held against the shingles themselves. Where an edge
    fails between two groups, a forest or the star of a crowded fingerprint may have
    stood for other pairs: all members of both are then joined on their shingles. Equal
    word sequences need no search and are one node. Rows without a doc_id are left out.
    """
    rows = docs.filter("doc_id is not null")
    prints = checkpointed(fingerprints(rows, 1, distinct=True))
    nodes = checkpointed(prints.groupBy("same").agg(F.min("doc_id").alias("node"), F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n")))
    edges = checkpointed(links(nodes.select("fp", "node"), radius, reach))
    wanted = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    texts = rows.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("binary").alias("text"))
    parts = map_arrow(texts.join(wanted, "node", "left_semi"), _sets, "node long, parts array<long>").groupBy("node").agg(F.max("parts").alias("parts"))
    parts = checkpointed(parts)
    release(docs.sparkSession)
    good = _checked(edges, parts, least)
    labels = checkpointed(wanted.join(components(good), "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    torn = checkpointed(_between(edges.join(good, ["a", "b"], "left_anti"), labels))
    found = labels
    if not torn.isEmpty():
        roots = torn.select(F.col("a").alias("root")).union(torn.select(F.col("b").alias("root"))).distinct()
        found = labels.join(roots, "root", "left_anti").select("node", "root").union(completed(labels.join(roots, "root", "left_semi").select("node", "root"), parts, least))
    found = checkpointed(found.join(found.groupBy("root").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "root", "left_semi"))
    named = nodes.join(found, "node", "left").filter("root is not null or n > 1").select("same", F.coalesce("root", "node").alias("group_id"))
    return prints.join(named, "same").select("doc_id", "group_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without all but one (the least doc_id) of each group of near copies."""
    surplus = near_copies(docs).filter("doc_id <> group_id").select("doc_id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.join(surplus, "doc_id", "left_anti").select("row.*")
