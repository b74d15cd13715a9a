"""Mixing sources to target weights by Sainte-Laguë apportionment.

A mix is made of blocks of equally many words. Its blocks go to the sources by
highest quotients target / (2 k + 1), a source's blocks to its shards likewise by
the shards' sizes, so each shard has an integer quota. Within a shard documents
stand in seeded order, and the mix takes the shard whole as often as the quota
holds it and then a run of blocks from a seeded start, around its end. So no
document is taken more than twice.

The quotients need no loop over blocks: near the divisor total / blocks each
share rounds to a count, and the few blocks over or missing are settled by
ranking the quotients next to it, linear in the number of sources.

Edge cases: a null or empty text has size 0 and takes nothing; null is a source,
last in order; repeated rows are documents of their own, taken as any; of an
empty table nothing; sources without words get nothing. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, checkpointed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2
#: Words of a block at most, documents that a shard is to hold, seed.
BLOCK, SHARD_ROWS, SEED = 512, 10_000, 1234
#: Sources up to which their targets are broadcast (some 100 bytes each). Sources are ordered by one task: names, not rows.
FEW = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def apportioned(shares: DataFrame, within: list[str], share: str, seats: str) -> DataFrame:
    """Adds `quota`: `seats` dealt to the rows of each group `within` by Sainte-Laguë on `share`; ties by the columns' order."""
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    key = [c for c in shares.columns if c not in (share, seats, *within)]
    live = shares.withColumn("_all", F.sum(share).over(group)).withColumn("_n", F.count(F.when(F.col(share) > 0, 1)).over(group))
    live = live.withColumn("_q", F.when(F.col("_all") > 0, F.col(share) * F.col(seats) / F.col("_all")).otherwise(0.0))
    live = live.withColumn("_base", F.floor(F.col("_q") + 0.5)).withColumn("_over", F.col(seats) - F.sum("_base").over(group))
    reach = F.ceil(F.col(share) / F.col("_all") * (F.abs("_over") + F.col("_n"))) + 1
    up, down = F.sequence(F.col("_base"), F.col("_base") + reach), F.sequence(F.greatest(F.col("_base") - reach, F.lit(0)), F.col("_base") - 1)
    none = F.array().cast("array<bigint>")
    steps = F.when((F.col(share) <= 0) | (F.col("_all") <= 0) | (F.col("_over") == 0), none).when(F.col("_over") > 0, up).when(F.col("_base") > 0, down).otherwise(none)
    live = live.withColumn("_place", F.row_number().over(group.orderBy(*[F.asc_nulls_last(c) for c in key])))
    next_ = live.select(*within, *key, "_over", "_place", share, F.explode(steps).alias("_k")).withColumn("_quotient", F.col(share) / (2 * F.col("_k") + 1))
    order = [-F.col("_quotient") * F.signum("_over"), F.col("_place") * F.signum("_over")]  # of equal quotients the first gains, the last loses
    taken = next_.withColumn("_r", F.row_number().over(group.orderBy(*order))).filter(F.col("_r") <= F.abs("_over"))
    change = taken.groupBy(*within, *key).agg(F.sum(F.signum("_over")).cast("long").alias("_change"))
    a, b = live.alias("a"), change.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*within, *key)]
    on = same[0]
    for x in same[1:]:
        on = on & x
    quota = (F.col("a._base") + F.coalesce("b._change", F.lit(0))).cast("long").alias("quota")
    return a.join(b, on, "left").select(*[F.col(f"a.{c}").alias(c) for c in shares.columns], quota)


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, times: float = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) of (source, source_size): shares of the whole by weight, none over `times` its source's size.

    The level at which sources reach their bound follows from their order by size
    over weight: those before a source are at their bound, the rest share what is
    left by weight.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1
    rows = sources.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    rows = rows.withColumn("_bound", F.col("source_size") * float(times)).withColumn("_left", F.lit(float(share)) * F.sum("source_size").over(everything))
    rows = rows.withColumn("_at", F.when(F.col("_w") > 0, F.col("_bound") / F.col("_w")).otherwise(F.lit(0.0)))
    order = everything.orderBy("_at", F.asc_nulls_last("source"))
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    # A source's level if just those before it were at their bounds; the true level is the first that a bound doesn't undercut.
    rows = rows.withColumn("_level", F.when(F.sum("_w").over(later) > 0, (F.col("_left") - F.coalesce(F.sum("_bound").over(earlier), F.lit(0.0))) / F.sum("_w").over(later)))
    rows = rows.withColumn("_rank", F.row_number().over(order))
    rows = rows.withColumn("_true", F.min(F.when(F.col("_level") <= F.col("_at"), F.struct("_rank", "_level"))).over(everything)["_level"])
    target = F.when(F.col("_true").isNull(), F.col("_bound")).otherwise(F.least(F.col("_bound"), F.col("_true") * F.col("_w")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def taken(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each document; texts are read once and not shuffled."""
    slim = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"))
    return _overlaps(slim, weights, share, seed).select("doc_id", "size", "source_size", "target", "taken")


def _overlaps(slim: DataFrame, weights: tuple[float, ...], share: float, seed: int) -> DataFrame:
    """slim rows (source, doc_id, size, key) with source_size, target and taken."""
    slim = checkpointed(slim)
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goals = checkpointed(targets(sources.select("source", "source_size"), weights, share))
    whole = goals.agg(F.sum("target"), F.min(F.when(F.col("target") > 0, F.col("target")))).first()
    block = int(max(1, min(BLOCK, (whole[1] or 1) // 64)))
    seats = goals.select("source", "target", F.lit(round((whole[0] or 0) / block)).cast("long").alias("seats"))
    quotas = apportioned(seats, [], "target", "seats").select("source", F.col("quota").alias("blocks"))
    a, b, c = goals.alias("a"), quotas.alias("b"), sources.alias("c")
    goals = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).join(c, F.col("a.source").eqNullSafe(F.col("c.source")))
    goals = goals.select("a.source", "a.source_size", "a.target", "b.blocks", F.greatest(F.lit(1), F.ceil(F.col("c.rows") / SHARD_ROWS)).cast("long").alias("shards"))
    # One row a source: broadcast up to FEW of them, counted, so that a hot source's rows stay where they are; beyond, shuffled.
    goals = checkpointed(goals)
    a, b = slim.alias("a"), (F.broadcast(goals) if goals.count() <= FEW else goals).alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "b.source_size", "b.target", "b.blocks", "b.shards")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed + 1)), F.col("shards")))
    cells = rows.groupBy("source", "blocks", "shard").agg(F.sum("size").alias("cell_size"))
    cells = apportioned(cells.select("source", "shard", "cell_size", "blocks"), ["source"], "cell_size", "blocks").select("source", "shard", "cell_size", "quota")
    a, b = rows.alias("a"), cells.alias("b")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.shard") == F.col("b.shard"))).select("a.*", "b.cell_size", F.least(F.col("b.quota") * block, F.col("b.cell_size") * MOST_TIMES).alias("words"))
    line = Window.partitionBy("source", "shard").orderBy("key", "doc_id", "size", *[c for c in ("same",) if c in rows.columns])
    rows = rows.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("start", F.col("end") - F.col("size")).withColumn("rest", F.when(F.col("cell_size") > 0, F.col("words") % F.col("cell_size")).otherwise(F.lit(0)))
    blocks = F.ceil(F.col("cell_size") / block)
    first = F.when(F.col("cell_size") > 0, F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), blocks) * block).otherwise(F.lit(0))
    rows = rows.withColumn("first", first).withColumn("last", F.col("first") + F.col("rest"))
    common = lambda s, e: F.greatest(F.lit(0), F.least(F.col("end"), e) - F.greatest(F.col("start"), s))
    around = common(F.col("first"), F.col("last")) + common(F.lit(0), F.col("last") - F.col("cell_size"))
    whole_times = F.when(F.col("cell_size") > 0, F.floor(F.col("words") / F.col("cell_size"))).otherwise(F.lit(0))
    return rows.withColumn("taken", (whole_times * F.col("size") + around).cast("long"))


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """The documents as the mix takes them, whole: each as many times as its taken words round to.

    Where a document is taken in part, it stays whole if half of its words or more
    are; its row occurs twice if it is taken one and a half times or more. Rows that
    are the same in all columns are one key, put together before they are shuffled,
    and come back as often as all of them are taken.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    same = F.md5(F.to_json(row))
    slim = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("size"), key.alias("key"), same.alias("same"))
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(F.lit(0)).cast("int")
    wanted = _overlaps(slim, weights, share, seed).groupBy("same").agg(F.sum(times).alias("_times")).filter("_times > 0")
    rows = docs.select(same.alias("same"), row.alias("row")).groupBy("same").agg(F.first("row").alias("row"))
    joined = rows.join(wanted, "same")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_i")).select("row.*")
