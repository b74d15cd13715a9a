"""An audit of how sources differ in their words, exact in integers.

Terms are counted by document in tasks, summed by (lang, source, term), and those
in at least LEAST documents of their language kept. A share p of a group is one
plus SCALE (count + 2) / (N + 2 V), rounded down; what two shares differ by is
(p - q)^2 / (p + q), rounded down.

Pairs of sources sum this over all kept terms, of which a source has few. So a
pair starts from the baseline, all terms counted 0 on both sides, and is corrected
by what occurs: terms of one side by their number at each count (a histogram, as a
share depends on the count alone), terms of both sides by one join on the term.

The terms of a group that stand out are ranked by radix select: histograms over
the value's bits, DIGIT of them a round, give each group's k-th value; where more
terms have that value than there are places left, their UTF-8 bytes, two a round,
are selected in the same way. No group is sorted, and a histogram has at most 2^16
bins and one; only k rows a group are put in order.

Edge cases: a null text, lang or source counts as ''; rows that are alike are
documents of their own; a group without kept terms has shares of nothing but the
baseline; a language with none gives pairs with value 0 and no terms; one with one
source gives no pairs; of an empty table nothing. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, map_arrow

#: Documents of its language that a term is in at least, scale of a share, terms that are reported of a group.
LEAST, SCALE, TOP = 10, 1_000_000_000, 10
#: Bits of a value, of a digit.
BITS, DIGIT = 30, 10
#: Terms that a task holds before it hands them on.
HELD = 400_000
#: Groups up to which one row of each is broadcast, counted first; beyond, they are joined by shuffles.
FEW = 100_000

#: ASCII letters small, other ASCII characters a space; bytes of further characters stay.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_SCHEMA = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, letters A to Z small."""
    return text.translate(_TABLE).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[bytes, bytes], dict[bytes, list[int]]] = {}
    size = 0

    def given() -> pa.RecordBatch:
        rows = [(lang, source, term, *count) for (lang, source), own in held.items() for term, count in own.items()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.binary()] * 3 + [pa.int64()] * 2
        arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([a.cast(pa.string()) if a.type == pa.binary() else a for a in arrays], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        lang, source, text = (batch.column(i).cast(pa.binary()).to_pylist() for i in range(3))
        for where, whole in zip(zip(lang, source, strict=True), text, strict=True):
            own = held.get(where)
            if own is None:
                own = held[where] = {b"": [0, 0]}  # the group occurs, whether it has terms or not
            before = len(own)
            for w, n in Counter(terms_of(whole)).items():
                count = own.get(w)
                if count is None:
                    own[w] = [n, 1]
                else:
                    count[0] += n
                    count[1] += 1
            size += len(own) - before
            if size > HELD:
                yield given()
                held.clear()
                size = 0
    yield given()


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term of each group; the empty term stands for the group."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    part = map_arrow(docs.select(text("lang"), text("source"), text("text")), _counted, _SCHEMA)
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, whole: Column, terms: Column) -> Column:
    """1 + SCALE (count + 2) / (whole + 2 terms), rounded down: exact in integers of any size."""
    wide = lambda x: x.cast("decimal(38,0)")
    return F.lit(1).cast("long") + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 2), wide(whole) + 2 * wide(terms))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table, broadcast if it has FEW rows at most."""
    return F.broadcast(df) if df.count() <= FEW else df


def _bins(rows: DataFrame, group: list[str], bin_: Column, need: Column, ascending: bool) -> DataFrame:
    """Of each group the bin that holds its `need`-th row, how many rows are needed of it, and how many it has."""
    counts = rows.groupBy(*group, bin_.alias("_bin")).agg(F.count(F.lit(1)).alias("_has"), F.first(need).alias("_need"))
    line = Window.partitionBy(*group).orderBy(F.asc("_bin") if ascending else F.desc("_bin"))
    upto = counts.withColumn("_upto", F.sum("_has").over(line)).withColumn("_all", F.sum("_has").over(Window.partitionBy(*group)))
    hit = upto.filter((F.col("_upto") >= F.least("_need", "_all")) & (F.col("_upto") - F.col("_has") < F.least("_need", "_all")))
    return hit.select(*group, F.col("_bin").alias("_at"), (F.least("_need", "_all") - F.col("_upto") + F.col("_has")).alias("_left"), "_has")


def top(rows: DataFrame, group: list[str], value: str, item: str, k: int) -> DataFrame:
    """The rows of each group's k largest values (0 <= value < 2^BITS), of equal ones those with the least UTF-8 bytes.

    rows: checkpointed, as each round reads them; an item occurs once in a group.
    """
    state = None
    for low in range(BITS - DIGIT, -1, -DIGIT):
        open_ = rows if state is None else rows.join(_small(state), group).filter(F.shiftright(value, low + DIGIT) == F.col("_at"))
        need = F.lit(k).cast("long") if state is None else F.col("_left")
        state = checkpointed(_bins(open_, group, F.shiftright(F.col(value), low), need, False))
    found = rows.join(_small(state), group).filter(F.col(value) >= F.col("_at"))
    surely = (F.col(value) > F.col("_at")) | (F.col("_left") == F.col("_has"))
    out = [found.filter(surely).select(*rows.columns)]
    ties = checkpointed(found.filter(~surely).select(*rows.columns, F.encode(item, "UTF-8").alias("_bytes"), "_left"))
    while not ties.isEmpty():
        head = F.substring("_bytes", 1, 2)
        state = checkpointed(_bins(ties, group, head, F.col("_left"), True))
        found = ties.drop("_left").join(_small(state), group).filter(head <= F.col("_at"))
        surely = (head < F.col("_at")) | (F.col("_left") == F.col("_has"))
        out.append(found.filter(surely).select(*rows.columns))
        ties = checkpointed(found.filter(~surely).select(*rows.columns, F.expr("substring(_bytes, 3)").alias("_bytes"), "_left"))
    chosen = out[0]
    for more in out[1:]:
        chosen = chosen.unionByName(more)
    return chosen


def audit(docs: DataFrame, least: int = LEAST, k: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one of its language, and the terms by which it stands out most."""
    counts = checkpointed(counted(docs))
    groups = counts.filter("term = ''").select("lang", "source")
    common = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all")).filter(F.col("docs") >= least)
    kept = checkpointed(counts.filter("term <> ''").select("lang", "source", "term", "n").join(common.select("lang", "term", "all"), ["lang", "term"]))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("whole")).join(common.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("own", "whole", "terms")])
    base = F.when(F.col("terms") > 0, share(F.lit(0), F.col("own"), F.col("terms")))
    groups = checkpointed(groups.withColumn("base", base))
    sized = _small(groups)
    rows = kept.join(sized, ["lang", "source"])
    rows = checkpointed(rows.select("lang", "source", "term", "n", "base", share(F.col("n"), F.col("own"), F.col("terms")).alias("p"), share(F.col("all"), F.col("whole"), F.col("terms")).alias("q")))
    return pairs(rows, groups).unionByName(terms(rows, k))


def terms(rows: DataFrame, k: int) -> DataFrame:
    """The k terms of each group that lie furthest above their language's share."""
    above = checkpointed(rows.filter("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")))
    chosen = top(above, ["lang", "source"], "value", "item", k)
    return _ranked(chosen, "term")


def pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source against each other source of its language, summed over all kept terms."""
    sized = _small(groups)
    other = sized.select("lang", F.col("source").alias("item"), F.col("base").alias("other"))
    each = groups.join(other, "lang").filter("source <> item")
    zero = F.coalesce(F.col("terms") * difference(F.col("base"), F.col("other")), F.lit(0)).alias("value")
    start = each.select("lang", "source", "item", zero)
    # Terms of one side, by count: shares depend on nothing else.
    by_share = rows.groupBy("lang", "source", "base", "p").agg(F.count(F.lit(1)).alias("n"))
    one = by_share.join(other, "lang").filter("source <> item")
    change = F.col("n") * (difference(F.col("p"), F.col("other")) - difference(F.col("base"), F.col("other")))
    one = one.groupBy("lang", "source", "item").agg(F.sum(change).alias("value"))
    mirrored = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x")
    one = one.select("lang", mirrored, "value").select("lang", "x.*", "value")
    # Terms of both sides: what the two corrections by one side got wrong. A term meets each pair of its sources once.
    a = rows.select("lang", "term", "source", "base", "p")
    b = rows.select("lang", "term", F.col("source").alias("item"), F.col("base").alias("other"), F.col("p").alias("p2"))
    met = a.join(b, ["lang", "term"]).filter("source < item")
    wrong = difference(F.col("p"), F.col("p2")) - difference(F.col("p"), F.col("other")) - difference(F.col("base"), F.col("p2")) + difference(F.col("base"), F.col("other"))
    both = met.groupBy("lang", "source", "item").agg(F.sum(wrong).alias("value")).select("lang", mirrored, "value").select("lang", "x.*", "value")
    value = start.unionByName(one).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    return _ranked(value, "pair")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    """Rows (lang, source, item, value) with their place in their group: k terms, or as many rows as a language has sources."""
    line = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(line).cast("int").alias("rank"))


#: The same in SQL for DuckDB.
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST}),
k AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY ALL),
l AS (SELECT lang, sum(n) AS whole, count(*) AS terms FROM v GROUP BY lang),
g AS (SELECT e.lang, e.source, coalesce(sum(k.n), 0) AS own FROM (SELECT DISTINCT lang, source FROM d) e LEFT JOIN k ON e.lang = k.lang AND e.source = k.source GROUP BY ALL),
c AS (SELECT g.lang, g.source, v.term, coalesce(k.n, 0) AS n, 1 + {SCALE} * (coalesce(k.n, 0) + 2) // (g.own + 2 * l.terms) AS p, 1 + {SCALE} * (v.n + 2) // (l.whole + 2 * l.terms) AS q
  FROM g JOIN l ON g.lang = l.lang JOIN v ON g.lang = v.lang LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.term = v.term),
p AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN c x ON x.lang = a.lang AND x.source = a.source LEFT JOIN c y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
t AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM c WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM p
UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT), CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM t QUALIFY rank <= {TOP}
"""
