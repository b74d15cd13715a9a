"""Benchmark decontamination by canonical templates.

Texts become words in which numbers, names and units are typed placeholders:
<number>, <unit> after a number, <name> for a capitalised word. Eight or more
capitalised words on end are text in title case: their words are plain. Items are taken in a
second form as well, with capitalised words as plain ones, so that copies in other
case are found too; documents in one form only.
Windows of WIDTH such words of each benchmark item are hash-joined with the windows
of all documents, so an item matches although its numbers or names were changed. A
window with the item's own values, or without any, counts at once. A run of changed
windows along one alignment counts only if its slots are consistent: equal values of
the item have equal values in the document. Different ones may come out equal. Slots
are looked at for texts with hits only. Native columns only.

Windows of which fewer than half are plain words would match any list of numbers:
their hash takes in the values, so they match word for word only. Items of under
WIDTH words match as one window of their own length, and only if PLAIN of its words
or more are plain ones: a bare number or name is no evidence.

Edge cases: null and empty texts have no words and match nothing; items without
words, or short ones without enough plain words, match nothing; repeated rows give
one result for each doc_id and item; a null doc_id is a document like others. Texts
are told apart by 128 bits of MD5. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

WIDTH, PLAIN = 8, 3
#: Benchmark windows up to which their hashes are broadcast (some 30 bytes each) to sift the documents' windows; beyond, both sides are shuffled.
MANY = 2_000_000
#: Hashes of texts with hits up to which they are broadcast (some 100 bytes each).
FEW = 200_000
MARK, SEP = "§", "¦"
#: Capitalised words on end, with no letters between, or what goes on behind so many that one match ends.
TITLE = r"(?=\p{Lu})(?<!\p{L})\p{Lu}\p{L}*+(?:[^\p{L}]{1,20}+\p{Lu}\p{L}*+){7,200}+|\G(?!\A)(?:[^\p{L}]{1,20}+\p{Lu}\p{L}*+){1,200}+"
#: What all texts with a TITLE run hold; cheaper to look for.
TITLED = r"\p{Lu}\p{L}*+(?:[^\p{L}]{1,20}+\p{Lu}\p{L}*+){7}"
NO_WINDOWS = "array<struct<n:int,at:int,h:bigint>>"
#: Units that may follow a number.
UNITS = "km cm mm nm m kg mg g lb lbs oz t l ml mph kmh kph ft inch inches mile miles hour hours hr hrs h minute minutes min second seconds sec s day days week weeks month months year years dollar dollars euro euros cent cents percent degrees mb gb kb tb hz khz mhz ghz kw w v".split()


def tagged(text: Column, names: bool = True, values: bool = True) -> Column:
    """Words joined by spaces; a placeholder is its type and, with values, SEP and the value. names: capitalised words are placeholders."""
    shown = lambda kind: f"{MARK}{kind}{SEP}$1" if values else f"{MARK}{kind}"
    t = F.translate(F.coalesce(text, F.lit("")), MARK + SEP, "  ")
    if names:
        t = _bound(t, lambda x: F.when(x.rlike(TITLED), _lowered(x)).otherwise(x))
        t = F.regexp_replace(t, r"(?=\p{Lu})(?<![\p{L}\p{N}])(\p{Lu}\p{Ll}+)", shown("n"))
    t = F.lower(t)
    marks = MARK + SEP

    def with_numbers(x: Column) -> Column:
        x = F.regexp_replace(x, rf"[^\p{{L}}\p{{N}}.,%€${marks}]+|(?<![0-9])[.,%€$]|[.,](?![0-9])", " ")
        number = F.regexp_replace(x, rf"(?=[0-9])(?<![\p{{L}}\p{{N}}{marks}])([0-9]+(?:[.,][0-9]+)*)", f" {shown('#')} ")
        before = rf"{MARK}#{SEP}[0-9.,]+" if values else rf"{MARK}#"
        return F.regexp_replace(number, rf"({before}) +({'|'.join(UNITS)}|%|€|\$)(?![\p{{L}}\p{{N}}])", f"$1 {shown('u').replace('$1', '$2')}")

    return F.trim(_bound(t, lambda x: F.when(x.rlike("[0-9]"), with_numbers(x)).otherwise(F.regexp_replace(x, rf"[^\p{{L}}\p{{N}}{marks}]+", " "))))


def _lowered(text: Column) -> Column:
    """The text with its runs in title case in lower case."""
    runs = F.regexp_extract_all(text, F.lit(TITLE), F.lit(0))
    return F.array_join(F.zip_with(F.split(text, TITLE), runs, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.lower(F.coalesce(b, F.lit(""))))), "")


def _bound(value: Column, f) -> Column:
    """f(value) with the value computed once: a lambda's own expressions are evaluated anew for each element."""
    return F.transform(F.array(value), f)[0]


def _runs(words: Column, n: int) -> Column:
    """A hash for each run of n words, by doubling: a run of n is one of half of it beside another, or one shorter beside the last word."""

    def of(h: Column, k: int) -> Column:
        if k == 1:
            return h
        if k % 2:
            return _bound(of(h, k - 1), lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(h) - k + 1, F.lit(0))), F.slice(h, k, F.size(h)), lambda a, b: F.xxhash64(a, b)))
        return _bound(of(h, k // 2), lambda x: F.zip_with(F.slice(x, 1, F.greatest(F.size(h) - k + 1, F.lit(0))), F.slice(x, k // 2 + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)))

    cut = lambda x: F.slice(x, 1, F.greatest(F.size(words) - n + 1, F.lit(0)))
    return F.when(F.size(words) >= n, _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda h: cut(of(h, n)))).otherwise(F.array().cast("array<bigint>"))


def _typed(words: Column) -> Column:
    return F.transform(words, lambda w: F.substring_index(w, SEP, 1))


def _slots(words: Column, at: Column, n: Column | int) -> Column:
    """The placeholders of a window with their values."""
    return F.array_join(F.filter(F.slice(words, at + 1, n), lambda w: w.contains(SEP)), " ")


def windows_of(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, n, item_at, h, item_slots, heavy) of each window of each item in both forms, which have as many words; heavy: h is of the words with their values."""
    forms = F.array_distinct(F.array(*[tagged(F.col("text"), names) for names in (True, False)]))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.explode(forms).alias("t")).filter("t <> ''").withColumn("words", F.split("t", " +"))
    lengths = [r[0] for r in items.select(F.size("words").alias("k")).filter(F.col("k") < width).distinct().collect()]  # at most width - 1 numbers
    out = None
    for n in sorted({width, *lengths}):
        rows = items.filter(F.size("words") >= width if n == width else F.size("words") == n)
        one = lambda h, i: F.struct(F.lit(n).alias("n"), i.alias("item_at"), h.alias("typed"))  # noqa: E731, B023
        rows = rows.withColumns({"a": _runs(_typed(F.col("words")), n), "b": _runs(F.col("words"), n)})
        rows = rows.select("item_id", "words", "b", F.explode(F.transform("a", one)).alias("w"))
        rows = rows.select("item_id", F.lit(n).alias("n"), "w.item_at", F.col("w.typed").alias("typed"), F.element_at("b", F.col("w.item_at") + 1).alias("full"), _slots(F.col("words"), F.col("w.item_at"), n).alias("item_slots"))
        count = F.when(F.col("item_slots") == "", 0).otherwise(F.size(F.split("item_slots", " ")))
        rows = rows.withColumn("heavy", count * 2 > n).filter(F.lit(True) if n == width else n - count >= PLAIN)
        rows = rows.select("item_id", "n", "item_at", F.when(F.col("heavy"), F.col("full")).otherwise(F.col("typed")).alias("h"), "item_slots", "heavy")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def sifting(keys: DataFrame) -> DataFrame:
    """Keys that sift documents: broadcast up to FEW of them, counted; beyond, the join shuffles."""
    return F.broadcast(keys) if keys.limit(FEW + 1).count() <= FEW else keys


def matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(th, item_id, n_windows, verbatim): texts (by MD5) that hold windows of an item with consistent slots; verbatim: along some alignment all are equal."""
    windows = windows_of(benchmark, width)
    sizes = windows.groupBy("n").agg(F.max("heavy").alias("heavy")).collect()  # a row for each length of window
    # Without any window there is nothing to find, and the plan still has its columns.
    lengths = sorted((r.n, bool(r.heavy)) for r in sizes) or [(width, False)]
    few = windows.select("h").distinct().limit(MANY + 1).count() <= MANY

    def listed(x: Column, heavy: bool) -> Column:
        """Every window's hash by length and place: of typed words, or (heavy) of words with values where that differs."""
        one = lambda n: lambda h, i: F.struct(F.lit(n).alias("n"), i.alias("at"), h.alias("h"))
        parts = []
        for n, any_heavy in lengths:
            if not heavy:
                parts.append(F.transform(_runs(x, n), one(n)))
            elif any_heavy:
                same = lambda n: _bound(_runs(_typed(x), n), lambda a: F.filter(F.transform(_runs(x, n), one(n)), lambda w: w["h"] != a[w["at"]]))
                parts.append(same(n))
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    def both(t: Column) -> Column:
        plain = _bound(F.split(t, " +"), lambda w: listed(w, False))
        crowded = [n for n, heavy in lengths if heavy]
        if not crowded:
            return plain
        # Only texts with so many placeholders near each other can have a window of which over half are.
        crowd = MARK + (rf"\S*(?: +[^ {MARK}]\S*){{0,{max(n - n // 2 - 1 for n in crowded)}}} +{MARK}" * min(n // 2 for n in crowded))
        full = _bound(F.split(tagged(F.col("text")), " +"), lambda w: listed(w, True))
        return F.concat(plain, F.when(t.rlike(crowd), full).otherwise(F.array().cast(NO_WINDOWS)))

    keyed = docs.select(F.md5("text").alias("th"), "text")
    probes = keyed.select("th", F.explode(_bound(tagged(F.col("text"), values=False), both)).alias("w")).select("th", "w.n", "w.at", "w.h")
    if few:
        probes = probes.join(F.broadcast(windows.select("h").distinct()), "h", "left_semi")
    hits = checkpointed(probes.join(windows, ["n", "h"]).select("th", "item_id", "n", "at", "item_at", "item_slots").distinct())
    places = hits.groupBy("th").agg(F.collect_set(F.struct("n", "at")).alias("places"))  # at most the windows of one text
    texts = keyed.join(sifting(hits.select("th").distinct()), "th", "left_semi").groupBy("th").agg(F.first("text").alias("text")).join(places, "th")
    shown = _bound(F.split(tagged(F.col("text")), " +"), lambda w: F.transform(F.col("places"), lambda p: F.struct(p["n"].alias("n"), p["at"].alias("at"), _slots(w, p["at"], p["n"]).alias("slots"))))
    slots = texts.select("th", F.explode(shown).alias("p")).select("th", "p.n", "p.at", "p.slots")
    hits = hits.join(slots, ["th", "n", "at"])
    key = ["th", "item_id", "n"]
    hits = hits.groupBy(*key, (F.col("at") - F.col("item_at")).alias("shift"), "item_at", "slots", "item_slots").agg(F.count(F.lit(1)).alias("c"))
    # Runs of windows that are all changed or all equal; an item's windows are few.
    hits = hits.withColumn("same", F.col("slots") == F.col("item_slots"))
    hits = hits.withColumn("run", F.col("item_at") - F.row_number().over(Window.partitionBy(*key, "shift", "same").orderBy("item_at")))
    pairs = F.when(F.col("same"), F.array().cast("array<struct<a:string,b:string>>")).otherwise(F.arrays_zip(F.split("item_slots", " ").alias("a"), F.split("slots", " ").alias("b")))
    runs = hits.groupBy(*key, "shift", "same", "run").agg(F.count(F.lit(1)).alias("c"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    good = F.size(F.array_distinct(F.transform("pairs", lambda x: x["a"]))) == F.size("pairs")
    lined = runs.groupBy(*key, "shift").agg(F.sum(F.when(good, F.col("c"))).alias("c"), F.min(F.col("same").cast("int")).alias("verbatim")).filter("c > 0")
    return lined.groupBy("th", "item_id").agg(F.sum("c").alias("n_windows"), F.max("verbatim").cast("boolean").alias("verbatim"))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, item_id, n_windows, verbatim) of each document that holds a benchmark passage."""
    found = matches(docs, benchmark, width)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("th"))
    return ids.join(found, "th").select("doc_id", "item_id", "n_windows", "verbatim").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that hold no benchmark passage."""
    found = sifting(checkpointed(matches(docs, benchmark, width).select(F.col("th").alias("_th")).distinct()))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.md5("text").alias("_th"))
    return rows.join(found, "_th", "left_anti").select("row.*")
