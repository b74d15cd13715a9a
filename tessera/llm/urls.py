"""URL filters: fixed host and path rules, and association rules mined from labels.

A fixed rule fits its host and all subdomains if the path starts with the rule's;
of several the longest decides. URLs that none fits are judged by association
rules: FP-growth mines the token combinations (host labels, path segments, query
keys) of labelled URLs. A combination blocks if it implies a bad label with enough
support and confidence and its bad pages are too many for chance: the Chernoff bound
of that chance, times the number of combinations mined, is under RISK. So labels
that URLs tell nothing of give next to no rules. A rule that holds another is left out. Each rule is indexed by its rarest token, so
a URL meets only rules of which it has that token. Native columns only.

Edge cases: a null URL or one without "://" has an empty host and path, no tokens,
and is allowed; repeated URLs are judged once and rows repeat; without labels no
rules are mined and all is allowed. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

#: Fixed values: (verdict, host, path) of the rules.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
SUPPORT, CONFIDENCE, RISK = 0.005, 0.6, 0.01
#: Labelled pages that a rule needs at least.
LEAST = 10
BAD = "=bad"
#: Rules beyond this number are joined by shuffle.
FEW = 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens: host labels, the last two of them together, path segments (digits as #), query keys."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    steps = F.filter(F.split(path(url), "/"), lambda x: x != "")
    keys = F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != "")
    parts = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("d:"), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>")),
        F.transform(steps, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(keys, lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))),
    )
    return F.coalesce(F.array_distinct(parts), F.array().cast("array<string>"))


def by_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the longest rule that fits. rules: (verdict, host, path).

    A URL's host suffixes and its path's prefixes of the lengths that rules have
    are matched by equality.
    """
    few = rules.limit(FEW + 1).count() <= FEW
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # as many numbers as paths of rules have lengths
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("p")) for n in lengths]), lambda x: F.length(x.p) == x.n)
    keys = urls.select("url", "path", F.explode(suffixes).alias("h")).select("url", "h", F.explode(prefixes).alias("x")).select("url", "h", F.col("x.p").alias("p"))
    right = rules.select(F.col("host").alias("h"), F.col("path").alias("p"), "verdict")
    hits = keys.join(F.broadcast(right) if few else right, ["h", "p"]).withColumn("rule", F.concat("h", "p"))
    return hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("x")).select("url", "x.rule", "x.verdict")


def mined(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, risk: float = RISK) -> DataFrame:
    """(rule_id, items, n, confidence): token combinations that imply a bad label (quality 0 or toxic 1) beyond chance.

    labels tell of the document with the page's number. Tokens that occur on too few
    labelled pages are left out, and of tokens that occur on the same pages, all of
    which support the same rules, the least stands for all, so that a URL of many
    tokens, wherever they stand, makes no more itemsets than it has kinds of them.
    """
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    rows = pages.select("page_id", tokens(F.col("url")).alias("t")).join(marks, "page_id").filter(F.size("t") > 0)
    rows = checkpointed(rows.select(F.monotonically_increasing_id().alias("row"), "t", "bad"))
    n, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    if not 0 < bad < n:
        return pages.sparkSession.createDataFrame([], "rule_id string, items array<string>, n long, confidence double")
    least = max(support, LEAST * confidence / n)
    each = rows.select("row", F.explode("t").alias("token"))
    spread = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("where")).filter(F.col("n") >= least * n)
    kinds = spread.groupBy("n", "where").agg(F.min("token").alias("token")).select("token")
    kept = each.join(kinds, "token").groupBy("row").agg(F.collect_list("token").alias("kept"))
    items = F.concat(F.coalesce("kept", F.array().cast("array<string>")), F.when(F.col("bad") == 1, F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")))
    baskets = checkpointed(rows.select("row", "bad").join(kept, "row", "left").select(items.alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(baskets)
    sets = checkpointed(model.freqItemsets)
    tried, base = sets.count(), bad / n
    key = F.array_join(F.array_sort("items"), " ")
    with_bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_sort(F.array_remove("items", BAD)).alias("items"), F.col("freq").alias("k"))
    plain = sets.filter(~F.array_contains("items", BAD)).select(key.alias("key"), F.col("freq").alias("n"))
    found = with_bad.withColumn("key", key).join(plain, "key").withColumn("confidence", F.col("k") / F.col("n"))
    c = F.col("confidence")
    apart = c * F.log(c / base) + F.when(c < 1, (1 - c) * F.log((1 - c) / (1 - base))).otherwise(F.lit(0.0))
    sure = (F.col("n") >= LEAST) & (c >= confidence) & (c > base) & (F.col("n") * apart >= math.log(max(tried, 1) / risk))
    rules = checkpointed(found.filter(sure).select(F.sha2("key", 256).alias("rule_id"), "items", "n", "confidence"))
    # A rule that holds all the tokens of a shorter one blocks nothing more.
    wider = by_tokens(rules.select(F.col("rule_id").alias("url"), F.col("items").alias("tokens")), rules, True).withColumnRenamed("url", "rule_id")
    return rules.join(wider, "rule_id", "left_anti")


def by_tokens(urls: DataFrame, rules: DataFrame, longer: bool = False) -> DataFrame:
    """The urls (url, tokens) that hold all the tokens of a rule (longer: and more), each once."""
    items = rules.select("rule_id", "items", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rarest = items.join(often, "item").groupBy("rule_id").agg(F.min(F.struct("n", "item")).alias("x"), F.first("items").alias("items"))
    index = rarest.select(F.col("x.item").alias("item"), "items")
    probes = urls.select("url", "tokens", F.explode("tokens").alias("item"))
    hits = probes.join(index, "item").filter(F.size(F.array_except("items", "tokens")) == 0)
    return hits.filter(F.size("items") < F.size("tokens") if longer else F.lit(True)).select("url").distinct()


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page."""
    spark = pages.sparkSession
    urls = pages.select("url").filter("url is not null").distinct()
    urls = urls.select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    fixed = by_rule(urls, spark.createDataFrame(list(rules), "verdict string, host string, path string"))
    blocked = by_tokens(urls.select("url", "tokens"), mined(pages, labels)).withColumn("bad", F.lit(True))
    verdict = F.coalesce("verdict", F.when(F.col("bad"), "block"), F.lit("allow")).alias("verdict")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    rows = rows.join(fixed, "url", "left").join(blocked, "url", "left")
    return rows.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule", verdict)
