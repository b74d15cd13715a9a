"""Fill-in-middle: texts cut at lines into prefix, middle and suffix and rearranged around sentinels.

All of it is Spark SQL's own functions: regexp_extract_all makes the array of a
text's lines, substring and conv of a sha2 give its four numbers, slice and
array_join build the arrangements, and `restored` parses the sentinels to rebuild
the text. Nothing is shuffled; a row depends on its own doc_id and text alone.

A text that holds a sentinel itself stays plain, so the first occurrence of each
sentinel in an arrangement is the one put there.

Edge cases: a null text counts as empty, and an empty one stays plain, with no
lines; a null doc_id hashes as the empty string; of repeated rows each comes out
alike; a text of one line is cut before or behind it; an empty table gives an empty
one. The columns added replace any named like them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit: a line with its end, or what follows the last end.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Salt of the hash, percentage of texts to rearrange, percentage of these that have the suffix first.
SEED, RATE, SUFFIX_FIRST = 7, 100, 50


def _number(digest: str, i: int) -> Column:
    """The i-th group of eight hex digits."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def arranged(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """docs with n (lines), form (plain, psm or spm), prefix, middle, suffix (null if plain) and output."""
    rows = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_digest", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256))
    rows = rows.withColumn("_units", F.regexp_extract_all("_text", F.lit(LINE), 0)).withColumn("n", F.size("_units").cast("long"))
    one, two = _number("_digest", 0) % (F.col("n") + 1), _number("_digest", 1) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("_text").contains(PREFIX) | F.col("_text").contains(SUFFIX) | F.col("_text").contains(MIDDLE) | (_number("_digest", 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_number("_digest", 3) % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.withColumns({"_a": F.least(one, two).cast("int"), "_b": F.greatest(one, two).cast("int"), "form": form})
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("_units", start, length), ""))
    rows = rows.withColumns({"prefix": part(F.lit(1), F.col("_a")), "middle": part(F.col("_a") + 1, F.col("_b") - F.col("_a")), "suffix": part(F.col("_b") + 1, F.col("n").cast("int") - F.col("_b"))})
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "plain", F.col("_text")).when(F.col("form") == "psm", psm).otherwise(spm)
    return rows.withColumn("output", output).drop("_text", "_digest", "_units", "_a", "_b")


def restored(output: Column, form: Column) -> Column:
    """The text of an arrangement: what stands between its sentinels, in order."""
    first, second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)), F.lit(MIDDLE)
    rest = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))  # behind the sentinel that it begins with
    cut = F.position(first, rest)
    left, behind = F.substring(rest, F.lit(1), cut - 1), F.substring(rest, cut + len(SUFFIX), F.length(rest))
    at = F.position(second, behind)
    right, middle = F.substring(behind, F.lit(1), at - 1), F.substring(behind, at + len(MIDDLE), F.length(behind))
    return F.when(form == "plain", output).when(form == "psm", F.concat(left, middle, right)).otherwise(F.concat(right, middle, left))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of arranged rows."""
    rows = rows.withColumn("_restored", restored(F.col("output"), F.col("form")))
    chars = lambda c: F.char_length(c).cast("long").alias(f"{c}_chars")
    return rows.select("doc_id", "n", "form", chars("prefix"), chars("middle"), F.sha2("output", 256).alias("output_sha256"), F.sha2("_restored", 256).alias("restored_sha256"))


#: The same in SQL for DuckDB.
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256(concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '{LINE}') AS units, [CAST(concat('0x', substr(h, i, 8)) AS BIGINT) FOR i IN [1, 9, 17, 25]] AS r FROM t),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS a, greatest(r[1] % (len(units) + 1), r[2] % (len(units) + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR r[3] % 100 >= {RATE} THEN 'plain' WHEN r[4] % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form,
  coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:n], ''), '') AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('{PREFIX}', p, '{SUFFIX}', s, '{MIDDLE}', m) ELSE concat('{SUFFIX}', s, '{PREFIX}', p, '{MIDDLE}', m) END AS output FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""
