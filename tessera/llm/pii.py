"""Personal data by weak supervision.

Candidates are the base spans (email, ip, card, phone: strict patterns with their
checks) and what looser patterns propose: credentials, written-out addresses,
account numbers. Labelers vote on each candidate (yes, no or nothing): regular
expressions on its form, a gazetteer of words that name such data, and the words
around it. Expectation-maximisation over the vote patterns of all documents
estimates how often each labeler votes and how reliably, without labels, and so a
probability for each pattern. A logistic model of the candidate's form and
surroundings is trained on these probabilities, weighted by how often each
pattern occurs; it is the final span classifier. Base spans always stay, and
proposals stay where it says so.

Votes and features have a handful of values each, so there are a few hundred
distinct patterns, whatever the input, and only their counts come to the driver;
the spans themselves stay distributed.

Edge cases: a null text counts as empty; an empty text has no spans; repeated
rows repeat; positions are code points, ends exclusive. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrow

BASE = ("email", "ip", "card", "phone")
EXTRA = ("secret", "account", "address")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}(?![A-Za-z0-9_+/=-])")
_ACCOUNT = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]{2})?[0-9]{8,34}(?![A-Za-z0-9])")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{2,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{2,63})+")
_AROUND = re.compile(r"[A-Za-z]+")
#: Words that name personal data or credentials beside them.
GAZETTEER = frozenset("token secret key apikey api password passwd pwd bearer auth credential credentials private iban account acct konto compte cuenta card carte tarjeta karte phone tel telephone mobile email mail contact ssn passport".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = end = m.end()
        at = text.find("@", end)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; those that fail its check are dropped."""
    out = [("email", s, e) for s, e in _emails(text)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    return out + [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]


def proposals(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser candidates that touch no base span and no earlier proposal."""
    found = [("secret", m) for m in _SECRET.finditer(text)] + [("account", m) for m in _ACCOUNT.finditer(text)]
    if "at" in text:
        found += [("address", m) for m in _SPELLED.finditer(text)]
    if not found:
        return []
    out, ends = [], sorted((s, e) for _, s, e in taken)
    for kind, m in sorted(found, key=lambda x: (x[1].start(), -x[1].end(), x[0])):
        s, e = m.span()
        if not any(a < e and s < b for a, b in _near(ends, s, e)) and not (out and out[-1][2] > s):
            out.append((kind, s, e))
    return out


def _near(ends: list[tuple[int, int]], s: int, e: int) -> list[tuple[int, int]]:
    i = bisect.bisect_left(ends, (s, s))
    return ends[max(0, i - 4) : bisect.bisect_left(ends, (e, e)) + 1]


def votes(text: str, kind: str, s: int, e: int) -> tuple[int, ...]:
    """The labelers: 1 yes, -1 no, 0 nothing."""
    span = text[s:e]
    digits, letters = len(_digits(span)), sum(c.isalpha() for c in span)
    before, after = text[max(0, s - 24) : s], text[e : e + 12]
    named = {w.lower() for w in _AROUND.findall(before)} & GAZETTEER
    hexa = all(c in "0123456789abcdefABCDEF" for c in span)
    share = digits / len(span)
    form = 1 if kind in BASE else (1 if hexa and digits and letters else -1 if digits == 0 else 0) if kind == "secret" else (1 if 13 <= digits <= 34 else 0) if kind == "account" else 1
    check = 1 if kind == "card" or kind == "account" and luhn(_digits(span)) else -1 if kind == "account" else 0
    mixed = 0 if kind != "secret" else 1 if 0.2 < share < 0.9 and letters else -1
    quoted = 1 if before.rstrip()[-1:] in ("=", ":", '"', "'") or before[-1:] in ('"', "'") else 0
    word = -1 if before[-1:].isalnum() or after[:1].isalnum() else 0
    return form, check, mixed, 1 if named else (-1 if kind in EXTRA and quoted == 0 else 0), quoted, word


def features(text: str, kind: str, s: int, e: int) -> tuple[int, ...]:
    """What the final classifier sees: form and surroundings in steps."""
    span, before = text[s:e], text[max(0, s - 24) : s]
    share = len(_digits(span)) / len(span)
    return (
        [*BASE, *EXTRA].index(kind),
        min(4, int(math.log2(len(span)))),
        int(share * 4),
        sum(c.isupper() for c in span) * 2 // len(span),
        int(len(set(span)) > len(span) / 4) + int(len(set(span)) > 8),
        int(before[-1:] in ('"', "'")) + 2 * int(before.rstrip(" \"'")[-1:] in ("=", ":")),
        int(bool({w.lower() for w in _AROUND.findall(before)} & GAZETTEER)),
    )


def _candidates(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    text = text or ""
    if not any(c in text for c in "0123456789@") and "at" not in text and not _SECRET.search(text):
        return [], []
    base = base_spans(text)
    return base, proposals(text, base)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, int] = {}
        for text in batch.column(0).to_pylist():
            base, more = _candidates(text)
            for kind, s, e in base + more:
                key = ",".join(map(str, votes(text, kind, s, e))) + ";" + ",".join(map(str, features(text, kind, s, e)))
                out[key] = out.get(key, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], names=["pattern", "n"])


def reliabilities(v: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """The probability of each vote pattern, by expectation-maximisation over conditionally independent labelers."""
    p = 1 / (1 + np.exp(-(v.sum(1) + 0.0)))
    for _ in range(rounds):
        prior = np.clip((p * n).sum() / n.sum(), 0.05, 0.95)
        score = np.full(len(v), np.log(prior / (1 - prior)))
        for j in range(v.shape[1]):
            for value in (-1, 0, 1):
                at = v[:, j] == value
                yes = ((p * n)[at].sum() + 1) / ((p * n).sum() + 3)
                no = (((1 - p) * n)[at].sum() + 1) / (((1 - p) * n).sum() + 3)
                score[at] += np.log(yes / no)
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return p


def one_hot(x: np.ndarray) -> np.ndarray:
    sizes = (len(BASE) + len(EXTRA), 5, 5, 3, 3, 4, 2)
    return np.concatenate([np.ones((len(x), 1)), *(np.eye(k)[np.minimum(x[:, i], k - 1)] for i, k in enumerate(sizes))], axis=1)


def trained(docs: DataFrame) -> np.ndarray:
    """Weights of the span classifier, from the vote patterns of all documents."""
    counts = map_arrow(docs.select("text"), _patterns, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted(counts.collect())
    if not rows:
        return np.zeros(one_hot(np.zeros((1, 7), int)).shape[1])
    v, x = (np.array([[int(i) for i in r.pattern.split(";")[part].split(",")] for r in rows]) for part in (0, 1))
    n = np.array([r.n for r in rows], float)
    p, z = reliabilities(v, n), one_hot(x)
    w = np.zeros(z.shape[1])
    for _ in range(30):  # Newton steps of the weighted logistic loss
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (n * (q - p)) + 0.1 * w
        w = w - np.linalg.solve((z * (n * q * (1 - q) + 1e-9)[:, None]).T @ z + 0.1 * np.eye(len(w)), grad)
    return w


def spans_of(text: str | None, weights: np.ndarray) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the proposals that the classifier keeps."""
    base, more = _candidates(text)
    if more:
        keep = one_hot(np.array([features(text or "", *x) for x in more])) @ weights > 0
        more = [x for x, k in zip(more, keep, strict=True) if k]
    return base, more


def _found(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for text in batch.column(1).to_pylist():
            base, more = spans_of(text, weights)
            spans.append([{"kind": k, "start": s, "end": e, "base": i < len(base)} for i, (k, s, e) in enumerate(base + sorted(more, key=lambda x: (EXTRA.index(x[0]), x[1])))])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "found"])


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, found): the spans of each text, base spans first, by kind and start."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(rows, partial(_found, weights=trained(docs)), "doc_id long, found array<struct<kind:string,start:long,end:long,base:boolean>>")


def digests(spans: DataFrame) -> DataFrame:
    """Counts and digests of found()."""
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
    of_kind = lambda k: F.filter("found", lambda x: x.kind == k)
    base = F.filter("found", lambda x: x.base)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE]
    more = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in EXTRA]
    total = F.size("found").cast("long").alias("n_spans")
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), *more, total)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, done = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"<{kind}>"]
            done = e
    return "".join([*out, text[done:]])
