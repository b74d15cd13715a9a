"""Token records, the divergence audit and fill-in-middle against plain versions in Python."""

import glob
import hashlib
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import divergence, infilling, queries, records

DOCS = "doc_id long, text string, lang string, source string, n_chars long, output string, part int, ids string, `a.b` int"


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows, odd white space, clashing columns."""
    long = " ".join(f"wort{i % 900}é" for i in range(40_000))
    texts = [
        None, "", "   \n\t ", "one", "one\n", "\n\n\n", "a <P> b\nc", "x<S>", "<M>", "a\tb \n c  d \n e\x1c f \x1d\ng", long, long, "no end" + "\nline" * 50, "<P\nS>\n<\nM",
        "naïve Ünïcode 𝒳 \U0001f600\n\n  two  spaces   it's we'll 1234 5.6!? \r\n end ", "A" * 5000, "ONE two Two tWO", "ßİIſ zz", " lead", "trail ", "<|endoftext|> kept <|endoftext|>",
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["b", None, "a", "ç", ""][i % 5], 1, "x", 1, "y", i) for i, t in enumerate(texts)]
    rows += [rows[14], rows[14], (None, "no number\nat all", "en", "a", None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [(100 + i, f"common word{i % 7} shared text{i % 3} only{i % 40}", "en", "abc"[i % 3], 1, "", 0, "", 0) for i in range(60)]
    rows += [(200 + i, "gleich viele wörter hier " * (1 + i % 2), "de", "xyzw"[i % 4], 1, "", 0, "", 0) for i in range(24)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def both(spark, sf_dir, hard):
    return [spark.read.parquet(f"{sf_dir}/documents.parquet"), hard]


def test_fill_in_middle(both, empty):
    assert infilling.digests(infilling.arranged(empty)).collect() == []
    for docs in both:
        got = Counter(map(tuple, infilling.digests(infilling.arranged(docs)).collect()))
        want = Counter()
        for d, t in ((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()):
            h = hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()
            h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
            units = re.findall(r"[^\n]*\n|[^\n]+", t)
            n = len(units)
            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
            plain = not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100
            form = "plain" if plain else "spm" if h4 % 100 < 50 else "psm"
            out = {"plain": t, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
            sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
            want[(d, n, form, None if plain else len(p), None if plain else len(m), sha(out), sha(t))] += 1
        assert got == want


def test_fill_in_middle_rates_and_columns(hard):
    out = infilling.arranged(hard, seed=3, rate=40, suffix_first=100)
    forms = Counter(r.form for r in out.collect())
    assert forms["psm"] == 0 and 0 < forms["spm"] < forms["plain"] and "a.b" in out.columns
    again = out.select("text", infilling.restored(F.col("output"), F.col("form")).alias("again")).collect()
    assert all((r.text or "") == r.again for r in again)


def plain_audit(rows, k):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = {t for t, n in Counter(t for d in own for t in set(d[2])).items() if n >= 10}
        count = {None: Counter(), **{d[1]: Counter() for d in own}}
        for _, source, words in own:
            for w in words:
                if w in kept:
                    count[source][w] += 1
                    count[None][w] += 1
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept} for s, c in count.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            if s is not None:
                pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in count if o not in (s, None)]
                terms = [(t, f(p[s][t], p[None][t])) for t in kept if count[s][t] and p[s][t] > p[None][t]]
                for part, items, most in (("pair", pairs, None), ("term", terms, k)):
                    items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                    out += [(lang, s, part, item, v, i) for i, (item, v) in enumerate(items, 1)]
    return sorted(out)


def test_divergence(both, empty):
    assert divergence.audit(empty).collect() == []
    for docs in both:
        rows = [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]
        assert sorted(map(tuple, divergence.audit(docs).collect())) == plain_audit(rows, 10)
    assert sorted(map(tuple, divergence.audit(both[1], k=2).collect())) == plain_audit(rows, 2)


def test_radix_select(spark):
    r = random.Random(5)
    rows = [(g, "é" * r.randrange(4) + r.choice("ab\U0001f600z") * r.randrange(6) + str(i), r.choice([0, 1, 5, 5, 5, 2**29, 2**30 - 1, i])) for g in "pqr" for i in range(400)] + [("few", "x", 3)]
    df = spark.createDataFrame(rows, "g string, item string, value long")
    for k in (1, 7, 100):
        want = {x for g in ("p", "q", "r", "few") for x in sorted((x for x in rows if x[0] == g), key=lambda x: (-x[2], x[1].encode()))[:k]}
        assert set(map(tuple, divergence.top(df, ["g"], "value", "item", k).collect())) == want


def test_token_records(spark, both, empty):
    tokenizer = Tokenizer.from_file(queries.tokenizer())
    assert records.round_trip(empty, queries.tokenizer()).collect() == []
    for docs in both:
        rows = sorted(((r.doc_id, r.text or "", r.text is not None) for r in docs.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[2], x[1].encode()))
        start, want = 0, []
        for d, t, _ in rows:
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
            want.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            start += len(ids)
        assert sorted(map(tuple, records.round_trip(docs, queries.tokenizer()).collect()), key=lambda x: x[1]) == want


def test_token_records_format(spark, hard, tmp_path):
    folder = str(tmp_path / "out")
    records.write(hard, folder, queries.tokenizer())
    inorder = records.read(spark, folder).orderBy("start").collect()
    mixed = records.shuffled(spark, folder, 3).collect()
    assert sorted((str(r.doc_id), r.ids) for r in mixed) == sorted((str(r.doc_id), r.ids) for r in inorder)
    assert [r.doc_id for r in mixed] != [r.doc_id for r in inorder] and [r.doc_id for r in mixed] == [r.doc_id for r in records.shuffled(spark, folder, 3).collect()]
    assert [r.place for r in mixed] == sorted(r.place for r in mixed)
    listed = records.files(spark, folder).collect()
    stray = f"{folder}/records/000000-stray.bin"  # of a task that was tried again
    with open(stray, "wb") as f:
        f.write(b"\x01")
    assert records.read(spark, folder).count() == len(inorder)
    # By hand: length, checksum, payload, checksum.
    whole = max(glob.glob(f"{folder}/records/*.bin"), key=lambda p: any(p.endswith(r.file) for r in listed) and len(open(p, "rb").read()))
    data, at, seen = open(whole, "rb").read(), 0, 0
    rot = lambda b: ((((c := zlib.crc32(b)) >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        assert int.from_bytes(data[at + 8 : at + 12], "little") == rot(data[at : at + 8])
        assert int.from_bytes(data[at + 12 + n : at + 16 + n], "little") == rot(data[at + 12 : at + 12 + n])
        at, seen = at + n + 16, seen + 1
    assert seen == next(r.records for r in listed if whole.endswith(r.file))
    for broken, why in ((data[:-3], "ends within a record"), (data[:20] + bytes([data[20] ^ 1]) + data[21:], "a record is damaged"), (bytes([data[0] ^ 1]) + data[1:], "a length is damaged")):
        with open(whole, "wb") as f:
            f.write(broken)
        with pytest.raises(Exception, match=why):
            records.read(spark, folder).collect()


def test_encoder_cuts_where_the_tokenizer_does():
    with open(queries.tokenizer(), encoding="utf-8") as f:
        definition = f.read()
    whole, encode = Tokenizer.from_str(definition), records.Encoder(definition, None)
    r = random.Random(11)
    signs = ["a", "B", "é", "1", "!", "'s", "'", " ", " ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\x1c", "​", "᠎", "﻿", "\x85", "𝒳", "́", "<|endoftext|>", "-", " "]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(40))) for _ in range(4000)]
    old, records.CACHE = records.CACHE, 500
    try:
        for text, ids in (x for at in range(0, len(texts), 100) for x in zip(texts[at : at + 100], encode(pa.array(texts[at : at + 100])), strict=True)):
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)
    finally:
        records.CACHE = old
