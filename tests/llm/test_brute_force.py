"""Each query against a plain version in Python, over the smallest tables and over a table of hard cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontamination, licenses, mixing, multiset, pii, quality, queries, sharding, simhash, substrings, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, th long, `a.b` int"


def passage(seed, n):
    return " ".join(f"w{(seed * 7919 + i * 104729) % 100003:x}" for i in range(n))


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls, empty and long texts, ties, repeated rows, shared passages, clashing columns."""
    long = passage(1, 30_000)
    shared = passage(2, 80)
    texts = [
        None, "", "   \n\t ", "one", "two words", "one", long, long, long.replace("w5", "x5", 1),
        f"{passage(3, 10)} {shared} {passage(4, 5)}", f"{passage(5, 33)}\n{shared}", shared, shared + " ", shared.upper(),
        f"{passage(6, 60)} {passage(7, 60)} {passage(6, 60)}", f"{passage(7, 60)}", "a\u00a0b c\u2003d \x1c x\x0by",
        "mail a@b.c_d@e.fg, a@b@c.de x@y.z. 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 +1 (017) 555-7713 4111 1111 1111 1111 +12 token = \"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\"",
        "Released under the MIT License.", "naïve Ünïcode 𝒳 text\nwith lines\n\nand more. Licensed under the Apache License, Version 2.0.",
    ]
    rows = [(i, t, "en", ["b", None, "a", "ç", "a"][i % 5], len(t or ""), 0.5, "x", 1, i) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, shared, None, None, None, None, None, None, None), (None, None, "en", "a", 0, 0.1, "y", 2, 3)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def both(spark, sf_dir, hard):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return [docs, hard]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def count(text):
    return len(WORD.findall(text or ""))


def test_mix(both, empty):
    assert mixing.taken(empty).collect() == []
    for docs in both:
        out = mixing.taken(docs).collect()
        assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.taken(docs.repartition(3)).collect()), key=str)
        rows = [(r.doc_id, count(r.text), r.source) for r in docs.collect()]
        assert Counter((r.doc_id, r.size) for r in out) == Counter(x[:2] for x in rows)
        sizes = Counter()
        for _, n, s in rows:
            sizes[s] += n
        order = sorted(sizes, key=lambda s: (s is None, s))
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
        left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
        while open_:
            level = left / sum(weight[s] for s in open_)
            full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
            for s in full or open_:
                target[s] = 2 * sizes[s] if full else level * weight[s]
                left -= target[s] if full else 0
            open_ -= full or open_
        assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-3
        source = defaultdict(set)
        for d, n, s in rows:
            source[d, n].add(s)
        took = Counter()
        for r in out:
            assert 0 <= r.taken <= 2 * r.size
            assert any(sizes[s] == r.source_size and abs(target[s] - r.target) < 1e-6 * max(1, r.target) for s in source[r.doc_id, r.size])
            took[r.source_size, round(r.target, 3)] += r.taken
        goal = Counter()
        for s in order:
            goal[sizes[s], round(target[s], 3)] += target[s]
        for k, v in goal.items():
            assert abs(took[k] - v) <= max(2, 0.03 * v), (k, took[k], v)


def test_apportionment_is_sainte_lague(spark):
    for weights, seats in (([5.0, 3.0, 1.0, 0.0], 17), ([1.0] * 7, 3), ([1000.0] + [0.51] * 200, 1100), ([1.0, 1.0, 1.0], 100), ([2.5], 4), ([1e6, 1.0, 1.0], 10)):
        df = spark.createDataFrame([(i, w, seats) for i, w in enumerate(weights)], "id long, w double, n long")
        got = {r.id: r.quota for r in mixing.apportioned(df, [], "w", "n").collect()}
        want = Counter()
        for _ in range(seats):
            best = max((w / (2 * want[i] + 1), -i) for i, w in enumerate(weights) if w > 0)
            want[-best[1]] += 1
        assert got == {i: want[i] for i in range(len(weights))}, (weights, seats)


def test_multiset(both, empty, spark):
    assert multiset.compared(empty).collect() == []
    for docs in both:
        rows = sorted(pairs(docs), key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
        want = []
        for (d, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
            t, u = t or "", u or ""
            half = len(t) // 2
            e = t[: len(t) - half] + u[:half]
            fp = [multiset.vector(x) for x in (t, e, u)]
            want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), multiset.as_hex(fp[0]), multiset.as_hex(fp[1]), multiset.likeness(fp[0], fp[1]), multiset.likeness(fp[0], fp[2])))
        old, multiset.RUN = multiset.RUN, 7
        try:
            assert sorted(map(tuple, multiset.compared(docs).collect()), key=str) == sorted(want, key=str)
        finally:
            multiset.RUN = old
        assert sorted(map(tuple, multiset.compared(docs).collect()), key=str) == sorted(want, key=str)


def test_multiset_is_homomorphic():
    a = multiset.vector("one two three four\nfive six seven\neight")
    assert multiset.as_hex(a) == multiset.as_hex(multiset.vector("eight\none two three four\nfive six seven"))
    b = multiset.plus(multiset.vector("one two three four\neight"), "five six seven")
    assert multiset.likeness(a, b) == 1 and multiset.as_hex(multiset.minus(b, "eight")) == multiset.as_hex(multiset.vector("five six seven\none two three four"))
    x, y = passage(1, 400), passage(2, 400)
    assert multiset.likeness(multiset.vector(x), multiset.vector(multiset.edited(x, y))) > 0.3 > multiset.likeness(multiset.vector(x), multiset.vector(y))


def test_multiset_inserts_and_deletes(spark):
    v, same = multiset.vector, lambda a, b: multiset.as_hex(a) == multiset.as_hex(b)
    assert same(multiset.plus(v("a"), ""), v("a\n")) and same(multiset.minus(v("\na"), ""), v("a")) and same(multiset.minus(v("a"), "a"), v(""))
    assert same(multiset.plus(v("a\nb"), "b\n"), v("b\nb\na\n")) and not same(v("a\na"), v("a")) and not same(v("\n"), v("\n\n"))
    docs = spark.createDataFrame([(1, "a b c d\ne"), (2, None), (3, "x\n\ny")], "doc_id long, text string")
    changes = spark.createDataFrame([(1, "e", -1), (1, "f g h", 1), (1, "", 1), (2, "new", 1), (3, "", -1), (9, "none", 1)], "doc_id long, paragraph string, sign int")
    got = {r.doc_id: r.fingerprint for r in multiset.changed(multiset.fingerprints(docs), changes).collect()}
    assert got == {1: multiset.as_hex(v("f g h\na b c d\n")), 2: multiset.as_hex(v("new")), 3: multiset.as_hex(v("x\ny"))}


def test_licenses(both, empty):
    assert licenses.scanned(empty).collect() == []
    for docs in both:
        want = []
        for d, t in pairs(docs):
            best = defaultdict(list)
            for unit in licenses.units(t or ""):
                a = Counter(licenses.bigrams(unit))
                for name, notices in licenses.TEMPLATES.items():
                    for notice in notices:
                        b = Counter(licenses.bigrams(notice))
                        dice = 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))
                        if dice >= licenses.THRESHOLD:
                            best[name].append(dice)
            want += [(d, name, round(max(v), 6), len(v)) for name, v in best.items()]
        assert sorted(map(tuple, licenses.scanned(docs).collect()), key=str) == sorted(want, key=str)
        assert want


def test_quality(spark, both, empty):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert len(out) == docs.count()
    held = [(out[r.doc_id].score, r.quality) for r in labels.collect() if out[r.doc_id].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.9
    for d, r in out.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    for table in (*both, empty):
        got = quality.scored(table, labels.filter("doc_id < 0")).collect()
        assert len(got) == table.count() and {r.score for r in got} <= {0.5}
    kept = quality.accepted(both[1], labels, 0.0)
    assert kept.schema == both[1].schema and kept.count() == both[1].count()


def test_context_vectors_by_hand(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, n)) for n in (0, 1, 2, 40, 9000)] + [None]
    place, sign = quality._index(quality.VOCABULARY, quality.SEED)
    want = np.zeros((quality.VOCABULARY, quality.DIM))
    for t in texts:
        words = [xxhash.xxh64_intdigest(w.encode(), 42) % quality.VOCABULARY for w in (t or "").split()]
        for a, b in zip(words, words[1:]):
            for x, y in ((a, b), (b, a)):
                for j in range(quality.NONZERO):
                    want[x, place[y, j]] += sign[y, j]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-6)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for parts in (1, 7):
        assert np.abs(quality.context_vectors(docs.repartition(parts)) - want).max() < 1e-5


def test_network_and_temperature():
    """Its gradient is the loss's, it learns what two layers can and one can't, and its temperature is the best of its steps."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 6))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.2)).astype(float)
    net = quality.Network(x[:2000], y[:2000])
    p = net.probability(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.72
    bins = [(p[at].mean(), y[2000:][at].mean()) for at in (p < 0.3, (p > 0.3) & (p < 0.7), p > 0.7)]
    assert all(abs(a - b) < 0.12 for a, b in bins)
    assert quality.Network(x[:5], np.ones(5)).probability(x[:2]).tolist() == [1.0, 1.0] and quality.Network(x[:0], y[:0]).probability(x[:2]).tolist() == [0.5, 0.5]


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group(), flags=re.A)
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m.group(), flags=re.A)) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_pii(spark, both, empty):
    assert pii.digests(pii.found(empty)).collect() == []
    for docs in (*both, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        out = pii.digests(pii.found(docs)).collect()
        texts = defaultdict(list)
        for d, t in pairs(docs):
            texts[d].append(plain_spans(t or ""))
        assert len(out) == sum(map(len, texts.values()))
        for r in out:
            shown = {hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest(): spans for spans in texts[r.doc_id]}
            spans = shown[r.base_sha256]
            assert Counter(k for k, _, _ in spans) == Counter({k: r[f"n_{k}"] for k in pii.BASE if r[f"n_{k}"]})
            assert set(filter(None, r.spans.split(","))) >= {f"{k}:{s}:{e}" for k, s, e in spans}
    assert any("secret:" in r.spans for r in out)


def test_reliabilities_find_the_better_labelers():
    """Votes of known reliability: EM names most truths, better than the plain majority."""
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.4
    right = (0.95, 0.9, 0.6, 0.55, 0.55)
    votes = np.stack([np.where(rng.random(4000) < 0.2, 0, np.where((rng.random(4000) < r) == truth, 1, -1)) for r in right], axis=1)
    found, n = np.unique(votes, axis=0, return_counts=True)
    p = pii.reliabilities(found, n.astype(float))
    of = {tuple(v): q for v, q in zip(found.tolist(), p.tolist(), strict=True)}
    em = np.mean([(of[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)])
    plain = np.mean([(sum(v) > 0) == t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert em > 0.9 and em > plain + 0.03


def test_all_added_kinds_are_found(spark):
    rng = np.random.default_rng(9)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    rows = []
    for i in range(200):
        number = "".join(map(str, rng.integers(0, 10, 16)))
        rows += [f'token = "{hexa(40)}" end', f"my iban: GB{number} thanks", f"mail bob{i} [at] example [dot] com or a{i}@b.cd", f"order of plain-words-without-any-meaning{'x' * (i % 9)} and so on"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r.doc_id: r for r in pii.digests(pii.found(docs)).collect()}
    share = lambda k, kind: np.mean([out[i][f"n_{kind}"] > 0 for i in range(k, 800, 4)])
    assert share(0, "secret") > 0.9 and share(1, "account") > 0.9 and share(2, "address") > 0.9 and share(2, "email") == 1 and share(3, "secret") < 0.05
    assert all(r.n_spans == len([x for x in r.spans.split(",") if x]) for r in out.values())


def test_pii_masks():
    text = "mail a@b.cd now"
    assert pii.masked(text, pii.base_spans(text)) == "mail <email> now"


def test_shards(both, empty):
    assert sharding.placed(empty).collect() == [] and sharding.sharded(empty).collect() == []
    old, sharding.BLOCK_ROWS = sharding.BLOCK_ROWS, 2
    try:
        for docs in both:
            out = sharding.placed(docs).collect()
            want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in pairs(docs))
            assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
            slots = defaultdict(list)
            for r in out:
                assert 0 <= r["shard"] < 40 and r.grown_shard in (r["shard"], 40) and r.law == "key"
                slots[r["shard"]].append(r["slot"])
            assert all(sorted(v) == list(range(len(v))) for v in slots.values())
            assert len({(r.doc_id, r["shard"]) for r in out}) == len({r.doc_id for r in out})
            assert sorted(map(tuple, out), key=str) == sorted(map(tuple, sharding.placed(docs.repartition(2)).collect()), key=str)
            assert sharding.sharded(docs).count() == len(out)
    finally:
        sharding.BLOCK_ROWS = old


def test_weighted_shards(spark):
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"))
    got = {r["shard"]: r["count"] for r in ids.select(sharding.rendezvous([F.col("doc_id")], [1.0, 3.0, 0.0, 4.0]).alias("shard")).groupBy("shard").count().collect()}
    assert set(got) == {0, 1, 3} and abs(got[1] - 15_000) < 600 and abs(got[0] - 5_000) < 400


def brute_repeats(rows):
    first = {}
    windows = []
    for d, t in rows:
        words = WORD.findall(t or "")
        own = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        windows.append((d, words, own))
        for w in own:
            if d is not None:
                first[w] = min(d, first.get(w, d))
    out = []
    for d, words, own in windows:
        gone = set()
        for i, w in enumerate(own):
            if d is not None and first[w] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_substrings(both, empty, spark):
    assert substrings.without_repeats(empty, False).collect() == []
    base = passage(9, 400).split()
    rows = [(i, " ".join([*(f"d{i}x{j}" for j in range(i % 31)), *base[(i * 13) % 200 : (i * 13) % 200 + 40 + i % 90], f"e{i}"])) for i in range(300)]
    crafted = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for docs in (*both, crafted):
        for chunk in (substrings.CHUNK, 300):
            old, substrings.CHUNK = substrings.CHUNK, chunk
            try:
                got = sorted(map(tuple, substrings.without_repeats(docs, False).collect()), key=str)
            finally:
                substrings.CHUNK = old
            want = sorted(brute_repeats(pairs(docs)), key=str)
            assert got == want
            assert any(x[2] for x in want)


def test_small_chunks_reach_the_workers():
    """CHUNK is read where it runs: a worker imports the module anew, so the chunked path is held to its own function too."""
    import numpy as np
    import pyarrow as pa

    rows = [(i, i * 7, f"{passage(i, 20)} {passage(99, 120)}".encode()) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(3)], names=["doc_id", "th", "text"])
    old, substrings.CHUNK = substrings.CHUNK, 500
    try:
        packs = pa.Table.from_batches(list(substrings._probe(iter([batch]), 4)))
    finally:
        substrings.CHUNK = old
    flags = defaultdict(set)
    for b in range(4):
        part = substrings._by_document(substrings._hits(packs.filter(pa.compute.equal(packs["bucket"], b)), 3))
        for d, at in zip(part["doc_id"].to_pylist(), part["flags"].to_pylist(), strict=True):
            flags[d] |= set(np.frombuffer(at, np.int32).tolist())
    for i in range(40):
        for start in range(20, 20 + 120 - 49):
            assert any(start <= f <= start + 25 for f in flags[i])


def test_urls(spark, sf_dir):
    odd = [None, "", "no scheme", "http://", "HTTP://Sub.EXAMPLE.com/en/7x?q#f", "x://example.net/de/8", "x://a.example.net/de/7", "a://notexample.com/en/7", "a://com/en/", "a://org?x=/es/", "u://b://com/en/", "h://EXAMPLE.org/es/\n9", "a://x.comm/en/", "a://.com/en/1"]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    pages = pages.union(spark.createDataFrame([(1000 + i, u) for i, u in enumerate(odd + odd)], "page_id long, url string"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {r.page_id: r for r in urls.judged(pages, labels).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        host = path = ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path = re.split(r"[?#]", rest[len(host) :])[0]
            host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        got = out[r.page_id]
        assert (got.host, got.path, got.rule) == (host, path, max(fits)[1] if fits else None), r
        assert got.verdict == max(fits)[2] if fits else got.verdict in ("allow", "block")
    assert urls.judged(pages.filter("page_id < 0"), labels).collect() == []


def test_mined_rules_block(spark):
    pages = spark.createDataFrame([(i, f"http://{'spam' if i % 4 == 0 else 'good'}{i % 3}.example.com/{'win' if i % 4 == 0 else 'en'}/{i}") for i in range(200)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1, 0) for i in range(160)], "doc_id long, quality int, toxic int")
    rules = urls.mined(pages, labels)
    assert rules.count() > 0 and {tuple(r["items"]) for r in rules.collect()} >= {("p:win",)}
    out = {r.page_id: r.verdict for r in urls.judged(pages, labels, (("allow", "none", "/"),)).collect()}
    assert all(out[i] == ("block" if i % 4 == 0 else "allow") for i in range(200))


def test_mined_rules_hold_out(spark):
    """Planted labels: rules learnt on one half judge the other; shuffled labels: next to nothing is blocked."""
    rng = np.random.default_rng(8)
    kinds = [("casino", "play"), ("news", "en"), ("shop", "cart"), ("blog", "fr")]
    rows, bad = [], []
    for i in range(4000):
        host, step = kinds[rng.integers(4)]
        rows.append((i, f"https://{host}{rng.integers(9)}.site{rng.integers(40)}.com/{step}/{rng.integers(1000)}?ref={rng.integers(5)}"))
        bad.append(int(rng.random() < (0.95 if step == "play" else 0.03)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = lambda y: spark.createDataFrame([(i, 1 - y[i], 0) for i in range(0, 4000, 2)], "doc_id long, quality int, toxic int")
    none = (("allow", "none", "/"),)
    out = {r.page_id: r.verdict == "block" for r in urls.judged(pages, marks(bad), none).collect()}
    held = [(out[i], bad[i]) for i in range(1, 4000, 2)]
    assert sum(b and y for b, y in held) >= 0.9 * sum(b for b, _ in held) and sum(b and y for b, y in held) >= 0.85 * sum(y for _, y in held)
    mined = [set(r["items"]) for r in urls.mined(pages, marks(bad)).collect()]
    assert not any(a < b for a in mined for b in mined)
    for seed in range(2):
        mixed = np.random.default_rng(seed).permutation(bad)
        assert sum(r.verdict == "block" for r in urls.judged(pages, marks(mixed.tolist()), none).collect()) <= 40
    odd = spark.createDataFrame([(None, "http://casino1.site1.com/play/" + "/".join(f"s{i}" for i in range(3000)), "x", 1, 2), (7, None, None, None, None)], "page_id long, url string, rule string, tokens int, `a.b` int")
    assert {(r.page_id, r.verdict) for r in urls.judged(odd, marks(bad), none).collect()} == {(None, "allow"), (7, "allow")}


def test_decontamination(spark, both, empty, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontamination.contaminated(empty, benchmark).collect() == []
    assert decontamination.contaminated(both[0], benchmark.filter("item_id < 0")).collect() == []
    norm = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = defaultdict(set)
    for r in benchmark.collect():
        words = norm(r.text)
        for i in range(len(words) - 7):
            grams[tuple(words[i : i + 8])].add(r.item_id)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {(d, i) for d, t in pairs(docs) for w in [norm(t)] for j in range(len(w) - 7) for i in grams.get(tuple(w[j : j + 8]), ())}
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()}
    assert got and want == got
    assert bench.count() == benchmark.count()
    assert decontamination.clean(both[1], benchmark).schema == both[1].schema


def test_templates(spark):
    bench = spark.createDataFrame([(1, "A train leaves at 9 and travels 120 km with driver Alice, who meets Bob after 9 hours of driving on the road."), (2, "stop here now"), (3, None), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [
            (1, "Before. A train leaves at 7 and travels 300 miles with driver Carol, who meets Dave after 7 hours of driving on the road. After."),
            (2, "A train leaves at 7 and travels 300 miles with driver Carol, who meets Dave after 8 hours of driving on the road."),
            (3, "please STOP, here now!"),
            (4, "1 2 3 4 5 6 7 8 9 10 11 12"),
            (5, None),
            (None, "a train leaves at 9 and travels 120 km with driver Alice, who meets Bob after 9 hours of driving on the road"),
        ],
        "doc_id long, text string",
    )
    out = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, bench).collect()}
    assert set(out) == {(1, 1), (3, 2), (None, 1)}
    assert out[None, 1].verbatim and not out[1, 1].verbatim
    assert {r.doc_id for r in decontamination.clean(docs, bench).collect()} == {2, 4, 5}
    old, decontamination.MANY = decontamination.MANY, 0
    try:
        assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == set(out)
    finally:
        decontamination.MANY = old


def test_short_and_bare_items_are_no_evidence(spark):
    bench = spark.createDataFrame([(1, "42"), (2, "7 km"), (3, "Alice 42 Bob"), (4, "what is the capital of France?"), (5, "5 12 7 19 23 42 8 15 16 99")], "item_id long, text string")
    texts = ["It is 42 or 7 km from Alice 42 Bob.", "tell me what is the capital of France", "tell me what is the capital of Spain", "1 2 3 4 5 6 7 8 9 10 42", "a 5 12 7 19 23 42 8 15 b", "WHAT IS THE CAPITAL OF FRANCE"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == {(1, 4), (2, 4), (4, 5), (5, 4)}


def test_decontamination_of_hard_rows(spark, hard):
    """Long texts, repeated rows, null keys and clashing columns, in results."""
    item = passage(2, 20)
    bench = spark.createDataFrame([(7, f"Seen in {item} once"), (8, passage(1, 30_000).split(" ", 20_000)[-1][:400])], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontamination.contaminated(hard, bench).collect()), key=str)
    with_item = [(d, 7) for d, t in pairs(hard) if t and item.lower() in t.lower()]
    assert got == sorted({*with_item, (6, 8), (7, 8), (8, 8)}, key=str)
    kept = decontamination.clean(hard, bench)
    assert kept.schema == hard.schema and kept.count() == hard.count() - sum(1 for d, t in pairs(hard) if t and (item.lower() in t.lower() or len(t) > 50_000))


def brute_simhash(rows):
    fps = []
    for _, t in rows:
        words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))]
        parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hs = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [(d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)]


def test_simhash(both, empty):
    assert simhash.groups(empty).collect() == []
    for docs in both:
        got = sorted(map(tuple, simhash.groups(docs).collect()), key=str)
        assert got == sorted(brute_simhash(pairs(docs)), key=str)


def test_covering_links_lose_nothing(spark, monkeypatch):
    """Chains and crowds of fingerprints, with buckets small enough to be parted."""
    import random

    rng = random.Random(3)
    fps = set()
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(120):
            fps.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(12 if rng.random() < 0.7 else 64)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x, x) for x in signed], "fp long, node long")
    want = {}
    for i, x in enumerate(fps):
        want.setdefault(i, i)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    groups = defaultdict(set)
    for i, x in enumerate(signed):
        groups[find(i)].add(x)
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    from tessera.llm.common import components

    got = defaultdict(set)
    for r in components(simhash.links(nodes, 3)).collect():
        got[r.root].add(r.node)
    assert {frozenset(g) for g in got.values()} == want

    # The parting path, in this process: buckets of over 8 stream on and finer tables still connect them.
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BUCKET", 8)
    rows, of, edges = [(x, None) for x in fps], {None: simhash.masks(3)}, set()
    for _ in range(12):
        keyed = sorted({(x & m, m, x) for x, mask in rows for m in of[mask]})
        if not keyed:
            break
        arr = np.array(keyed, np.uint64).view(np.int64)
        batches = [pa.RecordBatch.from_arrays([pa.array(arr[i : i + 50, c]) for c in (0, 1, 2, 2)], names=["key", "mask", "fp", "node"]) for i in range(0, len(arr), 50)]
        rows = []
        for b in simhash._buckets(iter(batches), 3):
            for kind, a, c, m in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if kind:
                    rows.append((a % 2**64, m % 2**64))
                else:
                    edges.add((a, c))
        of = {m: simhash._finer(m, 4) for _, m in rows}
    assert not rows
    parent = {x: x for x in signed}

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in edges:
        parent[top(a)] = top(b)
    found = defaultdict(set)
    for x in signed:
        found[top(x)].add(x)
    assert {frozenset(g) for g in found.values() if len(g) > 1} == want


def test_near_copies(spark):
    """Recall and precision against all pairs of five-word shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {}
    for d, t in pairs(docs):
        w = [x.encode() for x in WORD.findall((t or ""))]
        w = [x.lower() for x in w]
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    index = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            index[x].add(d)
    want = set()
    for d, s in sets.items():
        met = Counter(o for x in s for o in index[x] if o < d)
        want |= {(o, d) for o, n in met.items() if n >= 0.8 * (len(s) + len(sets[o]) - n)}
    group = {r.doc_id: r.group_id for r in simhash.near_copies(docs).collect()}
    assert want and sum(group.get(a, -1) == group.get(b, -2) for a, b in want) >= 0.95 * len(want)
    similar = defaultdict(set)
    for a, b in want:
        similar[a].add(b)
        similar[b].add(a)
    assert all(d in similar for d in group)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - sum(d != g for d, g in group.items())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]


def test_links_do_not_depend_on_the_order_of_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(np.bitwise_or.reduce(1 << rng.integers(0, 60, rng.integers(0, 5)), initial=0)), i) for i in range(400)]
    found = [{tuple(r) for r in simhash.links(spark.createDataFrame(order, "fp long, node long").repartition(n), 3, 5).collect()} for order, n in ((rows, 3), (rows[::-1], 7))]
    assert found[0] and found[0] == found[1]


def test_near_copies_of_a_crowded_fingerprint(spark):
    """Families of orders of the same words: near copies of each other, not of the least node of their fingerprint."""
    rng = np.random.default_rng(5)
    vocabulary = [f"v{i}" for i in range(120)]
    rows = []
    for family in range(170):
        words = [vocabulary[i] for i in rng.permutation(120)]
        rows.append((len(rows), " ".join(words)))
        if family % 2:
            words[0], words[1] = words[1], words[0]
            rows.append((len(rows), " ".join(words)))
    near = [(i, i + 1) for (i, t), (_, u) in zip(rows, rows[1:]) if sorted(t.split()[:2]) == sorted(u.split()[:2]) and t.split()[2:] == u.split()[2:]]
    group = {r.doc_id: r.group_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(near) == 85 and group == {d: a for a, b in near for d in (a, b)}


def test_crowded_shingles_are_joined_in_blocks(spark):
    """Any split into pairs, one block or many blocks gives the components of all pairs of similar sets."""
    rng = np.random.default_rng(11)
    base = list(range(40))
    sets = [sorted({*rng.permutation(base)[: rng.integers(30, 41)].tolist(), *(1000 * i + np.arange(rng.integers(0, 6))).tolist()}) for i in range(1, 91)]
    root = list(range(90))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(set(x) & set(y))
            if both >= 0.8 * (len(x) + len(y) - both):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    assert 1 < len(set(root)) < 80
    parts = spark.createDataFrame(list(enumerate(sets)), "node long, parts array<long>").repartition(3)
    labels = spark.createDataFrame([(i, i) for i in range(90)], "node long, root long")
    for spare, block in ((32, 1 << 20), (0, 1 << 20), (0, 300), (1000, 300)):
        found = {r.node: r.root for r in simhash.completed(labels, parts, 0.8, spare, block).collect()}
        assert found == dict(enumerate(root)), (spare, block)


def test_one_bad_slot_drops_no_other_window(spark):
    item = "The quiet river carries old wooden boats down to the distant harbour town every single morning with 5 sailors and 3 dogs on board"
    bench = spark.createDataFrame([(1, item), (2, "Then 5 men carry some of the 3 stones")], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("3", "5")), (2, "then 4 men carry some of the 4 stones"), (3, "all of it is new")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == {(1, 1), (2, 2)}
    assert [r.doc_id for r in decontamination.clean(docs, bench).collect()] == [3]


def test_copies_of_one_text_are_spread_over_parts():
    import pyarrow as pa

    text = f"{passage(98, 120)}".encode()
    batch = pa.RecordBatch.from_arrays([pa.array(list(range(-20, 380))), pa.array([-7] * 400), pa.array([text] * 400)], names=["doc_id", "th", "text"])
    packs = pa.Table.from_batches(list(substrings._probe(iter([batch]), 8)))
    settled = packs.filter(pa.compute.equal(packs["kind"], 2))
    assert set(settled["bucket"].to_pylist()) == set(range(8))
    parts = pa.concat_tables(substrings._hits(packs.filter(pa.compute.equal(packs["bucket"], b)), 8) for b in range(8))
    by_part = [{tuple(k) for ids in parts.filter(pa.compute.equal(parts["part"], b))["ids"].to_pylist() for k in substrings.unpacked_keys(ids).tolist()} for b in range(8)]
    assert sum(map(len, by_part)) == len(set().union(*by_part)) == 400 and max(map(len, by_part)) < 100


def test_slot_heavy_windows_and_names_at_starts(spark):
    bench = spark.createDataFrame([(1, "5 12 7 19 23 42 8 15 16 99"), (2, "Tom has 5 apples. Tom buys 3 more.")], "item_id long, text string")
    texts = ["List: 5, 12, 7, 19, 23, 42, 8, 15, 16, 99.", "5 12 7 18 23 42 8 15 16 99", "So. Anna has 7 apples. Anna buys 4 more.", "Anna has 7 apples. Ben buys 4 more.", "tom has 5 apples. tom buys 3 more."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.n_windows, r.verbatim) for r in decontamination.contaminated(docs, bench).collect()} == {(0, 1, 3, True), (2, 2, 1, False), (4, 2, 1, True)}


def test_wrapped_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:"
    more = passage(11, 60)
    texts = ["Licensed under CC BY-NC 4.0.", f"{more}\n{mit}\n{more}", f"{more} This Source Code Form is subject to the\nterms of the Mozilla Public License, v. 2.0. {more}", f"{more}\n{more}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in licenses.scanned(docs).collect()} == {(0, "CC-BY-NC-4.0"), (1, "MIT"), (2, "MPL-2.0")}


def test_mix_takes_whole_rows(both, spark):
    """Rows of one text and number but other columns are rows of their own, whatever the partitioning."""
    twins = spark.createDataFrame([(1, "en", "a", "one two three four"), (1, "de", "b", "one two three four"), *[(2, "en", "a", "same row")] * 5, (3, "en", "b", None), (None, None, None, "x y")], "doc_id long, lang string, source string, text string")
    for docs in (*both, twins):
        out = mixing.repeated(docs)
        assert out.schema == docs.schema
        got = Counter(map(str, out.collect()))
        assert got == Counter(map(str, mixing.repeated(docs.repartition(3)).collect()))
        have = Counter(map(str, docs.collect()))
        assert all(n <= 2 * have[r] for r, n in got.items()) and not set(got) - set(have)
        sizes, took, goal, largest = Counter(), Counter(), {}, Counter()
        for r in docs.collect():
            sizes[r.source] += count(r.text)
            largest[r.source] = max(largest[r.source], count(r.text))
        for r in out.collect():
            took[r.source] += count(r.text)
        for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect():
            goal[r.source] = r.target
        if docs is both[0]:
            assert all(abs(took[s] - goal[s]) <= 0.1 * goal[s] + largest[s] for s in goal)


def test_pipeline_on_hard_rows(spark, hard, sf_dir, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing and dotted names: all stages end and agree with the plain versions of each."""
    import corpus_pipeline

    for name, docs in (("a", hard), ("b", hard.repartition(2))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(str(tmp_path / name / f"{table}.parquet"))
    out = [corpus_pipeline.run(spark, str(tmp_path / name)) for name in ("a", "b")]
    rows = [Counter(str(r) for r in o.drop("slot").collect()) for o in out]
    assert rows[0] == rows[1] and rows[0] and set(out[0].columns) >= {"doc_id", "text", "a.b", "shard", "slot", "grown_shard"}
    spark.createDataFrame([], hard.schema).write.parquet(str(tmp_path / "c" / "documents.parquet"))
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(str(tmp_path / "c" / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "c")).count() == 0
    kept = simhash.deduplicated(hard)
    assert kept.schema == hard.schema and kept.filter("doc_id in (6, 7, 8)").count() == 1 and kept.filter("doc_id is null").count() == 2


def test_components_of_any_graph(spark):
    """Chains, stars, hubs of small or large ids, repeated and reversed edges, loops and no edges at all."""
    from tessera.llm.common import components

    rng = np.random.default_rng(5)
    graphs = [
        [],
        [(7, 7)],
        [(i, i + 1) for i in range(60)],
        [(500, i) for i in range(200)] + [(0, 900), (900, 0), (900, 0)],
        [(-5, i) for i in range(100)] + [(i, i + 1000) for i in range(100)],
        [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))],
    ]
    for edges in graphs:
        root = {x: x for e in edges for x in e if e[0] != e[1]}
        for _ in root:
            for a, b in edges:
                if a != b:
                    root[a] = root[b] = min(root[a], root[b])
        found = components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
        assert sorted((r.node, r.root) for r in found) == sorted(root.items())


def test_url_tokens_count_wherever_they_stand(spark):
    """URLs of 3,000 tokens: a token that tells bad pages is found behind all others, and those that go together are one."""
    many = "/".join(f"s{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000))
    rows = [(i, f"http://a.org/{many}/{'zzbad' if i % 3 == 0 else 'zzgood'}/x{chr(97 + i % 20)}") for i in range(240)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if i % 3 == 0 else 1, 0) for i in range(240)], "doc_id long, quality int, toxic int")
    assert [r["items"] for r in urls.mined(pages, labels).collect()] == [["p:zzbad"]]
