"""Texts in title case among benchmark passages, and likeness of texts that have few words a line."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import decontamination, multiset

ITEM = "A train leaves at 9 and travels 120 km with driver Alice, who meets Bob after 9 hours of driving on the road."


def found(spark, texts, items=(ITEM,)):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}


def test_title_case(spark):
    texts = ["we read: " + ITEM.title() + " and so on", ITEM.title(), (ITEM.title() + " ") * 40, ITEM.upper(), ITEM.lower(), "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy met here", ITEM.title().replace("120", "77"), ITEM.title().replace("Bob", "Eve")]
    assert found(spark, texts) == {(i, 0) for i in (0, 1, 2, 3, 4, 6, 7)}
    names = "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy"
    assert found(spark, [names, names.lower(), names.replace("Bob", "Eve"), " ".join(reversed(names.split()))], (names,)) == {(0, 0), (1, 0)} | ({(2, 0)} if len(names.split()) - 2 >= decontamination.WIDTH else set())


def test_title_runs_are_lowered_whole(spark):
    rng = random.Random(3)
    for n in (1, 7, 8, 200, 201, 202, 207, 208, 209, 1000, 20_000):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 6))).capitalize() for _ in range(n)]
        text = "so " + " ".join(words) + " then Alice and Bob"
        got = spark.createDataFrame([(text,)], "t string").select(decontamination._lowered(decontamination.F.col("t"))).first()[0]
        assert got == ("so " + " ".join(words).lower() + " then Alice and Bob" if n >= 8 else text), n


def plain_likeness(a, b):
    """Cosine of the counts themselves."""

    def counts(text):
        out = Counter()
        for line in text.split("\n"):
            words = re.findall(r"[^\x20\x09-\x0D]+", line)
            out.update(("3", *words[i : i + 3]) for i in range(len(words) - 2))
            if len(words) < multiset.SHORT:
                out.update(("1", w) for w in words)
                out.update(("2", *words[i : i + 2]) for i in range(len(words) - 1))
            if len(words) < 3:
                raw = line.encode()
                out.update(("8", raw[i : i + 8]) for i in range(len(raw) - 7) if len(raw) > multiset.LONG)
        return out

    x, y = counts(a), counts(b)
    size = (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
    return sum(v * y[k] for k, v in x.items()) / size if size else 0.0


@pytest.mark.parametrize("width", [1, 2, 3, 30])
def test_likeness_by_count(width):
    rng = random.Random(width)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(width)) for _ in range(n))
    for n in (2, 10, 60):
        a, b = text(n), text(n)
        for x, y in ((a, multiset.edited(a, b)), (a, b)):
            assert multiset.likeness(multiset.vector(x), multiset.vector(y)) == pytest.approx(plain_likeness(x, y), abs=0.35)
        assert multiset.likeness(multiset.vector(a), multiset.vector(multiset.edited(a, b))) > 0.15


def test_likeness_of_texts_without_spaces():
    rng = random.Random(9)
    a, b = ("".join(rng.choice("abcdefghijklmnop日本語") for _ in range(1500)) for _ in range(2))
    near, far = (multiset.likeness(multiset.vector(a), multiset.vector(x)) for x in (multiset.edited(a, b), b))
    assert near > 0.3 > far and near == pytest.approx(plain_likeness(a, multiset.edited(a, b)), abs=0.25)
    assert multiset.as_hex(multiset.plus(multiset.vector("x"), a)) == multiset.as_hex(multiset.vector(a + "\nx"))
