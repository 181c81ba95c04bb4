"""Near-duplicate groups against a comparison of all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from siltstone.llm import near_dedup
from siltstone.llm.common import UPPER

LOWER = str.maketrans(UPPER, UPPER.lower())


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def by_hand(texts, k, num, den):
    rows = [(i, shingles(t, k)) for i, t in texts]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    places = {}
    for x, (i, s) in enumerate(rows):
        if i is None:
            continue
        for y in {y for w in s for y in places.get(w, ())}:
            t = rows[y][1]
            if den * len(s & t) >= num * len(s | t):
                parent[find(x)] = find(y)
        for w in s:
            places.setdefault(w, []).append(x)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return Counter((i, len(s), None if i is None else least[find(x)], i is None or i == least[find(x)]) for x, (i, s) in enumerate(rows))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, b"s") for i, t in texts], "doc_id long, text string, cls string, n int, set binary")


@pytest.mark.parametrize(("k", "num"), [(3, 85), (5, 80)])
def test_documents(spark, k, num):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = Counter(tuple(r) for r in near_dedup.near_groups(docs, k=k, num=num).collect())
    assert found == by_hand([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], k, num, 100)


def hard_texts():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    texts = [(i, t) for i, t in enumerate([None, "", " ", "one", "One", "one two", "ONE  two", "é a b", "É a b", "x " * 50000])]
    for n in range(250):  # many near copies of one text, and chains between them
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        texts.append((1000 - n, " ".join(words)))
    passage = [rng.choice(vocabulary) for _ in range(30)]
    texts += [(2000 + n, " ".join(passage + [rng.choice(vocabulary) for _ in range(30)])) for n in range(150)]
    return texts + [(5, "one"), (None, "one"), (None, "zz"), (7, " ".join(base)), (3000, "a b c d e f"), (3001, "a b c d e f g")]


@pytest.mark.parametrize("options", [{}, {"small": 10, "depth": 2, "block": 16}])
def test_hard_rows(spark, options):
    texts = hard_texts()
    found = Counter(tuple(r) for r in near_dedup.near_groups(frame(spark, texts), k=3, num=85, **options).collect())
    assert found == by_hand(texts, 3, 85, 100)


def test_one_template(spark):
    """Pairs at the threshold among documents of one template: every tree branches with tokens of its own."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    template, texts = words(404), []
    for n in range(800):
        shared = words(24)
        texts += [(2 * n + i, " ".join(template + shared + words(52))) for i in (0, 1)]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(frame(spark, texts), k=5, num=80, small=64).collect()}
    assert [n for n in range(800) if found[2 * n] != found[2 * n + 1]] == []
    assert len(set(found.values())) == 800


def test_large_group(spark):
    """3,000 near copies of a text, some of them near to it and some to others only, in nodes of far more than 1,024."""
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    texts = [(0, " ".join(base))]
    for n in range(1, 3000):
        words = list(base) if n % 7 else texts[rng.randrange(len(texts))][1].split(" ")
        for _ in range(rng.choice([1, 1, 1, 2, 3, 4])):
            words[rng.randrange(60)] = rng.choice(vocabulary)
        texts.append((n, " ".join(words)))
    rng.shuffle(texts)
    expected = by_hand(texts, 3, 85, 100)
    largest = Counter(c for (_, _, c, _), _ in expected.items()).most_common(1)[0][1]
    assert 1000 < largest < 3000
    for options in ({}, {"small": 64, "block": 32}):
        assert Counter(tuple(r) for r in near_dedup.near_groups(frame(spark, texts), k=3, num=85, **options).collect()) == expected


def test_recall_in_large_nodes(spark):
    """1,500 planted pairs at the threshold, all of one template, so that nodes of its tokens have up to 3,000 members."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    template, texts = words(404), []
    for n in range(1500):
        shared = words(24)
        texts += [(2 * n + i, " ".join(template + shared + words(52))) for i in (0, 1)]
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(frame(spark, texts), k=5, num=80).collect()}
    caught = sum(found[2 * n] == found[2 * n + 1] for n in range(1500))
    print(caught, "of 1500")
    assert caught >= 0.99 * 1500


def test_nothing(spark):
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("at_once", [0, 10**6])
def test_components(spark, at_once):
    from siltstone.llm.components import components

    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = list(range(1100))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    expected = {(x, find(x)) for link in links for x in link if find(x) != x}
    frame = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in components(frame, at_once).collect()} == expected
    assert components(frame.limit(0), at_once).count() == 0
