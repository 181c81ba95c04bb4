"""Repeated passages against a dictionary of all windows, and the index against plain search."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import fm_index, substring_dedup


def by_hand(texts, window):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        words = split(t)
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s : s + window]), (i, s))
    out = Counter()
    for i, t in texts:
        words = split(t)
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        kept = " ".join(w for n, w in enumerate(words) if n not in gone)
        out[(i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def answer(docs, **options):
    rows = substring_dedup.remove_repeats(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("h")).collect()
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("shard_passages", [3, 500, 60_000])
def test_documents(spark, shard_passages):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert answer(docs, shard_passages=shard_passages, hot=shard_passages) == by_hand([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 20)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in texts], "doc_id long, text string, key string, version int, place int")


def test_hard_rows(spark):
    rng = random.Random(9)
    words = ["a", "b", "É", "c\x0bd", "\xa0", "e."]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 90)))) for i in range(150)]
    texts += [(1000, "x " * 3000), (1001, "x\n" * 25), (1002, None), (1003, ""), (1004, " \t "), (1005, "one"), (900, "a " * 19), (901, "a " * 20)]
    passage = " ".join(f"w{i}" for i in range(60))
    texts += [(2000 - i, f"n{i} {passage} m{i}") for i in range(200)]
    assert answer(frame(spark, texts)) == by_hand(texts, 20)
    assert answer(frame(spark, texts), window=9, shard_passages=100, hot=100) == by_hand(texts, 9)


def test_rows_without_id_or_that_repeat(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    texts = [(1, passage), (1, passage), (None, f"{passage} z"), (2, f"y {passage}"), (2, "other")]
    found = {(r[0], r[1]): (r[2], n) for r, n in answer(frame(spark, texts)).items()}
    assert found == {(1, 40): (0, 2), (None, 41): (40, 1), (2, 41): (40, 1), (2, 1): (0, 1)}
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=3, max_size=12), min_size=1, max_size=8), st.integers(1, 3))
def test_index(passages, length):
    flat = [x for p in passages for x in [*p, 0]]
    index = fm_index.FMIndex(np.array(flat))
    starts = [i for i in range(len(flat) - length + 1) if 0 not in flat[i : i + length]]
    expected = [any(flat[j : j + length] == flat[i : i + length] for j in range(i)) for i in starts]
    lengths, lows, highs = index.matching_statistics(np.array(flat), np.array(starts, dtype=np.int64) + length, length, places=2)
    several = [sum(flat[j : j + length] == flat[i : i + length] for j in starts) > 1 for i in starts]
    assert (lengths == length).tolist() == several
    assert [n and min(index.places(np.arange(a, b))) < i for n, a, b, i in zip(several, lows, highs, starts, strict=True)] == expected
    pattern = passages[0][:length]
    assert index.locate(np.array(pattern)).tolist() == [i for i in starts if flat[i : i + length] == pattern]
    assert index.places(np.arange(len(flat))).tolist() == fm_index.suffix_array(np.array(flat)).tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=9), min_size=1, max_size=6), st.lists(st.integers(1, 5), min_size=1, max_size=12), st.integers(1, 6), st.integers(1, 3))
def test_matching_statistics(passages, text, limit, places):
    """Another text streamed against the index, with symbols that the index has not."""
    flat = [x for p in passages for x in [*p, 0]]
    found, lows, highs = fm_index.FMIndex(np.array(flat)).matching_statistics(np.array(text), np.arange(1, len(text) + 1), limit, places)
    count = lambda p: sum(flat[i : i + len(p)] == p for i in range(len(flat)))
    for end, n, a, b in zip(range(1, len(text) + 1), found.tolist(), lows.tolist(), highs.tolist(), strict=True):
        assert n == max([k for k in range(1, min(limit, end) + 1) if count(text[end - k : end]) >= places], default=0)
        assert n == 0 or b - a == count(text[end - n : end])
