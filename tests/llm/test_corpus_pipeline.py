"""The pipeline's stages against plain versions."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from test_first_operators import check_packing
from test_near_dedup import LOWER
from test_near_dedup import by_hand as near_by_hand
from test_substring_dedup import by_hand as cut_by_hand

from siltstone.llm import toxicity

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = rows_of(docs)
    machine = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    scorer = toxicity.Scorer(machine)
    expected = {i: r for i, r in before.items() if scorer.score(r["text"]) < 0.5}
    stages = dict(corpus_pipeline.STAGES)
    now = stages["toxicity"](spark, docs, small)
    assert now.columns == docs.columns and rows_of(now) == expected

    by = {}
    for i in sorted(expected):
        by.setdefault((expected[i]["text"] or "").translate(LOWER), i)
    expected = {i: expected[i] for i in by.values()}
    now = stages["exact dedup"](spark, now, small)
    assert now.columns == docs.columns and rows_of(now) == expected

    kept = {i for (i, _, _, k) in near_by_hand([(i, r["text"]) for i, r in expected.items()], 5, 80, 100) if k}
    expected = {i: expected[i] for i in kept}
    now = stages["near dedup"](spark, now, small)
    assert now.columns == docs.columns and rows_of(now) == expected

    cut = {i: (n, gone, sha) for (i, n, gone, sha) in cut_by_hand([(i, r["text"]) for i, r in expected.items()], 20)}
    now = stages["substring dedup"](spark, now, small)
    found = rows_of(now)
    assert now.columns == docs.columns and set(found) == set(expected)
    for i, r in found.items():
        if cut[i][1]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == cut[i][2] and r["n_chars"] == len(r["text"])
            assert (r["lang"], r["source"]) == (expected[i]["lang"], expected[i]["source"])
        else:
            assert r == expected[i]
    texts = [(i, r["text"]) for i, r in found.items()]
    check_packing(texts, stages["packing"](spark, now, small).collect())

    whole = {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, small).collect()}
    assert whole == {(r["doc_id"], r["start"]): (r["length"], r["ids_crc32"]) for r in stages["packing"](spark, now, small).collect()}


def test_odd_rows(spark, small):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(1, text), (1, text), (2, text.upper()), (3, None), (4, ""), (None, text), (None, "z"), (None, "z"), (5, "word " * 5000)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DDL)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), (r["text"] or "")[:3]) for r in docs.collect())
    assert left == [(-1, "z"), (1, "a b"), (3, ""), (5, "wor")]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
