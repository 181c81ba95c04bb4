"""Provenance, gate rules, limits, correlations, files, streaming, and what the sources may not use."""

from __future__ import annotations

import ast
import hashlib
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone.config import FEATURES, LABELS, LIMITS, PipelineConfig, QualityThresholds
from siltstone.functions import correlation, provenance
from siltstone.operators import gate, unnest
from siltstone.sources import files
from siltstone.store.table import VersionedTable
from siltstone.streaming.ingest import into_table, stream_files

REPO = Path(__file__).resolve().parents[1]
IDS = {
    "control_gwp_1": "control_synthetic", "control_archfinish_slump_299": "control_synthetic", "expert_118": "expert_annotated", "3782": "llm_generated", " 3782 ": "llm_generated",
    "control_gwp": "unknown", "control__1": "unknown", "control_a_1": "unknown", "expert_": "unknown", "x3": "unknown", "": "unknown", "EXPERT_1": "unknown", None: "unknown",
}


def test_classifier(spark):
    assert {i: provenance.classify_source_type(i) for i in IDS} == IDS
    frame = spark.createDataFrame([(i,) for i in IDS], "scenario_id string").withColumn("source_type", provenance.CORRECTED())
    assert {r[0]: r[1] for r in frame.collect()} == IDS
    assert provenance.control_axis("control_archfinish_slump_299") == "archfinish_slump" and provenance.control_axis("expert_1") is None
    assert set(provenance.TAXONOMIES) == {"naive", "corrected"}


LABEL_DDL = "scenario_id string, id_prod string, pref double, conf double, source_type string"
FEATURE_DDL = "scenario_id string, id_prod string, compressive_strength double, water_to_cement_ratio double, density double"


def reasons(spark, labels, features):
    left, right = spark.createDataFrame(labels, LABEL_DDL), spark.createDataFrame(features, FEATURE_DDL)
    from siltstone.operators.join import presence_join

    joined = presence_join(left, right, ["scenario_id", "id_prod"], "_has_label", "_has_feature")
    out = gate.with_reasons(joined, gate.product_sets(left, right), QualityThresholds())
    return sorted((r["scenario_id"], r["id_prod"], tuple(r["rejection_reasons"])) for r in out.collect())


def test_reasons(spark):
    ok = [("s", "p", 0.5, 0.5, "x")], [("s", "p", 30.0, 0.5, 2400.0)]
    assert reasons(spark, *ok) == [("s", "p", ())]
    for value in (0.0, 1.0):
        assert reasons(spark, [("s", "p", value, value, "x")], ok[1]) == [("s", "p", ())]
    assert reasons(spark, [("s", "p", 1.01, -0.1, "x")], ok[1]) == [("s", "p", ("conf_out_of_bounds", "pref_out_of_bounds"))]
    assert reasons(spark, [("s", "p", float("nan"), None, "x")], ok[1]) == [("s", "p", ("conf_missing", "pref_out_of_bounds"))]
    for low, high in ((5.0, 150.0),):
        assert reasons(spark, ok[0], [("s", "p", low, 0.2, 1200.0)]) == reasons(spark, ok[0], [("s", "p", high, 1.0, 3000.0)]) == [("s", "p", ())]
    assert reasons(spark, ok[0], [("s", "p", None, None, None)]) == [("s", "p", ())]
    assert reasons(spark, ok[0], [("s", "p", 4.9, 1.1, 3001.0)]) == [("s", "p", ("compressive_strength_out_of_range", "density_out_of_range", "water_to_cement_ratio_out_of_range"))]
    assert reasons(spark, ok[0] * 2, ok[1]) == [("s", "p", ("duplicate_scenario_product",))] * 2
    whole = reasons(spark, [*ok[0], ("s", "q", 0.5, 0.5, "x")], ok[1])
    assert whole == [("s", "p", ("scenario_product_set_mismatch",)), ("s", "q", ("missing_feature_row", "scenario_product_set_mismatch"))]
    assert reasons(spark, [], ok[1]) == [("s", "p", ("missing_label_row", "scenario_product_set_mismatch"))]


def test_limits(spark):
    def check(passed, rejected, unknown=0, **limits):
        rows = passed + rejected
        frame = spark.createDataFrame([(passed, rejected, unknown, rejected / rows if rows else None)], "passed_rows long, rejected_rows long, unknown_rows long, rejected_share double")
        return gate.enforce(frame, LIMITS | limits)

    check(0, 0)
    check(99, 1)
    for bad in ((98, 2), (0, 1)):
        with pytest.raises(gate.GateFailure, match="rejected_share"):
            check(*bad)
    with pytest.raises(gate.GateFailure):
        check(10_000, 3, rejected_rows=2)
    check(10_000, 2, rejected_rows=2)
    with pytest.raises(gate.GateFailure, match="unknown_rows 1"):
        check(1000, 0, 1)
    check(1000, 0, 1, unknown_rows=None)
    check(0, 5, 5, unknown_rows=None, rejected_share=None)


def gold(spark, n, kind="a"):
    return spark.range(n).select(F.lit(kind).alias("source_type"), F.col("id").cast("double").alias("pref"), (-F.col("id")).cast("double").alias("gwp"), F.col("id").cast("double").alias("health"), F.lit(1.0).alias("circ_orig"))


def test_correlations(spark):
    verdicts = lambda df: {(r["source_type"], r["variable"]): r["verdict"] for r in correlation.checks(df).collect()}
    assert verdicts(gold(spark, 40).unionByName(gold(spark, 5, "b"))) == {("a", "gwp"): "OK", ("a", "health"): "OK", ("a", "circ_orig"): "NO DATA", ("b", "gwp"): "TOO FEW", ("b", "health"): "TOO FEW", ("b", "circ_orig"): "NO DATA", ("ALL", "gwp"): "OK", ("ALL", "health"): "OK", ("ALL", "circ_orig"): "NO DATA"}
    assert all(r["correlation"] is None for r in correlation.checks(gold(spark, 1)).collect())
    wrong = correlation.checks(gold(spark, 40).withColumn("gwp", -F.col("gwp")))
    assert {r["variable"] for r in wrong.filter("verdict = 'WRONG SIGN'").collect()} == {"gwp"} and "WRONG SIGN" in correlation.report(wrong)
    seen = spark.createDataFrame([(0.04, 100), (0.0, 100), (0.5, 29), (-0.5, 100), (None, 1)], "c double, n int").select(correlation.observed_column(F.col("c")), correlation.verdict_column(F.col("c"), F.col("n"), "positive"))
    assert [tuple(r) for r in seen.collect()] == [("negligible", "FLAT"), ("negligible", "FLAT"), ("positive", "TOO FEW"), ("negative", "WRONG SIGN"), ("undefined", "NO DATA")]
    axes = gold(spark, 40, "control_synthetic").withColumn("scenario_id", F.concat(F.lit("control_gwp_"), F.col("pref").cast("int")))
    assert [(r["axis"], r["rows"], round(r["gwp"], 6), r["circ_orig"]) for r in correlation.by_axis(axes).collect()] == [("gwp", 40, -1.0, None)]


def test_files(spark, tmp_path):
    config = PipelineConfig(raw_dir=tmp_path)
    with pytest.raises(FileNotFoundError):
        files.listed(spark, config, LABELS)
    for name in ("labelled_dataset.json", "labelled_alternatives_b.json", "frozen_dataset.json"):
        (tmp_path / name).write_text(f'[{{"id": "{name}"}}]')
    assert [p.rsplit("/", 1)[1] for p in files.listed(spark, config, LABELS)] == ["labelled_alternatives_b.json", "labelled_dataset.json"]
    assert files.first_release(spark, config, LABELS).endswith("/labelled_dataset.json") and files.first_release(spark, config, FEATURES)
    (tmp_path / "labelled_dataset.json").rename(tmp_path / "other.json")
    with pytest.raises(FileNotFoundError):
        files.first_release(spark, config, LABELS)
    (tmp_path / "other.json").rename(tmp_path / "labelled_dataset.json")
    found = files.describe(spark, config)
    assert [(f.kind, f.name) for f in found] == [(LABELS, "labelled_alternatives_b.json"), (LABELS, "labelled_dataset.json"), (FEATURES, "frozen_dataset.json")]
    assert {f.digest for f in found} == {hashlib.sha256((tmp_path / f.name).read_bytes()).hexdigest() for f in found} == {files.stream_hash(spark, f.path) for f in found}
    log = files.empty_log(spark)
    assert files.not_ingested(spark, found, log) == found
    log = log.union(files.log_rows(spark, found, "b1", {}))
    assert files.not_ingested(spark, found, log) == []
    old = [files.RawFile(f.kind, f.path, "other", 1) for f in found[:1]]
    assert files.not_ingested(spark, found, log.union(files.log_rows(spark, old, "b2", {}))) == found[:1]


def test_preflight(tmp_path):
    from siltstone.session import preflight

    assert preflight("posix") == [] and preflight("nt", "") == ["HADOOP_HOME is not set"] and len(preflight("nt", str(tmp_path))) == 2
    (tmp_path / "bin").mkdir()
    for name in ("winutils.exe", "hadoop.dll"):
        (tmp_path / "bin" / name).touch()
    assert preflight("nt", str(tmp_path)) == []


def test_current_rows(spark):
    landed = spark.createDataFrame([("a", "f1", "b1", 1), ("a", "f1", "b2", 2), ("b", "f1", "b1", 3), ("c", "f2", "b1", 4), ("a", "f3", "b2", 5)], "id string, _source_file string, _batch_id string, v int")
    assert sorted(r["v"] for r in unnest.current_rows(landed).collect()) == [4, 5]


def test_streaming(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    (tmp_path / "in").mkdir()

    def run():
        stream = stream_files(spark, str(tmp_path / "in"), "id STRING, n DOUBLE", ("a*.json", "b*.json"))
        into_table(stream, table, str(tmp_path / "cp")).awaitTermination()
        return sorted((r["id"], r["_source_file"]) for r in table.read().collect())

    (tmp_path / "in" / "a1.json").write_text(json.dumps([{"id": "1", "n": 3}, {"id": "2"}]))
    (tmp_path / "in" / "c.json").write_text("[]")
    assert run() == [("1", "a1.json"), ("2", "a1.json")]
    (tmp_path / "in" / "b1.json").write_text(json.dumps([{"id": "3"}]))
    assert run() == [("1", "a1.json"), ("2", "a1.json"), ("3", "b1.json")] == run()


def test_sources_use_frames_only():
    """No RDDs, caches or Python functions in the engine; its own parts never import the corpus operators."""
    for path in (REPO / "siltstone").rglob("*.py"):
        text = path.read_text()
        for node in ast.walk(ast.parse(text)):
            if isinstance(node, ast.Attribute):
                assert node.attr not in ("rdd", "cache", "persist", "unpersist", "localCheckpoint"), path
                if "llm" not in path.parts:
                    assert node.attr not in ("udf", "pandas_udf", "mapInPandas", "mapInArrow", "applyInPandas"), path
        if "llm" not in path.parts:
            assert not re.search(r"siltstone\.llm|corpus_pipeline", text), path


def test_every_query_has_sql_or_a_reason():
    import sys

    sys.path.insert(0, str(REPO))
    from siltstone.plans import catalog

    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and set(catalog.QUERIES) == set(catalog.ORACLES)
