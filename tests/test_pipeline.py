"""The incremental build in its four stages, and what must survive of it."""

from __future__ import annotations

import json

import pytest
import scenarios as s
from pyspark.sql import functions as F

from siltstone import PipelineConfig, cli, run_pipeline
from siltstone.config import LIMITS
from siltstone.functions.provenance import FIRST_GUESS
from siltstone.operators import gate
from siltstone.operators.unnest import current_rows
from siltstone.plans import pipeline as p
from siltstone.plans.layout import open_table, publish
from siltstone.plans.profile_raw import profile_raw
from siltstone.plans.versions import reclassify
from siltstone.schema import BRONZE_LABELS, GOLD, GOLD_COLUMNS, REJECTED, SILVER_FEATURES, SILVER_LABELS, SILVER_SITUATION, SILVER_STAKEHOLDER
from siltstone.store.maintenance import run_maintenance


def config_at(path, **more) -> PipelineConfig:
    return PipelineConfig(raw_dir=path / "raw", lakehouse_dir=path / "lake", buckets=4, **more).for_fixtures()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stages")
    config = config_at(path)
    out = {}

    def run(name):
        result = run_pipeline(spark, config)
        out[name] = {
            "skipped": result.skipped, "changed": result.changed_ids(), "counts": result.counts(),
            "bronze": {"all": result.table(BRONZE_LABELS).count(), "current": current_rows(result.table(BRONZE_LABELS)).count()},
            "gold": {(r["scenario_id"], r["id_prod"], r["label_ordinal"]): r for r in result.table(GOLD).collect()},
            "rejected": {(r["scenario_id"], r["id_prod"], r["label_ordinal"]): r for r in result.table(REJECTED).collect()}, "report": p.run_report(result),
            "columns": result.table(GOLD).columns, "rejected_columns": result.table(REJECTED).columns,
        }

    s.put_base(config.raw_dir)
    run("first")
    run("none")
    s.put_next(config.raw_dir)
    run("next")
    s.put(config.raw_dir, "labelled_alternatives.json", s.REVISED_LABELS)
    run("revised")
    s.put(config.raw_dir, "labelled_alternatives.json", s.BASE_LABELS)
    run("back")
    out["config"] = config
    return out


def test_first_load(stages):
    one = stages["first"]
    assert one["changed"] is None and not one["skipped"] and one["bronze"] == {"all": 5, "current": 5}
    assert {k: one["counts"][k] for k in (SILVER_LABELS, SILVER_FEATURES, SILVER_STAKEHOLDER, SILVER_SITUATION, GOLD, REJECTED)} == {SILVER_LABELS: 17, SILVER_FEATURES: 16, SILVER_STAKEHOLDER: 6, SILVER_SITUATION: 6, GOLD: 13, REJECTED: 4}
    assert {k: sorted(r["rejection_reasons"]) for k, r in one["rejected"].items()} == {
        ("3782", "prod_4", 3): ["density_out_of_range", "water_to_cement_ratio_out_of_range"], ("2647", "prod_5", 4): ["pref_out_of_bounds"],
        ("2647", "prod_1", 0): ["duplicate_scenario_product"], ("2647", "prod_1", 5): ["duplicate_scenario_product"],
    }
    assert tuple(one["columns"]) == GOLD_COLUMNS and one["rejected_columns"] == [*GOLD_COLUMNS, "rejection_reasons"]
    row = one["gold"][("3782", "prod_1", 0)]
    assert row["stakeholder_preferences"] == ["builder", "city"] and row["situations"] == ["dry", "wet"] and row["c_p"] == 1.0 and row["source_type"] == "llm_generated"
    mix = [r["source_type"] for r in one["gold"].values()]
    assert (mix.count("control_synthetic"), mix.count("llm_generated"), mix.count("expert_annotated")) == (5, 6, 2)
    assert "duplicate_scenario_product" in one["report"]


def test_nothing_new(stages):
    assert stages["none"]["skipped"] and stages["none"]["changed"] == [] and stages["none"]["gold"] == stages["first"]["gold"]


def test_new_file(stages):
    two = stages["next"]
    assert two["changed"] == ["control_gwp_777", "expert_9"]
    assert (two["counts"][SILVER_LABELS], two["counts"][SILVER_FEATURES], two["counts"][GOLD], two["counts"][REJECTED]) == (22, 21, 18, 4)
    assert all(two["gold"][k] == r for k, r in stages["first"]["gold"].items())


def test_replaced_file(stages):
    three = stages["revised"]
    assert three["bronze"] == {"all": 12, "current": 7} and len(three["changed"]) == 5
    assert (three["counts"][SILVER_LABELS], three["counts"][GOLD], three["counts"][REJECTED]) == (21, 20, 1)
    assert three["gold"][("control_health_1068", "prod_1", 1)]["pref"] == 0.5 and ("2647", "prod_1", 5) not in three["rejected"]
    assert set(three["rejected"]) == {("3782", "prod_4", 3)}


def test_going_back_is_a_change(stages):
    assert (stages["back"]["counts"][SILVER_LABELS], stages["back"]["counts"][GOLD], stages["back"]["counts"][REJECTED]) == (22, 18, 4)


def test_run_that_died_after_silver_is_caught_up_with(spark, tmp_path, monkeypatch):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    run_pipeline(spark, config)
    s.put_next(config.raw_dir)
    with monkeypatch.context() as m:
        m.setattr(p, "build_gold", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_pipeline(spark, config)
    assert open_table(spark, config, GOLD).read().count() == 13
    assert run_pipeline(spark, config).changed_ids() == ["control_gwp_777", "expert_9"]
    s.put(config.raw_dir, "labelled_alternatives.json", s.REVISED_LABELS)
    with monkeypatch.context() as m:
        m.setattr(p, "build_silver", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_pipeline(spark, config)
    assert len(run_pipeline(spark, config).changed_ids()) == 5 and open_table(spark, config, REJECTED).read().count() == 1


def test_limits_stop_a_run_before_gold(spark, tmp_path):
    config = config_at(tmp_path, limits={**LIMITS, "rejected_rows": 3})
    s.put_base(config.raw_dir)
    for _ in range(2):  # the next run fails again
        with pytest.raises(gate.GateFailure):
            run_pipeline(spark, config)
        assert not open_table(spark, config, GOLD).exists()


def test_unknown_and_half_scenarios(spark, tmp_path):
    config = config_at(tmp_path)
    s.put(config.raw_dir, "frozen_dataset.json", [*s.BASE_FEATURES, s.feature_record("expert_1", [s.alternative(1)]), s.feature_record(None, [s.alternative(1)])])
    s.put(config.raw_dir, "labelled_alternatives.json", [*s.BASE_LABELS, s.label_record("expert_2", [s.label(1, None)])])
    run_pipeline(spark, config)
    reasons = {r["scenario_id"]: r["rejection_reasons"] for r in open_table(spark, config, REJECTED).read().collect()}
    assert reasons["expert_1"] == ["missing_label_row", "scenario_product_set_mismatch"]
    assert reasons["expert_2"] == ["missing_feature_row", "pref_missing", "scenario_product_set_mismatch"]
    s.put(config.raw_dir, "frozen_dataset_x.json", [s.feature_record("weird", [s.alternative(1)])])
    s.put(config.raw_dir, "labelled_alternatives_x.json", [s.label_record("weird", [s.label(1, 0.5)])])
    with pytest.raises(gate.GateFailure, match="unknown"):
        run_pipeline(spark, config)


def test_rescue_and_broken_files(spark, tmp_path):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    odd = [{**s.label_record("expert_5", [s.label(1, 0.5)]), "note": 1}, {"id": "expert_6", "labelled_alternatives": "text"}]
    s.put(config.raw_dir, "labelled_alternatives_odd.json", odd)
    p.ingest(spark, config, "b1")
    rows = {r["id"]: r["_rescued_data"] for r in open_table(spark, config, BRONZE_LABELS).read().collect()}
    assert json.loads(rows["expert_5"])["note"] == 1 and "text" in rows["expert_6"] and rows["3782"] is None
    (config.raw_dir / "labelled_alternatives_bad.json").write_text('[{"id": "1"')
    with pytest.raises(ValueError, match="labelled_alternatives_bad"):
        p.ingest(spark, config, "b2")


def test_version_diff(spark, tmp_path):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    found = reclassify(spark, config)
    assert {(r["before"], r["after"]): (r["rows"], r["groups"]) for r in found.transitions.collect()} == {("llm_generated", "control_synthetic"): (2, 1), ("llm_generated", "expert_annotated"): (2, 1)}
    assert {r["source_type"]: r["delta"] for r in found.totals.collect()} == {"control_synthetic": 2, "expert_annotated": 2, "llm_generated": -4}
    assert found.sample().count() == 2


def test_naive_is_naive(spark):
    ids = spark.createDataFrame([("control_gwp_1",), ("control_archfinish_slump_2",), ("expert_1",)], "scenario_id string")
    assert [r[0] for r in ids.select(FIRST_GUESS()).collect()] == ["control_synthetic", "llm_generated", "llm_generated"]


def test_maintenance_keeps_rows(spark, stages):
    config = stages["config"]
    before = sorted(map(str, open_table(spark, config, GOLD).read().collect()))
    results = {r.table: r for r in run_maintenance(spark, config, retain_hours=0)}
    assert not any(r.error for r in results.values()) and results[BRONZE_LABELS].optimized and results[GOLD].present
    assert sorted(map(str, open_table(spark, config, GOLD).read().collect())) == before


def test_profile(spark, tmp_path):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    found = profile_raw(spark, config)
    assert found["labels"]["scenarios"] == {"rows": 5, "ids": 5} and found["features"]["lengths"] == {"count": 5, "min": 2, "max": 5, "mean": 3.2}
    assert {r["pattern"] for r in found["labels"]["patterns"]} == {"control_health_<n>", "control_archfinish_slump_<n>", "<n>", "expert_<n>"}
    assert found["cross_file"] == [{"side": "both", "same_items": True, "scenarios": 5}]
    assert next(r for r in found["features"]["ranges"] if r["column"] == "density")["min"] == 950.0


def test_command_line(spark, tmp_path, capsys):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    where = ["--raw-dir", str(config.raw_dir), "--lakehouse-dir", str(config.lakehouse_dir), "--fixtures"]
    assert cli.main(["validate", *where]) == 1
    assert cli.main(["build", *where]) == 0 and "gold_scenarios" in capsys.readouterr().out
    assert cli.main(["validate", *where]) == 0 and cli.main(["validate", "--strict", *where]) == 1
    assert cli.main(["build", *where[:-1]]) == 0  # nothing new: skipped
    assert cli.main(["build", "--full-refresh", *where[:-1]]) == 1  # a quarter of the rows is rejected
    assert cli.main(["maintain", *where]) == 0 and cli.main(["profile", "--json-out", str(tmp_path / "p.json"), *where]) == 0
    assert cli.main(["diff", *where]) == 0 and json.loads((tmp_path / "p.json").read_text())["cross_file"]


def test_value_changes_only(spark, tmp_path):
    config = config_at(tmp_path, lineage_counts_as_change=False)
    s.put_base(config.raw_dir)
    run_pipeline(spark, config)
    s.put(config.raw_dir, "labelled_alternatives.json", s.REVISED_LABELS)
    assert run_pipeline(spark, config).changed_ids() == ["2647", "control_health_1068"]
    assert open_table(spark, config, GOLD).read().filter(F.col("scenario_id") == "2647").count() == 5


def test_arrival_by_stream(spark, tmp_path):
    """New files by the stream, with rescue and lineage; a replaced one by its content; the same tables in the end."""
    config = config_at(tmp_path, checkpoint_dir=str(tmp_path / "progress"))
    s.put_base(config.raw_dir)
    run_pipeline(spark, config)
    assert open_table(spark, config, GOLD).read().count() == 13 and (tmp_path / "progress" / "labels").exists()
    landed = open_table(spark, config, BRONZE_LABELS).read()
    assert landed.filter("_file_hash IS NULL AND _batch_id IS NOT NULL AND _ingested_at IS NOT NULL").count() == 5
    assert run_pipeline(spark, config).skipped
    s.put_next(config.raw_dir)
    s.put(config.raw_dir, "labelled_alternatives.json", s.REVISED_LABELS)
    result = run_pipeline(spark, config)
    assert sorted(f.name for f in result.ingested) == ["frozen_dataset_batch2.json", "labelled_alternatives.json", "labelled_alternatives_batch2.json"]
    assert (open_table(spark, config, GOLD).read().count(), open_table(spark, config, REJECTED).read().count()) == (20, 1)
    hashed = open_table(spark, config, BRONZE_LABELS).read().groupBy("_source_file").agg(F.count_if(F.col("_file_hash").isNotNull()).alias("n")).collect()
    assert {r[0]: r[1] for r in hashed} == {"labelled_alternatives.json": 5, "labelled_alternatives_batch2.json": 0}
    (config.raw_dir / "labelled_alternatives_bad.json").write_text("{")
    with pytest.raises(Exception, match="labelled_alternatives_bad"):
        p.ingest(spark, config, "b9")


def test_publish_and_job(spark, tmp_path, capsys):
    config = config_at(tmp_path)
    s.put_base(config.raw_dir)
    where = ["--raw-dir", str(config.raw_dir), "--lakehouse-dir", str(config.lakehouse_dir)]
    assert cli.main(["job", *where]) == 1 and "done: nothing" in capsys.readouterr().out  # a quarter of the rows is rejected
    assert cli.main(["job", "--fixtures", "--strict", *where]) == 1 and "done: build" in capsys.readouterr().out
    assert cli.main(["job", "--fixtures", *where]) == 0 and "done: build, validate, maintain" in capsys.readouterr().out
    shown = {r["tableName"] for r in publish(spark, config, "quarry").collect()}
    assert {GOLD, REJECTED, BRONZE_LABELS} <= shown
    assert spark.sql("SELECT count(*) FROM quarry.gold_scenarios").first()[0] == 13
    spark.sql("DROP SCHEMA quarry CASCADE")
