"""What must not grow with the square of a file: scans of nested files; and fixtures in files of bounded size."""

from __future__ import annotations

import json
from collections import Counter
from glob import glob

import duckdb
import pytest

from siltstone.plans import catalog, pipeline, queries_engine, scenario_tables, versions
from siltstone.schema import LABELS_DDL
from siltstone.sources.json_scan import NO_ARRAY, records
from siltstone.streaming import ingest


def nodes(plan, name):
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] * (plan.nodeName() == name) + [n for p in below for n in nodes(p, name)]


def names(attributes):
    return {attributes.apply(i).name() for i in range(attributes.size())}


@pytest.fixture
def dealt(monkeypatch):
    """Files of 20 turns."""
    monkeypatch.setattr(scenario_tables, "PART_TURNS", 20)


def same_as_sql(spark, small, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small}/conversations.parquet'")
    expected = c.execute(catalog.ORACLES[name])
    columns = [x[0] for x in expected.description]
    return Counter(tuple(r) for r in catalog.QUERIES[name](spark, small).select(*columns).collect()) == Counter(expected.fetchall())


def test_a_record_does_not_carry_its_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "labelled_alternatives": []}, None, 7]))
    (tmp_path / "b.json").write_text('{"id": "1"}')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text("null")
    rows = records(spark, [str(tmp_path / f"{x}.json") for x in "abcd"], LABELS_DDL)
    exploded = nodes(rows._jdf.queryExecution().optimizedPlan(), "Generate")
    assert len(exploded) == 1 and "v" not in names(exploded[0].output())
    found = Counter((r["_source_file"], r["id"], r["_rescued_data"]) for r in rows.collect())
    assert found == Counter([("a.json", "1", None), ("a.json", None, "null"), ("a.json", None, "7"), ("b.json", None, NO_ARRAY), ("d.json", None, NO_ARRAY)])


def test_files_are_bounded(spark, small, tmp_path, dealt):
    n = scenario_tables.parts(spark, small)
    scenario_tables.put_files(spark, scenario_tables.landed_labels(spark, small), str(tmp_path / "raw"), "labels", n)
    found = [json.loads(p.read_text()) for p in (tmp_path / "raw").glob("labels_*_*.json")]
    whole = scenario_tables.landed_labels(spark, small).collect()
    assert n > 1 and len(found) > scenario_tables.FILES
    assert sorted(r["id"] for f in found for r in f) == sorted(r["id"] for r in whole)
    assert max(len(f) for f in found) < len(whole) / scenario_tables.FILES


def test_scan_of_several_files(spark, small, dealt):
    assert same_as_sql(spark, small, "scan_json_nested")


def test_stream_of_several_folders(spark, small, dealt, monkeypatch):
    found = []

    def arrive(spark, folder, *more):
        found.extend(glob(f"{folder.removeprefix('file:')}/labelled_alternatives_a_*.json"))
        ingest.arrive(spark, folder, *more)

    monkeypatch.setattr(queries_engine, "arrive", arrive)
    assert same_as_sql(spark, small, "stream_records")
    assert len(found) > len({f.rsplit("/", 1)[1] for f in found}) == scenario_tables.FILES


@pytest.fixture
def raw_files(monkeypatch):
    """Names of the raw files of each run of a build."""
    runs = []

    def run_pipeline(spark, config, *more, **named):
        runs.append({f.rsplit("/", 1)[1] for f in glob(f"{config.raw_dir.removeprefix('file:')}/*.json")})
        return pipeline.run_pipeline(spark, config, *more, **named)

    monkeypatch.setattr(versions, "run_pipeline", run_pipeline)
    return runs


def test_builds_of_many_files(spark, small, dealt, raw_files):
    assert same_as_sql(spark, small, "version_diff_transitions")
    assert len(raw_files) == 2 and len(raw_files[0]) > 2 * scenario_tables.FILES


def test_a_replaced_file_keeps_its_parts(spark, small, dealt, monkeypatch):
    """Landing the records of a file again replaces all of its parts, and adds no file."""
    files = []

    def run_pipeline(spark, config):
        files.append({f.rsplit("/", 1)[1] for f in glob(f"{config.raw_dir.removeprefix('file:')}/*.json")})
        return pipeline_run(spark, config)

    pipeline_run = pipeline.run_pipeline
    monkeypatch.setattr(pipeline, "run_pipeline", run_pipeline)
    assert same_as_sql(spark, small, "pipeline_stages")
    assert len(files) == 4 and files[0] == files[1] < files[2] == files[3] and len(files[3]) > 2 * scenario_tables.FILES
