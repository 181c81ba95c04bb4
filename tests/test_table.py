"""The versioned table: transactions, merge, time travel, changes, constraints, compaction, expiry."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.store.log import CommitConflict, Log
from siltstone.store.table import ConstraintViolation, VersionedTable, VersionGone, merged_schema

DDL = "k long, g string, v double"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def table(spark, path, **more):
    return VersionedTable(spark, str(path / "t"), "g", 3, **more)


def test_overwrite_append_travel(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(VersionGone):
        t.read()
    t.overwrite(spark.createDataFrame([(1, "a", 1.0)], DDL))
    t.append(spark.createDataFrame([(2, "b", 2.0, True)], f"{DDL}, w boolean"))
    t.append(spark.createDataFrame([(3,)], "k long"))
    assert rows(t.read()) == Counter([(1, "a", 1.0, None), (2, "b", 2.0, True), (3, None, None, None)])
    assert rows(t.read(0)) == Counter([(1, "a", 1.0)]) and t.read(0).columns == ["k", "g", "v"]
    t.overwrite(spark.createDataFrame([], "z int"))
    assert t.read().columns == ["z"] and t.read().count() == 0 and t.read(2).count() == 3
    assert [r["operation"] for r in t.history().orderBy("version").collect()] == ["WRITE", "APPEND", "APPEND", "WRITE"]
    t.view("t_first", 0)
    assert spark.sql("SELECT v FROM t_first").collect()[0][0] == 1.0
    with pytest.raises(VersionGone):
        t.read(9)
    with pytest.raises(ValueError):
        t.append(spark.createDataFrame([("x",)], "z string"))


def test_two_writers_can_not_both_win(spark, tmp_path):
    log = Log(spark, str(tmp_path / "t"))
    log.commit(0, {"a": 1})
    with pytest.raises(CommitConflict):
        log.commit(0, {"a": 2})
    assert log.read(0) == {"a": 1} and log.versions() == [0]


def merged_by_hand(target, source, scope):
    keys = {r[:2] for r in source}
    return Counter([r for r in target if r[:2] not in keys and r[1] not in scope] + source)


@pytest.mark.parametrize("seed", range(4))
def test_merge_against_its_definition(spark, tmp_path, seed):
    rng = random.Random(seed)
    groups = [None, "a", "b", "c", "d", "e"]
    make = lambda n: [(k, g, rng.random()) for k, g in {(rng.choice([None, *range(8)]), rng.choice(groups)) for _ in range(n)}]
    t, state = table(spark, tmp_path), make(20)
    t.overwrite(spark.createDataFrame(state, DDL))
    before = Counter(state)
    for _ in range(2):
        source, scope = make(rng.randrange(6)), rng.sample(groups, rng.randrange(3))
        done = t.merge_scoped(spark.createDataFrame(source, DDL), ["k", "g"], spark.createDataFrame([(g,) for g in scope], "s string"))
        after = merged_by_hand(list(before), source, scope)
        assert rows(t.read()) == after and (done is None) == (not source and not scope)
        if done is not None:
            changes = t.changes(done - 1, done, ["k", "g"]).collect()
            gone = Counter(tuple(r)[:3] for r in changes if r["_change_type"] in ("delete", "update_preimage"))
            come = Counter(tuple(r)[:3] for r in changes if r["_change_type"] in ("insert", "update_postimage"))
            assert before - gone + come == after and not gone & come
        before = after
    assert rows(t.read(0)) == Counter(state)


def test_merge_takes_any_size_and_unique_keys(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(spark.range(9000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("g"), F.lit(0.0).alias("v")))
    t.merge_scoped(spark.range(7000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("g"), F.lit(1.0).alias("v")), ["k"], spark.range(7000).select(F.col("id").cast("string")))
    assert t.read().groupBy("v").count().orderBy("v").collect() == [(0.0, 2000), (1.0, 7000)]
    with pytest.raises(ValueError, match="several source rows"):
        t.merge_scoped(spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0)], DDL), ["k"], spark.createDataFrame([], "s string"))


def test_merge_leaves_other_buckets_alone(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "g", 8)
    t.overwrite(spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("string").alias("g"), F.lit(0.0).alias("v")))
    t.merge_scoped(spark.createDataFrame([(5, "5", 9.0)], DDL), ["k"], spark.createDataFrame([("5",)], "s string"))
    old, new = ({f["path"] for f in t.manifest(v)["folders"]} for v in (0, 1))
    assert len(old & new) == 7


def test_constraints(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(spark.createDataFrame([(1, "a", 1.0), (2, None, None)], DDL))
    with pytest.raises(ConstraintViolation):
        t.add_constraints({"big": "v > 5"})
    assert t.add_constraints({"positive": "v > 0"}) == ["positive"] and t.add_constraints({"positive": "v > 0"}) == []
    with pytest.raises(ConstraintViolation, match="positive: 1"):
        t.append(spark.createDataFrame([(3, "c", -1.0)], DDL))
    t.append(spark.createDataFrame([(3, "c", None)], DDL))  # null passes
    assert t.read().count() == 3 and t.constraints() == {"positive": "v > 0"}
    t.set_properties(owner="me")
    assert t.properties() == {"owner": "me"}


def test_compaction_and_expiry(spark, tmp_path):
    t = table(spark, tmp_path)
    for i in range(4):
        t.append(spark.createDataFrame([(i, g, float(i)) for g in "abcde"], DDL))
    before = rows(t.read())
    assert t.optimize(["g", "k"]) == 4 and t.optimize(["g"]) is None and rows(t.read()) == before
    assert len(t.manifest()["folders"]) == len({f["bucket"] for f in t.manifest()["folders"]}) and t.vacuum(168) == []
    assert t.vacuum(0) and rows(t.read()) == before
    with pytest.raises(VersionGone):
        t.read(1)
    assert t.vacuum(0) == []


def test_failed_write_leaves_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    t.overwrite(spark.createDataFrame([(1, "a", 1.0)], DDL))
    t.add_constraints({"small": "v < 2"})
    before = len(list((tmp_path / "t" / "data").iterdir()))
    with pytest.raises(ConstraintViolation):
        t.overwrite(spark.createDataFrame([(1, "a", 3.0)], DDL))
    assert t.latest() == 1 and t.read().count() == 1
    assert sum(1 for _ in (tmp_path / "t" / "data").rglob("*.parquet")) == 1 and before >= 1


def test_schema_merge(spark):
    a, b = spark.createDataFrame([], "a int").schema, spark.createDataFrame([], "b string, a int").schema
    assert merged_schema(a, b).names == ["a", "b"]


def test_buckets_follow_rows(spark, tmp_path):
    """A small table has one folder; one that has grown is dealt over more when it is written whole or compacted."""
    t = VersionedTable(spark, str(tmp_path / "t"), "g", bucket_rows=100)
    rows_ = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.col("id").cast("string").alias("g"), F.lit(0.0).alias("v"))
    t.overwrite(rows_(0, 90))
    assert t.manifest()["buckets"] == 1 and len(t.manifest()["folders"]) == 1
    t.merge_scoped(rows_(90, 1500), ["k"], rows_(90, 1500).select("g"))
    t.optimize(["g", "k"])
    assert t.manifest()["buckets"] == 16 and len(t.manifest()["folders"]) == 16 and t.read().count() == 1500
    t.merge_scoped(rows_(5, 6).withColumn("v", F.lit(9.0)), ["k"], rows_(5, 6).select("g"))
    before, after = ({f["path"] for f in t.manifest(v)["folders"]} for v in (t.latest() - 1, t.latest()))
    assert len(before & after) == 15 and t.added(t.latest()).count() < 300
    assert [(r["k"], r["_change_type"]) for r in t.changes(t.latest() - 1, t.latest(), ["k"]).collect()] == [(5, "update_preimage"), (5, "update_postimage")]
    t.overwrite(rows_(0, 400))
    assert t.manifest()["buckets"] == 4 and rows(t.read()) == rows(rows_(0, 400))


def test_one_scope_value_may_hold_most_rows(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "g", 4)
    t.overwrite(spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), F.lit(0.0).alias("v")))
    assert t.read().filter("g = 'hot'").count() == 2000 and t.read().count() == 3000
