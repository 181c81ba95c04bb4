"""Queries that write: versioned tables, change feed, version diff, streaming.

Tables of a query lie in the session's shared folder and are removed once the rows that come back are checkpointed.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from siltstone.operators import diff
from siltstone.plans.pipeline import changed_keys
from siltstone.plans.registry import Register, table
from siltstone.store.table import VersionedTable
from siltstone.streaming.ingest import into_table, stream_files

R = Register()
QUERIES, ORACLES = R.queries, R.oracles


@contextmanager
def workspace(spark):
    """A folder that all executors see, for the time of a query; results are to be kept by ``settled``."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None and not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    named = named or tempfile.mkdtemp(prefix="siltstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    path = f"{named.rstrip('/')}/tables-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(df):
    return df.checkpoint(eager=True)


def orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


def customers_in_scope(spark, d):
    return table(spark, d, "customer").filter("c_nationkey = 7").select("c_custkey")


def edited(spark, d, path):
    """Orders as a table, then a merge whose scope is the customers of a nation: finished orders go, others go up by one, and each gets a new one."""
    t = VersionedTable(spark, f"{path}/orders", "o_custkey", 8)
    t.overwrite(orders(spark, d))
    scope = customers_in_scope(spark, d)
    mine = orders(spark, d).join(scope, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    source = mine.filter("o_orderstatus != 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    fresh = mine.groupBy("o_custkey").agg(F.max("o_orderkey").alias("k")).select((-F.col("k")).alias("o_orderkey"), "o_custkey", F.lit(1.0).alias("o_totalprice"), F.lit("N").alias("o_orderstatus"))
    t.merge_scoped(source.unionByName(fresh), ["o_orderkey"], scope)
    return t


STATE = """
first AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders),
second AS (SELECT * FROM first WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, o_orderstatus FROM first WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) AND o_orderstatus <> 'F'
  UNION ALL SELECT -max(o_orderkey), o_custkey, 1.0, 'N' FROM first WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) GROUP BY o_custkey)"""


@R.add("overwrite_table", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def overwrite_table(spark, d):
    with workspace(spark) as path:
        t = VersionedTable(spark, f"{path}/t")
        t.overwrite(table(spark, d, "nation"))
        t.overwrite(table(spark, d, "nation").filter("n_regionkey = 1").select("n_nationkey", "n_name"))
        return settled(t.read())


@R.add("append_merge_schema", "SELECT r_regionkey AS key, r_name AS name, CAST(NULL AS INTEGER) AS region FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def append_merge_schema(spark, d):
    with workspace(spark) as path:
        t = VersionedTable(spark, f"{path}/t")
        t.append(table(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")))
        t.append(table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")))
        return settled(t.read())


@R.add("merge_scoped_upsert", f"WITH {STATE} SELECT * FROM second")
def merge_scoped_upsert(spark, d):
    with workspace(spark) as path:
        return settled(edited(spark, d, path).read())


@R.add("merge_noop_empty_scope", "SELECT count(*) AS n, 0 AS version FROM orders")
def merge_noop_empty_scope(spark, d):
    with workspace(spark) as path:
        t = VersionedTable(spark, f"{path}/t", "o_custkey", 4)
        t.overwrite(orders(spark, d))
        t.merge_scoped(orders(spark, d).limit(0), ["o_orderkey"], orders(spark, d).limit(0).select("o_custkey"))
        return settled(t.read().agg(F.count(F.lit(1)).alias("n")).withColumn("version", F.lit(t.latest())))


@R.add("time_travel_snapshot", f"WITH {STATE} SELECT 0 AS version, o_orderstatus, count(*) AS n FROM first GROUP BY 2 UNION ALL SELECT 1, o_orderstatus, count(*) FROM second GROUP BY 2")
def time_travel_snapshot(spark, d):
    with workspace(spark) as path:
        t = edited(spark, d, path)
        for v in (0, 1):
            t.view(f"orders_v{v}", v)
        return settled(spark.sql("SELECT 0 AS version, o_orderstatus, count(*) AS n FROM orders_v0 GROUP BY 2 UNION ALL SELECT 1, o_orderstatus, count(*) FROM orders_v1 GROUP BY 2"))


@R.add("table_history", "SELECT * FROM (VALUES (0, 'WRITE'), (1, 'MERGE'), (2, 'SET PROPERTIES'), (3, 'ADD CONSTRAINT')) t(version, operation)")
def table_history(spark, d):
    with workspace(spark) as path:
        t = edited(spark, d, path)
        t.set_properties(owner="x")
        t.add_constraints({"price": "o_totalprice > 0"})
        return settled(t.history().select("version", "operation"))


@R.add("compaction_preserves_rows", f"WITH {STATE} SELECT * FROM second UNION ALL SELECT * FROM first WHERE o_orderstatus = 'F'")
def compaction_preserves_rows(spark, d):
    with workspace(spark) as path:
        t = edited(spark, d, path)
        t.append(orders(spark, d).filter("o_orderstatus = 'F'"))
        t.optimize(["o_custkey"])
        t.vacuum(0)
        return settled(t.read())


CHANGES = """
changes AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'delete' AS _change_type FROM first WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) AND o_orderstatus = 'F'
  UNION ALL SELECT *, 'update_preimage' FROM first WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) AND o_orderstatus <> 'F'
  UNION ALL SELECT *, 'update_postimage' FROM second WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7) AND o_orderkey > 0 UNION ALL SELECT *, 'insert' FROM second WHERE o_orderkey < 0)"""


@R.add("change_feed_rows", f"WITH {STATE}, {CHANGES} SELECT * FROM changes")
def change_feed_rows(spark, d):
    with workspace(spark) as path:
        return settled(edited(spark, d, path).changes(0, 1, ["o_orderkey"]))


@R.add("change_feed_keys", f"WITH {STATE}, {CHANGES} SELECT DISTINCT o_custkey FROM changes WHERE _change_type IN ('insert', 'update_postimage', 'delete')")
def change_feed_keys(spark, d):
    with workspace(spark) as path:
        return settled(changed_keys(edited(spark, d, path).changes(0, 1, ["o_orderkey"]), "o_custkey"))


@R.add("union_by_name", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL AS origin FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier")
def union_by_name(spark, d):
    """Rows appended by the names of their columns, in another order and with one more."""
    with workspace(spark) as path:
        t = VersionedTable(spark, f"{path}/t")
        t.append(table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
        t.append(table(spark, d, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))
        return settled(t.read())


DIFF = "moved AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_totalprice AS before, b.o_totalprice AS after, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' WHEN a.o_totalprice = b.o_totalprice THEN 'same' ELSE 'changed' END AS change FROM first a FULL JOIN second b ON a.o_orderkey = b.o_orderkey)"


@R.add("version_diff_changed", f"WITH {STATE}, {DIFF} SELECT o_orderkey, round(before, 4) AS before, round(after, 4) AS after FROM moved WHERE change = 'changed'")
def version_diff_changed(spark, d):
    with workspace(spark) as path:
        t = edited(spark, d, path)
        rows = diff.version_diff(t.read(0), t.read(1), ["o_orderkey"], "o_totalprice").filter("change = 'changed'")
        return settled(rows.select("o_orderkey", F.round("before", 4).alias("before"), F.round("after", 4).alias("after")))


@R.add("version_diff_counts", f"WITH {STATE}, {DIFF} SELECT change, count(*) AS n FROM moved GROUP BY 1")
def version_diff_counts(spark, d):
    with workspace(spark) as path:
        t = edited(spark, d, path)
        return settled(diff.version_diff(t.read(0), t.read(1), ["o_orderkey"], "o_totalprice").groupBy("change").agg(F.count(F.lit(1)).alias("n")))


@R.add("stream_available_now", "SELECT event_id, user_id, event_type FROM events")
def stream_available_now(spark, d):
    with workspace(spark) as path:
        table(spark, d, "events").select("event_id", "user_id", "event_type").write.json(f"{path}/in")
        t = VersionedTable(spark, f"{path}/t")
        stream = stream_files(spark, f"{path}/in", "event_id LONG, user_id LONG, event_type STRING", multiline=False)
        query = into_table(stream, t, f"{path}/checkpoint", lambda df: df.drop("_source_file"))
        query.awaitTermination()
        return settled(t.read())
