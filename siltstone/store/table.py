"""Versioned tables: overwrite, append, scoped merge, time travel, change feed, constraints, compaction, expiry.

A version is a manifest: live data folders, schema, properties, constraints and what made it. Data folders are never
changed. Rows of a table with a ``scope`` column lie in folders by a hash bucket of it, so that a merge reads and writes
the buckets that it touches and a diff looks only at buckets that are not the same folder in both versions. How many
buckets there are follows from the rows when a table is written whole, and is in the manifest; compaction deals a table
anew that has outgrown them. Writers get partitions of Spark's advisory size, and one scope value may hold any share.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.store.log import Log

BUCKET = "_bucket"
HISTORY = "version long, timestamp timestamp, operation string, metrics map<string,string>"
INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_preimage", "update_postimage"


class ConstraintViolation(ValueError):
    """Rows break a table constraint."""


class VersionGone(LookupError):
    """The version is not there, or its files have expired."""


def match(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of all pairs of keys."""
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])


def violations(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """(name, n): the number of rows that break each check, in one pass; a check that is null passes, as in SQL."""
    counts = df.agg(*[F.count_if(~F.coalesce(F.expr(c), F.lit(True))).alias(n) for n, c in checks.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in checks])).alias("s")).select("s.*")


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, scope: str | None = None, buckets: int | None = None, bucket_rows: int = 1_000_000):
        self.spark, self.root, self.log = spark, root.rstrip("/"), Log(spark, root)
        self.scope, self.fixed, self.bucket_rows = scope, buckets if scope else 1, bucket_rows

    # ---- reading

    def exists(self) -> bool:
        return bool(self.log.versions())

    def latest(self) -> int:
        found = self.log.versions()
        if not found:
            raise VersionGone(f"no table at {self.root}")
        return found[-1]

    def manifest(self, version: int | None = None) -> dict:
        version = self.latest() if version is None else version
        if version not in self.log.versions():
            raise VersionGone(f"{self.root} has no version {version}")
        return self.log.read(version)

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self.manifest(version)["schema"])

    def _frame(self, folders: Sequence[dict], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f['path']}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """The current snapshot, or the one of ``version``."""
        m = self.manifest(version)
        if version is not None and any(not self.log.exists(f["path"]) for f in m["folders"]):
            raise VersionGone(f"files of version {version} of {self.root} have expired")
        return self._frame(m["folders"], T.StructType.fromJson(m["schema"]))

    def view(self, name: str, version: int | None = None) -> None:
        """A temporary view of a snapshot, for SQL."""
        self.read(version).createOrReplaceTempView(name)

    def history(self) -> DataFrame:
        rows = [(v, m["timestamp"] / 1000, m["operation"], json.dumps(m["metrics"])) for v in self.log.versions() for m in [self.log.read(v)]]
        raw = self.spark.createDataFrame(rows, "version long, t double, operation string, m string")
        return raw.select("version", F.timestamp_seconds("t").alias("timestamp"), "operation", F.from_json("m", "map<string,string>").alias("metrics"))

    # ---- writing

    def _put(self, df: DataFrame, buckets: int, order: Sequence[str] = ()) -> list[dict]:
        """Data folders of the rows of ``df``, one for each bucket that has any; sorted by ``order`` in each file."""
        name = f"data/{uuid.uuid4().hex}"
        if buckets == 1:
            (df.sortWithinPartitions(*order) if order else df).write.parquet(f"{self.root}/{name}")
            return [{"path": name, "bucket": 0}]
        dealt = df.withColumn(BUCKET, self._bucket(F.col(self.scope), buckets))
        if order:
            dealt = dealt.repartitionByRange(BUCKET, *order).sortWithinPartitions(BUCKET, *order)
        else:
            # Partitions of the advisory size: small buckets share a writer, large ones have several.
            dealt = dealt.hint("rebalance", BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        return [{"path": path, "bucket": int(path.rsplit("=", 1)[1])} for path, _ in self.log.folders(name)]

    def _fitting(self, rows: int) -> int:
        """Buckets for so many rows."""
        if self.fixed:
            return self.fixed
        return 1 << max(0, (-(-rows // self.bucket_rows) - 1).bit_length())

    def _write(self, df: DataFrame) -> tuple[list[dict], int]:
        """Folders of a whole table and the number of its buckets. What ``df`` says is computed once."""
        if self.fixed:
            return self._put(df, self.fixed), self.fixed
        whole = self._put(df, 1)
        there = self.spark.read.schema(_nullable(df.schema)).parquet(f"{self.root}/{whole[0]['path']}")
        buckets = self._fitting(there.count())
        if buckets == 1:
            return whole, 1
        try:
            return self._put(there, buckets), buckets
        finally:
            self.log.delete(whole[0]["path"])

    @contextmanager
    def _staged(self, df: DataFrame):
        """``df``, computed once and written down for the time of the block."""
        path = f"staged/{uuid.uuid4().hex}"
        try:
            df.write.parquet(f"{self.root}/{path}")
            yield self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")
        finally:
            self.log.delete(path)

    @staticmethod
    def _bucket(column: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")

    def _commit(self, before: dict | None, folders: list[dict], fresh: list[dict], schema: T.StructType, operation: str, metrics: dict | None = None, check: Callable[[DataFrame], None] | None = None, **more) -> int:
        """Check the constraints, and ``check``, on the fresh folders, then commit on top of ``before``."""
        base = before or {"version": -1, "properties": {}, "constraints": {}, "buckets": 1}
        made = {"version": base["version"] + 1, "timestamp": int(time.time() * 1000), "operation": operation, "metrics": {k: str(v) for k, v in (metrics or {}).items()}, "folders": folders, "schema": json.loads(schema.json()), "properties": base["properties"], "constraints": base["constraints"], "buckets": base["buckets"]} | more
        try:
            if fresh and made["constraints"]:
                self._validate(self._frame(fresh, schema), made["constraints"])
            if fresh and check:
                check(self._frame(fresh, schema))
            self.log.commit(made["version"], made)
        except Exception:
            for f in fresh:
                self.log.delete(f["path"])
            raise
        return made["version"]

    def _before(self) -> dict | None:
        return self.manifest() if self.exists() else None

    def overwrite(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Replace rows and schema."""
        fresh, buckets = self._write(df)
        return self._commit(self._before(), fresh, fresh, _nullable(df.schema), "WRITE", {"folders": len(fresh)}, check, buckets=buckets)

    def append(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Add rows; new columns are added to the schema, columns that ``df`` lacks are null. ``check`` sees the rows as they
        are written, and they stay out of the table if it raises."""
        before = self._before()
        if before is None:
            return self.overwrite(df, check)
        schema = merged_schema(T.StructType.fromJson(before["schema"]), df.schema)
        fresh = self._put(df, before["buckets"])
        return self._commit(before, before["folders"] + fresh, fresh, schema, "APPEND", {"folders": len(fresh)}, check)

    def added(self, version: int) -> DataFrame:
        """The rows of the folders that a version has and the one before it has not."""
        m = self.manifest(version)
        old = {f["path"] for f in self.manifest(version - 1)["folders"]} if version else set()
        return self._frame([f for f in m["folders"] if f["path"] not in old], T.StructType.fromJson(m["schema"]))

    def merge_scoped(self, source: DataFrame, keys: Sequence[str], scope: DataFrame) -> int | None:
        """Update and insert the rows of ``source``, and delete other rows whose scope value is in ``scope``.

        ``scope`` has one column. Keys match null-safely and must be unique in ``source``. With an empty scope and source
        nothing is committed. There is no limit on the size of a scope.
        """
        if not self.scope:
            raise ValueError("a merge needs a table with a scope column")
        with self._staged(source) as rows, self._staged(scope.select(F.col(scope.columns[0]).alias("_scope")).distinct()) as values:
            return self._merge(rows, keys, values)

    def _merge(self, source: DataFrame, keys: Sequence[str], scope: DataFrame) -> int | None:
        if not source.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"several source rows have the same {', '.join(keys)}")
        before = self._before()
        if before is None:
            return self.overwrite(source)
        buckets = before["buckets"]
        touched = scope.select(self._bucket(F.col("_scope"), buckets).alias("b")).union(source.select(self._bucket(source[self.scope], buckets).alias("b"))).distinct()
        which = {r["b"] for r in touched.collect()}  # at most ``buckets`` numbers
        if not which:
            return None
        schema = merged_schema(T.StructType.fromJson(before["schema"]), source.schema)
        old = self._frame([f for f in before["folders"] if f["bucket"] in which], schema)
        out_of_scope = old.join(scope, old[self.scope].eqNullSafe(scope["_scope"]), "left_anti")
        named = source.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        stay = out_of_scope.join(named, match([out_of_scope[k] for k in keys], [named[c] for c in named.columns]), "left_anti")
        fresh = self._put(stay.unionByName(source, allowMissingColumns=True).select(*schema.names), buckets)
        folders = [f for f in before["folders"] if f["bucket"] not in which] + fresh
        return self._commit(before, folders, fresh, schema, "MERGE", {"buckets": len(which)})

    # ---- properties and constraints

    def set_properties(self, **properties: str) -> int:
        before = self.manifest()
        return self._commit(before, before["folders"], [], T.StructType.fromJson(before["schema"]), "SET PROPERTIES", properties=before["properties"] | properties)

    def properties(self) -> dict[str, str]:
        return self.manifest()["properties"]

    def constraints(self) -> dict[str, str]:
        return self.manifest()["constraints"]

    def add_constraints(self, checks: dict[str, str]) -> list[str]:
        """Add the checks that the table has not; existing rows are validated first. Returns the names added."""
        before = self.manifest()
        new = {k: v for k, v in checks.items() if k not in before["constraints"]}
        if new:
            self._validate(self.read(), new)
            self._commit(before, before["folders"], [], T.StructType.fromJson(before["schema"]), "ADD CONSTRAINT", {"names": ",".join(new)}, constraints=before["constraints"] | new)
        return list(new)

    @staticmethod
    def _validate(df: DataFrame, checks: Mapping[str, str]) -> None:
        if bad := violations(df, checks).filter("n > 0").orderBy("name").collect():
            raise ConstraintViolation(", ".join(f"{r['name']}: {r['n']} rows" for r in bad))

    # ---- changes

    def changes(self, start: int, end: int, keys: Sequence[str]) -> DataFrame:
        """Rows that differ between two versions, by null-safe key, with a ``_change_type``.

        An updated key has its row before and its row after. Folders that both versions have are not read.
        """
        a, b = self.manifest(start), self.manifest(end)
        schema = merged_schema(T.StructType.fromJson(a["schema"]), T.StructType.fromJson(b["schema"]))
        shared = {f["path"] for f in a["folders"]} & {f["path"] for f in b["folders"]}
        old, new = (self._frame([f for f in m["folders"] if f["path"] not in shared], schema) for m in (a, b))
        pack = lambda df, name: df.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], F.struct(*schema.names).alias(name))
        old, new = pack(old, "old"), pack(new, "new")
        same = match([old[f"old_{i}"] for i in range(len(keys))], [new[f"new_{i}"] for i in range(len(keys))])
        both = old.join(new, same, "full_outer").filter(~F.col("old").eqNullSafe(F.col("new")))
        kinds = F.when(F.col("old").isNull(), F.array(F.struct(F.lit(INSERT).alias("t"), F.col("new").alias("r")))).when(F.col("new").isNull(), F.array(F.struct(F.lit(DELETE).alias("t"), F.col("old").alias("r")))).otherwise(F.array(F.struct(F.lit(BEFORE).alias("t"), F.col("old").alias("r")), F.struct(F.lit(AFTER).alias("t"), F.col("new").alias("r"))))
        return both.select(F.explode(kinds).alias("c")).select("c.r.*", F.col("c.t").alias("_change_type"))

    # ---- maintenance

    def optimize(self, order: Sequence[str]) -> int | None:
        """Rewrite buckets of several folders, or all if the table has outgrown its buckets or has none, sorted by all
        columns of ``order``; rows stay the same."""
        before = self.manifest()
        schema = T.StructType.fromJson(before["schema"])
        by: dict[int, list[dict]] = {}
        for f in before["folders"]:
            by.setdefault(f["bucket"], []).append(f)
        buckets = self._fitting(self.read().count()) if self.scope else 1
        outgrown = not before["buckets"] <= buckets < 4 * before["buckets"]
        if not outgrown:
            buckets = before["buckets"]
        several = {b for b, fs in by.items() if outgrown or len(fs) > 1 or not self.scope}
        if not several:
            return None
        old = self._frame([f for b in several for f in by[b]], schema)
        fresh = self._put(old if buckets > 1 else old.repartitionByRange(*order), buckets, order)
        folders = [f for f in before["folders"] if f["bucket"] not in several] + fresh
        return self._commit(before, folders, fresh, schema, "OPTIMIZE", {"buckets": len(several)}, buckets=buckets)

    def vacuum(self, retain_hours: float = 168.0) -> list[str]:
        """Delete data folders that no version has that was current inside the window; returns their names."""
        edge = time.time() * 1000 - retain_hours * 3_600_000
        manifests = [self.log.read(v) for v in self.log.versions()]
        keep: set[str] = set()
        for i, m in enumerate(manifests):
            replaced = manifests[i + 1]["timestamp"] if i + 1 < len(manifests) else float("inf")
            if replaced >= edge:
                keep |= {f["path"] for f in m["folders"]}
        gone = []
        for top, changed in self.log.folders("data"):
            inner = [p for p, _ in self.log.folders(top) if "=" in p.rsplit("/", 1)[1]]
            used = [p for p in [top, *inner] if p in keep]
            if not used and changed < edge:
                self.log.delete(top)
                gone.append(top)
            elif used and top not in keep:
                for p in inner:
                    if p not in keep and changed < edge:
                        self.log.delete(p)
                        gone.append(p)
        return gone


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def merged_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of ``old``, then those that only ``new`` has; a column can't change its type."""
    types = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in types and types[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*old, *(f for f in new if f.name not in types)]])
