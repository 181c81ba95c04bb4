"""What moved between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def version_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer join of two snapshots by key: the value before and after and what became of the row."""
    old = before.select(*keys, F.col(value).alias("before"), F.lit(True).alias("_b"))
    new = after.select(*keys, F.col(value).alias("after"), F.lit(True).alias("_a"))
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("changed")
    return old.join(new, list(keys), "full_outer").withColumn("change", kind).drop("_a", "_b")


def transitions(diff: DataFrame, group: str) -> DataFrame:
    """Rows and distinct groups of each transition of changed rows, most rows first."""
    moved = diff.filter("change = 'changed'").groupBy("before", "after")
    return moved.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(group).alias("groups")).orderBy(F.col("rows").desc(), "before", "after")


def moved(diff: DataFrame, group: str, n: int) -> DataFrame:
    """The first groups with changed rows and their values before and after."""
    return diff.filter("change = 'changed'").select(group, "before", "after").distinct().orderBy(group, "before", "after").limit(n)


def totals(before: DataFrame, after: DataFrame, value: str) -> DataFrame:
    """Rows by value in both snapshots and the signed difference."""
    b = before.groupBy(value).agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.groupBy(value).agg(F.count(F.lit(1)).alias("rows_after"))
    both = b.join(a, value, "full_outer").fillna(0, ["rows_before", "rows_after"])
    return both.withColumn("delta", F.col("rows_after") - F.col("rows_before")).orderBy(value)


def source_mix(df: DataFrame, kind: str, group: str) -> DataFrame:
    """Rows and distinct groups of each kind, most rows first."""
    return df.groupBy(kind).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(group).alias("groups")).orderBy(F.col("rows").desc(), kind)
