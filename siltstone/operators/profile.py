"""Profiles of raw data as aggregates: nothing but the result reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_stats(df: DataFrame, size: Column) -> DataFrame:
    """count, min, max, and mean to three places of a size."""
    return df.select(size.alias("s")).agg(F.count("s").alias("count"), F.min("s").alias("min"), F.max("s").alias("max"), F.round(F.avg("s"), 3).alias("mean"))


def length_histogram(df: DataFrame, size: Column) -> DataFrame:
    return df.select(size.alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("rows"))


def numeric_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, present, min, max, mean) of each column, in one pass over the table and no shuffle of rows."""
    aggs = [f(c).alias(f"{c}__{n}") for c in columns for n, f in (("present", F.count), ("min", F.min), ("max", F.max), ("mean", F.avg))]
    stats = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__present").alias("present"), F.round(F.col(f"{c}__min").cast("double") + 0.0, 4).alias("min"), F.round(F.col(f"{c}__max").cast("double") + 0.0, 4).alias("max"), F.round(F.col(f"{c}__mean"), 4).alias("mean")) for c in columns]
    return df.agg(*aggs).select(F.explode(F.array(*stats)).alias("s")).select("s.*")


def duplicates(df: DataFrame, key: str, first: int | None = None) -> DataFrame:
    """Keys that several rows have, with their number; the first ones in order, if asked for."""
    found = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return found.orderBy(key).limit(first) if first else found


def key_presence(df: DataFrame) -> DataFrame:
    """(column, present): rows in which each column is not null."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in df.columns])).alias("s")).select("s.*")


def id_pattern(column: Column) -> Column:
    """The id with each run of digits as ``<n>``."""
    return F.regexp_replace(column, r"\d+", "<n>")


def id_prefix(column: Column) -> Column:
    """The first token of the id, or ``<numeric>``."""
    first = F.split(column, "_")[0]
    return F.when(first.rlike(r"^\d+$"), "<numeric>").otherwise(first)


def id_taxonomy(df: DataFrame, key: str) -> DataFrame:
    """Rows of each id pattern, with the least id as an example."""
    return df.groupBy(id_pattern(F.col(key)).alias("pattern"), id_prefix(F.col(key)).alias("prefix")).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("example"))


def cross_file(left: DataFrame, right: DataFrame, key: str, item: str) -> DataFrame:
    """For each key: whether it is in both frames or in one, and whether the sets of items are the same."""
    sets = lambda df, n: df.groupBy(key).agg(F.array_sort(F.collect_set(item)).alias(n))
    both = sets(left, "l").join(sets(right, "r"), key, "full_outer")
    where = F.when(F.col("r").isNull(), "left_only").when(F.col("l").isNull(), "right_only").otherwise("both")
    return both.select(key, where.alias("side"), F.coalesce(F.col("l") == F.col("r"), F.lit(False)).alias("same_items"))
