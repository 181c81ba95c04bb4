"""Joins with presence marks, roll-ups of attributes, semi-joins on a scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_mark: str, right_mark: str) -> DataFrame:
    """Full outer join by equal keys, with a boolean for each side; null keys match nothing."""
    marked = left.withColumn(left_mark, F.lit(True)).join(right.withColumn(right_mark, F.lit(True)), list(keys), "full_outer")
    return marked.fillna({left_mark: False, right_mark: False})


def in_scope(df: DataFrame, scope: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key is in the one column of ``scope``; all rows without a scope. Ids never enter the plan's text."""
    if scope is None:
        return df
    ids = scope.select(F.col(scope.columns[0]).alias("_scope")).distinct()
    return df.join(ids, df[key] == ids["_scope"], "left_semi")


def rolled_up(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The sorted distinct values of each key."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(name))


def joined_scenarios(labels: DataFrame, features: DataFrame, stakeholders: DataFrame, situations: DataFrame, classifier) -> DataFrame:
    """Labels and features of scenarios with marks, class and attributes.

    The class is that of the joined id, so that a row without a label has its own too. Lineage is the label's.
    """
    sides = presence_join(labels.drop("source_type"), features.drop("_source_file", "_batch_id"), ["scenario_id", "id_prod"], "_has_label", "_has_feature")
    typed = sides.withColumn("source_type", F.coalesce(classifier("scenario_id"), F.lit("unknown")))
    out = typed.join(rolled_up(stakeholders, "scenario_id", "stakeholder_preference", "stakeholder_preferences"), "scenario_id", "left")
    return out.join(rolled_up(situations, "scenario_id", "situation", "situations"), "scenario_id", "left")
