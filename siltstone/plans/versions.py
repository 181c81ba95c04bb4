"""Gold built by a first guess of the classifier, then by the right one, and what moved between the two versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from siltstone.config import PipelineConfig
from siltstone.functions.provenance import CORRECTED, FIRST_GUESS
from siltstone.operators import diff
from siltstone.plans.layout import open_table
from siltstone.plans.pipeline import run_pipeline
from siltstone.schema import GOLD, GOLD_KEYS


@dataclass(frozen=True)
class VersionDiff:
    before: int
    after: int
    rows: DataFrame
    transitions: DataFrame
    totals: DataFrame

    def changed(self) -> DataFrame:
        return self.rows.filter("change = 'changed'")

    def sample(self, n: int = 10) -> DataFrame:
        """The first changed scenarios with the values before and after."""
        return diff.moved(self.rows, "scenario_id", n)


def diff_versions(spark: SparkSession, config: PipelineConfig, before: int, after: int, value: str = "source_type") -> VersionDiff:
    table = open_table(spark, config, GOLD)
    old, new = table.read(before), table.read(after)
    rows = diff.version_diff(old, new, GOLD_KEYS[:2], value)
    return VersionDiff(before, after, rows, diff.transitions(rows, "scenario_id"), diff.totals(old, new, value))


def reclassify(spark: SparkSession, config: PipelineConfig) -> VersionDiff:
    """Two whole builds, the second with all rows classified anew."""
    run_pipeline(spark, config, FIRST_GUESS, full_refresh=True)
    before = open_table(spark, config, GOLD).latest()
    run_pipeline(spark, config, CORRECTED, full_refresh=True)
    return diff_versions(spark, config, before, open_table(spark, config, GOLD).latest())
