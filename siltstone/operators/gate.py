"""The quality gate: each row gets the sorted array of its reasons; rows without one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.config import QualityThresholds
from siltstone.functions.provenance import UNKNOWN

# Reasons.
PREF_MISSING, CONF_MISSING = "pref_missing", "conf_missing"
DUPLICATE, SET_MISMATCH = "duplicate_scenario_product", "scenario_product_set_mismatch"
MISSING_FEATURE, MISSING_LABEL = "missing_feature_row", "missing_label_row"
REASONS = "rejection_reasons"


class GateFailure(RuntimeError):
    """A run's rejections are beyond its limits."""


def outside(column: str, low: float, high: float) -> Column:
    """True for values out of [low, high]; null never is, NaN is."""
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def reasons_array(rules: dict[str, Column]) -> Column:
    """The names of the rules that hold, sorted."""
    return F.array_sort(F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])))


def product_sets(labels: DataFrame, features: DataFrame, group: str = "scenario_id", item: str = "id_prod") -> DataFrame:
    """Each group's sorted sets of items on both sides and whether they are the same; one side missing is not the same."""
    sets = lambda df, name: df.groupBy(group).agg(F.array_sort(F.collect_set(item)).alias(name))
    both = sets(labels, "label_products").join(sets(features, "feature_products"), group, "full_outer")
    return both.withColumn("products_match", F.coalesce(F.col("label_products") == F.col("feature_products"), F.lit(False)))


def with_reasons(joined: DataFrame, sets: DataFrame, thresholds: QualityThresholds) -> DataFrame:
    """``joined`` with its reasons, without marks; a scenario whose sets differ is rejected whole."""
    differing = sets.filter(~F.col("products_match")).select("scenario_id", F.lit(True).alias("_differs"))
    rows = joined.join(differing, "scenario_id", "left")
    times = F.count(F.lit(1)).over(Window.partitionBy("scenario_id", "id_prod"))
    rules = {thresholds.reason(c): outside(c, *bounds) for c, bounds in thresholds.bounds.items()} | {
        PREF_MISSING: F.col("_has_label") & F.col("pref").isNull(),
        CONF_MISSING: F.col("_has_label") & F.col("conf").isNull(),
        DUPLICATE: F.col("_times") > 1,
        SET_MISMATCH: F.coalesce("_differs", F.lit(False)),
        MISSING_FEATURE: ~F.col("_has_feature"),
        MISSING_LABEL: ~F.col("_has_label"),
    }
    return rows.withColumn("_times", times).withColumn(REASONS, reasons_array(rules)).drop("_times", "_differs", "_has_label", "_has_feature")


def first_rejected(rejected: DataFrame, n: int = 20) -> DataFrame:
    """The first rejected rows in order of their keys."""
    return rejected.orderBy("scenario_id", "id_prod", "label_ordinal").limit(n)


def split_on_gate(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed without reasons, rejected with them)."""
    return gated.filter(F.size(REASONS) == 0).drop(REASONS), gated.filter(F.size(REASONS) > 0)


def gate_counts(gated: DataFrame) -> DataFrame:
    """One row (passed_rows, rejected_rows, rejected_share, unknown_rows); the share is null without rows."""
    bad = F.size(REASONS) > 0
    counts = gated.agg(F.count_if(~bad).alias("passed_rows"), F.count_if(bad).alias("rejected_rows"), F.count_if(F.col("source_type") == UNKNOWN).alias("unknown_rows"))
    return counts.withColumn("rejected_share", F.try_divide("rejected_rows", F.col("passed_rows") + F.col("rejected_rows")))


def beyond(counts: DataFrame, limits: Mapping[str, float | None]) -> DataFrame:
    """(measure, value, most) for each limit that the counts are beyond; nothing is beyond a limit of None."""
    rows = [F.struct(F.lit(name).alias("measure"), F.col(name).cast("double").alias("value"), F.lit(float(most)).alias("most")) for name, most in limits.items() if most is not None]
    if not rows:
        return counts.sparkSession.createDataFrame([], "measure string, value double, most double")
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("value > most")


def enforce(counts: DataFrame, limits: Mapping[str, float | None]) -> dict[str, float]:
    """The counts; an error if too much was rejected or an id, passed or not, is of no known class."""
    over = [f"{r['measure']} {r['value']:g}, more than {r['most']:g}" for r in beyond(counts, limits).orderBy("measure").collect()]
    if over:
        raise GateFailure("; ".join(over))
    return counts.first().asDict()


def gate_summary(rejected: DataFrame) -> DataFrame:
    """Rows by reason, most first."""
    return rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").count().orderBy(F.col("count").desc(), "reason")
