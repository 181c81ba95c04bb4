"""Correlations that are null where they are undefined, and verdicts on their signs, all of them columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.provenance import CONTROL_SYNTHETIC, axis_column

# Signs that are expected, below which size a correlation has none, and from how many rows on it counts.
EXPECTED = {"gwp": "negative", "health": "positive", "circ_orig": "positive"}
NEGLIGIBLE = 0.05
MIN_ROWS = 30


def safe_corr(left: str, right: str) -> Column:
    """Pearson's correlation over rows with both values; null for no variance or fewer than two rows."""
    x = F.when(F.col(right).isNotNull(), F.col(left))
    y = F.when(F.col(left).isNotNull(), F.col(right))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def grouped(df: DataFrame, group: str, against: str, variables: Sequence[str], total: str = "ALL") -> DataFrame:
    """Rows and correlations by group and over all, in one scan by grouping sets."""
    aggs = [F.count(F.lit(1)).alias("rows"), *(safe_corr(against, v).alias(v) for v in variables)]
    sets = df.withColumn("_g", F.col(group)).groupingSets([[F.col("_g")], []], F.col("_g")).agg(F.grouping("_g").alias("_all"), *aggs)
    return sets.select(F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col("_g")).alias(group), F.col("_all").cast("int").alias("is_total"), "rows", *variables)


def observed_column(correlation: Column) -> Column:
    """What sign is seen: undefined, negligible, positive or negative."""
    seen = F.create_map(F.lit(-1.0), F.lit("negative"), F.lit(1.0), F.lit("positive"))[F.signum(correlation)]
    return F.when(F.abs(correlation) < NEGLIGIBLE, "negligible").otherwise(F.coalesce(seen, F.lit("undefined")))


def verdict_column(correlation: Column, rows: Column, expected: Column | str, min_rows: int = MIN_ROWS) -> Column:
    """NO DATA, TOO FEW, FLAT, OK or WRONG SIGN, the first of them that holds."""
    seen = observed_column(correlation)
    known = F.when(seen == "undefined", "NO DATA").when(rows < min_rows, "TOO FEW").when(seen == "negligible", "FLAT")
    return known.when(seen == expected, "OK").otherwise("WRONG SIGN")


def checks(gold: DataFrame, expected: Mapping[str, str] = EXPECTED, min_rows: int = MIN_ROWS, group: str = "source_type", against: str = "pref") -> DataFrame:
    """(group, is_total, variable, rows, correlation, expected, observed, verdict) by group and over all rows."""
    found = grouped(gold, group, against, list(expected))
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).alias("correlation"), F.lit(sign).alias("expected")) for v, sign in expected.items()]))
    rows = found.select(group, "is_total", "rows", each.alias("c")).select(group, "is_total", "c.variable", "rows", "c.correlation", "c.expected")
    c = F.col("correlation")
    return rows.withColumn("observed", observed_column(c)).withColumn("verdict", verdict_column(c, F.col("rows"), F.col("expected"), min_rows))


def report(found: DataFrame, group: str = "source_type") -> str:
    """The checks as text, groups in order and all rows last."""
    lines = [f"{group:<20}{'variable':<12}{'rows':>9}{'corr':>10}  {'expected':<10}verdict"]
    lines.append("-" * len(lines[0]))
    for r in found.orderBy("is_total", group, "variable").collect():
        corr = "-" if r["correlation"] is None else format(r["correlation"], "+.4f")
        lines.append(f"{r[group]:<20}{r['variable']:<12}{r['rows']:>9}{corr:>10}  {r['expected']:<10}{r['verdict']}")
    return "\n".join(lines)


def by_axis(gold: DataFrame, id_column: str = "scenario_id") -> DataFrame:
    """(axis, rows, a correlation for each variable) of control rows."""
    rows = gold.filter(F.col("source_type") == CONTROL_SYNTHETIC).withColumn("axis", axis_column(id_column))
    return rows.groupBy("axis").agg(F.count(F.lit(1)).alias("rows"), *(safe_corr("pref", v).alias(v) for v in EXPECTED))
