"""A profile of the raw files: sizes, presence, ranges, ids, and how the two kinds fit together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.config import FEATURES, LABELS, PipelineConfig
from siltstone.operators import profile
from siltstone.schema import COSTS, FEATURES_DDL, LABELS_DDL, MEASURES
from siltstone.sources.files import listed
from siltstone.sources.json_scan import records


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def profile_raw(spark: SparkSession, config: PipelineConfig, top_patterns: int = 20) -> dict:
    """Everything as plain lists and dictionaries; each is an aggregate of bounded size."""
    labels = records(spark, list(listed(spark, config, LABELS)), LABELS_DDL)
    features = records(spark, list(listed(spark, config, FEATURES)), FEATURES_DDL)
    judged = labels.select("id", F.explode("labelled_alternatives").alias("l")).select("id", "l.*")
    options = features.select("id", F.explode("alternatives").alias("a")).select("id", "a.id_prod", *[f"a.{m}" for m in MEASURES], *[F.col(f"a.c.{c}").alias(c) for c in COSTS])
    out = {}
    for name, df, array, flat, numbers in (("labels", labels, "labelled_alternatives", judged, ("pref", "conf")), ("features", features, "alternatives", options, (*MEASURES, *COSTS))):
        taxonomy = profile.id_taxonomy(df, "id")
        out[name] = {
            "scenarios": df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids")).first().asDict(),
            "duplicate_ids": [r["id"] for r in profile.duplicates(df, "id", 20).collect()],
            "lengths": _rows(profile.length_stats(df, F.size(array)))[0],
            "histogram": _rows(profile.length_histogram(df, F.size(array)).orderBy("size")),
            "missing_arrays": df.filter(F.col(array).isNull()).count(),
            "presence": _rows(profile.key_presence(flat)),
            "ranges": _rows(profile.numeric_ranges(flat, numbers)),
            "patterns": _rows(taxonomy.orderBy(F.col("rows").desc(), "pattern").limit(top_patterns)),
        }
    both = profile.cross_file(judged, options, "id", "id_prod")
    out["cross_file"] = _rows(both.groupBy("side", "same_items").agg(F.count(F.lit(1)).alias("scenarios")).orderBy("side", "same_items"))
    return out
