"""From landed scenarios to flat, keyed rows; the class of an id is attached on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.provenance import CORRECTED, Classifier
from siltstone.schema import COSTS, LINEAGE, MEASURES, SILVER_FEATURES, SILVER_LABELS, SILVER_SITUATION, SILVER_STAKEHOLDER


def current_rows(landed: DataFrame, key: str = "id", file: str = "_source_file", batch: str = "_batch_id") -> DataFrame:
    """The newest batch of each file, and of scenarios that several files hold, the newest copy (file name on ties).

    A file's newest batch is an aggregate of a row for each file, and a scenario's newest copy one for each scenario: no
    file is gathered in a task.
    """
    newest = landed.groupBy(F.col(file).alias("_f")).agg(F.max(batch).alias("_b"))
    rows = landed.join(newest, landed[file].eqNullSafe(newest["_f"]) & (landed[batch] == newest["_b"]), "left_semi")
    place = F.struct(F.col(batch), F.col(file))
    copies = rows.groupBy(F.col(key).alias("_k")).agg(F.max(place).alias("_copy"))
    return rows.join(copies, rows[key].eqNullSafe(copies["_k"]) & (F.struct(rows[batch], rows[file]) == copies["_copy"]), "left_semi")


def of_files(landed: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of the files named in a frame of one column."""
    return landed.join(names.select(F.col(names.columns[0]).alias("_name")), F.col("_source_file") == F.col("_name"), "left_semi")


def labels(landed: DataFrame, classifier: Classifier = CORRECTED) -> DataFrame:
    rows = landed.select(F.col("id").alias("scenario_id"), *LINEAGE, F.posexplode("labelled_alternatives").alias("label_ordinal", "l"))
    flat = rows.select("scenario_id", "label_ordinal", *[F.col(f"l.{c}").alias(c) for c in ("id_prod", "pref", "conf", "reason")], *LINEAGE)
    return flat.withColumn("source_type", classifier("scenario_id"))


def features(landed: DataFrame) -> DataFrame:
    rows = landed.select(F.col("id").alias("scenario_id"), *LINEAGE, F.posexplode("alternatives").alias("alternative_ordinal", "a"))
    return rows.select("scenario_id", "alternative_ordinal", *[F.col(f"a.{c}").alias(c) for c in ("id_prod", *MEASURES)], *[F.col(f"a.c.{c}").alias(c) for c in COSTS], *LINEAGE)


def attribute(landed: DataFrame, array: str, ordinal: str, value: str) -> DataFrame:
    return landed.select(F.col("id").alias("scenario_id"), *LINEAGE, F.posexplode(array).alias(ordinal, value))


def silver(landed_labels: DataFrame, landed_features: DataFrame, classifier: Classifier = CORRECTED) -> dict[str, DataFrame]:
    """All four flat frames, by table name."""
    return {
        SILVER_LABELS: labels(landed_labels, classifier),
        SILVER_FEATURES: features(landed_features),
        SILVER_STAKEHOLDER: attribute(landed_features, "stakeholder_preference", "stakeholder_ordinal", "stakeholder_preference"),
        SILVER_SITUATION: attribute(landed_features, "situations", "situation_ordinal", "situation"),
    }
