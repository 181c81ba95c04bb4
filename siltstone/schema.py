"""Schemas, table names, keys and rules of the scenario data."""

from __future__ import annotations

# Fields of one alternative in the features file, in file order; all but the first are doubles.
COSTS = ("c_p", "c_w", "c_m")
MEASURES = ("circ_orig", "fu_recyc", "fu_incin", "fu_inert", "fu_haz", "health", "gwp", "wdp", "fwu", "b", "compressive_strength", "slump", "water_to_cement_ratio", "cement_content", "SCM_content", "density", "d_max")

_cost = f"c STRUCT<{', '.join(f'{c}: DOUBLE' for c in COSTS)}>"
_fields = [f"{m} DOUBLE" for m in MEASURES]
_fields.insert(MEASURES.index("b") + 1, _cost)
ALTERNATIVE = ", ".join(["id_prod STRING", *_fields])
LABELS_DDL = "id STRING, labelled_alternatives ARRAY<STRUCT<id_prod: STRING, pref: DOUBLE, conf: DOUBLE, reason: STRING>>"
FEATURES_DDL = f"id STRING, stakeholder_preference ARRAY<STRING>, situations ARRAY<STRING>, alternatives ARRAY<STRUCT<{ALTERNATIVE}>>"
INGEST_LOG_DDL = "source_file STRING NOT NULL, file_hash STRING NOT NULL, source_kind STRING NOT NULL, byte_size LONG, row_count LONG, batch_id STRING NOT NULL, ingested_at TIMESTAMP NOT NULL"

# Table names.
BRONZE_LABELS, BRONZE_FEATURES, BRONZE_LOG = "bronze_labels", "bronze_features", "bronze_ingest_log"
SILVER_LABELS, SILVER_FEATURES = "silver_labels", "silver_features"
SILVER_STAKEHOLDER, SILVER_SITUATION = "silver_scenario_stakeholder", "silver_scenario_situation"
GOLD, REJECTED = "gold_scenarios", "gold_scenarios_rejected"

SILVER_KEYS = {
    SILVER_LABELS: ("scenario_id", "label_ordinal"),
    SILVER_FEATURES: ("scenario_id", "alternative_ordinal"),
    SILVER_STAKEHOLDER: ("scenario_id", "stakeholder_ordinal"),
    SILVER_SITUATION: ("scenario_id", "situation_ordinal"),
}
GOLD_KEYS = ("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal")
GOLD_COLUMNS = ("scenario_id", "id_prod", "label_ordinal", "alternative_ordinal", "source_type", "pref", "conf", "reason", "stakeholder_preferences", "situations", *MEASURES, *COSTS, "_source_file", "_batch_id")
LINEAGE = ("_source_file", "_batch_id")

# The four checks of the gold table.
GOLD_CHECKS = {
    "pref_in_range": "pref IS NOT NULL AND pref BETWEEN 0.0 AND 1.0",
    "conf_in_range": "conf IS NOT NULL AND conf BETWEEN 0.0 AND 1.0",
    "source_type_known": "source_type IN ('control_synthetic', 'llm_generated', 'expert_annotated', 'unknown')",
    "ordinals_present": "label_ordinal IS NOT NULL AND alternative_ordinal IS NOT NULL",
}

