"""Siltstone: an incremental, versioned, quality-gated table engine on PySpark."""

from siltstone.config import PipelineConfig, QualityThresholds
from siltstone.functions.provenance import CONTROL_SYNTHETIC, EXPERT_ANNOTATED, LLM_GENERATED, UNKNOWN, classify_source_type
from siltstone.plans.pipeline import PipelineResult, print_run_report, run_pipeline

__all__ = ["CONTROL_SYNTHETIC", "EXPERT_ANNOTATED", "LLM_GENERATED", "UNKNOWN", "PipelineConfig", "PipelineResult", "QualityThresholds", "classify_source_type", "print_run_report", "run_pipeline"]
