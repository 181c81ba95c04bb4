"""Compaction and expiry of a lakehouse's tables, with a report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from siltstone.config import PipelineConfig
from siltstone.plans.layout import open_table
from siltstone.schema import BRONZE_FEATURES, BRONZE_LABELS, BRONZE_LOG, GOLD, REJECTED, SILVER_KEYS

#: The column by which each table is sorted when it is compacted.
ORDER: Mapping[str, tuple[str, ...]] = {BRONZE_LABELS: ("id",), BRONZE_FEATURES: ("id",), BRONZE_LOG: ("source_file",), **{t: k for t, k in SILVER_KEYS.items()}, GOLD: ("scenario_id",), REJECTED: ("scenario_id",)}


@dataclass(frozen=True)
class MaintenanceResult:
    table: str
    present: bool
    optimized: bool = False
    expired: int = 0
    error: str = ""


def run_maintenance(spark: SparkSession, config: PipelineConfig, retain_hours: float = 168.0, vacuum: bool = True) -> list[MaintenanceResult]:
    """Compact and expire every table; a failure is in the result and does not stop the others."""
    out = []
    for name, order in ORDER.items():
        table = open_table(spark, config, name)
        if not table.exists():
            out.append(MaintenanceResult(name, False))
            continue
        optimized, expired, error = False, 0, ""
        try:
            optimized = table.optimize(order) is not None
            expired = len(table.vacuum(retain_hours)) if vacuum else 0
        except Exception as e:  # reported, and the exit status of the command line tells
            error = f"{type(e).__name__}: {e}"[:300]
        out.append(MaintenanceResult(name, True, optimized, expired, error))
    return out


def maintenance_report(results: list[MaintenanceResult]) -> str:
    lines = [f"{'table':<30}{'optimized':<11}{'expired':>8}  note"]
    for r in results:
        lines.append(f"{r.table:<30}{('yes' if r.optimized else 'no') if r.present else '-':<11}{r.expired:>8}  {'absent' if not r.present else r.error}")
    return "\n".join(lines)
