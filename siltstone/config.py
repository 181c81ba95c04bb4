"""What a run reads and writes, and what it takes for sound."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

LABELS, FEATURES = "labels", "features"
# The patterns of raw files by kind. Without the star, a pattern is the name of the one file of a first release.
SOURCES: Mapping[str, tuple[str, ...]] = {LABELS: ("labelled_alternatives*.json", "labelled_dataset*.json"), FEATURES: ("frozen_dataset*.json",)}
# Inclusive bounds of columns.
BOUNDS: Mapping[str, tuple[float, float]] = {"pref": (0.0, 1.0), "conf": (0.0, 1.0), "compressive_strength": (5.0, 150.0), "water_to_cement_ratio": (0.20, 1.00), "density": (1200.0, 3000.0)}
#: Judgements are out of bounds, measurements out of range.
JUDGED = ("pref", "conf")
# A run fails beyond these; None is no limit.
LIMITS: Mapping[str, float | None] = {"rejected_rows": None, "rejected_share": 0.01, "unknown_rows": 0}


@dataclass(frozen=True)
class QualityThresholds:
    """Inclusive bounds of the gate by column."""

    bounds: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(BOUNDS))

    @staticmethod
    def reason(column: str) -> str:
        return f"{column}_out_of_{'bounds' if column in JUDGED else 'range'}"


@dataclass(frozen=True)
class PipelineConfig:
    """Raw folder and lakehouse, in any file system that Spark reads; with ``namespace`` tables lie in a catalogue folder."""

    raw_dir: object = "data/raw"
    lakehouse_dir: object = "data/lakehouse"
    namespace: str | None = None
    thresholds: QualityThresholds = field(default_factory=QualityThresholds)
    limits: Mapping[str, float | None] = field(default_factory=lambda: dict(LIMITS))
    #: If set, new files arrive by a stream that keeps its progress here; replaced files still go by content.
    checkpoint_dir: str | None = None
    #: Rows for each bucket folder of a table, which says how many buckets it gets; or a fixed number of buckets.
    bucket_rows: int = 1_000_000
    buckets: int | None = None
    #: Whether a re-ingested row whose values are the same counts as changed (its batch differs).
    lineage_counts_as_change: bool = True

    def under(self, name: str) -> str:
        """The place of a table."""
        parts = [str(self.lakehouse_dir).rstrip("/"), *(self.namespace or "").split("."), name]
        return "/".join(p for i, p in enumerate(parts) if p or not i)

    def for_fixtures(self) -> PipelineConfig:
        """The same for small planted data, of which any share may be rejected."""
        return replace(self, limits={**self.limits, "rejected_share": 1.0})
