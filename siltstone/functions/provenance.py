"""Where a scenario comes from, read off its id: taxonomies of id patterns."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The classes, the control axes and the patterns of ids.
CONTROL_SYNTHETIC, LLM_GENERATED, EXPERT_ANNOTATED, UNKNOWN = "control_synthetic", "llm_generated", "expert_annotated", "unknown"
CONTROL_AXES = ("archfinish", "archfinish_slump", "cost", "density", "fwu", "gwp", "health", "wdp")
CONTROL_ID, EXPERT_ID, GENERATED_ID = r"control_([a-z][a-z_]*[a-z])_\d+", r"expert_\d+", r"\d+"

#: From the name of an id column to its class.
Classifier = Callable[[str], Column]


@dataclass(frozen=True)
class Taxonomy:
    """Rules (pattern of the whole id, class), the first that fits counts, and a class for all other ids.

    Called with a column's name it is the class as a column, in which spaces around an id do not count.
    """

    rules: tuple[tuple[str, str], ...]
    other: str

    def __call__(self, id_column: str = "scenario_id") -> Column:
        trimmed = F.trim(id_column)
        fits = [F.when(trimmed.rlike(f"^(?:{pattern})$"), name) for pattern, name in self.rules]
        return F.coalesce(*fits, F.lit(self.other))

    def of(self, scenario_id: str | None) -> str:
        """The class of one id on the driver; no white space around it counts."""
        for pattern, name in self.rules:
            if re.fullmatch(pattern, (scenario_id or "").strip(), re.ASCII):
                return name
        return self.other


CORRECTED = Taxonomy(((CONTROL_ID, CONTROL_SYNTHETIC), (EXPERT_ID, EXPERT_ANNOTATED), (GENERATED_ID, LLM_GENERATED)), UNKNOWN)
#: A first guess, there to be corrected: it knows control ids of one-word axes, and takes all else for generated.
FIRST_GUESS = Taxonomy(((rf"control_(?:{'|'.join(x for x in CONTROL_AXES if x.isalpha())})_\d+", CONTROL_SYNTHETIC),), LLM_GENERATED)
TAXONOMIES = {"naive": FIRST_GUESS, "corrected": CORRECTED}

classify_source_type = CORRECTED.of


def axis_column(id_column: str = "scenario_id") -> Column:
    """The probed axis of control ids, with all its words; else an empty string."""
    return F.regexp_extract(F.trim(id_column), f"^{CONTROL_ID}$", 1)


def control_axis(scenario_id: str | None) -> str | None:
    """The same for one id on the driver; None for other ids."""
    found = re.fullmatch(CONTROL_ID, (scenario_id or "").strip(), re.ASCII)
    return found and found[1]
