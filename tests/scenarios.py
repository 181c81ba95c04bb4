"""Small invented scenario files with planted defects, in four stages of arrival."""

from __future__ import annotations

import json
from pathlib import Path

FIELDS = ("circ_orig", "fu_recyc", "fu_incin", "fu_inert", "fu_haz", "health", "gwp", "wdp", "fwu", "b", "slump", "cement_content", "SCM_content", "d_max")


def alternative(i: int, **changes) -> dict:
    row = {"id_prod": f"prod_{i}"} | {f: float(i) + n / 10 for n, f in enumerate(FIELDS)}
    row |= {"c": {"c_p": i, "c_w": 2, "c_m": 3.5}, "compressive_strength": 30 + i, "water_to_cement_ratio": 0.5, "density": 2400}
    return row | changes


def label(i: int, pref: float, conf: float = 0.8) -> dict:
    return {"id_prod": f"prod_{i}", "pref": pref, "conf": conf, "reason": f"because {i}"}


def feature_record(name: str, alternatives: list[dict], stakeholders=("city",), situations=("dry",)) -> dict:
    return {"id": name, "stakeholder_preference": list(stakeholders), "situations": list(situations), "alternatives": alternatives}


def label_record(name: str, labels: list[dict]) -> dict:
    return {"id": name, "labelled_alternatives": labels}


BASE_FEATURES = [
    feature_record("control_health_1068", [alternative(i) for i in (1, 2, 3)]),
    feature_record("control_archfinish_slump_299", [alternative(i) for i in (1, 2)]),
    feature_record("3782", [alternative(1), alternative(2), alternative(3), alternative(4, density=950, water_to_cement_ratio=1.35)], ("city", "builder"), ("wet", "dry")),
    feature_record("expert_118", [alternative(i) for i in (1, 2)]),
    feature_record("2647", [alternative(i) for i in (1, 2, 3, 4, 5)]),
]
BASE_LABELS = [
    label_record("control_health_1068", [label(3, 0.9), label(1, 0.393), label(2, 0.1)]),
    label_record("control_archfinish_slump_299", [label(1, 0.5), label(2, 1)]),
    label_record("3782", [label(i, i / 10) for i in (1, 2, 3, 4)]),
    label_record("expert_118", [label(1, 0.25), label(2, 0.75)]),
    label_record("2647", [label(1, 0.62), label(2, 0.3), label(3, 0.4), label(4, 0.5), label(5, 1.4), label(1, 0.05)]),
]
REVISED_LABELS = [
    label_record("control_health_1068", [label(3, 0.9), label(1, 0.5), label(2, 0.1)]),
    *BASE_LABELS[1:4],
    label_record("2647", [label(1, 0.62), label(2, 0.3), label(3, 0.4), label(4, 0.5), label(5, 0.97)]),
]
NEXT_FEATURES = [feature_record("control_gwp_777", [alternative(i) for i in (1, 2)]), feature_record("expert_9", [alternative(i) for i in (1, 2, 3)])]
NEXT_LABELS = [label_record("control_gwp_777", [label(1, 0.2), label(2, 0.8)]), label_record("expert_9", [label(i, 0.1 * i) for i in (1, 2, 3)])]


def put(folder: Path, name: str, content: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(content))


def put_base(folder: Path) -> None:
    put(folder, "frozen_dataset.json", BASE_FEATURES)
    put(folder, "labelled_alternatives.json", BASE_LABELS)


def put_next(folder: Path) -> None:
    put(folder, "frozen_dataset_batch2.json", NEXT_FEATURES)
    put(folder, "labelled_alternatives_batch2.json", NEXT_LABELS)
