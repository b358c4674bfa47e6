"""The declaration of a report: its levels with their aliases, vocabularies and licences, and the policies of every gate."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from tallyframe.functions.members import key_of

#: Aggregation prefixes of headers, and labels of total rows.
PREFIXES = ("sum of", "count of", "average of", "avg of", "max of", "min of", "total of", "count distinct of")
TOTAL_LABELS = ("grand total", "subtotal", "total")
CLOSED, REGISTRY, OBSERVED = "closed", "registry", "observed"


@dataclass(frozen=True)
class Level:
    canonical: str
    aliases: tuple[str, ...] = ()
    vocabulary: tuple[str, ...] = ()
    punctuation: bool = False
    case: bool = False
    mode: str = OBSERVED
    bootstrap: bool = False

    def __post_init__(self):
        if self.mode not in (CLOSED, REGISTRY, OBSERVED):
            raise ValueError(f"level {self.canonical}: unknown mode {self.mode!r}")
        if (self.mode == CLOSED) != bool(self.vocabulary):
            raise ValueError(f"level {self.canonical}: a vocabulary belongs to closed levels and to no others")
        if self.bootstrap and self.mode != REGISTRY:
            raise ValueError(f"level {self.canonical}: bootstrap needs the mode registry")
        merged = license_collisions(self.vocabulary, self.punctuation, self.case)
        if merged:
            raise ValueError(f"level {self.canonical}: the licence merges {merged}")


@dataclass(frozen=True)
class Declaration:
    levels: tuple[Level, ...]
    declared_fields: tuple[str, ...] = ()
    required_fields: tuple[str, ...] = ()
    check_report_name: bool = True
    fuzzy: bool = True
    accept: float = 0.85
    review: float = 0.6
    validate_totals: bool = True
    tolerance: float = 0.01
    prefixes: tuple[str, ...] = PREFIXES
    total_labels: tuple[str, ...] = TOTAL_LABELS
    blank_member: str = "(blank)"
    scan_rows: int = 12
    value_threshold: float = 0.6
    near_miss: float = 0.4
    var_name: str = "Period"
    value_name: str = "Value"
    allow_missing: dict[str, tuple[str, ...]] = field(default_factory=dict)
    drift_tolerance: float = 0.25

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(v.canonical for v in self.levels)


def license_collisions(members, punctuation: bool, case: bool) -> list[list[str]]:
    """Declared members that a licence would make one."""
    groups: dict[str, set[str]] = {}
    for m in members:
        groups.setdefault(key_of(m, punctuation, case), set()).add(m)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def build_hierarchy(spec) -> list[str]:
    """Level names in business order from a list, or from a mapping of numbers to names."""
    return [spec[k] for k in sorted(spec, key=int)] if isinstance(spec, dict) else list(spec)


def load(source: str | dict[str, Any]) -> Declaration:
    """From a JSON file's path or its parsed content. A level is closed if it has a vocabulary, else observed, unless it says."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as f:
            source = json.load(f)
    levels = []
    for x in source.get("hierarchy", ()):
        licence, words = x.get("normalization", {}), tuple(x.get("vocabulary", ()))
        mode = x.get("mode") or (CLOSED if words else OBSERVED)
        levels.append(Level(x["canonical"], tuple(x.get("aliases", ())), words, bool(licence.get("punctuation")), bool(licence.get("case")), mode, bool(x.get("bootstrap"))))
    #: JSON block and key of each setting.
    places = {
        "declared_fields": ("metadata", "declared_fields"), "required_fields": ("metadata", "required_fields"), "check_report_name": ("metadata", "check_report_name"),
        "fuzzy": ("matching", "fuzzy"), "accept": ("matching", "accept_threshold"), "review": ("matching", "review_threshold"),
        "validate_totals": ("reconciliation", "validate_totals"), "tolerance": ("reconciliation", "tolerance"),
        "prefixes": ("parsing", "aggregation_prefixes"), "total_labels": ("parsing", "total_labels"), "blank_member": ("parsing", "blank_member_literal"),
        "scan_rows": ("parsing", "metadata_scan_rows"), "value_threshold": ("parsing", "value_column_threshold"), "near_miss": ("parsing", "nearmiss_note_floor"),
        "var_name": ("output", "var_name"), "value_name": ("output", "value_name"),
        "allow_missing": ("overrides", "allow_missing_levels"), "drift_tolerance": ("registry", "cardinality_drift_tolerance"),
    }
    given = {k: source[b][key] for k, (b, key) in places.items() if source.get(b, {}).get(key) is not None}
    return Declaration(tuple(levels), **{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
