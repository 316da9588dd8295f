"""Configuration: required sections, checked values, dotted overrides."""

from __future__ import annotations

import copy
import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

SECTIONS = ("corpus", "tokenizer", "lemmatizer", "filters", "fixes", "output")
FLAGS = ("diacritic_folding", "accent_folding", "plural_folding", "lemma_closure", "split_ambiguous", "short_tokens", "extended_proper_nouns", "proper_noun_review", "mwe_check")

DEFAULT: dict[str, Any] = {
    "corpus": {"path": "", "sample_lines": None, "partitions": None},
    "tokenizer": {"split_clusters": True, "restore_stems": True, "repair_glue": False},
    "lemmatizer": {"primary_tier": 144},
    "filters": {"exclusions": [], "removals": [], "interjections": ["ah", "oh"], "cap_ratio": 0.85, "min_count": 1},
    "fixes": dict.fromkeys(FLAGS, True) | {"fold_ratio": 10, "plural_ratio": 5, "plural_min_count": 1000},
    "mwe": {"min_word": 100, "min_g2": 2500.0, "min_share": 0.05, "denominator": "max"},
    "contexts": {"size": 5, "large": 50, "large_from": 10_000, "types": 70_000},
    "output": {"path": "", "limit": 10_000, "bands": [[1, 5000], [5001, 10_000]], "dropped_from": 100},
}


@dataclass(frozen=True)
class Config:
    """A validated configuration; stage 1 switches all fixes off."""

    values: dict = field(default_factory=lambda: copy.deepcopy(DEFAULT))
    stage: int = 2

    def __post_init__(self):
        validate(self.values)
        if self.stage not in (1, 2):
            raise ValueError(f"stage {self.stage}")

    def __getitem__(self, section: str) -> dict:
        return self.values[section]

    def fix(self, name: str) -> bool:
        return self.stage == 2 and bool(self.values["fixes"][name])

    def with_overrides(self, pairs: dict[str, Any]) -> Config:
        """A copy with values at dotted paths, which must exist."""
        values = copy.deepcopy(self.values)
        for path, value in pairs.items():
            *parents, last = path.split(".")
            at = values
            for p in parents:
                at = at[p] if isinstance(at, dict) and p in at else _fail(path)
            if not isinstance(at, dict) or last not in at:
                _fail(path)
            at[last] = value
        return Config(values, self.stage)

    def digest(self, *sections: str, stamps: tuple[str, ...] = ()) -> str:
        """Key of what the sections, and the stamps of input tables, determine."""
        part = {s: self.values[s] for s in sections} | {"stage": self.stage, "stamps": list(stamps)}
        return hashlib.sha256(json.dumps(part, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]

    @property
    def root(self) -> str:
        """Output folder; samples and stage 1 have their own."""
        kind = "sample" if self.values["corpus"]["sample_lines"] else f"stage{self.stage}"
        return f"{self.values['output']['path']}/{kind}"


def _fail(path: str):
    raise KeyError(f"no such setting: {path}")


def coerce(text: str) -> Any:
    """A command line value: JSON where it is some, else the text."""
    try:
        return json.loads(text)
    except ValueError:
        return text


def validate(values: dict) -> None:
    for s in SECTIONS:
        if not isinstance(values.get(s), dict):
            raise ValueError(f"section {s} is missing")
    for f in FLAGS:
        if not isinstance(values["fixes"].get(f), bool):
            raise ValueError(f"fixes.{f} must be true or false")
    end = 0
    for low, high in values["output"]["bands"]:
        if low != end + 1 or high < low:
            raise ValueError("bands must follow each other")
        end = high
    if end > values["output"]["limit"]:
        raise ValueError("bands go beyond the limit")
    if values["mwe"]["denominator"] not in ("max", "min", "left", "right"):
        raise ValueError("mwe.denominator")


def load(path: str, stage: int = 2) -> Config:
    """From a YAML or JSON file, over the defaults."""
    raw = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        own = yaml.safe_load(raw)
    else:
        own = json.loads(raw)
    values = {s: {**copy.deepcopy(DEFAULT.get(s, {})), **(own.get(s) or {})} for s in {*DEFAULT, *own}}
    return Config(values, stage)
