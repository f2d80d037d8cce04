"""Settings with the precedence environment > .env file > YAML file > defaults.

Only what some operator reads is a setting.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace
from pathlib import Path

PREFIX = "CLAIMSPARK_"


@dataclass(frozen=True)
class Settings:
    max_tokens: int = 1_800
    overlap_tokens: int = 150
    minimum_confidence: float = 0.55
    lexical_threshold: float = 90.0
    ambiguous_threshold: float = 78.0
    budget_terms: int = 250
    budget_relations: int = 400
    budget_axioms: int = 200
    budget_models: int = 60
    critic_repairs: int = 1
    workspace: str = "workspace"

    def __post_init__(self) -> None:
        if self.max_tokens < 1 or not 0 <= self.overlap_tokens < self.max_tokens:
            raise ValueError("max_tokens must be positive and overlap_tokens below it")
        if not 0 <= self.minimum_confidence <= 1 or self.critic_repairs not in (0, 1):
            raise ValueError("minimum_confidence lies in 0..1, critic_repairs is 0 or 1")


def _pairs(text: str, separator: str) -> dict[str, str]:
    out = {}
    for line in text.splitlines():
        key, found, value = line.partition(separator)
        if found and not line.lstrip().startswith("#"):
            out[key.strip()] = value.strip().strip("\"'")
    return out


def load(yaml_file: str | Path | None = None, env_file: str | Path | None = None, environ: dict[str, str] | None = None) -> Settings:
    """Flat ``name: value`` YAML, NAME=value lines and CLAIMSPARK_NAME variables over the defaults; unknown names are errors."""
    kinds = {f.name: type(f.default) for f in fields(Settings)}
    found: dict[str, str] = {}
    if yaml_file and Path(yaml_file).exists():
        found |= _pairs(Path(yaml_file).read_text(), ":")
    if unknown := set(found) - set(kinds):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    for source in (_pairs(Path(env_file).read_text(), "=") if env_file and Path(env_file).exists() else {}, os.environ if environ is None else environ):
        found |= {k[len(PREFIX) :].lower(): v for k, v in source.items() if k.startswith(PREFIX) and k[len(PREFIX) :].lower() in kinds}
    return replace(Settings(), **{k: kinds[k](v) for k, v in found.items()})
