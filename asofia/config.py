"""Configuration from JSON or, where a parser is installed, YAML: checks, gates, event catalogues, taxonomies. Everything is checked when it is loaded."""

from __future__ import annotations

import json
from pathlib import Path

from asofia.operators.catalysts import Spec
from asofia.operators.checks import Check, CheckError, assert_monotone
from asofia.operators.gate import Filter, Gate
from asofia.operators.themes import Theme, validate


def read(path: str) -> dict:
    raw = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise CheckError(f"{path}: no YAML parser is installed; use JSON") from e
        return yaml.safe_load(raw)
    return json.loads(raw)


def checks(config: dict) -> list[Check]:
    out = []
    for c in config.get("checks", []):
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}
        try:
            one = Check(**known)
        except TypeError as e:
            raise CheckError(f"{c.get('id')}: {e}") from e
        if one.kind == "gate_filter" and one.loose is not None and one.tight is not None:
            assert_monotone(one.loose, one.tight, one.op)
        one.value()
        out.append(one)
    if len({c.id for c in out}) < len(out):
        raise CheckError("a check's id is there twice")
    return out


def gate(config: dict) -> Gate:
    g = dict(config["gate"])
    filters = tuple(Filter(**f) for f in config["filters"])
    ranking = tuple((r["metric"], float(r["weight"])) for r in config["ranking"])
    return Gate(filters, ranking, **g)


def events(config: dict) -> tuple[Spec, ...]:
    return tuple(Spec(**{k: tuple(v) if isinstance(v, list) else v for k, v in s.items()}) for s in config["events"])


def taxonomy(config: dict, universe: set[str]) -> list[Theme]:
    themes = [Theme(**{k: tuple(v) if isinstance(v, list) else v for k, v in t.items()}) for t in config["themes"]]
    if errors := validate(themes, universe):
        raise ValueError("; ".join(errors))
    return themes
