"""Normalisation mappings: a YAML file per data type, validated strictly."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml


class MappingError(ValueError):
    """The mapping file is missing, is no YAML, or breaks a rule."""


@dataclass
class Mapping:
    """target: the pinned file. on_unmapped: per value-mapped column, ``error`` or ``null``."""

    target: str
    renames: dict[str, str] = field(default_factory=dict)
    lossy_casts: dict[str, dict] = field(default_factory=dict)
    acknowledged_data_loss: dict[str, dict] = field(default_factory=dict)
    value_maps: dict[str, dict[str, Any]] = field(default_factory=dict)
    on_unmapped: dict[str, str] = field(default_factory=dict)


SECTIONS = ("target", "renames", "lossy_casts", "acknowledged_data_loss", "value_maps")
POLICIES = ("error", "null")


def _section(raw: dict, name: str, path) -> dict:
    value = raw.get(name) or {}
    if not isinstance(value, dict):
        raise MappingError(f"{path}: {name} must be a mapping")
    return value


def _acknowledged(raw: dict, name: str, needs: tuple[str, ...], path) -> dict[str, dict]:
    found = _section(raw, name, path)
    for column, entry in found.items():
        if not isinstance(entry, dict):
            raise MappingError(f"{path}: {name}.{column} must be a mapping")
        for key in needs:
            if not entry.get(key):
                raise MappingError(f"{path}: {name}.{column} lacks {key}")
    return dict(found)


def parse(raw: Any, path: str = "mapping") -> Mapping:
    """A mapping from parsed YAML."""
    if raw is None:
        raise MappingError(f"{path}: empty")
    if not isinstance(raw, dict):
        raise MappingError(f"{path}: must be a mapping")
    if unknown := sorted(set(map(str, raw)) - set(SECTIONS)):
        raise MappingError(f"{path}: unknown key {', '.join(unknown)}")
    target = raw.get("target")
    if not isinstance(target, str) or not target.strip():
        raise MappingError(f"{path}: target must be a file name")
    renames = _section(raw, "renames", path)
    if any(not isinstance(k, str) or not isinstance(v, str) for k, v in renames.items()):
        raise MappingError(f"{path}: renames must go from name to name")
    out = Mapping(target, dict(renames), _acknowledged(raw, "lossy_casts", ("ack_date", "from", "to"), path), _acknowledged(raw, "acknowledged_data_loss", ("ack_date",), path))
    for column, entry in _section(raw, "value_maps", path).items():
        if not isinstance(entry, dict) or not entry:
            raise MappingError(f"{path}: value_maps.{column} must be a mapping with entries")
        pairs, policy = entry, "error"
        if "map" in entry and isinstance(entry["map"], dict):
            if extra := sorted(set(map(str, entry)) - {"map", "on_unmapped"}):
                raise MappingError(f"{path}: value_maps.{column}: unknown key {', '.join(extra)}")
            pairs, policy = entry["map"], entry.get("on_unmapped", "error")
        if not pairs:
            raise MappingError(f"{path}: value_maps.{column} has no entries")
        if policy not in POLICIES:
            raise MappingError(f"{path}: value_maps.{column}: on_unmapped must be error or null (quoted)")
        out.value_maps[column] = {str(k): v for k, v in pairs.items()}
        out.on_unmapped[column] = policy
    return out


def load(path: str | Path) -> Mapping:
    path = Path(path)
    if not path.exists():
        raise MappingError(f"{path}: not found")
    try:
        raw = yaml.safe_load(path.read_text())
    except yaml.YAMLError as problem:
        raise MappingError(f"{path}: {problem}") from problem
    return parse(raw, str(path))


def as_dict(mapping: Mapping) -> dict:
    """The mapping as it is written: value maps keep their policy."""
    maps = {c: {"map": pairs, "on_unmapped": "null"} if mapping.on_unmapped.get(c) == "null" else pairs for c, pairs in mapping.value_maps.items()}
    return {"target": mapping.target, "renames": mapping.renames, "lossy_casts": mapping.lossy_casts, "acknowledged_data_loss": mapping.acknowledged_data_loss, "value_maps": maps}


def dump(mapping: Mapping, comments: list[str] = ()) -> str:
    """YAML text with leading comments."""
    return "".join(f"# {line}\n" for line in comments) + yaml.safe_dump(as_dict(mapping), sort_keys=False, allow_unicode=True)
