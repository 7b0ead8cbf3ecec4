"""Planning: from the footers of a file to one action per target column, or the reasons why not."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.types import fits, is_float, is_integer, is_string
from .mapping import Mapping


@dataclass(frozen=True)
class Action:
    """How a target column is made. kind: passthrough, rename, cast, value_map or null_fill."""

    kind: str
    target: str
    target_type: str
    source: str | None = None
    source_type: str | None = None
    values: tuple[tuple[str, object], ...] = ()
    on_unmapped: str = "error"


@dataclass(frozen=True)
class Unresolved:
    kind: str
    column: str
    details: str


@dataclass
class Plan:
    actions: list[Action] = field(default_factory=list)
    unresolved: list[Unresolved] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def holds_values(stats: dict) -> bool:
    return stats["num_rows"] > stats["null_count"]


def safe_cast(stats: dict, target: str) -> bool:
    """Judged by footers alone: fractions can never be ruled out, so floating point to integer is never safe."""
    if is_float(stats["type"]) and is_integer(target):
        return False
    return fits(stats.get("min"), stats.get("max"), stats.get("longest"), target)[0]


def _why(stats: dict, target: str) -> str:
    reason = "fractions may be lost" if is_float(stats["type"]) and is_integer(target) else fits(stats.get("min"), stats.get("max"), stats.get("longest"), target)[1]
    return f"{stats['type']} -> {target}: {reason}"


def plan_file(raw: dict[str, dict], target: dict[str, dict], mapping: Mapping, strict: bool = False) -> Plan:
    """The plan of one file. raw, target: column statistics in file order, as the footers give them.

    strict: casts across type families need an acknowledgement too.
    """
    from ..functions.types import cast_runs

    plan = Plan()
    sources: dict[str, list[str]] = {}
    for old, new in mapping.renames.items():
        if old in raw:
            sources.setdefault(new, []).append(old)

    def convert(name: str, source: str, acks: tuple[str, ...]) -> None:
        """One source column to one target column of the plan."""
        stats, kind = raw[source], target[name]["type"]
        same = source == name
        if stats["type"] == kind:
            plan.actions.append(Action("passthrough" if same else "rename", name, kind, source, kind))
        elif name in mapping.value_maps and (not same or is_string(stats["type"])):
            plan.actions.append(Action("value_map", name, kind, source, stats["type"], tuple(mapping.value_maps[name].items()), mapping.on_unmapped.get(name, "error")))
        elif safe_cast(stats, kind) and (not strict or cast_runs(stats["type"], kind)) or any(a in mapping.lossy_casts for a in acks):
            for a in acks:
                noted = mapping.lossy_casts.get(a)
                if noted and str(noted["from"]).upper() != stats["type"].upper():
                    plan.warnings.append(f"{a}: acknowledged from {noted['from']}, the file has {stats['type']}")
            plan.actions.append(Action("cast" if same else "rename", name, kind, source, stats["type"]))
        else:
            plan.unresolved.append(Unresolved("unacked_lossy_cast", source, _why(stats, kind)))

    for name, stats in target.items():
        named = sources.get(name, [])
        if name in raw:
            convert(name, name, (name,))
        elif len(named) > 1:
            plan.unresolved.append(Unresolved("ambiguous_multisource_rename", name, "renamed from each of " + ", ".join(sorted(named))))
        elif named:
            convert(name, named[0], (name, named[0]))
        else:
            plan.actions.append(Action("null_fill", name, stats["type"]))

    for column, stats in raw.items():
        if column in target or not holds_values(stats):
            continue
        new = mapping.renames.get(column)
        # a rename only takes the data along where its target exists and is not in the file itself
        if new in target and new not in raw:
            continue
        if column not in mapping.acknowledged_data_loss:
            plan.unresolved.append(Unresolved("unmapped_drop", column, f"holds {stats['num_rows'] - stats['null_count']} values and goes nowhere"))
    return plan


def first_details(plans: list[Plan]) -> list[Unresolved]:
    """Unresolved items of several files: the first of each kind and column."""
    seen: dict[tuple[str, str], Unresolved] = {}
    for plan in plans:
        for item in plan.unresolved:
            seen.setdefault((item.kind, item.column), item)
    return list(seen.values())
