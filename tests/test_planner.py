import pytest

from driftwright.functions.types import TypeMappingError, cast_runs, family, fits, target_type
from driftwright.plans.mapping import Mapping, MappingError, as_dict, parse
from driftwright.plans.planner import first_details, plan_file


def stats(kind, low=None, high=None, nulls=0, rows=10):
    return {"type": kind, "min": low, "max": high, "null_count": nulls, "num_rows": rows}


def one(raw, target, **sections):
    return plan_file(raw, target, Mapping("t", **sections))


ACK = {"ack_date": "2024-01-01", "from": "DOUBLE", "to": "BIGINT"}


@pytest.mark.parametrize(
    ("raw", "target", "sections", "kinds", "open_"),
    [
        ({"a": stats("BIGINT")}, {"a": stats("BIGINT")}, {}, ["passthrough"], []),
        ({"a": stats("BIGINT", 1, 9)}, {"a": stats("INTEGER")}, {}, ["cast"], []),
        ({"a": stats("BIGINT", 1, 2**40)}, {"a": stats("INTEGER")}, {}, [], ["unacked_lossy_cast"]),
        ({"a": stats("DOUBLE", 1.0, 2.0)}, {"a": stats("BIGINT")}, {}, [], ["unacked_lossy_cast"]),
        ({"a": stats("DOUBLE", 1.0, 2.0)}, {"a": stats("BIGINT")}, {"lossy_casts": {"a": ACK}}, ["cast"], []),
        ({"a": stats("VARCHAR", "A", "B")}, {"a": stats("BIGINT")}, {"value_maps": {"a": {"A": 1}}}, ["value_map"], []),
        ({"a": stats("DOUBLE", 1.0, 6.0)}, {"a": stats("BIGINT")}, {"value_maps": {"a": {"1": 1}}}, [], ["unacked_lossy_cast"]),
        ({"b": stats("BIGINT")}, {"a": stats("BIGINT")}, {"renames": {"b": "a"}}, ["rename"], []),
        ({"b": stats("DOUBLE", 1.0, 6.0)}, {"a": stats("BIGINT")}, {"renames": {"b": "a"}, "value_maps": {"a": {"1.0": 1}}}, ["value_map"], []),
        ({"b": stats("DOUBLE", 1.0, 6.0)}, {"a": stats("BIGINT")}, {"renames": {"b": "a"}, "lossy_casts": {"b": ACK}}, ["rename"], []),
        ({"b": stats("DOUBLE", 1.0, 6.0)}, {"a": stats("BIGINT")}, {"renames": {"b": "a"}}, [], ["unacked_lossy_cast"]),
        ({"b": stats("BIGINT"), "c": stats("BIGINT")}, {"a": stats("BIGINT")}, {"renames": {"b": "a", "c": "a"}}, [], ["ambiguous_multisource_rename"]),
        ({}, {"a": stats("BIGINT")}, {}, ["null_fill"], []),
        ({"z": stats("BIGINT")}, {"a": stats("BIGINT")}, {}, ["null_fill"], ["unmapped_drop"]),
        ({"z": stats("BIGINT", nulls=10)}, {"a": stats("BIGINT")}, {}, ["null_fill"], []),
        ({"z": stats("BIGINT")}, {"a": stats("BIGINT")}, {"acknowledged_data_loss": {"z": {"ack_date": "x"}}}, ["null_fill"], []),
        # a rename whose target is in the file, or is no target column, loses data and must be settled
        ({"a": stats("BIGINT"), "b": stats("BIGINT")}, {"a": stats("BIGINT")}, {"renames": {"b": "a"}}, ["passthrough"], ["unmapped_drop"]),
        ({"b": stats("BIGINT")}, {"a": stats("BIGINT")}, {"renames": {"b": "nowhere"}}, ["null_fill"], ["unmapped_drop"]),
        ({"a": stats("BIGINT"), "A": stats("BIGINT")}, {"A": stats("BIGINT")}, {"renames": {"a": "A"}}, ["passthrough"], ["unmapped_drop"]),
        # texts count as castable to times
        ({"a": stats("VARCHAR", "x", "y")}, {"a": stats("TIMESTAMP")}, {}, ["cast"], []),
    ],
)
def test_decisions(raw, target, sections, kinds, open_):
    plan = one(raw, target, **sections)
    assert [a.kind for a in plan.actions] == kinds
    assert [u.kind for u in plan.unresolved] == open_


def test_order_is_the_targets_and_details_come_once():
    target = {"b": stats("BIGINT"), "a": stats("BIGINT"), "c": stats("DOUBLE")}
    plan = one({"a": stats("BIGINT"), "b": stats("BIGINT")}, target)
    assert [x.target for x in plan.actions] == ["b", "a", "c"]
    bad = [one({"z": stats("BIGINT", rows=n)}, {}) for n in (3, 5)]
    assert [u.details for u in first_details(bad)] == ["holds 3 values and goes nowhere"]


def test_acknowledged_type_differs_is_a_warning():
    plan = one({"a": stats("DECIMAL(4,1)", 1.0, 2.0)}, {"a": stats("BIGINT")}, lossy_casts={"a": ACK})
    assert plan.warnings and not plan.unresolved


@pytest.mark.parametrize(
    ("low", "high", "longest", "target", "ok"),
    [(-128, 127, None, "TINYINT", True), (-129, 0, None, "TINYINT", False), (0, 32768, None, "SMALLINT", False), ("N", "Y", None, "BIGINT", False), (None, None, None, "INTEGER", True), (None, None, 5, "VARCHAR(4)", False), ("a", "b", 3, "VARCHAR(4)", True), ("x", "y", None, "DOUBLE", True)],
)
def test_fits(low, high, longest, target, ok):
    assert fits(low, high, longest, target)[0] is ok


def test_types():
    assert target_type(" decimal(10, 2) ") == "DECIMAL(10,2)" and target_type("timestamp_ns") == "DATETIME2"
    with pytest.raises(TypeMappingError):
        target_type("UUID")
    assert [family(t) for t in ("VARCHAR", "UINTEGER", "TIMESTAMP", "BOOLEAN", "UUID")] == ["string", "numeric", "temporal", "bool", "other"]
    assert cast_runs("BIGINT", "VARCHAR") and cast_runs("DOUBLE", "BIGINT") and not cast_runs("VARCHAR", "BIGINT")


@pytest.mark.parametrize(
    "raw",
    [None, [], {"target": ""}, {"target": "t", "odd": 1}, {"target": "t", "renames": {"a": 1}}, {"target": "t", "lossy_casts": {"a": {"ack_date": "x"}}}, {"target": "t", "acknowledged_data_loss": {"a": {}}}, {"target": "t", "value_maps": {"a": {}}}, {"target": "t", "value_maps": {"a": {"map": {"x": 1}, "on_unmapped": None}}}, {"target": "t", "value_maps": {"a": {"map": {"x": 1}, "on_unmapped": "skip"}}}],
)
def test_bad_mappings(raw):
    with pytest.raises(MappingError):
        parse(raw)


def test_value_maps_survive_a_round_trip():
    raw = {"target": "t", "value_maps": {"a": {1: 2, "x": None}, "b": {"map": {"y": 3}, "on_unmapped": "null"}}}
    mapping = parse(raw)
    assert mapping.value_maps == {"a": {"1": 2, "x": None}, "b": {"y": 3}} and mapping.on_unmapped == {"a": "error", "b": "null"}
    assert parse(as_dict(mapping)) == mapping
