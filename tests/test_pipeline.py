from datetime import date

import pytest

from driftwright.operators.load import create_table_sql, delete_sql, insert_sql, manifest_sql, update_sql, year_table
from driftwright.operators.profile import parse_sample
from driftwright.plans import pipeline as p
from driftwright.sources import download as d


@pytest.mark.parametrize(
    ("stage", "code", "status", "halt", "abort"),
    [("download", 0, "ok", False, False), ("download", 2, "failed", True, False), ("normalize", 0, "ok", False, False), ("normalize", 1, "needs_review", True, False), ("normalize", 3, "needs_review", True, False), ("normalize", 2, "failed", True, False), ("load", 0, "ok", False, False), ("load", 1, "partial", False, False), ("load", 2, "conn_error", True, True)],
)
def test_classify(stage, code, status, halt, abort):
    assert p.classify(stage, code) == p.Outcome(stage, code, status, halt, abort)


def test_run_halts_and_aborts():
    work = {"download": lambda t: 0, "normalize": lambda t: 1 if t == "green" else 0, "load": lambda t: 2}
    runs, code = p.run(["yellow", "green", "fhv"], p.stages(load=True), work)
    assert {t: [o.stage for o in os] for t, os in runs.items()} == {"yellow": ["download", "normalize", "load"], "green": ["download", "normalize"], "fhv": ["download", "normalize"]}
    assert code == 2 and [p.label(o) for o in runs.values()] == ["LOAD ERROR", "NEEDS REVIEW", "OK"]
    assert p.summary(runs).splitlines()[2].startswith("yellow") and p.label([]) == "SKIPPED"
    with pytest.raises(ValueError):
        p.classify("other", 0)
    with pytest.raises(ValueError):
        p.stages(load=True, download_only=True)


class Stub:
    """Answers by file name; writes a byte where a file is there."""

    def __init__(self, present=(), limited=()):
        self.present, self.limited, self.asked = set(present), dict(limited), []

    def fetch(self, name, to):
        self.asked.append(name)
        if self.limited.get(name, 0) > 0:
            self.limited[name] -= 1
            return d.Fetch.RATELIMIT
        if name not in self.present:
            return d.Fetch.NOTFOUND
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_bytes(b"x")
        return d.Fetch.OK


def names(*months):
    return [d.file_name("fhvhv", *m) for m in months]


def test_full_skips_the_gap_before_and_stops_at_the_gap_after(tmp_path):
    stub = Stub(names((2019, 4), (2019, 5), (2019, 7)))
    assert d.full(stub, "fhvhv", tmp_path, date(2019, 12, 1)) == d.Walk(2, 0)
    assert stub.asked[-1] == d.file_name("fhvhv", 2019, 6)


def test_full_gives_up_after_three_failures(tmp_path):
    waits = []
    stub = Stub(limited={n: 99 for n in names((2019, 2), (2019, 3), (2019, 4), (2019, 5))})
    assert d.full(stub, "fhvhv", tmp_path, date(2020, 1, 1), waits.append) == d.Walk(0, 3)
    assert waits == [30, 90, 270] * 3


def test_recent_stops_at_a_local_file(tmp_path):
    stub = Stub(names((2024, 1), (2024, 2), (2024, 3)))
    assert d.recent(stub, "fhvhv", tmp_path, 1, date(2024, 5, 9)) == d.Walk(1, 0)
    assert d.recent(stub, "fhvhv", tmp_path, 3, date(2024, 5, 9)) == d.Walk(0, 0)


def test_retry_then_success(tmp_path):
    waits = []
    stub = Stub(names((2024, 3)), {names((2024, 3))[0]: 2})
    assert d.month(stub, "fhvhv", (2024, 3), tmp_path, waits.append) is d.Fetch.OK and waits == [30, 90]


def test_months_and_answers():
    assert d.before(date(2024, 1, 5)) == (2023, 12) and list(d.forward((2023, 11), (2024, 1))) == [(2023, 11), (2023, 12), (2024, 1)]
    assert [d.classify(*a).value for a in ((404, ""), (403, "AccessDenied"), (403, "x"), (429, ""), (502, ""), (400, ""))] == ["notfound", "notfound", "ratelimit", "ratelimit", "ratelimit", "neterror"]


def test_samples():
    assert [parse_sample(x) for x in ("100", "10%", "0%", "100%", " 5 % ")] == [100, "10%", 0, 0, "5%"]
    with pytest.raises(ValueError):
        parse_sample("some")


def test_statements():
    assert insert_sql("t", ["a", "b"]) == "INSERT INTO t (a, b) VALUES (@p1, @p2)"
    assert update_sql("t", ["k", "a", "b"], ["k"]) == "UPDATE t SET a = @p1, b = @p2 WHERE k = @p3"
    assert delete_sql("t", ["k", "m"]) == "DELETE FROM t WHERE k = @p1 AND m = @p2"
    assert create_table_sql("t", [("a", "INT")]) == "CREATE TABLE t (\n    a INT\n) WITH (DATA_COMPRESSION = PAGE);"
    assert "PRIMARY KEY (data_type, year, month)" in manifest_sql() and year_table("yellow", 2024) == "yellow_2024"
