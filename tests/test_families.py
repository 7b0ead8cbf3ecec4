"""Plans of whole families, marks of files, and the stream's footers."""

import random
from datetime import datetime

import pytest

from driftwright.operators.load import ParquetSink
from driftwright.plans.mapping import Mapping
from driftwright.plans.normalize import plan_family
from driftwright.plans.planner import first_details, plan_file
from driftwright.session import configure
from driftwright.sources.files import drop_corrupt, list_parquet
from driftwright.sources.footer import file_stats, read_footers, read_marks
from driftwright.streaming import incremental


def made(rng):
    """A schema and values of one file."""
    kinds = {"a": ["bigint", "double", "string", "int"], "b": ["bigint", "double", "int"], "old_b": ["bigint", "int"], "other_b": ["int"], "c": ["string", "bigint"], "gone": ["int", "string"], "noted": ["int"]}
    cells = {"bigint": [1, 2**40, None], "int": [5, None], "double": [1.5, 2.0, None], "string": ["x", "7", None]}
    columns = [(n, rng.choice(k)) for n, k in kinds.items() if rng.random() < 0.6]
    rng.shuffle(columns)
    return columns or [("a", "int")], [tuple(rng.choice(cells[k]) for _, k in columns or [("a", "int")]) for _ in range(2)]


@pytest.mark.parametrize("seed", range(3))
def test_plans_of_a_family_equal_those_of_its_files(spark, tmp_path, seed):
    configure(spark)
    rng = random.Random(seed)
    spark.createDataFrame([(1, 2, 3)], "a int, b bigint, c bigint").coalesce(1).write.parquet(f"{tmp_path}/99.parquet")
    files = [made(rng) for _ in range(14)]
    for k, (columns, rows) in enumerate(files + files[:6]):
        spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in columns)).coalesce(1).write.parquet(f"{tmp_path}/{k:02d}.parquet")
    ack = {"ack_date": "2024-01-01", "from": "DOUBLE", "to": "INTEGER"}
    mapping = Mapping("99", {"old_b": "b", "other_b": "b"}, {"a": ack} if seed else {}, {"noted": {"ack_date": "x"}}, {"c": {"x": 1, "7": 7}} if seed < 2 else {})
    paths = list_parquet(spark, str(tmp_path))
    pinned = next(p for p in paths if "/99.parquet/" in p)
    footers = read_footers(spark, paths)
    stats = file_stats(footers)
    expected = {p: plan_file(stats[p], stats[pinned], mapping) for p in paths}
    groups = plan_family(footers, pinned, mapping)
    assert sorted(p for _, own in groups for p in own) == sorted(paths) and len(groups) < len(paths)
    for plan, own in groups:
        for p in own:
            assert (plan.actions, [(u.kind, u.column) for u in plan.unresolved], plan.warnings) == (expected[p].actions, [(u.kind, u.column) for u in expected[p].unresolved], expected[p].warnings)
    key = lambda items: sorted((u.kind, u.column, u.details) for u in items)
    assert key(first_details([plan for plan, _ in groups])) == key(first_details([expected[p] for p in sorted(paths)]))


def test_marks_by_uri(spark, tmp_path):
    configure(spark)
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/good.parquet")
    for name, data in (("a", b""), ("b", b"PAR1"), ("c", b"PAR1" + b"x" * 20), ("d", b"PAR1xxxxPAR1")):
        (tmp_path / f"{name}.parquet").write_bytes(data)
    paths = [f"file://{p}" for p in list_parquet(spark, f"file://{tmp_path}")] + ["file:///no/such.parquet"]
    found = {r.path.rsplit("/", 1)[-1]: r for r in read_marks(spark, paths).collect()}
    assert [found[f"{n}.parquet"].valid for n in "abcd"] == [False, False, False, True] and found["such.parquet"].valid is None and found["such.parquet"].error
    assert drop_corrupt(f"file://{tmp_path}", spark) == 3 and drop_corrupt(f"file://{tmp_path}", spark) == 0 and drop_corrupt(f"{tmp_path}/none", spark) == 0
    assert {p.rsplit("/", 2)[-1][:4] for p in list_parquet(spark, str(tmp_path))} == {"part", "d.pa"}


def test_the_stream_reads_new_footers_only(spark, tmp_path, monkeypatch):
    configure(spark)
    disk, read = tmp_path / "normalized", []
    real = incremental.read_footers
    monkeypatch.setattr(incremental, "read_footers", lambda spark, paths: (read.append(len(paths)), real(spark, paths))[1])
    schema = spark.createDataFrame([], "k bigint, at timestamp_ntz").schema

    def put(when, n):
        spark.createDataFrame([(k, datetime(2023, 1, 1)) for k in range(n)], schema).coalesce(1).write.mode("overwrite").parquet(f"{disk}/out")
        part = next((disk / "out").glob("part-*.parquet"))
        part.rename(disk / f"yellow_tripdata_{when}.parquet")
        for left in (disk / "out").iterdir():
            left.unlink()
        (disk / "out").rmdir()

    sink = ParquetSink(spark, str(tmp_path / "warehouse"))
    turn = lambda: incremental.load_new_months(spark, str(disk), schema, "yellow", sink.root, str(tmp_path / "state")).awaitTermination()
    for k in range(1, 6):
        put(f"2023-{k:02d}", k)
    turn()
    assert read == [5] and sink.counts("yellow") == {2023: 15}
    put("2023-06", 6)
    put("2024-01", 2)
    turn()
    turn()
    assert read == [5, 2] and sink.counts("yellow") == {2023: 21, 2024: 2}
    (disk / "yellow_tripdata_2023-01.parquet").unlink()
    put("2024-02", 1)
    turn()
    assert read == [5, 2, 1] and sink.counts("yellow") == {2023: 20, 2024: 3}


def test_renames_are_held_against_the_data(spark, tmp_path):
    from driftwright.operators import drift

    configure(spark)
    old, new = f"{tmp_path}/raw/x_tripdata_2023-01.parquet", f"{tmp_path}/raw/x_tripdata_2023-02.parquet"
    spark.range(200).selectExpr("id as `trip``dist`", "id * 1.5 as fare_amt", "id as tip_amt").coalesce(1).write.parquet(old)
    spark.range(200).selectExpr("id as `trip``distance`", "id * 1.5 as fare_amount", "'x' || id as tip_amount").coalesce(1).write.parquet(new)
    sure = drift.Rename("a", "b", 0.99)
    open_ = [drift.Rename("trip`dist", "trip`distance", 0.8, None, "BIGINT", "BIGINT"), drift.Rename("fare_amt", "fare_amount", 0.8, None, "DOUBLE", "DOUBLE"), drift.Rename("fare_amt", "trip`distance", 0.7, None, "DOUBLE", "BIGINT"), drift.Rename("tip_amt", "tip_amount", 0.7, None, "BIGINT", "VARCHAR")]
    found = drift.verify_renames(spark, [sure, *open_], old, new)
    assert found[0] == sure and [r.data_verified for r in found[1:3]] == [True, True] and found[4].data_verified is None
    assert drift.verify_renames(spark, [sure], old, new) == [sure]
