"""A family of drifting files from raw to loaded."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from driftwright.cli import main
from driftwright.functions import names
from driftwright.operators import drift
from driftwright.operators.load import ParquetSink, execute, plan_years
from driftwright.operators.profile import profile
from driftwright.plans import bootstrap
from driftwright.plans.mapping import load
from driftwright.plans.planner import Action, Plan
from driftwright.plans.transform import apply
from driftwright.session import configure
from driftwright.sources.files import drop_corrupt, is_parquet, month_files, period
from driftwright.sources.footer import file_stats, read_footers
from driftwright.streaming.incremental import load_new_months

T0 = datetime(2009, 1, 1, 8)


def write(spark, root, kind, when, rows, schema):
    folder = root / kind / when[:4]
    folder.mkdir(parents=True, exist_ok=True)
    staging = str(folder / "staging")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(staging)
    part = next((folder / "staging").glob("part-*.parquet"))
    part.rename(folder / f"{kind}_tripdata_{when}.parquet")
    for rest in (folder / "staging").iterdir():
        rest.unlink()
    (folder / "staging").rmdir()


@pytest.fixture
def family(spark, tmp_path):
    configure(spark)
    raw = tmp_path / "raw"
    write(spark, raw, "yellow", "2009-01", [(k, T0, 40.7, float(k)) for k in (1, 2, 3)], "vendorid int, pu_datetime timestamp_ntz, pickup_latitude double, passenger_count double")
    write(spark, raw, "yellow", "2015-06", [(k, T0, k + 0.5) for k in (1, 2, 3)], "vendorid int, tpep_pickup_datetime timestamp_ntz, passenger_count double")
    write(spark, raw, "yellow", "2024-01", [(k, T0, k, Decimal("1.75")) for k in (1, 2, 3)], "vendorid int, tpep_pickup_datetime timestamp_ntz, passenger_count bigint, airport_fee decimal(3,2)")
    return tmp_path


def test_footers(spark, family):
    path = str(family / "raw/yellow/2015/yellow_tripdata_2015-06.parquet")
    stats = file_stats(read_footers(spark, [path]))[path]
    assert list(stats) == ["vendorid", "tpep_pickup_datetime", "passenger_count"]
    assert stats["passenger_count"] == {"type": "DOUBLE", "min": 1.5, "max": 3.5, "null_count": 0, "num_rows": 3}
    assert period(path) == "2015-06"


def test_drift_report(spark, family):
    by_name = drift.analyze(spark, str(family / "raw/yellow"), "yellow")
    assert [(r.old, r.new) for c in by_name.changes for r in c.renamed] == [("pu_datetime", "tpep_pickup_datetime")]
    assert by_name.changes[0].removed == [("pickup_latitude", "DOUBLE")] and by_name.changes[1].retyped == [("passenger_count", "DOUBLE", "BIGINT")]
    generic = drift.analyze(spark, str(family / "raw/yellow"), "yellow", generic=True)
    assert all(r.data_verified for c in generic.changes for r in c.renamed)
    assert "different schemas: 3" in drift.report([by_name])


def test_normalize_review_then_write(spark, family, capsys):
    args = ["normalize", "yellow", "--data-dir", str(family)]
    assert main(args, spark) == 3
    assert main(args, spark) == 1  # items are open: nothing is written
    assert not (family / "normalized").exists()
    done = bootstrap.curate(spark, str(family / "raw/yellow"), "yellow", family / "mappings/yellow.yaml", "2024-02-02")
    assert [c for c, _, _ in done.lossy] == ["passenger_count"] and "acknowledged_data_loss" in (family / "mappings/yellow.yaml").read_text()
    assert load(family / "mappings/yellow.yaml").renames == {"pu_datetime": "tpep_pickup_datetime"}
    assert main(args, spark) == 0
    out = spark.read.parquet(str(family / "normalized/yellow"))
    assert out.columns == ["vendorid", "tpep_pickup_datetime", "passenger_count", "airport_fee", "year", "month"]
    # 1.5, 2.5 and 3.5 round half to even
    assert [r.passenger_count for r in out.where("year = 2015").orderBy("vendorid").collect()] == [2, 2, 4]
    assert out.where("airport_fee is null").count() == 6
    assert main([*args, "--one-file"], spark) == 0


def test_value_maps(spark):
    df = spark.createDataFrame([(1, "CASH"), (2, None), (3, "X")], "id int, pay string")
    action = Action("value_map", "pay", "BIGINT", "pay", "VARCHAR", (("CASH", 2), ("DDS", None)), "null")
    assert [r.pay for r in apply(df, Plan([action])).collect()] == [2, None, None]
    strict = Action("value_map", "pay", "BIGINT", "pay", "VARCHAR", (("CASH", 2),), "error")
    with pytest.raises(Exception, match="unmapped value in pay: X"):
        apply(df, Plan([strict])).collect()


def month(spark, root, when, n):
    write(spark, root, "yellow", when, [(k, T0, k * 1.5, "NY"[k % 2]) for k in range(n)], "vendorid bigint, tpep_pickup_datetime timestamp_ntz, trip_distance double, flag string")


def test_loads_are_idempotent(spark, tmp_path):
    configure(spark)
    disk = tmp_path / "normalized"
    for when, n in (("2023-01", 3), ("2023-02", 4), ("2024-01", 5)):
        month(spark, disk, when, n)
    sink = ParquetSink(spark, str(tmp_path / "warehouse"))

    def turn(full=False):
        months = month_files(spark, str(disk / "yellow"))
        plans = plan_years(spark, months, sink, "yellow", full)
        for plan in plans:
            execute(spark, plan, months, sink, "yellow")
        return [(p.year, p.action, list(p.months)) for p in plans]

    assert turn() == [(2023, "append", [1, 2]), (2024, "append", [1])] and sink.counts("yellow") == {2023: 7, 2024: 5}
    assert turn() == [(2023, "skip", []), (2024, "skip", [])]
    month(spark, disk, "2024-02", 2)
    assert turn() == [(2023, "skip", []), (2024, "append", [2])]
    month(spark, disk, "2023-01", 9)
    assert turn() == [(2023, "reload", [1, 2]), (2024, "skip", [])] and sink.counts("yellow")[2023] == 13
    (disk / "yellow/2023/yellow_tripdata_2023-02.parquet").unlink()
    assert turn()[0] == (2023, "reload", [1]) and turn(full=True)[1] == (2024, "reload", [1, 2])
    assert sink.manifest("yellow") == [(2023, 1, 9), (2024, 1, 5), (2024, 2, 2)]


def test_stream_loads_each_month_once(spark, tmp_path):
    configure(spark)
    disk = tmp_path / "normalized"
    month(spark, disk, "2023-01", 3)
    sink = ParquetSink(spark, str(tmp_path / "warehouse"))
    schema = spark.read.parquet(str(disk / "yellow/2023/*.parquet")).schema
    for _ in range(2):
        load_new_months(spark, str(disk / "yellow"), schema, "yellow", sink.root, str(tmp_path / "state")).awaitTermination()
        assert sink.counts("yellow") == {2023: 3}
    month(spark, disk, "2023-02", 4)
    load_new_months(spark, str(disk / "yellow"), schema, "yellow", sink.root, str(tmp_path / "state")).awaitTermination()
    assert sink.counts("yellow") == {2023: 7}


def test_profile(spark):
    df = spark.createDataFrame([("1.5", 1), ("x", 1), (None, 2)], "a string, b int")
    a, b = profile(df).orderBy("column").collect()
    assert (a.total_count, a.non_null_count, a.unique_count, a.min, a.max, a.top_values) == (3, 2, 2, 1.5, 1.5, ["1.5", "x"])
    assert (b.avg, b.top_values) == (pytest.approx(4 / 3), ["1", "2"])


@pytest.mark.parametrize(
    ("a", "b", "value"),
    [("PULocationID", "DOLocationID", 0.0), ("Start_Lon", "pickup_longitude", 1.0), ("Tip_Amt", "tip_amount", 1.0), ("vendor", "vendor_name", 6 / 10), ("trip", "lpep", 1.0), ("fare_amount", "flag", 0.0 if False else None)],
)
def test_name_similarity(spark, a, b, value):
    found = spark.range(1).select(names.similarity(F.lit(a), F.lit(b))).first()[0]
    assert 0 <= found < 0.7 if value is None else found == pytest.approx(value)


def test_subsequence_against_brute_force(spark):
    def lcs(x, y):
        return 0 if not x or not y else lcs(x[1:], y[1:]) + 1 if x[0] == y[0] else max(lcs(x[1:], y), lcs(x, y[1:]))

    pairs = [("abcde", "ace"), ("", "a"), ("pickup", "puck"), ("aaa", "aa")]
    found = spark.createDataFrame(pairs, "a string, b string").select(names.common_subsequence(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [lcs(*p) for p in pairs]


def test_corrupt_files(tmp_path):
    bad = tmp_path / "x.parquet"
    bad.write_bytes(b"PAR1")
    assert not is_parquet(str(bad)) and drop_corrupt(str(tmp_path)) == 1 and not bad.exists()


def test_missing_folders(spark, tmp_path, capsys):
    assert main(["normalize", "yellow", "--data-dir", str(tmp_path)], spark) == 0
    assert main(["drift", "yellow", "--data-dir", str(tmp_path)], spark) == 1
    assert main(["run", "yellow", "--dry-run", "--load", "--data-dir", str(tmp_path)], spark) == 0
    assert main(["run", "yellow", "--download-only", "--load", "--data-dir", str(tmp_path)], spark) == 2


@pytest.mark.parametrize("layout", [[], ["--one-file"]])
def test_what_normalize_writes_is_loaded_once(spark, tmp_path, layout, capsys):
    configure(spark)
    raw = tmp_path / "raw"
    rows = {"2023-01": 5, "2023-02": 6, "2023-03": 4, "2024-01": 5}
    for when, n in rows.items():
        write(spark, raw, "yellow", when, [(k, T0, float(k)) for k in range(n)], "vendorid bigint, tpep_pickup_datetime timestamp_ntz, trip_distance double")
    run = lambda command, *options: main([command, "yellow", *options, "--data-dir", str(tmp_path)], spark)
    assert run("normalize", *layout) == 3 and run("normalize", *layout) == 0
    months = month_files(spark, str(tmp_path / "normalized" / "yellow"))
    assert {(m.year, m.month): m.source_row_count for m in months} == {(2023, 1): 5, (2023, 2): 6, (2023, 3): 4, (2024, 1): 5}
    capsys.readouterr()
    assert run("load") == 0 and capsys.readouterr().out.splitlines() == ["yellow 2023: append [1, 2, 3]", "yellow 2024: append [1]"]
    sink = ParquetSink(spark, str(tmp_path / "warehouse"))
    assert sink.counts("yellow") == {2023: 15, 2024: 5} and sink.manifest("yellow") == [(2023, 1, 5), (2023, 2, 6), (2023, 3, 4), (2024, 1, 5)]
    assert run("load") == 0 and capsys.readouterr().out.splitlines() == ["yellow 2023: skip []", "yellow 2024: skip []"]
    write(spark, raw, "yellow", "2024-02", [(1, T0, 1.0)], "vendorid bigint, tpep_pickup_datetime timestamp_ntz, trip_distance double")
    assert run("normalize", *layout) == 0 and run("load") == 0
    assert sink.counts("yellow") == {2023: 15, 2024: 6}


def test_a_year_that_fails_leaves_the_others(spark, tmp_path, monkeypatch, capsys):
    configure(spark)
    for when in ("2023-01", "2024-01"):
        write(spark, tmp_path / "normalized", "yellow", when, [(1, T0)], "vendorid bigint, tpep_pickup_datetime timestamp_ntz")
    real = ParquetSink.append_all

    def failing(self, data_type, year, months):
        if year == 2023:
            spark.sql("SELECT no_such_column")
        real(self, data_type, year, months)

    monkeypatch.setattr(ParquetSink, "append_all", failing)
    assert main(["load", "yellow", "--data-dir", str(tmp_path)], spark) == 1
    assert ParquetSink(spark, str(tmp_path / "warehouse")).counts("yellow") == {2024: 1}


def test_months_of_paths():
    from driftwright.sources.files import month_of

    assert month_of("/x/year=2023/month=2/part-00001-7500-11aa.parquet") == (2023, 2) and month_of("/x/yellow_tripdata_2023-11.parquet") == (2023, 11)
    assert [month_of(p) for p in ("/x/part-00000-7575-4a.parquet", "/x/a_2023-13.parquet", "/x/year=2023/month=14/a.parquet", "/x/2023-1.parquet")] == [None] * 4


def test_a_row_group_without_statistics_bounds_nothing(monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa

    from driftwright.sources import footer

    chunk = lambda n, low=None, high=None: SimpleNamespace(num_values=n, statistics=None if low is None else SimpleNamespace(null_count=0, has_min_max=True, min=low, max=high))

    def file(*chunks):
        group = lambda k: SimpleNamespace(column=lambda _: chunks[k])
        meta = SimpleNamespace(num_columns=1, num_rows=9, num_row_groups=len(chunks), schema=SimpleNamespace(column=lambda _: SimpleNamespace(path="a")), row_group=group)
        return SimpleNamespace(metadata=meta, schema_arrow=pa.schema([("a", pa.int64())]))

    bounds = lambda *chunks: (monkeypatch.setattr(footer, "_open", lambda _: file(*chunks)), next(footer.footer_rows("x"))[7:9])[1]
    assert bounds(chunk(3, 1, 5), chunk(2, 0, 9)) == (0, 9)
    assert bounds(chunk(3, 1, 5), chunk(2)) == (1 - 2**63, 2**63 - 1) and bounds(chunk(3, 1, 5), chunk(0)) == (1, 5) and bounds(chunk(3)) == (None, None)
