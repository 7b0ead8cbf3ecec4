"""Both sinks: loads that die between any two steps, typed database tables, read-back, and the command line."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwright.cli import PASSWORD, main
from driftwright.functions.types import TypeMappingError
from driftwright.operators.database import DIALECTS, JdbcSink, typed
from driftwright.operators.load import Connection, LoaderConfigError, LoaderConnectionError, LoaderError, ParquetSink, execute, plan_years
from driftwright.session import configure
from driftwright.sources.files import month_files

ROWS = "vendorid bigint, pickup timestamp_ntz, distance double, flag string, month int"


def put(spark, disk, when, n, schema=ROWS, data_type="yellow"):
    folder = disk / data_type / when[:4]
    rows = [(k, datetime(2023, 1, 1, k % 24), k * 1.5, None if k % 3 else "é" * k, 7)[: len(schema.split(", "))] for k in range(n)]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(str(folder / "out"))
    (part,) = (folder / "out").glob("part-*.parquet")
    part.rename(folder / f"{data_type}_tripdata_{when}.parquet")


class Killed(BaseException):
    """Not an error that anything on the way would handle."""


def sinks(spark, tmp_path, kind, after=lambda step: None):
    if kind == "parquet":
        return ParquetSink(spark, str(tmp_path / "warehouse"), after)
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    sink = JdbcSink(spark, Connection("", str(tmp_path / "db"), "loader", "secret", schema="TRIPS"), "derby", flush_rows=3, connections=3, after=after)
    sink.provision()
    return sink


def turn(spark, disk, sink, full=False):
    months = month_files(spark, str(disk / "yellow"))
    plans = plan_years(spark, months, sink, "yellow", full)
    for plan in plans:
        execute(spark, plan, months, sink, "yellow")
    return [(p.year, p.action, list(p.months)) for p in plans]


STEPS = {"parquet": ["staged", "verified", "drafted", "switched", "cleaned"], "jdbc": ["created", "staged", "verified", "moved", "recorded", "committed"]}


@pytest.mark.parametrize("kind", ["parquet", "jdbc"])
def test_a_load_that_dies_anywhere_shows_the_state_before_or_after(spark, tmp_path, kind):
    configure(spark)
    disk = tmp_path / "normalized"
    put(spark, disk, "2023-01", 5)
    assert turn(spark, disk, sinks(spark, tmp_path, kind)) == [(2023, "append", [1])]
    rows = {1: 5}
    for number, step in enumerate([*STEPS[kind], *STEPS[kind]]):
        before = dict(rows)
        if number < len(STEPS[kind]):  # a changed month: the year is loaded anew
            rows[1] = 6 + number
            put(spark, disk, "2023-01", rows[1])
        else:  # a new month
            rows[2 + number - len(STEPS[kind])] = 3
            put(spark, disk, f"2023-{max(rows):02d}", 3)

        def die(at, step=step):
            if at == step:
                raise Killed

        with pytest.raises(Killed):
            turn(spark, disk, sinks(spark, tmp_path, kind, die))
        fresh = sinks(spark, tmp_path, kind)
        shown = {m: n for _, m, n in fresh.manifest("yellow")}
        assert shown in (before, rows) and fresh.table("yellow", 2023).count() == sum(shown.values()) == fresh.counts("yellow")[2023]
        assert shown == (rows if step in ("switched", "cleaned", "committed") else before)
        turn(spark, disk, fresh)
        assert {m: n for _, m, n in fresh.manifest("yellow")} == rows and fresh.counts("yellow") == {2023: sum(rows.values())}
        assert turn(spark, disk, fresh) == [(2023, "skip", [])]
    left = fresh._names("yellow_2023") if kind == "parquet" else fresh.tables(".*_stage_.*")
    assert len(left) == (len({load for _, load in fresh.state("yellow")[2023].values()}) if kind == "parquet" else 0)


@pytest.mark.parametrize("kind", ["parquet", "jdbc"])
def test_loads_and_vanished_years(spark, tmp_path, kind):
    configure(spark)
    disk, sink = tmp_path / "normalized", sinks(spark, tmp_path, kind)
    for when, n in (("2023-01", 3), ("2023-02", 4), ("2024-01", 5)):
        put(spark, disk, when, n)
    assert turn(spark, disk, sink) == [(2023, "append", [1, 2]), (2024, "append", [1])] and sink.counts("yellow") == {2023: 7, 2024: 5}
    assert turn(spark, disk, sink, full=True) == [(2023, "reload", [1, 2]), (2024, "reload", [1])] and sink.counts("yellow") == {2023: 7, 2024: 5}
    (disk / "yellow/2024/yellow_tripdata_2024-01.parquet").unlink()
    assert turn(spark, disk, sink) == [(2023, "skip", []), (2024, "reload", [])]
    assert sink.counts("yellow") == {2023: 7} and sink.manifest("yellow") == [(2023, 1, 3), (2023, 2, 4)]
    assert turn(spark, disk, sink) == [(2023, "skip", [])]
    found = sorted(tuple(r) for r in sink.table("yellow", 2023).select("vendorid", "pickup", "distance", "flag", "month").collect())
    assert found == sorted((k, datetime(2023, 1, 1, k), k * 1.5, None if k % 3 else "é" * k, 7) for n in (3, 4) for k in range(n))


@pytest.mark.parametrize("kind", ["parquet", "jdbc"])
def test_a_wrong_number_of_staged_rows_is_not_recorded(spark, tmp_path, kind):
    configure(spark)
    disk, sink = tmp_path / "normalized", sinks(spark, tmp_path, kind)
    put(spark, disk, "2023-01", 3)
    turn(spark, disk, sink)
    sink.append_all("yellow", 2023, {2: spark.read.parquet(str(disk / "yellow/2023/*.parquet"))})
    with pytest.raises(LoaderError, match="3 of 4"):
        sink.record("yellow", 2023, [(2, 4)], False)
    assert sink.counts("yellow") == {2023: 3} and turn(spark, disk, sink) == [(2023, "skip", [])]


def test_database_tables_are_typed(spark, tmp_path):
    sink = sinks(spark, tmp_path, "jdbc")
    schema = T.StructType([T.StructField(n, k) for n, k in [("Tiny", T.ByteType()), ("small", T.ShortType()), ("i", T.IntegerType()), ("l", T.LongType()), ("f", T.FloatType()), ("d", T.DoubleType()), ("dec", T.DecimalType(12, 3)), ("select", T.StringType()), ("b", T.BooleanType()), ("day", T.DateType()), ("at", T.TimestampNTZType()), ("raw", T.BinaryType()), ('odd "name"', T.IntegerType())]])
    row = (1, 2, 3, 2**60, 1.5, 2.25, Decimal("1.125"), "long " * 20_000, True, datetime(2024, 2, 29).date(), datetime(2024, 2, 29, 1, 2, 3, 456000), bytearray(b"\x00\xff"), 4)
    df = spark.createDataFrame([row, (None,) * 13], schema)
    sink.append_all("t", 2024, {1: df})
    sink.record("t", 2024, [(1, 2)], False)
    assert sink.columns("t_2024") == {"Tiny": "SMALLINT", "small": "SMALLINT", "i": "INTEGER", "l": "BIGINT", "f": "REAL", "d": "DOUBLE", "dec": "DECIMAL", "select": "CLOB", "b": "BOOLEAN", "day": "DATE", "at": "TIMESTAMP", "raw": "BLOB", 'odd "name"': "INTEGER"}
    back = typed(sink.table("t", 2024), schema)
    assert back.schema.simpleString() == schema.simpleString() and sorted(map(tuple, back.collect()), key=str) == sorted([row, (None,) * 13], key=str)
    sink.append_all("t", 2024, {2: df.withColumn("more", F.lit(1))})
    with pytest.raises(LoaderError, match="more"):
        sink.record("t", 2024, [(2, 2)], False)
    with pytest.raises(TypeMappingError):
        sink.append_all("t", 2024, {2: df.withColumn("list", F.array(F.lit(1)))})
    with pytest.raises(LoaderConfigError):
        sink.table("t", 2024, "no such column")


def test_read_back_is_partitioned(spark, tmp_path):
    sink = sinks(spark, tmp_path, "jdbc")
    df = spark.range(1000).withColumn("at", F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz"))
    sink.append_all("t", 2024, {1: df})
    sink.record("t", 2024, [(1, 1000)], False)
    for by in ("id", "at"):
        found = sink.table("t", 2024, by)
        assert found.rdd.getNumPartitions() == 3 and found.distinct().count() == 1000 == found.count()
    assert sink.table("t", 2024).rdd.getNumPartitions() == 1


def test_what_other_databases_are_told(spark):
    server = DIALECTS["sqlserver"]
    to = Connection("db.example", "taxi", "sa", "x")
    assert server.url(to).startswith("jdbc:sqlserver://db.example:1433;databaseName=taxi;") and "databaseName=master" in server.url(to, "master")
    assert server.table("[dbo].[t]", spark.createDataFrame([], "`a]b` int, c string")) == "CREATE TABLE [dbo].[t] (\n    [a]]b] INT,\n    [c] NVARCHAR(MAX)\n) WITH (DATA_COMPRESSION = PAGE)"
    assert server.options(5)["bulkCopyForBatchInsertBatchSize"] == "5" and "IF DB_ID('taxi') IS NULL" in server.database("taxi")
    with pytest.raises(LoaderConfigError):
        server.database("x'; DROP")
    with pytest.raises(LoaderConfigError):
        JdbcSink(spark, to, "derby", flush_rows=0)
    assert DIALECTS["derby"].url(to) == "jdbc:derby://db.example:1433/taxi;create=true"
    with pytest.raises(LoaderConnectionError), JdbcSink(spark, Connection("", "/proc/none/db", "u", "p"), "derby").connected():
        pass


def test_the_command_line_loads_into_a_database(spark, tmp_path, monkeypatch, capsys):
    configure(spark)
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    for when, n in (("2023-01", 3), ("2024-01", 5)):
        put(spark, tmp_path / "normalized", when, n)
    run = lambda *options: main(["load", "yellow", "--sink", "jdbc", "--dialect", "derby", "--host", "", "--database", str(tmp_path / "db"), "--schema", "TRIPS", "--user", "loader", "--flush-rows", "2", "--data-dir", str(tmp_path), *options], spark)
    monkeypatch.delenv(PASSWORD, raising=False)
    assert run() == 2 and PASSWORD in capsys.readouterr().err
    monkeypatch.setenv(PASSWORD, "secret")
    assert run("--dry-run") == 0 and capsys.readouterr().out.splitlines() == ["yellow 2023: append [1]", "yellow 2024: append [1]"]
    assert run() == 0 and run() == 0 and capsys.readouterr().out.splitlines()[2:] == ["yellow 2023: skip []", "yellow 2024: skip []"]
    assert run("--full-refresh") == 0 and run("--schema", "no-name") == 2
    sink = JdbcSink(spark, Connection("", str(tmp_path / "db"), "loader", "secret", schema="TRIPS"), "derby")
    assert sink.counts("yellow") == {2023: 3, 2024: 5} and sink.manifest("yellow") == [(2023, 1, 3), (2024, 1, 5)]
    put(spark, tmp_path / "normalized", "2023-02", 2, schema=ROWS.rsplit(", ", 1)[0])  # lacks a column: that year fails alone
    put(spark, tmp_path / "normalized", "2024-02", 2)
    assert run() == 1 and sink.counts("yellow") == {2023: 3, 2024: 7}


def test_a_stage_that_breaks_is_an_outcome(spark, tmp_path, monkeypatch, capsys):
    def breaks(spark, name, *rest):
        if name == "yellow":
            spark.sql("SELECT no_such_column")
        return 0

    monkeypatch.setattr("driftwright.cli.normalize", breaks)
    assert main(["run", "yellow", "green", "--skip-download", "--data-dir", str(tmp_path)], spark) == 2
    told = capsys.readouterr()
    assert "yellow normalize" in told.err and "NORMALIZE ERROR" in told.out and "OK" in told.out


def test_an_embedded_database_takes_and_gives_rows_as_files(spark, tmp_path):
    """As on a cluster, whose executors cannot connect to an engine in the driver: every type and odd text, and all ranges."""
    sinks(spark, tmp_path, "jdbc")
    sink = JdbcSink(spark, Connection("", str(tmp_path / "db"), "loader", "secret", schema="TRIPS"), "derby", flush_rows=3, connections=3, by_files=True)
    schema = T.StructType([T.StructField(n, k) for n, k in [("small", T.ShortType()), ("l", T.LongType()), ("f", T.FloatType()), ("d", T.DoubleType()), ("dec", T.DecimalType(12, 3)), ("select", T.StringType()), ("b", T.BooleanType()), ("day", T.DateType()), ("at", T.TimestampNTZType()), ("raw", T.BinaryType()), ('odd "name"', T.IntegerType())]])
    texts = ["long " * 20_000, "", " ", 'a "quoted", text', "two\nlines\r\nand\rmore", "\\", 'é\\"', '"', None, " x ", ",", "NULL"]
    rows = [(k, 2**60 + k, 1.5, 0.1 + k, Decimal("1.125"), text, k % 2 == 0, datetime(2024, 2, 29).date(), datetime(2024, 2, 29, 1, 2, 3, 456000 + k), bytearray(b"\x00\xff"[: k % 3]), 4) for k, text in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None,) * 11], schema)
    sink.append_all("t", 2024, {1: df})
    sink.record("t", 2024, [(1, len(rows) + 1)], False)
    for by in (None, "l", "small", "d", "at", "day"):
        back = typed(sink.table("t", 2024, by), schema)
        assert back.schema.simpleString() == schema.simpleString() and sorted(map(tuple, back.collect()), key=str) == sorted([*rows, (None,) * 11], key=str), by
    single = spark.createDataFrame([("",), (None,)], "only string")
    sink.append_all("u", 2024, {1: single})
    sink.record("u", 2024, [(1, 2)], False)
    assert sorted(map(tuple, sink.table("u", 2024).collect()), key=str) == [("",), (None,)]
