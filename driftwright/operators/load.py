"""Idempotent loads: reconcile the months on disk with a manifest, then append or reload year tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.types import sql_name, target_type
from ..sources.files import MonthFile, list_parquet

FLUSH_ROWS = 100_000
MANIFEST = "_load_manifest"


class LoaderError(Exception):
    """A load that cannot go on."""


class LoaderConnectionError(LoaderError):
    """The target cannot be reached."""


class LoaderConfigError(LoaderError):
    """The settings make no sense."""


@dataclass(frozen=True)
class YearPlan:
    year: int
    action: str
    months: tuple[int, ...]


def identifier(name: str) -> str:
    """The name, if it is a plain identifier."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name or ""):
        raise LoaderConfigError(f"{name!r} is no identifier")
    return name


def year_table(data_type: str, year: int) -> str:
    return identifier(f"{data_type}_{year}")


def compare_months(disk: DataFrame, manifest: DataFrame) -> DataFrame:
    """``year, month, on_disk, loaded, intact``: every month of either side, and whether both have it with equal rows."""
    both = disk.select("year", "month", F.col("rows").alias("on_disk")).join(manifest.select("year", "month", F.col("row_count").alias("loaded")), ["year", "month"], "full_outer")
    return both.withColumn("intact", F.coalesce(F.col("on_disk") == F.col("loaded"), F.lit(False)))


def reconcile(disk: DataFrame, manifest: DataFrame, counts: DataFrame, full_refresh: bool = False) -> DataFrame:
    """``year, action, months`` per year.

    disk: year, month, rows. manifest: year, month, row_count. counts: year, table_rows.
    A year is reloaded where the table disagrees with the manifest, or a loaded month is gone or changed; new
    months alone are appended; else it is skipped. One full outer join on (year, month), one aggregation by year.
    """
    years = compare_months(disk, manifest).groupBy("year").agg(
        F.coalesce(F.sum("loaded"), F.lit(0)).alias("manifest_rows"), F.bool_or(F.col("on_disk").isNull()).alias("vanished"),
        F.bool_or(F.coalesce(F.col("on_disk") != F.col("loaded"), F.lit(False))).alias("changed"),
        F.sort_array(F.collect_list(F.when(F.col("loaded").isNull(), F.col("month")))).alias("fresh"), F.sort_array(F.collect_list(F.when(F.col("on_disk").isNotNull(), F.col("month")))).alias("present"),
    )
    known = years.join(counts.select("year", "table_rows"), "year", "left").withColumn("table_rows", F.coalesce("table_rows", F.lit(0)))
    wrong = F.lit(full_refresh) | (F.col("table_rows") != F.col("manifest_rows")) | F.col("vanished") | F.col("changed")
    action = F.when(wrong, "reload").when(F.size("fresh") > 0, "append").otherwise("skip")
    months = F.when(F.col("action") == "reload", F.col("present")).when(F.col("action") == "append", F.col("fresh")).otherwise(F.array().cast("array<int>"))
    return known.withColumn("action", action).select("year", "action", months.alias("months"))


class Sink(Protocol):
    """Where year tables and the manifest live. What ``append_all`` writes shows when ``record`` is done."""

    def counts(self, data_type: str) -> dict[int, int]: ...

    def manifest(self, data_type: str) -> list[tuple[int, int, int]]: ...

    def drop_year(self, data_type: str, year: int) -> None: ...

    def append_all(self, data_type: str, year: int, months: dict[int, DataFrame]) -> None: ...

    def record(self, data_type: str, year: int, months: list[tuple[int, int]], replace: bool) -> None: ...


class ParquetSink:
    """Year tables as folders, one per load with a partition per month, and a manifest of numbered versions.

    A load writes its rows into a folder that no version names, checks their number in the footers, and then gives the
    year's next manifest version its name: that rename is the switch. A version says which load holds each month, so a
    reader (``table``) sees the load before or after it and nothing between; folders that the newest version does not
    name are removed after the switch and, where a load died before, at the begin of the next one. One loader at a time
    may write a data type. ``after`` is told each step that is done.
    """

    #: The partition column of the folders; dropped where the table is read.
    MONTH = "load_month"

    def __init__(self, spark: SparkSession, root: str, after: Callable[[str], None] = lambda step: None):
        self.spark, self.root, self.after = spark, root.rstrip("/"), after
        self._staged: dict[tuple[str, int], str] = {}

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path, system = self._path(*parts)
        return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []

    def _versions(self, data_type: str, year: int) -> list[str]:
        return [n for n in self._names(MANIFEST, f"data_type={data_type}", f"year={year}") if re.fullmatch(r"v\d{8}\.json", n)]

    def state(self, data_type: str) -> dict[int, dict[int, tuple[int, str]]]:
        """Per year and month, the rows and the load of the newest manifest versions."""
        newest = {}
        for name in self._names(MANIFEST, f"data_type={data_type}"):
            if (found := re.fullmatch(r"year=(\d+)", name)) and (versions := self._versions(data_type, int(found[1]))):
                newest[int(found[1])] = f"{self.root}/{MANIFEST}/data_type={data_type}/{name}/{versions[-1]}"
        if not newest:
            return {}
        texts = self.spark.read.option("wholetext", True).text(list(newest.values())).collect()  # one short text per year
        held = [json.loads(r[0]) for r in texts]
        return {h["year"]: {int(m): (n, load) for m, (n, load) in h["months"].items()} for h in held}

    def _folders(self, data_type: str, year: int, months: dict[int, tuple[int, str]]) -> list[str]:
        return [f"{self.root}/{year_table(data_type, year)}/load={load}/{self.MONTH}={m}" for m, (_, load) in sorted(months.items())]

    def counts(self, data_type: str) -> dict[int, int]:
        """Rows per year, in the footers of the files that the manifest names: one job for all years."""
        held = {year: months for year, months in self.state(data_type).items() if months}
        files = {p: year for year, months in held.items() for folder in self._folders(data_type, year, months) for p in list_parquet(self.spark, folder)}
        return {year: 0 for year in held} | self._rows(files)

    def _rows(self, files: dict[str, int]) -> dict[int, int]:
        """Rows by the numbers given to files."""
        from ..sources.footer import read_footers

        out: dict[int, int] = {}
        if files:
            for r in read_footers(self.spark, list(files)).groupBy("path").agg(F.max("num_rows").alias("rows")).toLocalIterator():
                out[files[r["path"]]] = out.get(files[r["path"]], 0) + r["rows"]
        return out

    def manifest(self, data_type: str) -> list[tuple[int, int, int]]:
        return sorted((y, m, n) for y, months in self.state(data_type).items() for m, (n, _) in months.items())

    def table(self, data_type: str, year: int) -> DataFrame:
        """The year table as its newest version has it."""
        months = self.state(data_type).get(year)
        if not months:
            raise LoaderError(f"no table {year_table(data_type, year)}")
        return self.spark.read.option("mergeSchema", "true").parquet(*self._folders(data_type, year, months))

    def clean(self, data_type: str, year: int) -> None:
        """Remove the loads that the newest version does not name, and names that were never given."""
        held = {load for _, load in self.state(data_type).get(year, {}).values()}
        table, place = year_table(data_type, year), (MANIFEST, f"data_type={data_type}", f"year={year}")
        gone = [(table, n) for n in self._names(table) if n.startswith("load=") and n[5:] not in held]
        gone += [(*place, n) for n in self._names(*place) if n.endswith(".tmp")]
        for parts in gone:
            path, system = self._path(*parts)
            system.delete(path, True)

    def append_all(self, data_type: str, year: int, months: dict[int, DataFrame]) -> None:
        """Several months in one job, into a folder of their own."""
        self.clean(data_type, year)
        load = uuid.uuid4().hex
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(self.MONTH, F.lit(month)) for month, df in months.items()])
        writer = rows.write.option("compression", "zstd").option("maxRecordsPerFile", 50 * FLUSH_ROWS)
        writer.partitionBy(self.MONTH).parquet(f"{self.root}/{year_table(data_type, year)}/load={load}")
        self._staged[data_type, year] = load
        self.after("staged")

    def record(self, data_type: str, year: int, months: list[tuple[int, int]], replace: bool) -> None:
        """Check the staged months, switch to them, and remove what was before."""
        load = self._staged.pop((data_type, year), "")
        place = f"{self.root}/{year_table(data_type, year)}/load={load}/{self.MONTH}="
        files = {p: m for m, _ in months for p in list_parquet(self.spark, f"{place}{m}")}
        found = self._rows(files)
        wrong = [f"{m}: {found.get(m, 0)} of {n}" for m, n in months if found.get(m, 0) != n]
        if wrong:
            raise LoaderError(f"{year_table(data_type, year)}: rows staged by month {', '.join(wrong)}")
        self.after("verified")
        known = {} if replace else self.state(data_type).get(year, {})
        known = known | {m: (n, load) for m, n in months}
        parts = (MANIFEST, f"data_type={data_type}", f"year={year}")
        versions = self._versions(data_type, year)
        number = int(versions[-1][1:9]) + 1 if versions else 1
        written = {"year": year, "months": {m: list(held) for m, held in sorted(known.items())}, "loaded_at": datetime.now(UTC).isoformat()}
        draft, system = self._path(*parts, f"{uuid.uuid4().hex}.tmp")
        out = system.create(draft)
        out.write(bytearray(json.dumps(written).encode()))
        out.close()
        self.after("drafted")
        target, _ = self._path(*parts, f"v{number:08d}.json")
        if system.exists(target) or not system.rename(draft, target):
            raise LoaderError(f"another loader wrote {target}")
        self.after("switched")
        self.clean(data_type, year)
        self.after("cleaned")

    def drop_year(self, data_type: str, year: int) -> None:
        self.record(data_type, year, [], True)


@dataclass(frozen=True)
class Connection:
    host: str
    database: str
    user: str
    password: str
    port: int = 1433
    schema: str = "dbo"


def plan_years(spark: SparkSession, months: list[MonthFile], sink: Sink, data_type: str, full_refresh: bool = False) -> list[YearPlan]:
    """The reconciled plan of one type."""
    disk = spark.createDataFrame([(m.year, m.month, m.source_row_count) for m in months], "year int, month int, rows bigint")
    manifest = spark.createDataFrame(sink.manifest(data_type), "year int, month int, row_count bigint")
    counts = spark.createDataFrame(list(sink.counts(data_type).items()), "year int, table_rows bigint")
    return [YearPlan(r["year"], r["action"], tuple(r["months"])) for r in reconcile(disk, manifest, counts, full_refresh).orderBy("year").collect()]


def execute(spark: SparkSession, plan: YearPlan, months: list[MonthFile], sink: Sink, data_type: str) -> int:
    """Carry out one year: the rows that were written. All its months go in one job; nothing of the year is dropped before
    the sink switches to the new rows."""
    if plan.action == "skip":
        return 0
    if not plan.months:
        sink.drop_year(data_type, plan.year)
        return 0
    at = {m.month: m for m in months if m.year == plan.year}
    sink.append_all(data_type, plan.year, {month: spark.read.parquet(*at[month].paths) for month in plan.months})
    written = [(month, at[month].source_row_count) for month in plan.months]
    sink.record(data_type, plan.year, written, plan.action == "reload")
    return sum(n for _, n in written)


def create_table_sql(table: str, columns: list[tuple[str, str]], compress: bool = True) -> str:
    body = ",\n".join(f"    {name} {kind}" for name, kind in columns)
    return f"CREATE TABLE {table} (\n{body}\n)" + (" WITH (DATA_COMPRESSION = PAGE);" if compress else ";")


def create_table_for(df: DataFrame, table: str) -> str:
    """DDL of a table for the rows of ``df``."""
    return create_table_sql(table, [(f"[{f.name}]", target_type(sql_name(f.dataType))) for f in df.schema.fields])


def manifest_sql(schema: str = "dbo") -> str:
    columns = [("data_type", "NVARCHAR(32) NOT NULL"), ("year", "INT NOT NULL"), ("month", "INT NOT NULL"), ("row_count", "BIGINT NOT NULL"), ("loaded_at", "DATETIME2 NOT NULL")]
    body = ",\n".join([f"    {n} {k}" for n, k in columns] + [f"    CONSTRAINT pk_{MANIFEST} PRIMARY KEY (data_type, year, month)"])
    return f"CREATE TABLE {identifier(schema)}.{MANIFEST} (\n{body}\n) WITH (DATA_COMPRESSION = PAGE);"


def insert_sql(table: str, columns: list[str]) -> str:
    return f"INSERT INTO {table} ({', '.join(columns)}) VALUES ({', '.join(f'@p{k + 1}' for k in range(len(columns)))})"


def update_sql(table: str, columns: list[str], keys: list[str]) -> str:
    """Other columns are set, keys select; parameters are numbered in the order of writing."""
    rest = [c for c in columns if c not in keys]
    place = {c: f"@p{k + 1}" for k, c in enumerate([*rest, *keys])}
    return f"UPDATE {table} SET {', '.join(f'{c} = {place[c]}' for c in rest)} WHERE {' AND '.join(f'{c} = {place[c]}' for c in keys)}"


def delete_sql(table: str, keys: list[str]) -> str:
    return f"DELETE FROM {table} WHERE {' AND '.join(f'{c} = @p{k + 1}' for k, c in enumerate(keys))}"
