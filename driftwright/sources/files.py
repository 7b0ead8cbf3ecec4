"""File families: monthly parquet files of one data type, found through the Hadoop file system that Spark uses."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

PERIOD = r"_([^_/]+)\.parquet$"
#: Year and month at the end of a monthly file's name, and in the folders of a partitioned family.
NAMED_MONTH = r"(?:^|_)(\d{4})-(0[1-9]|1[0-2])\.parquet$"
FOLDER_MONTH = re.compile(r"/year=(\d{4})/month=(0?[1-9]|1[0-2])/[^/]+$")


@dataclass(frozen=True)
class MonthFile:
    """One month of a family: its file, or its first one and the others."""

    year: int
    month: int
    path: str
    source_row_count: int
    others: tuple[str, ...] = ()

    @property
    def paths(self) -> list[str]:
        return [self.path, *self.others]


def list_parquet(spark: SparkSession, folder: str) -> list[str]:
    """All parquet files under a folder, by path; none if the folder is missing."""
    jvm, found = spark._jvm, []
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    each = system.listFiles(path, True)
    while each.hasNext():
        name = each.next().getPath().toString()
        if name.endswith(".parquet"):
            found.append(re.sub(r"^file:/+", "/", name))
    return sorted(found)


def period(path: str) -> str:
    """The month of the file's partition folders as ``2024-01``, else the last part of its stem: of ``x_2024-01.parquet`` the same."""
    if found := FOLDER_MONTH.search(path):
        return f"{found[1]}-{int(found[2]):02d}"
    return path.rsplit("/", 1)[-1].removesuffix(".parquet").rsplit("_", 1)[-1]


def period_column(path: Column) -> Column:
    """As ``period``, over a column; empty where a name has no last part."""
    year, month = (F.regexp_extract(path, FOLDER_MONTH.pattern, k) for k in (1, 2))
    return F.when(year != "", F.concat(year, F.lit("-"), F.lpad(month, 2, "0"))).otherwise(F.regexp_extract(path, PERIOD, 1))


def family(spark: SparkSession, folder: str, data_type: str) -> list[str]:
    """The type's monthly files; where none has its name, all parquet files of the folder."""
    every = list_parquet(spark, folder)
    named = [p for p in every if p.rsplit("/", 1)[-1].startswith(f"{data_type}_tripdata_")]
    return named or every


def by_period(paths: list[str]) -> list[str]:
    return sorted(paths, key=lambda p: (period(p), p))


def month_of(path: str) -> tuple[int, int] | None:
    """Year and month of the file's partition folders, else those that end its name, else None."""
    found = FOLDER_MONTH.search(path) or re.search(NAMED_MONTH, path.rsplit("/", 1)[-1])
    return (int(found[1]), int(found[2])) if found else None


def month_files(spark: SparkSession, folder: str) -> list[MonthFile]:
    """The months on disk with their rows, counted in the footers.

    A month has all part files of its partition folder; a file of the month's name counts where it has no folder.
    """
    from .footer import read_footers

    months: dict[tuple[int, int], dict[bool, list[str]]] = {}
    for p in list_parquet(spark, folder):
        if when := month_of(p):
            months.setdefault(when, {}).setdefault(bool(FOLDER_MONTH.search(p)), []).append(p)
    chosen = {when: sorted(found.get(True) or found[False]) for when, found in sorted(months.items())}
    paths = [p for own in chosen.values() for p in own]
    if not paths:
        return []
    counts = {r["path"]: r["rows"] for r in read_footers(spark, paths).groupBy("path").agg(F.max("num_rows").alias("rows")).collect()}
    return [MonthFile(*when, own[0], sum(counts[p] for p in own), tuple(own[1:])) for when, own in chosen.items()]


def is_parquet(path: str) -> bool:
    """At least eight bytes, with the format's mark at both ends."""
    try:
        with open(path, "rb") as data:
            head = data.read(4)
            size = data.seek(0, 2)
            data.seek(max(size - 4, 0))
            return size >= 8 and head == b"PAR1" == data.read(4)
    except OSError:
        return False


def drop_corrupt(folder: str, spark: SparkSession | None = None) -> int:
    """Delete what is named as parquet under a folder, on any file system, and is none; how many there were. Files that
    cannot be read stay."""
    from .footer import read_marks

    session = spark or SparkSession.builder.getOrCreate()
    paths = list_parquet(session, folder)
    bad = [r["path"] for r in read_marks(session, paths).where("not valid").toLocalIterator()] if paths else []
    for path in bad:
        target = session._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(session._jsc.hadoopConfiguration()).delete(target, False)
    return len(bad)
