"""Normalising one data type: plan every file from footers, write all or nothing."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from ..sources.files import family, list_parquet, month_of
from ..sources.footer import file_stats, read_footers
from .bootstrap import bootstrap, claims
from .mapping import Mapping, MappingError, load
from .planner import Plan, first_details, plan_file
from .transform import group_by_plan, write, write_file


def plan_family(footers: DataFrame, pinned: str, mapping: Mapping) -> list[tuple[Plan, list[str]]]:
    """The plans of a family with the files of each, by first file.

    What a plan depends on is decided per column in the engine (``claims``): its type, the target column it goes to,
    whether its bounds fit there, and whether values would be lost. Files whose columns all agree in that have one
    fingerprint, hence one plan, which is made from the footer of the first of them. The driver sees a row per
    fingerprint, however many files there are, and the names of the files.
    """
    target = footers.where((F.col("path") == pinned) & F.col("error").isNull())
    wanted = target.select(F.col("column").alias("name"), F.col("dtype").alias("wanted"))
    fate = F.struct("ordinal", "column", "dtype", "goes_to", "out", "unsafe", "lost")
    places = footers.where("error is null").select("path", "column", "ordinal")
    decided = claims(footers, wanted, mapping.renames).join(places, ["path", "column"])
    prints = decided.groupBy("path").agg(F.md5(F.to_json(F.sort_array(F.collect_list(fate))).cast("binary")).alias("print"))
    groups = prints.groupBy("print").agg(F.sort_array(F.collect_list("path")).alias("paths")).select(F.col("paths")[0].alias("first"), "paths").orderBy("first").collect()
    firsts = [r["first"] for r in groups]
    stats = file_stats(footers.where(F.col("path").isin([*firsts, pinned])))
    plans = {r["first"]: plan_file(stats[r["first"]], stats[pinned], mapping) for r in groups}
    paths = {r["first"]: r["paths"] for r in groups}
    return [(plan, [p for first in same for p in paths[first]]) for plan, same in group_by_plan(plans)]


def normalize(spark: SparkSession, data_type: str, raw: str, mapping_path: str, out: str, sample: str = "100%", one_file: bool = False, say: Callable[[str], None] = print) -> int:
    """Exit code: 0 done, 1 open items (none written), 2 error, 3 a first mapping was written for review.

    one_file: keep one file per month under its raw name; else partitions year= and month=. Months that are already
    written are skipped in both layouts.
    """
    paths = family(spark, raw, data_type)
    if not paths:
        say(f"{data_type}: no raw files under {raw}")
        return 0
    if not Path(mapping_path).exists():
        _, items, _ = bootstrap(spark, raw, data_type, mapping_path, sample)
        say(f"{data_type}: wrote {mapping_path} with {items} item(s) to settle; review it and run again")
        return 3
    try:
        mapping = load(mapping_path)
    except MappingError as problem:
        say(str(problem))
        return 2
    folder = scratch(spark)
    read_footers(spark, paths).write.parquet(folder)  # read by all that follows
    footers = spark.read.parquet(folder)
    pinned = next((p for p in paths if p.rsplit("/", 1)[-1] == mapping.target), None)
    if pinned is None or footers.where((F.col("path") == pinned) & F.col("error").isNull()).isEmpty():
        say(f"{data_type}: the pinned file {mapping.target} is not under {raw}")
        return 2
    groups = plan_family(footers, pinned, mapping)
    if items := first_details([plan for plan, _ in groups]):
        bootstrap(spark, raw, data_type, mapping_path, sample)
        for item in items:
            say(f"{data_type}: {item.kind}: {item.column}: {item.details}")
        return 1
    for plan, _ in groups:
        for line in dict.fromkeys(plan.warnings):
            say(f"{data_type}: {line}")
    plans = {p: plan for plan, own in groups for p in own}
    there = list_parquet(spark, out)
    if one_file:
        names = {p.rsplit("/", 1)[-1] for p in there}
        for path, plan in plans.items():
            name = path.rsplit("/", 1)[-1]
            if name not in names:
                when = month_of(path)
                write_file(spark, path, plan, f"{out}/{when[0] if when else 'undated'}/{name}")
        return 0
    done = {f"year={y}/month={m}/" for y, m in filter(None, map(month_of, plans)) if any(f"/year={y}/month={m}/" in p for p in there)}
    todo = {p: plan for p, plan in plans.items() if (when := month_of(p)) and f"year={when[0]}/month={when[1]}/" not in done}
    if todo:
        write(spark, todo, out)
    return 0
