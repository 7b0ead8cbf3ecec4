"""Plans as DataFrames: actions become columns; files of equal plan are read and written in one job."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import exact_cast
from ..functions.columns import column
from ..functions.types import spark_type
from ..sources.files import NAMED_MONTH
from .planner import Action, Plan


def compile_action(action: Action) -> Column:
    """One column of the output."""
    kind = spark_type(action.target_type)
    if action.kind == "null_fill":
        return F.lit(None).cast(kind).alias(action.target)
    source = column(action.source)
    if action.kind == "value_map":
        text = source.cast("string")
        if action.on_unmapped == "error":
            rest = F.raise_error(F.concat(F.lit(f"value_map: unmapped value in {action.source}: "), text)).cast(kind)
        else:
            rest = F.lit(None).cast(kind)
        mapped = F.when(source.isNull(), F.lit(None).cast(kind))
        for key, value in action.values:
            mapped = mapped.when(text == key, F.lit(value).cast(kind))
        return mapped.otherwise(rest).alias(action.target)
    if action.source_type == action.target_type:
        return source.alias(action.target)
    return exact_cast(source, action.source_type, action.target_type).alias(action.target)


def apply(df: DataFrame, plan: Plan) -> DataFrame:
    """The normalised columns, in target order; what no action reads is never scanned."""
    return df.select(*(compile_action(a) for a in plan.actions))


def group_by_plan(plans: dict[str, Plan]) -> list[tuple[Plan, list[str]]]:
    """Files whose plans are the same; equal plans mean equal source types, so one reader schema serves all. Files with open
    items stay apart from those without."""
    groups: dict[tuple, list[str]] = {}
    for path, plan in plans.items():
        groups.setdefault((tuple(plan.actions), tuple(plan.unresolved), tuple(plan.warnings)), []).append(path)
    return [(plans[paths[0]], sorted(paths)) for paths in groups.values()]


def normalized(spark: SparkSession, plans: dict[str, Plan]) -> DataFrame:
    """All files together, with ``year`` and ``month`` from the file names: one scan per group of equal plans."""
    out: DataFrame | None = None
    for plan, paths in group_by_plan(plans):
        raw = spark.read.parquet(*paths)
        part_of = lambda k: F.regexp_extract(F.col("_metadata.file_name"), NAMED_MONTH, k).cast("int")
        part = raw.select(*(compile_action(a) for a in plan.actions), part_of(1).alias("year"), part_of(2).alias("month"))
        out = part if out is None else out.unionByName(part)
    return out


def write(spark: SparkSession, plans: dict[str, Plan], folder: str) -> None:
    """Partitions year= and month= under a folder; only the months at hand are replaced, by the committer at once."""
    df = normalized(spark, plans)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "month").parquet(folder)


def write_file(spark: SparkSession, path: str, plan: Plan, target: str) -> None:
    """One file of exactly this name: written to a staging folder beside the output tree, then renamed."""
    system_path = spark._jvm.org.apache.hadoop.fs.Path
    final = system_path(target)
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    staging = re.sub(r"[^/]+/?$", "", target.rstrip("/")).rstrip("/") + "/_staging_" + final.getName()
    apply(spark.read.parquet(path), plan).coalesce(1).write.mode("overwrite").option("compression", "zstd").parquet(staging)
    part = next(s.getPath() for s in system.listStatus(system_path(staging)) if s.getPath().getName().startswith("part-"))
    system.delete(final, False)
    if not system.rename(part, final):
        raise OSError(f"could not publish {target}")
    system.delete(system_path(staging), True)
