"""One table over a family whose files have different schemas."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import exact_cast
from ..functions.columns import column
from ..functions.types import INTEGER_BITS, family, spark_type
from .files import list_parquet
from .footer import read_footers

#: Decimal digits that hold every value of an integer type.
_DIGITS = {"TINYINT": 3, "SMALLINT": 5, "INTEGER": 10, "BIGINT": 19}


def common_type(a: str, b: str) -> str:
    """The least type that holds the values of both: integers widen, decimals keep all digits while 38 do, numbers of
    different kinds meet in DOUBLE, dates and times in TIMESTAMP, everything else in VARCHAR."""
    if a == b:
        return a
    if a in INTEGER_BITS and b in INTEGER_BITS:
        return max(a, b, key=INTEGER_BITS.__getitem__)
    sizes = [(int(m[1]), int(m[2])) if (m := re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", x)) else (_DIGITS[x], 0) if x in _DIGITS else None for x in (a, b)]
    if all(sizes):
        scale = max(s for _, s in sizes)
        whole = max(p - s for p, s in sizes)
        return f"DECIMAL({whole + scale},{scale})" if whole + scale <= 38 else "DOUBLE"
    kinds = {family(a), family(b)}
    if kinds == {"numeric"}:
        return "DOUBLE"
    if kinds == {"temporal"} and {a, b} == {"DATE", "TIMESTAMP"}:
        return "TIMESTAMP"
    return "VARCHAR"


def expand(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Parquet files of paths, folders and globs, on any file system; each once, in order."""
    jvm, found = spark._jvm, []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.globStatus(path) or []:
            found += list_parquet(spark, status.getPath().toString())
    return list(dict.fromkeys(found))


def scan(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """All rows of the files, columns by name in the order in which files (by path) first show them; a column has the
    common type of its files, and is null where a file lacks it.

    Schemas come from one job over the footers; files of one schema are one scan, so filters and columns reach each of
    them, and there are as many scans as schemas, not files.
    """
    paths = expand(spark, patterns)
    if not paths:
        raise FileNotFoundError(f"no parquet file in {patterns}")
    rows = read_footers(spark, paths).where("error is null").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ordinal", "column", "dtype"))).alias("c"))
    groups = rows.groupBy(F.transform("c", lambda x: F.struct(x["column"].alias("name"), x["dtype"].alias("dtype"))).alias("columns")).agg(F.sort_array(F.collect_list("path")).alias("paths"))
    known = sorted(([(c["name"], c["dtype"]) for c in r["columns"]], r["paths"]) for r in groups.collect())
    known.sort(key=lambda g: g[1][0])
    types: dict[str, str] = {}
    for columns, _ in known:
        for name, kind in columns:
            types[name] = common_type(types[name], kind) if name in types else kind
    parts = []
    for columns, own in known:
        df, held = spark.read.parquet(*own), dict(columns)
        kept = [column(n).alias(n) if held[n] == types[n] else exact_cast(column(n), held[n], types[n]).alias(n) for n in held]
        missing = [F.lit(None).cast(spark_type(types[n])).alias(n) for n in types if n not in held]
        parts.append(df.select(*kept, *missing).select(*(column(n) for n in types)))
    return reduce(DataFrame.unionByName, parts)
