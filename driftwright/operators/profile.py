"""Column profiles in one pass, sampling, and precision scans."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import loses_precision
from ..functions.columns import column as quoted_column
from ..functions.hashing import least_hash, row_hash
from ..functions.types import sql_name

TOP = 5


def parse_sample(text: str) -> int | str:
    """Rows (an int), a percentage as ``p%``, or 0 for everything (no percentage between 0 and 100)."""
    text = text.strip()
    if part := re.fullmatch(r"(-?\d+)\s*%", text):
        return f"{int(part[1])}%" if 0 < int(part[1]) < 100 else 0
    if re.fullmatch(r"-?\d+", text):
        return int(text)
    raise ValueError(f"a sample is a number of rows or a percentage, not {text!r}")


def sample(df: DataFrame, size: int | str, keys: list[str] | None = None) -> DataFrame:
    """Rows by their hash: the ``size`` least, those under ``p%`` of all hashes, or everything.

    keys: the columns that tell rows apart, all by default. Rows with equal keys are in or out of a percentage together.
    The least hashes are kept by each task and merged, so the table is neither sorted nor gathered.
    """
    if not isinstance(size, str) and size <= 0:
        return df
    mark = row_hash(keys or df.columns)
    if isinstance(size, str):
        return df.where(mark < least_hash(int(size.rstrip("%")) / 100))
    return df.orderBy(mark).limit(size)


def as_number(name: str, kind: T.DataType) -> Column | None:
    """The column as a double where its type has numbers in it, else None: dates and nested values have none."""
    if isinstance(kind, T.NumericType):
        return quoted_column(name).cast("double")
    if isinstance(kind, T.BooleanType):
        return quoted_column(name).cast("int").cast("double")
    if isinstance(kind, T.StringType):
        value = F.trim(quoted_column(name))
        return F.when(~value.rlike(r"(?i)[df]$") | value.rlike(r"(?i)inf$"), value.try_cast("double"))
    return None


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, place, value, mark, number, n``: how often each column has each value.

    One aggregation for all columns, combined before it is shuffled: a row becomes one (column, value) per column in
    its task, and each task sends a value once. mark tells values apart whose text may be equal; null values count too.
    """
    kinds, cells = {f.name: f.dataType for f in df.schema.fields}, []
    for place, name in enumerate(columns):
        own, kind = quoted_column(name), kinds[name]
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            own = own + F.lit(0.0).cast(kind)  # zero and minus zero are one value
        number = as_number(name, kind)
        plain = isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))
        mark = F.lit(None).cast("string") if plain else F.md5(own) if isinstance(kind, T.BinaryType) else F.md5(F.to_json(F.struct(own.alias("v"))).cast("binary"))
        cells.append(F.struct(F.lit(place).alias("place"), own.cast("string").alias("value"), mark.alias("mark"), (F.lit(None).cast("double") if number is None else number).alias("number")))
    names = F.array(*(F.lit(c) for c in columns))
    each = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    counted = each.groupBy("place", "value", "mark").agg(F.max("number").alias("number"), F.count("*").alias("n"))
    return counted.withColumn("column", F.element_at(names, F.col("place") + 1))


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: counts, distinct values, numeric range and mean, and the most frequent values.

    Everything follows from the counts of the values: the table is read and shuffled once, whatever its width.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    kinds = F.create_map(*(F.lit(x) for f in fields for x in (f.name, sql_name(f.dataType))))
    counted = value_counts(df, [f.name for f in fields])
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    weighted = F.sum(F.col("number") * F.col("n")) / F.sum(F.when(F.col("number").isNotNull(), F.col("n")))
    stats = counted.groupBy("column").agg(
        F.sum("n").alias("total_count"), F.coalesce(F.sum(known), F.lit(0)).alias("non_null_count"), F.count("value").alias("unique_count"),
        F.min("number").alias("min"), F.max("number").alias("max"), weighted.alias("avg"),
    )
    every = df.sparkSession.createDataFrame([(f.name,) for f in fields], "column string")
    zeros = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("total_count", "non_null_count", "unique_count")}
    found = every.join(stats, "column", "left").join(most_frequent(counted), "column", "left")
    return found.select("column", kinds[F.col("column")].alias("dtype"), *zeros.values(), "min", "max", "avg", "top_values")


def most_frequent(counted: DataFrame, k: int = TOP) -> DataFrame:
    """``column, top_values``: the k most frequent values as text, ties by value; each task hands on its k best."""
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value", "mark")
    best = counted.where("value is not null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("rank", "value"))).alias("v")).select("column", F.transform("v", lambda x: x["value"]).alias("top_values"))


def top_values(df: DataFrame, columns: list[str], k: int = TOP) -> DataFrame:
    return most_frequent(value_counts(df, columns), k)


def precision_loss(df: DataFrame, column: str, target: str) -> DataFrame:
    """``lossy_rows``: how many values an integer cast would change; never sampled."""
    return df.agg(F.count_if(loses_precision(quoted_column(column), target)).alias("lossy_rows"))
