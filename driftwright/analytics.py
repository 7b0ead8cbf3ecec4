"""The documented ad-hoc queries, for any family of files."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashing import least_hash, row_hash
from .session import scratch


def by_year(df: DataFrame, when: str, value: str, since: int | None = None) -> DataFrame:
    """Rows and mean value per year, null days left out, from a year on."""
    year = F.year(when).cast("bigint")
    known = df.where(F.col(when).isNotNull() & (year >= since)) if since else df
    return known.groupBy(year.alias("yr")).agg(F.count("*").alias("n"), F.avg(value).alias("avg_price"))


def by_weekday(df: DataFrame, when: str, value: str) -> DataFrame:
    """Rows and mean value per day of the week, by name."""
    return df.groupBy(F.date_format(when, "EEEE").alias("weekday")).agg(F.count("*").alias("n"), F.avg(value).alias("avg_value"))


def most_frequent(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def count_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows over several files, from one scan that reads no column."""
    return spark.read.parquet(*paths).agg(F.count("*").alias("n"))


def chunks(df: DataFrame, size: int) -> DataFrame:
    """``chunk, n``: the sizes of chunks of ``size`` rows, which follow from the number of rows alone."""
    total = df.agg(F.count("*").alias("total")).where("total > 0")
    each = total.select("total", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / size))).alias("chunk"))
    return each.select("chunk", F.least(F.lit(size).cast("bigint"), F.col("total") - F.col("chunk") * size).alias("n"))


def numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``position``: each row's exact place in key order from 0, without one task that sees all rows.

    Rows are dealt to ranges of the keys, sorted within each, and written once with their range and place in it: the
    cuts are sampled, so ranges must not be made twice. Counts per range, one number a partition, give each range's
    first place. Rows with equal keys come in some order of their own.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()  # the partition's number, then 33 bits of the place in it
    folder = scratch(df.sparkSession)
    ordered.withColumn("position", place).write.parquet(folder)
    held = df.sparkSession.read.schema(df.withColumn("position", place).schema).parquet(folder)
    part = F.shiftright("position", 33)
    counts = held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row a partition
    firsts = dict(zip((r["part"] for r in counts), accumulate((r["n"] for r in counts), initial=0), strict=False))
    offsets = df.sparkSession.createDataFrame(list(firsts.items()), "part bigint, first bigint")
    joined = held.withColumn("part", part).join(F.broadcast(offsets), "part")
    return joined.withColumn("position", F.col("first") + F.col("position").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "first")


def row_chunks(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``df`` with ``chunk``: rows in key order, ``size`` to a chunk."""
    return numbered(df, keys).withColumn("chunk", F.floor(F.col("position") / size)).drop("position")


def export_json(df: DataFrame, keys: list[str], folder: str, size: int) -> int:
    """Write one JSON file per chunk of exactly ``size`` rows (the last has what is left), in key order: ``chunk=k`` folders.
    Returns the number of chunks. A chunk is written by one task, and a task holds no more than the row it writes."""
    placed = numbered(df, keys).withColumn("chunk", F.floor(F.col("position") / size))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartition(parts, "chunk").sortWithinPartitions("chunk", "position").drop("position")
    ordered.write.partitionBy("chunk").mode("overwrite").option("partitionOverwriteMode", "static").json(folder)
    return -(-placed.count() // size)


def weighted_choice(df: DataFrame, weights: dict[str, float], seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """Append ``operation``: a weighted choice per row by the hash of the seed and its keys (all columns by default)."""
    mark, total = row_hash(keys or df.columns, seed), sum(weights.values())
    ends = zip(weights, accumulate(weights.values()), strict=True)
    out = F.lit(list(weights)[-1])
    for name, end in reversed(list(ends)):
        out = F.when(mark < least_hash(end / total), name).otherwise(out)
    return df.withColumn("operation", out)
