"""Incremental loads as a stream: new month files of a normalised family, each reconciled and loaded once.

The file source hands each micro-batch the files that came since the last; only their footers are read, and the month
rows of earlier batches are kept as a table of state in the shared folder, one folder per batch. A batch that runs
again after a failure replaces its own folder, and what it loads is reconciled with the manifest, so nothing is
loaded twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.load import ParquetSink, Sink, execute, plan_years
from ..sources.files import FOLDER_MONTH, MonthFile, list_parquet, month_of
from ..sources.footer import read_footers

STATE = "path string, year int, month int, rows bigint, parted boolean"


def footer_state(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, year, month, rows, parted`` of month files, from their footers."""
    known = [(p, *month_of(p), bool(FOLDER_MONTH.search(p))) for p in paths if month_of(p)]
    months = spark.createDataFrame(known, "path string, year int, month int, parted boolean")
    counts = read_footers(spark, [p for p, *_ in known]).where("error is null").groupBy("path").agg(F.max("num_rows").alias("rows"))
    return months.join(counts, "path").select("path", "year", "month", "rows", "parted")


def state_months(state: DataFrame, there: list[str]) -> list[MonthFile]:
    """The months of the files that are still there; of one file the latest state counts (``batch``)."""
    spark = state.sparkSession
    latest = state.withColumn("turn", F.row_number().over(Window.partitionBy("path").orderBy(F.desc("batch")))).where("turn = 1")
    held = latest.join(spark.createDataFrame([(p,) for p in there], "path string"), "path")
    of = held.withColumn("folder", F.max("parted").over(Window.partitionBy("year", "month"))).where("parted = folder")
    rows = of.groupBy("year", "month").agg(F.sum("rows").alias("rows"), F.sort_array(F.collect_list("path")).alias("paths")).orderBy("year", "month").collect()
    return [MonthFile(r["year"], r["month"], r["paths"][0], r["rows"], tuple(r["paths"][1:])) for r in rows]


def load_new_months(spark: SparkSession, folder: str, schema: T.StructType, data_type: str, root: str, checkpoint: str, sink: Sink | None = None) -> StreamingQuery:
    """Start the stream over what is there now (``availableNow``); await it, and start it again for what comes later."""
    target, state = sink or ParquetSink(spark, root), f"{checkpoint.rstrip('/')}/months"
    files = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(folder)
    files = files.select(F.regexp_replace("_metadata.file_path", "^file:/+", "/").alias("path"))  # reads no column

    def batch(df: DataFrame, number: int) -> None:
        fresh = sorted(r["path"] for r in df.distinct().toLocalIterator())  # the batch's files
        if not fresh:
            return
        footer_state(spark, fresh).write.mode("overwrite").parquet(f"{state}/batch={number}")
        held = spark.read.schema(STATE + ", batch bigint").parquet(state)
        months = state_months(held, list_parquet(spark, folder))
        for plan in plan_years(spark, months, target, data_type):
            execute(spark, plan, months, target, data_type)

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
