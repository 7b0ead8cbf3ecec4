"""Parquet footers as a Spark data source: statistics of every column of every file, without reading any data.

``spark.read.format("parquet_footer").option("paths", json_list).load()`` gives one row per file and leaf column; files are
dealt to tasks, so hundreds of footers are read at once. Leaves of nested columns count under their root's name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

SCHEMA = (
    "path string, ordinal int, column string, dtype string, num_rows bigint, num_values bigint, null_count bigint, "
    "min_long bigint, max_long bigint, min_double double, max_double double, min_text string, max_text string, error string"
)
FILES_PER_TASK = 8


class FooterPartition(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FooterReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self):
        return [FooterPartition(self.paths[k : k + FILES_PER_TASK]) for k in range(0, len(self.paths), FILES_PER_TASK)] or [FooterPartition([])]

    def read(self, partition: FooterPartition) -> Iterator[tuple]:
        for path in partition.paths:
            try:
                yield from footer_rows(path)
            except Exception as problem:  # noqa: BLE001  an unreadable file is a row with its error
                yield (path, None, None, None, None, None, None, None, None, None, None, None, None, str(problem))


class FooterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_footer"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FooterReader:
        return FooterReader(json.loads(self.options["paths"]))


class MarkReader(FooterReader):
    """Size of each file, and whether both ends bear the format's mark: eight bytes are read of a file."""

    def read(self, partition: FooterPartition) -> Iterator[tuple]:
        import pyarrow.fs as fs

        for path in partition.paths:
            try:
                local = urlparse(path).scheme in ("", "file")
                system, inner = (fs.LocalFileSystem(), urlparse(path).path if path.startswith("file:") else path) if local else fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as data:
                    size = data.size()
                    yield (path, size, size >= 8 and data.read_at(4, 0) == b"PAR1" == data.read_at(4, size - 4), None)
            except Exception as problem:  # noqa: BLE001  a file that cannot be read is a row with its error
                yield (path, None, None, str(problem))


class MarkSource(FooterSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_marks"

    def schema(self) -> str:
        return "path string, size bigint, valid boolean, error string"

    def reader(self, schema) -> MarkReader:
        return MarkReader(json.loads(self.options["paths"]))


def read_marks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, size, valid, error`` of files on any file system; files are dealt to tasks, which read their ends only.

    A file that could not be read is neither valid nor invalid: valid is null.
    """
    ship(spark)
    spark.dataSource.register(MarkSource)
    return spark.read.format("parquet_marks").option("paths", json.dumps(paths)).load()


def _open(path: str):
    import pyarrow.fs as fs
    import pyarrow.parquet as pq

    if urlparse(path).scheme in ("", "file"):
        return pq.ParquetFile(urlparse(path).path if path.startswith("file:") else path)
    system, inner = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(inner, filesystem=system)


def _name(field) -> str:
    """The SQL name of an Arrow field's type."""
    import pyarrow.types as at

    kind = field.type
    simple = {"int8": "TINYINT", "int16": "SMALLINT", "int32": "INTEGER", "int64": "BIGINT", "uint8": "UTINYINT", "uint16": "USMALLINT", "uint32": "UINTEGER", "uint64": "UBIGINT", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR", "large_string": "VARCHAR", "bool": "BOOLEAN", "date32[day]": "DATE", "binary": "BLOB"}
    if at.is_timestamp(kind):
        return "TIMESTAMP WITH TIME ZONE" if kind.tz else "TIMESTAMP"
    if at.is_decimal(kind):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return simple.get(str(kind), str(kind).upper())


def _leaves(kind) -> int:
    """Leaf columns of an Arrow type."""
    import pyarrow.types as at

    if at.is_struct(kind):
        return sum(_leaves(kind.field(k).type) for k in range(kind.num_fields))
    if at.is_map(kind):
        return _leaves(kind.key_type) + _leaves(kind.item_type)
    if at.is_list(kind) or at.is_large_list(kind) or at.is_fixed_size_list(kind):
        return _leaves(kind.value_type)
    return 1


def footer_rows(path: str) -> Iterator[tuple]:
    """One tuple per leaf column, its row groups folded together; bounds of a kind of value each."""
    import pyarrow.types as at

    file = _open(path)
    meta, arrow = file.metadata, file.schema_arrow
    # leaves are stored in the order of their roots; names cannot tell, since they may hold dots
    roots = [k for k, field in enumerate(arrow) for _ in range(_leaves(field.type))]
    for leaf in range(meta.num_columns):
        place = roots[leaf]
        root = arrow.names[place]
        low = high = None
        values = nulls = silent = 0
        for group in range(meta.num_row_groups):
            chunk = meta.row_group(group).column(leaf)
            values += chunk.num_values
            stats = chunk.statistics
            if stats is None:
                silent += chunk.num_values > 0
                continue
            nulls += stats.null_count or 0
            if not stats.has_min_max:
                silent += chunk.num_values > (stats.null_count or 0)
            else:
                low = stats.min if low is None else min(low, stats.min)
                high = stats.max if high is None else max(high, stats.max)
        if silent and isinstance(low, int) and at.is_integer(arrow.field(place).type):
            # a row group with values does not say which: any of the column's type
            kind = arrow.field(place).type
            signed = at.is_signed_integer(kind)
            low, high = (1 - (1 << kind.bit_width - 1) if signed else 0), min(1 << kind.bit_width - signed, 1 << 63) - 1

        def as_kind(value, kinds, turn):
            return turn(value) if isinstance(value, kinds) and not isinstance(value, bool) else None

        whole = lambda v: as_kind(v, int, int) if v is None or abs(as_kind(v, int, int) or 0) < 2**63 else None
        real = lambda v: None if v is None or isinstance(v, (bool, int, str, bytes)) else (float(v) if hasattr(v, "__float__") else None)
        text = lambda v: None if v is None or whole(v) is not None or real(v) is not None else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)
        yield (path, place, root, _name(arrow.field(place)), meta.num_rows, values, nulls, whole(low), whole(high), real(low), real(high), text(low), text(high), None)


def read_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file and column: leaves of a nested column are folded into their root."""
    ship(spark)
    spark.dataSource.register(FooterSource)
    leaves = spark.read.format("parquet_footer").option("paths", json.dumps(paths)).load()
    bounds = [f(c).alias(c) for c in ("min_long", "min_double", "min_text", "max_long", "max_double", "max_text") for f in [F.min if c.startswith("min") else F.max]]
    return leaves.groupBy("path", "ordinal", "column", "dtype", "error").agg(F.max("num_rows").alias("num_rows"), F.sum("num_values").alias("num_values"), F.sum("null_count").alias("null_count"), *bounds)


def has_data() -> Column:
    """Whether a column of a file holds any value."""
    return F.col("num_values") > F.col("null_count")


def family_stats(footers: DataFrame) -> DataFrame:
    """Per column over all files: presence, nulls, rows, types, and the range of the first file's kind of values.

    Bounds of different kinds cannot be compared; those of the kind that the first file (by path) shows are kept.
    """
    kind = F.when(F.col("min_long").isNotNull() | F.col("min_double").isNotNull(), "number").when(F.col("min_text").isNotNull(), "text")
    rows = footers.where("error is null").withColumn("kind", kind)
    first = rows.where("kind is not null").groupBy("column").agg(F.min_by("kind", "path").alias("first_kind"))
    number = lambda c: F.when(F.col("first_kind") == "number", F.coalesce(F.col(f"{c}_long").cast("double"), F.col(f"{c}_double")))
    text = lambda c: F.when(F.col("first_kind") == "text", F.col(f"{c}_text"))
    return rows.join(first, "column", "left").groupBy("column").agg(
        F.count("*").alias("files_present"), F.count_if(has_data()).alias("files_with_data"), F.sum("null_count").alias("total_nulls"), F.sum("num_values").alias("total_rows"),
        F.min(number("min")).alias("min_number"), F.max(number("max")).alias("max_number"), F.min(text("min")).alias("min_text"), F.max(text("max")).alias("max_text"),
        F.sort_array(F.collect_set("dtype")).alias("types_seen"),
    )


def file_stats(footers: DataFrame) -> dict[str, dict[str, dict]]:
    """Per path, the columns in file order with type, bounds and counts; small, for the planner on the driver."""
    found: dict[str, dict[str, dict]] = {}
    for r in footers.where("error is null").orderBy("path", "ordinal").collect():
        pick = lambda side: next((r[f"{side}_{k}"] for k in ("long", "double", "text") if r[f"{side}_{k}"] is not None), None)  # noqa: E731, B023
        found.setdefault(r["path"], {})[r["column"]] = {"type": r["dtype"], "min": pick("min"), "max": pick("max"), "null_count": r["null_count"], "num_rows": r["num_values"]}
    return found
