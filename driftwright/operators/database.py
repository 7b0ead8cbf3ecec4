"""Year tables in a database: typed tables, staged loads that appear in one transaction, and partitioned read-back.

A load writes its rows into a staging table, in parallel and in batches; a task that runs twice shows there as a wrong
number of rows. One transaction on the driver then puts the staged rows into the year table and the months into the
manifest, so a reader sees a load with its manifest or neither, and a load that dies leaves a staging table at most,
which the next load of that year drops. One loader at a time may write a data type.

An embedded engine runs inside the driver, where no executor can connect to it. On a cluster, rows pass to and from it as
files of the folder that all share: executors write and read them in parallel, and the engine's own bulk load and unload
procedures stream them one file at a time; no row becomes an object of the driver's Python or a result of a Spark job.

Dialects say how a database names and types things. Column names are quoted and keep their case.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from functools import reduce
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import column
from ..functions.types import TypeMappingError, sql_name, target_type
from ..session import is_local, scratch
from .load import FLUSH_ROWS, MANIFEST, Connection, LoaderConfigError, LoaderConnectionError, LoaderError, create_table_sql, identifier, manifest_sql, year_table

#: Connections that write or read at once.
CONNECTIONS = 8


class Dialect:
    """What a database needs to be told."""

    def quote(self, name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def url(self, to: Connection, database: str | None = None) -> str:
        raise NotImplementedError

    def column(self, kind: T.DataType) -> str:
        raise NotImplementedError

    def options(self, flush_rows: int) -> dict[str, str]:
        return {"batchsize": str(flush_rows)}

    def table(self, name: str, df: DataFrame) -> str:
        return create_table_sql(name, [(self.quote(f.name), self.column(f.dataType)) for f in df.schema.fields], compress=False).rstrip(";")

    def manifest(self, schema: str, name: str) -> str:
        raise NotImplementedError

    def rename(self, schema: str, old: str, new: str) -> str:
        raise NotImplementedError

    def database(self, name: str) -> str | None:
        """A statement that creates the database where it is missing; None if connecting does."""
        return None

    def embedded(self, to: Connection) -> bool:
        """Whether the engine runs in the process that connects, so that no other process can reach it."""
        return False

    def bulk_load(self, schema: str, table: str, file: str) -> tuple[str, list]:
        """The statement, and its values, by which an embedded engine appends a file of quoted text to a table."""
        raise NotImplementedError

    def bulk_unload(self, query: str, file: str) -> tuple[str, list]:
        """The statement, and its values, by which an embedded engine writes a query's rows as quoted text."""
        raise NotImplementedError


class SqlServer(Dialect):
    def quote(self, name: str) -> str:
        return "[" + name.replace("]", "]]") + "]"

    def url(self, to: Connection, database: str | None = None) -> str:
        return f"jdbc:sqlserver://{to.host}:{to.port};databaseName={identifier(database or to.database)};encrypt=true;trustServerCertificate=true"

    def column(self, kind: T.DataType) -> str:
        return target_type(sql_name(kind))

    def options(self, flush_rows: int) -> dict[str, str]:
        """Batches go as bulk copies under a table lock."""
        return super().options(flush_rows) | {"useBulkCopyForBatchInsert": "true", "bulkCopyForBatchInsertBatchSize": str(flush_rows), "bulkCopyForBatchInsertTableLock": "true"}

    def table(self, name: str, df: DataFrame) -> str:
        return super().table(name, df) + " WITH (DATA_COMPRESSION = PAGE)"

    def manifest(self, schema: str, name: str) -> str:
        return manifest_sql(schema)

    def rename(self, schema: str, old: str, new: str) -> str:
        return f"EXEC sp_rename '{schema}.{old}', '{new}'"

    def database(self, name: str) -> str:
        return f"IF DB_ID('{identifier(name)}') IS NULL EXEC('CREATE DATABASE [{identifier(name)}]')"


class Derby(Dialect):
    """Apache Derby, embedded or by its network server; its driver comes with Spark."""

    #: Types that Derby names otherwise than SQL.
    TYPES = {"TINYINT": "SMALLINT", "FLOAT": "REAL", "DOUBLE": "DOUBLE", "VARCHAR": "CLOB", "TIMESTAMP WITH TIME ZONE": "TIMESTAMP"}

    def url(self, to: Connection, database: str | None = None) -> str:
        place = f"//{to.host}:{to.port}/" if to.host else ""
        return f"jdbc:derby:{place}{database or to.database};create=true"

    def column(self, kind: T.DataType) -> str:
        name = sql_name(kind)
        if isinstance(kind, T.DecimalType):
            if kind.precision > 31:
                raise TypeMappingError(f"the target database has no type for {name!r}")
            return name
        if name not in ("SMALLINT", "INTEGER", "BIGINT", "BOOLEAN", "DATE", "TIMESTAMP", "BLOB", *self.TYPES):
            raise TypeMappingError(f"the target database has no type for {name!r}")
        return self.TYPES.get(name, name)

    def manifest(self, schema: str, name: str) -> str:
        columns = [("data_type", "VARCHAR(32) NOT NULL"), ("year", "INTEGER NOT NULL"), ("month", "INTEGER NOT NULL"), ("row_count", "BIGINT NOT NULL"), ("loaded_at", "TIMESTAMP NOT NULL")]
        keys = ", ".join(self.quote(c) for c in ("data_type", "year", "month"))
        return create_table_sql(name, [*((self.quote(c), kind) for c, kind in columns), ("PRIMARY KEY", f"({keys})")], compress=False).rstrip(";")

    def rename(self, schema: str, old: str, new: str) -> str:
        return f"RENAME TABLE {self.quote(schema)}.{self.quote(old)} TO {self.quote(new)}"

    def embedded(self, to: Connection) -> bool:
        return not to.host

    def bulk_load(self, schema: str, table: str, file: str) -> tuple[str, list]:
        return "CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(?, ?, ?, ',', '\"', 'UTF-8', 0)", [schema, table, file]

    def bulk_unload(self, query: str, file: str) -> tuple[str, list]:
        return "CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY(?, ?, ',', '\"', 'UTF-8')", [query, file]


DIALECTS: dict[str, Dialect] = {"sqlserver": SqlServer(), "derby": Derby()}


def _first_cause(problem: Py4JError) -> str:
    held = getattr(problem, "java_exception", None)
    return str(held.getMessage()) if held is not None else str(problem)


class JdbcSink:
    """A sink of the loader over JDBC. ``after`` is told each step that is done.

    by_files: rows pass as files of the shared folder; by default where the engine is embedded and executors are not in
    the driver's process.
    """

    #: Quoted text as embedded engines write it, quotes doubled; a row may go over several lines.
    CSV = {"sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8", "header": "false", "multiLine": "true", "lineSep": "\n", "maxCharsPerColumn": "-1", "mode": "FAILFAST"}

    def __init__(self, spark: SparkSession, connection: Connection, dialect: str | Dialect = "sqlserver", flush_rows: int = FLUSH_ROWS, connections: int = CONNECTIONS, after: Callable[[str], None] = lambda step: None, by_files: bool | None = None):
        self.spark, self.to, self.after = spark, connection, after
        self.dialect = DIALECTS[dialect] if isinstance(dialect, str) else dialect
        self.schema = identifier(connection.schema)
        if flush_rows < 1 or connections < 1:
            raise LoaderConfigError("batches and connections start at one")
        self.flush_rows, self.connections = flush_rows, connections
        self.by_files = self.dialect.embedded(connection) and not is_local(spark) if by_files is None else by_files
        self._staged: dict[tuple[str, int], tuple[str, list[str]]] = {}

    # -- statements on the driver

    @contextmanager
    def connected(self, database: str | None = None) -> Iterator:
        try:
            held = self.spark._jvm.java.sql.DriverManager.getConnection(self.dialect.url(self.to, database), self.to.user, self.to.password)
        except Py4JError as problem:
            raise LoaderConnectionError(_first_cause(problem)) from problem
        try:
            yield held
        finally:
            held.close()

    @contextmanager
    def transaction(self) -> Iterator[Callable[[str], None]]:
        """Statements that all take effect at the end, or none does."""
        with self.connected() as held:
            held.setAutoCommit(False)

            def run(sql: str, *values) -> None:
                statement = held.prepareStatement(sql)
                for k, value in enumerate(values):
                    statement.setObject(k + 1, value)
                statement.execute()
                statement.close()

            try:
                yield run
                held.commit()
            except Py4JError as problem:
                held.rollback()
                raise LoaderError(_first_cause(problem)) from problem
            except BaseException:
                held.rollback()
                raise

    def rows(self, sql: str, *values) -> list[tuple]:
        """The rows of a small query."""
        try:
            with self.connected() as held:
                statement = held.prepareStatement(sql)
                for k, value in enumerate(values):
                    statement.setObject(k + 1, value)
                found, out = statement.executeQuery(), []
                width = found.getMetaData().getColumnCount()
                while found.next():
                    out.append(tuple(found.getObject(k + 1) for k in range(width)))
                return out
        except Py4JError as problem:
            raise LoaderError(_first_cause(problem)) from problem

    def name(self, table: str) -> str:
        return f"{self.dialect.quote(self.schema)}.{self.dialect.quote(identifier(table))}"

    def tables(self, pattern: str) -> list[str]:
        """Tables of the schema by the driver's own catalogue."""
        with self.connected() as held:
            found, out = held.getMetaData().getTables(None, self.schema, None, None), []
            while found.next():
                out.append(found.getString("TABLE_NAME"))
        return sorted(t for t in out if re.fullmatch(pattern, t))

    def columns(self, table: str) -> dict[str, str]:
        """Column names and types as the database has them."""
        with self.connected() as held:
            found, out = held.getMetaData().getColumns(None, self.schema, identifier(table), None), {}
            while found.next():
                out[found.getString("COLUMN_NAME")] = found.getString("TYPE_NAME")
        return out

    def provision(self) -> None:
        """Database, schema and manifest, where they are missing."""
        if statement := self.dialect.database(self.to.database):
            with self.connected("master") as held:
                held.createStatement().execute(statement)
        with self.connected() as held:
            found, schemas = held.getMetaData().getSchemas(), set()
            while found.next():
                schemas.add(found.getString("TABLE_SCHEM"))
        missing = not self.tables(re.escape(MANIFEST))
        with self.transaction() as run:
            if self.schema not in schemas:
                run(f"CREATE SCHEMA {self.dialect.quote(self.schema)}")
            if missing:
                run(self.dialect.manifest(self.schema, self.name(MANIFEST)))

    # -- what the loader asks for

    def counts(self, data_type: str) -> dict[int, int]:
        names = self.tables(rf"{re.escape(identifier(data_type))}_\d{{4}}")
        if not names:
            return {}
        each = " UNION ALL ".join(f"SELECT {int(n[-4:])}, COUNT(*) FROM {self.name(n)}" for n in names)
        return {int(year): int(n) for year, n in self.rows(each)}

    def manifest(self, data_type: str) -> list[tuple[int, int, int]]:
        if not self.tables(re.escape(MANIFEST)):
            return []
        year, month, count, kind = (self.dialect.quote(c) for c in ("year", "month", "row_count", "data_type"))
        found = self.rows(f"SELECT {year}, {month}, {count} FROM {self.name(MANIFEST)} WHERE {kind} = ?", data_type)
        return sorted((int(y), int(m), int(n)) for y, m, n in found)

    def append_all(self, data_type: str, year: int, months: dict[int, DataFrame]) -> None:
        """Write the months' rows into a new staging table, after dropping what a dead load left."""
        table = year_table(data_type, year)
        for left in self.tables(rf"{re.escape(table)}_stage_\w+"):
            with self.transaction() as run:
                run(f"DROP TABLE {self.name(left)}")
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), months.values())
        stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
        with self.transaction() as run:
            run(self.dialect.table(self.name(stage), rows))
        self.after("created")
        if self.by_files:
            self._load(rows, stage)
            self._staged[data_type, year] = stage, rows.columns
            self.after("staged")
            return
        options = {"url": self.dialect.url(self.to), "user": self.to.user, "password": self.to.password, "dbtable": self.name(stage), "numPartitions": str(self.connections)}
        rows.write.format("jdbc").options(**options, **self.dialect.options(self.flush_rows)).mode("append").save()
        self._staged[data_type, year] = stage, rows.columns
        self.after("staged")

    def record(self, data_type: str, year: int, months: list[tuple[int, int]], replace: bool) -> None:
        """The staged rows and their months, in one transaction."""
        table, (stage, columns) = year_table(data_type, year), self._staged.pop((data_type, year), (None, []))
        staged = int(self.rows(f"SELECT COUNT(*) FROM {self.name(stage)}")[0][0]) if stage else 0
        expected = sum(n for _, n in months)
        if staged != expected:
            raise LoaderError(f"{table}: {staged} of {expected} rows are staged")
        self.after("verified")
        there = bool(self.tables(re.escape(table)))
        fresh = replace or not there
        if stage and not fresh and set(self.columns(table)) != set(columns):
            raise LoaderError(f"{table}: columns {sorted(set(self.columns(table)) ^ set(columns))} are in the table or the new months only; reload the year")
        quote, kind = self.dialect.quote, [self.dialect.quote(c) for c in ("data_type", "year")]
        with self.transaction() as run:
            if there and fresh:
                run(f"DROP TABLE {self.name(table)}")
            if stage and fresh:
                run(self.dialect.rename(self.schema, stage, table))
            elif stage:
                own = ", ".join(map(quote, columns))
                run(f"INSERT INTO {self.name(table)} ({own}) SELECT {own} FROM {self.name(stage)}")
                run(f"DROP TABLE {self.name(stage)}")
            self.after("moved")
            gone = f"DELETE FROM {self.name(MANIFEST)} WHERE {kind[0]} = ? AND {kind[1]} = ?"
            if replace:
                run(gone, data_type, year)
            for month, n in months:
                if not replace:
                    run(f"{gone} AND {quote('month')} = ?", data_type, year, month)
                own = ", ".join(map(quote, ("data_type", "year", "month", "row_count", "loaded_at")))
                run(f"INSERT INTO {self.name(MANIFEST)} ({own}) VALUES (?, ?, ?, ?, CURRENT_TIMESTAMP)", data_type, year, month, n)
            self.after("recorded")
        self.after("committed")

    def drop_year(self, data_type: str, year: int) -> None:
        self.record(data_type, year, [], True)

    def table(self, data_type: str, year: int, by: str | None = None) -> DataFrame:
        """A year table; by: a number or time column by whose range several connections read it at once."""
        name = year_table(data_type, year)
        options = {"url": self.dialect.url(self.to), "user": self.to.user, "password": self.to.password, "dbtable": self.name(name)}
        if by is not None and by not in self.columns(name):
            raise LoaderConfigError(f"{name} has no column {by!r}")
        if self.by_files:
            return self._unload(name, self.spark.read.format("jdbc").options(**options).load().schema, by)
        if by is not None:
            own = self.dialect.quote(by)
            low, high = self.rows(f"SELECT CAST(MIN({own}) AS CHAR(40)), CAST(MAX({own}) AS CHAR(40)) FROM {self.name(name)}")[0]
            if low is not None and low != high:
                options |= {"partitionColumn": own, "lowerBound": low.strip(), "upperBound": high.strip(), "numPartitions": str(self.connections)}
        # times without a zone are no partition columns: they are read in the session's zone and lose it again
        found = self.spark.read.format("jdbc").options(**options).load()
        return found.select(*(column(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else column(f.name) for f in found.schema.fields))

    def close(self) -> None:
        """End an embedded engine's database, whose memory is the driver's; what was unloaded from it stays readable."""
        if self.dialect.embedded(self.to):
            with suppress(Py4JError):  # that it has ended is told as an error
                self.spark._jvm.java.sql.DriverManager.getConnection(f"{self.dialect.url(self.to).replace(';create=true', '')};shutdown=true", self.to.user, self.to.password)

    # -- rows as files, where the engine is embedded in the driver

    def _files(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _load(self, rows: DataFrame, table: str) -> None:
        """Executors write the rows, the engine appends file by file; each file is on the driver's disk while it is read."""
        folder = scratch(self.spark)
        # every text is quoted, an empty one too; a null is nothing between commas
        written = F.concat_ws(",", *(F.coalesce(_quoted(f), F.lit("")) for f in rows.schema.fields))
        rows.select(written.alias("value")).write.option("lineSep", "\n").text(folder)
        path, system = self._files(folder)
        with tempfile.TemporaryDirectory(prefix="driftwright-load-") as home:
            for part in sorted(str(s.getPath()) for s in system.listStatus(path) if s.getPath().getName().startswith("part-") and s.getLen()):
                local = Path(home).resolve() / "part.csv"
                system.copyToLocalFile(False, self._files(part)[0], self._files(f"file://{local}")[0], True)
                with self.transaction() as run:
                    sql, values = self.dialect.bulk_load(self.schema, table, str(local))
                    run(sql, *values)
        system.delete(path, True)

    def _unload(self, table: str, schema: T.StructType, by: str | None) -> DataFrame:
        """The engine writes one file per range of ``by``; executors read them at once."""
        folder = scratch(self.spark)
        path, system = self._files(folder)
        system.mkdirs(path)
        names = [self.dialect.quote(f.name) for f in schema.fields]
        # a reader takes empty texts for nulls: a mark for each column tells them apart
        own = ", ".join([*names, *(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in names)])
        with tempfile.TemporaryDirectory(prefix="driftwright-unload-") as home:
            for number, where in enumerate(self._ranges(table, by)):
                local = Path(home).resolve() / f"part-{number:05d}.csv"
                with self.transaction() as run:
                    sql, values = self.dialect.bulk_unload(f"SELECT {own} FROM {self.name(table)}{where}", str(local))
                    run(sql, *values)
                system.copyFromLocalFile(True, True, self._files(f"file://{local}")[0], path)
        texts = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(2 * len(names))])
        found = self.spark.read.options(**self.CSV).schema(texts).csv(folder)
        return found.select(*(F.when(F.col(f"c{k + len(names)}") == "1", _parsed(F.coalesce(f"c{k}", F.lit("")), f)).alias(f.name) for k, f in enumerate(schema.fields)))

    def _ranges(self, table: str, by: str | None) -> list[str]:
        """Conditions that part the table by ranges of a number or time column, as many as rows ask for; nulls are in the first."""
        if by is None:
            return [""]
        own = self.dialect.quote(by)
        rows, low, high = self.rows(f"SELECT COUNT(*), MIN({own}), MAX({own}) FROM {self.name(table)}")[0]
        if low is None or low == high:
            return [""]
        if isinstance(low, int | float | Decimal):
            first, last = Decimal(str(low)), Decimal(str(high))
            # rounded, but the same number ends one range and begins the next: they part the rows exactly
            told = lambda x: f"{x:.15E}"
        else:
            first, last = datetime.fromisoformat(str(low)), datetime.fromisoformat(str(high))
            told = lambda x: f"TIMESTAMP('{x:%Y-%m-%d %H:%M:%S.%f}')"
        n = max(self.connections, -(-int(rows) // self.flush_rows))
        cuts = [told(first + (last - first) * k / n) for k in range(1, n)]
        lows = [f"{own} >= {c}" for c in cuts]
        highs = [f"{own} < {c}" for c in cuts]
        if not cuts:
            return [""]
        return [f" WHERE {own} IS NULL OR {highs[0]}", *(f" WHERE {a} AND {b}" for a, b in zip(lows, highs[1:], strict=False)), f" WHERE {lows[-1]}"]


def _quoted(field: T.StructField):
    """A value as quoted text; null stays null."""
    value = column(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.concat(F.lit('"'), F.hex(value), F.lit('"'))
    if isinstance(field.dataType, T.StringType):
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return value.cast("string")


def _parsed(text, field: T.StructField):
    if isinstance(field.dataType, T.BinaryType):
        return F.unhex(text)
    return text.cast("timestamp_ntz" if isinstance(field.dataType, T.TimestampType) else field.dataType)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns as they were before the database: types that it has no match for come back as others."""
    return df.select(*(column(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
