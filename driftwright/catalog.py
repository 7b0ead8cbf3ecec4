"""Registry of the queries and of the SQL that each must equal.

Every query runs over whole tables of a data folder; the operators that the reference describes are applied to the
driver's tables through the same functions that the command line uses.
"""

from __future__ import annotations

import re
import shutil
import tempfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import analytics
from .functions import names
from .functions.casts import exact_cast
from .functions.hashing import least_hash
from .functions.types import TARGET_TYPES, compatible, fits_column, target_type_column
from .operators import drift, load
from .operators.database import JdbcSink, typed
from .operators.profile import precision_loss as count_lossy
from .operators.profile import profile, sample
from .plans import pipeline
from .plans.mapping import Mapping
from .plans.planner import Action, Plan, plan_file
from .plans.transform import apply, compile_action
from .session import configure, scratch
from .sources.download import classify_column, pending
from .sources.files import list_parquet, month_files
from .sources.footer import family_stats, file_stats, read_footers
from .sources.union import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables whose columns have simple types.
_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"]


def _columns(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    """``tab, ordinal, name, dtype`` of the tables' columns, from the footers of all their files."""
    files = {p: t for t in tables for p in list_parquet(configure(spark), f"{sf_dir}/{t}.parquet")}
    kinds = F.create_map(*(F.lit(x) for pair in files.items() for x in pair))
    return read_footers(spark, list(files)).select(kinds[F.col("path")].alias("tab"), "ordinal", F.col("column").alias("name"), "dtype").distinct()


def _columns_sql(tables: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS tab, column_name AS name, column_type AS dtype FROM (DESCRIBE {t})" for t in tables)


# -- documented queries ------------------------------------------------------------------------------------------


@query("trips_by_year", "SELECT extract(year FROM o_orderdate) AS yr, count(*) AS n, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1")
def trips_by_year(spark, sf_dir):
    return analytics.by_year(read(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


@query("trips_since_year", "SELECT extract(year FROM o_orderdate) AS yr, count(*) AS n, avg(o_totalprice) AS avg_price FROM orders WHERE o_orderdate IS NOT NULL AND extract(year FROM o_orderdate) >= 1995 GROUP BY 1")
def trips_since_year(spark, sf_dir):
    return analytics.by_year(read(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", 1995)


@query("avg_by_weekday", "SELECT strftime(l_shipdate, '%A') AS weekday, count(*) AS n, round(avg(l_quantity), 6) AS avg_value FROM lineitem GROUP BY 1")
def avg_by_weekday(spark, sf_dir):
    return analytics.by_weekday(read(spark, sf_dir, "lineitem"), "l_shipdate", "l_quantity").withColumn("avg_value", F.round("avg_value", 6))


@query("top10_parts", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def top10_parts(spark, sf_dir):
    return analytics.most_frequent(read(spark, sf_dir, "lineitem"), "l_partkey", 10)


@query("count_multi_file", "SELECT count(*) AS n FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders)")
def count_multi_file(spark, sf_dir):
    return analytics.count_files(configure(spark), [f"{sf_dir}/orders.parquet"] * 2)


@query("union_by_name", "SELECT n_nationkey AS key, n_name, NULL AS r_name FROM nation UNION ALL SELECT r_regionkey, NULL, r_name FROM region")
def union_by_name(spark, sf_dir):
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    return nation.unionByName(read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), "r_name"), allowMissingColumns=True)


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("chunk_export", "SELECT chunk, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 5000 AS chunk FROM lineitem) GROUP BY 1")
def chunk_export(spark, sf_dir):
    return analytics.chunks(read(spark, sf_dir, "lineitem"), 5000)


_ITEM = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


@query("chunk_rows", f"SELECT {', '.join(_ITEM)}, (row_number() OVER (ORDER BY {', '.join(_ITEM)}) - 1) // 5000 AS chunk FROM lineitem")
def chunk_rows(spark, sf_dir):
    """Each row and the file it is exported to."""
    return analytics.row_chunks(read(spark, sf_dir, "lineitem").select(*_ITEM), _ITEM, 5000)


_MARK = "md5('42|' || CAST(o_orderkey AS VARCHAR))"


@query("weighted_operations", f"SELECT CASE WHEN {_MARK} < '{least_hash(0.5)}' THEN 'insert' WHEN {_MARK} < '{least_hash(0.8)}' THEN 'update' ELSE 'delete' END AS operation, count(*) AS n FROM orders GROUP BY 1")
def weighted_operations(spark, sf_dir):
    chosen = analytics.weighted_choice(read(spark, sf_dir, "orders"), {"insert": 0.5, "update": 0.3, "delete": 0.2}, 42, ["o_orderkey"])
    return chosen.groupBy("operation").agg(F.count("*").alias("n"))


@query("load_roundtrip", "SELECT CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, count(*) AS table_rows, count(DISTINCT extract(month FROM o_orderdate)) AS months, 'skip' AS again FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1")
def load_roundtrip(spark, sf_dir):
    """Orders as a partitioned family, several files a month, loaded into year tables; a second plan finds nothing to do."""
    root = scratch(spark)
    orders = read(spark, sf_dir, "orders").where("o_orderdate is not null")
    orders.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate")).repartition(2).write.partitionBy("year", "month").parquet(f"{root}/normalized")
    sink, months = load.ParquetSink(spark, f"{root}/warehouse"), month_files(spark, f"{root}/normalized")
    for plan in load.plan_years(spark, months, sink, "orders"):
        load.execute(spark, plan, months, sink, "orders")
    again = {p.year: p.action for p in load.plan_years(spark, months, sink, "orders")}
    recorded = sink.manifest("orders")
    rows = [(y, n, sum(m[0] == y for m in recorded), again[y]) for y, n in sink.counts("orders").items()]
    return spark.createDataFrame(rows, "year int, table_rows bigint, months bigint, again string")


def _database(spark: SparkSession) -> JdbcSink:
    """An embedded database in a new folder of the driver's machine; on a cluster rows pass to and from it as shared files."""
    home = tempfile.mkdtemp(prefix="driftwright-db-")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", f"{home}/derby.log")
    sink = JdbcSink(spark, load.Connection("", f"{home}/db", "loader", "loader", schema="LOADER"), "derby")
    sink.provision()
    return sink


@query(
    "jdbc_roundtrip",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(extract(year FROM o_orderdate) AS INTEGER) AS table_year,
    count(*) OVER (PARTITION BY date_trunc('month', o_orderdate)) AS manifest_rows, 'skip' AS again FROM orders WHERE o_orderdate IS NOT NULL""",
)
def jdbc_roundtrip(spark, sf_dir):
    """Orders loaded by month into typed year tables of a database, and read back by ranges of the key with their manifest."""
    root, sink = scratch(spark), _database(spark)
    orders = read(spark, sf_dir, "orders").where("o_orderdate is not null")
    orders.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate")).write.partitionBy("year", "month").parquet(f"{root}/normalized")
    months = month_files(spark, f"{root}/normalized")
    for plan in load.plan_years(spark, months, sink, "orders"):
        load.execute(spark, plan, months, sink, "orders")
    again = spark.createDataFrame([(p.year, p.action) for p in load.plan_years(spark, months, sink, "orders")], "table_year int, again string")
    manifest = spark.createDataFrame(sink.manifest("orders"), "table_year int, month int, manifest_rows bigint")
    tables = [typed(sink.table("orders", year, "o_orderkey"), orders.schema).withColumn("table_year", F.lit(year)) for year in sink.counts("orders")]
    if sink.by_files:
        sink.close()
        shutil.rmtree(Path(sink.to.database).parent)
    found = reduce(DataFrame.unionByName, tables).withColumn("month", F.month("o_orderdate"))
    return found.join(F.broadcast(manifest), ["table_year", "month"]).join(F.broadcast(again), "table_year").drop("month")


# -- normalisation -----------------------------------------------------------------------------------------------


@query("norm_passthrough_rename", 'SELECT n_nationkey AS "NationID", n_name FROM nation')
def norm_passthrough_rename(spark, sf_dir):
    plan = Plan([Action("rename", "NationID", "INTEGER", "n_nationkey", "INTEGER"), Action("passthrough", "n_name", "VARCHAR", "n_name", "VARCHAR")])
    return apply(read(spark, sf_dir, "nation"), plan)


@query("norm_cast_double_bigint", "SELECT CAST(l_quantity / 4 AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY 1")
def norm_cast_double_bigint(spark, sf_dir):
    q = exact_cast(F.col("l_quantity") / 4, "DOUBLE", "BIGINT")
    return read(spark, sf_dir, "lineitem").groupBy(q.alias("q")).agg(F.count("*").alias("n"))


@query("norm_cast_decimal_bigint", "SELECT CAST(CAST(l_quantity / 4 AS DECIMAL(10,2)) AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY 1")
def norm_cast_decimal_bigint(spark, sf_dir):
    q = exact_cast((F.col("l_quantity") / 4).cast("decimal(10,2)"), "DECIMAL(10,2)", "BIGINT")
    return read(spark, sf_dir, "lineitem").groupBy(q.alias("q")).agg(F.count("*").alias("n"))


@query("norm_cast_text_bigint", "SELECT CAST(CAST(l_quantity / 4 AS VARCHAR) AS BIGINT) AS q, count(*) AS n FROM lineitem GROUP BY 1")
def norm_cast_text_bigint(spark, sf_dir):
    q = exact_cast((F.col("l_quantity") / 4).cast("string"), "VARCHAR", "BIGINT")
    return read(spark, sf_dir, "lineitem").groupBy(q.alias("q")).agg(F.count("*").alias("n"))


@query("norm_null_fill", "SELECT o_orderkey, CAST(NULL AS DOUBLE) AS fee FROM orders")
def norm_null_fill(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", compile_action(Action("null_fill", "fee", "DOUBLE")))


def _mapped(source: str, values: dict, policy: str, source_type: str = "VARCHAR", name: str = "code"):
    return compile_action(Action("value_map", name, "BIGINT", source, source_type, tuple(values.items()), policy))


@query("norm_value_map_null", "SELECT l_orderkey, l_linenumber, coalesce(code, -1) AS code, code IS NULL AS unmapped FROM (SELECT *, CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS BIGINT) AS code FROM lineitem)")
def norm_value_map_null(spark, sf_dir):
    mapped = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _mapped("l_returnflag", {"A": 1, "N": 2}, "null"))
    return mapped.select("l_orderkey", "l_linenumber", F.coalesce("code", F.lit(-1)).alias("code"), F.col("code").isNull().alias("unmapped"))


@query("norm_value_map_strict", "SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS BIGINT) AS code FROM orders")
def norm_value_map_strict(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", _mapped("o_orderstatus", {"F": 1, "O": 2, "P": 3}, "error"))


@query("norm_value_map_code_keys", "SELECT c_custkey, coalesce(CAST(CASE CAST(CAST(c_nationkey AS DOUBLE) AS VARCHAR) WHEN '0.0' THEN 10 WHEN '1.0' THEN 11 END AS BIGINT), -1) AS code FROM customer")
def norm_value_map_code_keys(spark, sf_dir):
    codes = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("k"))
    return codes.select("c_custkey", F.coalesce(_mapped("k", {"0.0": 10, "1.0": 11}, "null", "DOUBLE"), F.lit(-1)).alias("code"))


@query(
    "norm_full_plan",
    """SELECT l_orderkey AS "OrderID", CAST(l_quantity AS BIGINT) AS quantity, CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT) AS l_returnflag,
    CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice, CAST(NULL AS DOUBLE) AS congestion_fee FROM lineitem""",
)
def norm_full_plan(spark, sf_dir):
    """Footers, planner and transform together: rename, cast, value map, widening, passthrough, null fill, drops."""
    path = f"{sf_dir}/lineitem.parquet"
    raw = next(iter(file_stats(read_footers(configure(spark), [path])).values()))
    target = {n: {"type": t} for n, t in [("OrderID", "BIGINT"), ("quantity", "BIGINT"), ("l_returnflag", "BIGINT"), ("l_linenumber", "BIGINT"), ("l_extendedprice", "DOUBLE"), ("congestion_fee", "DOUBLE")]}
    gone = ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]
    ack = {"ack_date": "2024-01-01", "from": "DOUBLE", "to": "BIGINT"}
    mapping = Mapping("x", {"l_orderkey": "OrderID", "l_quantity": "quantity"}, {"quantity": ack}, {c: ack for c in gone}, {"l_returnflag": {"A": 1, "N": 2, "R": 3}}, {"l_returnflag": "error"})
    plan = plan_file(raw, target, mapping)
    if plan.unresolved:
        raise ValueError(f"unresolved: {plan.unresolved}")
    return apply(spark.read.parquet(path), plan)


# -- footers and profiles ----------------------------------------------------------------------------------------

_FOOTER_COLUMNS = ["l_orderkey", "l_quantity", "l_returnflag"]


@query("footer_stats", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS num_rows, count(*) - count({c}) AS null_count, CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high FROM lineitem" for c in _FOOTER_COLUMNS))
def footer_stats(spark, sf_dir):
    rows = read_footers(configure(spark), [f"{sf_dir}/lineitem.parquet"]).where(F.col("column").isin(_FOOTER_COLUMNS))
    bound = lambda side: F.coalesce(*(F.col(f"{side}_{kind}").cast("string") for kind in ("long", "double", "text")))
    return rows.select("column", "num_rows", "null_count", bound("min").alias("low"), bound("max").alias("high"))


@query(
    "family_stats",
    """SELECT "column", CAST(2 AS BIGINT) AS files_present, CAST(2 AS BIGINT) AS files_with_data, CAST(n AS BIGINT) AS total_rows, lo AS min_number, hi AS max_number FROM (
    SELECT 'o_orderkey' AS "column", 2 * count(*) AS n, CAST(min(o_orderkey) AS DOUBLE) AS lo, CAST(max(o_orderkey) AS DOUBLE) AS hi FROM orders
    UNION ALL SELECT 'o_totalprice', 2 * count(*), min(o_totalprice), max(o_totalprice) FROM orders)""",
)
def family_statistics(spark, sf_dir):
    footers = read_footers(configure(spark), [f"{sf_dir}/orders.parquet"])
    twice = footers.unionByName(footers.withColumn("path", F.concat("path", F.lit("#2"))))
    return family_stats(twice).where(F.col("column").isin("o_orderkey", "o_totalprice")).select("column", "files_present", "files_with_data", "total_rows", "min_number", "max_number")


@query(
    "mixed_type_fold",
    """SELECT 'a' AS "column", min(o_orderpriority) AS min_text, max(o_orderpriority) AS max_text, CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number FROM orders
    UNION ALL SELECT 'b', NULL, NULL, CAST(min(o_custkey) AS DOUBLE), CAST(max(o_custkey) AS DOUBLE) FROM orders""",
)
def mixed_type_fold(spark, sf_dir):
    """A family whose columns change between texts and numbers keeps the bounds of the kind that its first file shows."""
    orders, root = read(spark, sf_dir, "orders"), scratch(spark)
    for when, text, number in (("2024-01", "a", "b"), ("2024-02", "b", "a")):
        orders.select(F.col("o_orderpriority").alias(text), F.col("o_custkey").alias(number)).write.parquet(f"{root}/x_{when}")
    return family_stats(read_footers(spark, list_parquet(spark, root))).select("column", "min_text", "max_text", "min_number", "max_number")


@query("precision_loss", "SELECT count(*) FILTER (WHERE l_extendedprice IS NOT NULL AND l_extendedprice != CAST(l_extendedprice AS BIGINT)) AS lossy_rows FROM lineitem")
def precision_loss(spark, sf_dir):
    return count_lossy(read(spark, sf_dir, "lineitem"), "l_extendedprice", "BIGINT")


_RANGES = {"TINYINT": 7, "SMALLINT": 15, "INTEGER": 31, "BIGINT": 63}


@query(
    "fits_matrix",
    " UNION ALL ".join(
        f"SELECT c AS \"column\", '{t}' AS target, lo >= -(CAST(2 AS HUGEINT) ** {b}) AND hi <= CAST(2 AS HUGEINT) ** {b} - 1 AS fits FROM (SELECT 'l_orderkey' AS c, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem UNION ALL SELECT 'l_linenumber', min(l_linenumber), max(l_linenumber) FROM lineitem UNION ALL SELECT 'l_partkey', min(l_partkey), max(l_partkey) FROM lineitem)"
        for t, b in _RANGES.items()
    ),
)
def fits_matrix(spark, sf_dir):
    rows = read_footers(configure(spark), [f"{sf_dir}/lineitem.parquet"]).where(F.col("column").isin("l_orderkey", "l_linenumber", "l_partkey"))
    each = F.array(*(F.struct(F.lit(t).alias("target"), fits_column(F.col("min_long"), F.col("max_long"), t).alias("fits")) for t in _RANGES))
    return rows.select("column", F.explode(each).alias("x")).select("column", "x.target", "x.fits")


_PROFILED = ["l_quantity", "l_returnflag", "l_linenumber", "l_discount"]


@query("profile_counts", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS total_count, count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count FROM lineitem" for c in _PROFILED))
def profile_counts(spark, sf_dir):
    return profile(read(spark, sf_dir, "lineitem"), _PROFILED).select("column", "total_count", "non_null_count", "unique_count")


@query("profile_numeric", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", min(TRY_CAST({c} AS DOUBLE)) AS min, max(TRY_CAST({c} AS DOUBLE)) AS max, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS avg FROM lineitem" for c in _PROFILED))
def profile_numeric(spark, sf_dir):
    return profile(read(spark, sf_dir, "lineitem"), _PROFILED).select("column", "min", "max", F.round("avg", 6).alias("avg"))


@query("profile_top5", " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INTEGER) AS place FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}) WHERE place <= 5" for c in _PROFILED))
def profile_top5(spark, sf_dir):
    found = profile(read(spark, sf_dir, "lineitem"), _PROFILED)
    return found.select("column", F.posexplode("top_values").alias("p", "value")).select("column", "value", (F.col("p") + 1).alias("place"))


def _profile_sql(table: str, columns: list[str]) -> str:
    one = """SELECT '{c}' AS c, count(*) AS t, count({c}) AS nn, count(DISTINCT {c}) AS u, CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi, avg({c}) AS a,
    (SELECT list(v) FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 5)) AS top FROM {t}"""
    return " UNION ALL ".join(one.format(c=c, t=table) for c in columns)


_PAIRED = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _measures_sql(left: str, right: str, on: str) -> str:
    """The measures of pairs of columns; left and right are tables of profiles."""
    return f"""m AS (SELECT x.c AS a, y.c AS b, abs(x.nn / x.t - y.nn / y.t) AS dn, abs(log10(x.u / x.nn + 0.001) - log10(y.u / y.nn + 0.001)) AS dk,
    least(x.hi, y.hi) - greatest(x.lo, y.lo) AS ov, greatest(CASE WHEN x.hi = x.lo THEN 1 ELSE x.hi - x.lo END, CASE WHEN y.hi = y.lo THEN 1 ELSE y.hi - y.lo END) AS w,
    abs(x.a - y.a) / greatest(abs(x.a), abs(y.a), 1) AS da, len(list_intersect(x.top, y.top)) AS common, greatest(len(x.top), len(y.top)) AS widest, x.u < 20 AND y.u < 20 AS few FROM {left} x JOIN {right} y ON {on})"""


_MEASURES = f"WITH p AS ({_profile_sql('lineitem', _PAIRED)}), {_measures_sql('p', 'p', 'x.c < y.c')}"
_SCORE = "round((greatest(0, 1 - 2 * dn) + greatest(0, 1 - dk) + 2 * CASE WHEN ov >= 0 THEN ov / w ELSE 0 END + greatest(0, 1 - da) + common / widest) / 6, 6)"
_VERIFIED = """(CASE WHEN dn < 0.1 THEN 1 ELSE 0 END + CASE WHEN dk < 0.5 THEN 1 ELSE 0 END + CASE WHEN ov >= 0 AND ov / w > 0.5 THEN 1.5 ELSE 0 END + CASE WHEN da < 0.2 THEN 1 ELSE 0 END + common / 5)
    / (4.5 + CASE WHEN common > 0 OR few THEN 1 ELSE 0 END) >= 0.5"""


def _pairs(spark, sf_dir):
    profiled = profile(read(spark, sf_dir, "lineitem"), _PAIRED)
    found = spark.createDataFrame(profiled.collect(), profiled.schema)  # a row per column; both sides of the join need it
    return drift.profile_pairs(found, found).where("old < new").select(F.col("old").alias("a"), F.col("new").alias("b"), F.round("score", 6).alias("score"), "verified")


@query("similarity_score", f"{_MEASURES} SELECT a, b, {_SCORE} AS score FROM m")
def similarity_score(spark, sf_dir):
    return _pairs(spark, sf_dir).drop("verified")


@query("verify_score", f"{_MEASURES} SELECT a, b, {_VERIFIED} AS verified FROM m")
def verify_score(spark, sf_dir):
    return _pairs(spark, sf_dir).drop("score")


_SAMPLED = "md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR))"
_SAMPLE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("sample_profile", f"WITH s AS (SELECT * FROM lineitem ORDER BY {_SAMPLED} LIMIT 5000) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS total_count, count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count, min(TRY_CAST({c} AS DOUBLE)) AS min, max(TRY_CAST({c} AS DOUBLE)) AS max, round(avg(TRY_CAST({c} AS DOUBLE)), 6) AS avg FROM s" for c in _PROFILED))
def sample_profile(spark, sf_dir):
    chosen = sample(read(spark, sf_dir, "lineitem"), 5000, _SAMPLE_KEYS)
    return profile(chosen, _PROFILED).select("column", "total_count", "non_null_count", "unique_count", "min", "max", F.round("avg", 6).alias("avg"))


@query("sample_percent", f"SELECT count(*) AS n FROM lineitem WHERE {_SAMPLED} < '{least_hash(0.1)}'")
def sample_percent(spark, sf_dir):
    return sample(read(spark, sf_dir, "lineitem"), "10%", _SAMPLE_KEYS).agg(F.count("*").alias("n"))


# -- names and types ---------------------------------------------------------------------------------------------

_NAMES_SQL = f"n AS (SELECT name FROM ({_columns_sql(_TABLES)}) UNION SELECT replace(p_name, ' ', '_') FROM part UNION SELECT p_type || '_pickup_' || lower(p_brand) FROM part)"


def _names(spark, sf_dir):
    """Column names of all tables, and names made of the parts' names, types and brands."""
    part = read(spark, sf_dir, "part")
    made = part.select(F.translate("p_name", " ", "_").alias("name")).union(part.select(F.concat("p_type", F.lit("_pickup_"), F.lower("p_brand"))))
    return _columns(spark, sf_dir, _TABLES).select("name").union(made).distinct()


_NORMALIZED = "list_transform(list_filter(string_split(replace(lower(name), '_', ' '), ' '), lambda w: w <> ''), lambda w: CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.EXPANSIONS.items()) + " ELSE w END)"


@query("name_normalize", f"WITH {_NAMES_SQL} SELECT name, array_to_string({_NORMALIZED}, '') AS normalized FROM n")
def name_normalize(spark, sf_dir):
    return _names(spark, sf_dir).select("name", names.normalized(F.col("name")).alias("normalized"))


@query("name_categories", f"WITH {_NAMES_SQL} SELECT name, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(name), '{'|'.join(parts)}') THEN '{c}' END" for c, parts in names.CATEGORIES.items()) + "], lambda x: x IS NOT NULL), ',') AS categories FROM n")
def name_categories(spark, sf_dir):
    return _names(spark, sf_dir).select("name", F.array_join(names.categories(F.col("name")), ",").alias("categories"))


@query("name_similarity")
def name_similarity(spark, sf_dir):
    """Each table's columns against those of the line items: common subsequences are beyond SQL."""
    every = _columns(spark, sf_dir, _TABLES)
    a, b = every.where("tab <> 'lineitem'").select(F.col("name").alias("a")).distinct(), every.where("tab = 'lineitem'").select(F.col("name").alias("b"))
    return a.join(F.broadcast(b), F.col("a") != F.col("b")).select("a", "b", F.round(names.similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


_SETS = " OR ".join("(x.dtype IN ({0}) AND y.dtype IN ({0}))".format(", ".join(f"'{t}'" for t in group)) for group in [["INTEGER", "BIGINT", "DOUBLE", "FLOAT", "DECIMAL", "NUMERIC", "INT"], ["VARCHAR", "TEXT", "STRING", "CHAR"], ["TIMESTAMP", "DATETIME", "DATE", "TIME"]])


@query("types_compatible_matrix", f"WITH c AS ({_columns_sql(_TABLES)}) SELECT x.name AS a, y.tab || '.' || y.name AS b, x.dtype = y.dtype OR {_SETS} AS compatible FROM c x JOIN c y ON x.tab = 'lineitem' AND y.tab <> 'lineitem'")
def types_compatible_matrix(spark, sf_dir):
    """Whether a line item's column may stand for a column of another table."""
    every = _columns(spark, sf_dir, _TABLES)
    a = every.where("tab = 'lineitem'").select(F.col("name").alias("a"), F.col("dtype").alias("s"))
    b = every.where("tab <> 'lineitem'").select(F.concat_ws(".", "tab", "name").alias("b"), F.col("dtype").alias("t"))
    return b.join(F.broadcast(a)).select("a", "b", compatible(F.col("s"), F.col("t")).alias("compatible"))


@query("type_map_ddl", f"SELECT tab, name, CASE dtype " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TARGET_TYPES.items()) + f" END AS target FROM ({_columns_sql(_TABLES)})")
def type_map_ddl(spark, sf_dir):
    return _columns(spark, sf_dir, _TABLES).select("tab", "name", target_type_column(F.col("dtype")).alias("target"))


# -- drift -------------------------------------------------------------------------------------------------------

#: Orders as three families by status, a folder per quarter, whose schema changes with the years.
_ERAS = [(None, 1997, "cust, price"), (1997, 2000, "o_custkey, price as whole"), (2000, None, "o_custkey, price, o_orderpriority")]
_QUARTERS = """q AS (SELECT DISTINCT o_orderstatus AS data_type, strftime(date_trunc('quarter', o_orderdate), '%Y-%m') AS period, CASE WHEN year(o_orderdate) < 1997 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2 ELSE 3 END AS era FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL),
    t AS (SELECT * FROM (SELECT *, lag(era) OVER (PARTITION BY data_type ORDER BY period) AS was FROM q) WHERE was IS NULL OR was <> era)"""
_SIGNATURES = {1: "o_orderkey:BIGINT,cust:BIGINT,price:DOUBLE", 2: "o_orderkey:BIGINT,o_custkey:BIGINT,price:BIGINT", 3: "o_orderkey:BIGINT,o_custkey:BIGINT,price:DOUBLE,o_orderpriority:VARCHAR"}
_drifted_at: dict[tuple[str, str], str] = {}


def _drifted(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    """The files of the drifted families, written once per application and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _drifted_at:
        root = scratch(configure(spark))
        orders = read(spark, sf_dir, "orders").where("o_orderdate is not null and o_orderstatus is not null")
        orders = orders.withColumns({"kind": F.col("o_orderstatus"), "year": F.year("o_orderdate"), "month": 3 * F.quarter("o_orderdate") - 2})
        price, folders = F.col("o_totalprice").alias("price"), ["kind", "year", "month"]
        eras = [(F.col("year") < 1997, [F.col("o_custkey").alias("cust"), price]), (F.col("year").between(1997, 1999), ["o_custkey", F.col("o_totalprice").cast("bigint").alias("price")]), (F.col("year") >= 2000, ["o_custkey", price, "o_orderpriority"])]
        for during, columns in eras:
            orders.where(during).select("o_orderkey", *columns, *folders).repartition(*folders).write.mode("append").partitionBy(*folders).parquet(root)
        _drifted_at[key] = root
    files = list_parquet(spark, _drifted_at[key])
    kinds = sorted({re.search(r"/kind=([^/]+)/", p)[1] for p in files})
    return {k: [p for p in files if f"/kind={k}/" in p] for k in kinds}


@query("schema_transitions", f"WITH {_QUARTERS} SELECT data_type, period, CASE era " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _SIGNATURES.items()) + " END AS sig FROM t")
def schema_transitions(spark, sf_dir):
    files = drift.family_schemas(spark, _drifted(spark, sf_dir)).withColumn("sig", drift.signature(F.col("columns")))
    return drift.transitions(files, ["data_type"]).select("data_type", "period", "sig")


@query(
    "drift_changes",
    f"""WITH {_QUARTERS}, c AS (SELECT *, lag(period) OVER (PARTITION BY data_type ORDER BY period) AS period_from FROM t)
    SELECT data_type, period_from, period AS period_to, CASE WHEN was = 1 THEN 'o_custkey:BIGINT' || CASE WHEN era = 3 THEN ',o_orderpriority:VARCHAR' ELSE '' END ELSE 'o_orderpriority:VARCHAR' END AS added,
    CASE WHEN was = 1 THEN 'cust:BIGINT' ELSE '' END AS removed, CASE WHEN was = 1 AND era = 3 THEN '' WHEN was = 1 THEN 'price:DOUBLE>BIGINT' ELSE 'price:BIGINT>DOUBLE' END AS retyped FROM c WHERE period_from IS NOT NULL""",
)
def drift_changes(spark, sf_dir):
    """Every change of three families over some eighty files, from one job over their footers."""
    found = drift.changes(drift.family_schemas(spark, _drifted(spark, sf_dir)))
    columns = lambda name: F.array_join(F.transform(name, lambda c: F.concat_ws(":", c["name"], c["dtype"])), ",").alias(name)
    retyped = F.array_join(F.transform("retyped", lambda c: F.concat(c["name"], F.lit(":"), c["old_type"], F.lit(">"), c["new_type"])), ",").alias("retyped")
    return found.select("data_type", "period_from", "period_to", columns("added"), columns("removed"), retyped)


@query(
    "family_scan",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1997 THEN o_custkey END AS cust, CASE WHEN year(o_orderdate) >= 1997 THEN o_custkey END AS o_custkey,
    CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1999 THEN trunc(o_totalprice) ELSE o_totalprice END AS price, CASE WHEN year(o_orderdate) >= 2000 THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus IS NOT NULL""",
)
def family_scan(spark, sf_dir):
    """All rows of files of three schemas as one table: columns by name, of the least type that holds them."""
    files = _drifted(spark, sf_dir)
    return scan(spark, [f"{_drifted_at[spark.sparkContext.applicationId, sf_dir]}/kind=*"]) if files else None


_STRIPPED = "regexp_replace(name, '^[a-z]+_', '')"


@query("schema_diff", f"SELECT coalesce(o.name, n.name) AS name, CASE WHEN o.name IS NULL THEN 'added' WHEN n.name IS NULL THEN 'removed' ELSE 'type_changed' END AS change, o.dtype AS old_type, n.dtype AS new_type FROM (SELECT {_STRIPPED} AS name, dtype FROM ({_columns_sql(['customer'])})) o FULL JOIN (SELECT {_STRIPPED} AS name, dtype FROM ({_columns_sql(['orders'])})) n ON o.name = n.name WHERE o.dtype IS DISTINCT FROM n.dtype")
def schema_diff(spark, sf_dir):
    """From the customers' schema to the orders', without the tables' prefixes."""
    stripped = _columns(spark, sf_dir, ["customer", "orders"]).select("tab", F.regexp_replace("name", "^[a-z]+_", "").alias("name"), "dtype")
    return drift.schema_diff(stripped.where("tab = 'customer'"), stripped.where("tab = 'orders'"))


_OLD, _NEW = ["o_orderkey", "o_custkey", "o_totalprice"], ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
_ACROSS = f"p AS ({_profile_sql('orders', _OLD)}), r AS ({_profile_sql('lineitem', _NEW)}), {_measures_sql('p', 'r', 'true')}"


def _across(spark, sf_dir):
    """Data similarity of the keys and prices of orders with those of line items."""
    kind = lambda c: "DOUBLE" if c.endswith("price") else "BIGINT"
    pairs = drift.data_pairs(configure(spark), [(c, kind(c)) for c in _OLD], [(c, kind(c)) for c in _NEW], f"{sf_dir}/orders.parquet", f"{sf_dir}/lineitem.parquet", 0)
    return pairs.select("old", "new", F.round("score", 6).alias("score"), "verified")


@query(
    "rename_greedy",
    f"""WITH RECURSIVE {_ACROSS}, e AS (SELECT a, b, {_SCORE} AS score, row_number() OVER (ORDER BY {_SCORE} DESC, a, b) AS k FROM m),
    g AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS olds, CAST([] AS VARCHAR[]) AS news, false AS taken
    UNION ALL SELECT e.k, CASE WHEN list_contains(olds, a) OR list_contains(news, b) THEN olds ELSE list_append(olds, a) END, CASE WHEN list_contains(olds, a) OR list_contains(news, b) THEN news ELSE list_append(news, b) END,
    NOT (list_contains(olds, a) OR list_contains(news, b)) FROM g JOIN e ON e.k = g.k + 1)
    SELECT a AS old, b AS new, score FROM g JOIN e ON e.k = g.k WHERE taken""",
)
def rename_greedy(spark, sf_dir):
    return drift.best_pairs(_across(spark, sf_dir))


@query("rename_by_data", f"WITH {_ACROSS} SELECT a AS old, b AS new, {_SCORE} AS score, {_VERIFIED} AS verified FROM m")
def rename_by_data(spark, sf_dir):
    return _across(spark, sf_dir)


@query(
    "column_coverage",
    f"""WITH {_QUARTERS}, c AS (SELECT data_type, unnest(CASE era WHEN 1 THEN ['o_orderkey', 'cust', 'price'] WHEN 2 THEN ['o_orderkey', 'o_custkey', 'price'] ELSE ['o_orderkey', 'o_custkey', 'price', 'o_orderpriority'] END) AS name FROM q)
    SELECT name, string_agg(DISTINCT data_type, ',' ORDER BY data_type) AS types FROM c GROUP BY name""",
)
def column_coverage(spark, sf_dir):
    return drift.column_types(drift.family_schemas(spark, _drifted(spark, sf_dir))).withColumn("types", F.array_join("types", ","))


# -- loads -------------------------------------------------------------------------------------------------------

_DISK_SQL = "SELECT CAST(extract(year FROM l_shipdate) AS INTEGER) AS year, CAST(extract(month FROM l_shipdate) AS INTEGER) AS month, count(*) AS rows FROM lineitem GROUP BY ALL"
_MANIFEST_SQL = """SELECT year, month, CASE WHEN year = 1994 AND month = 3 THEN rows + 1 ELSE rows END AS row_count FROM disk WHERE NOT (year = 1995 AND month >= 11) AND year <> 1996
    UNION ALL SELECT 1993, 13, 5"""


def _manifest(spark, sf_dir):
    """The months of line items, and a manifest that differs from them in a few."""
    items = read(spark, sf_dir, "lineitem")
    disk = items.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(F.count("*").alias("rows"))
    changed = F.when((F.col("year") == 1994) & (F.col("month") == 3), F.col("rows") + 1).otherwise(F.col("rows"))
    manifest = disk.where(~((F.col("year") == 1995) & (F.col("month") >= 11)) & (F.col("year") != 1996)).select("year", "month", changed.alias("row_count"))
    return disk, manifest.union(spark.createDataFrame([(1993, 13, 5)], "year int, month int, row_count bigint"))


@query(
    "reconcile_plan",
    f"""WITH disk AS ({_DISK_SQL}), manifest AS ({_MANIFEST_SQL}), counts AS (SELECT year, CAST(sum(row_count) + CASE WHEN year = 1997 THEN 1 ELSE 0 END AS BIGINT) AS n FROM manifest GROUP BY year),
    joined AS (SELECT coalesce(d.year, m.year) AS year, coalesce(d.month, m.month) AS month, d.rows, m.row_count FROM disk d FULL JOIN manifest m ON d.year = m.year AND d.month = m.month),
    y AS (SELECT year, coalesce(sum(row_count), 0) AS loaded, bool_or(rows IS NULL) AS gone, bool_or(coalesce(rows <> row_count, false)) AS changed, count(*) FILTER (WHERE row_count IS NULL) AS fresh,
    array_to_string(list_sort(list(month) FILTER (WHERE row_count IS NULL)), ',') AS fresh_months, array_to_string(list_sort(list(month) FILTER (WHERE rows IS NOT NULL)), ',') AS present FROM joined GROUP BY year)
    SELECT y.year, CASE WHEN coalesce(n, 0) <> loaded OR gone OR changed THEN 'reload' WHEN fresh > 0 THEN 'append' ELSE 'skip' END AS action,
    CASE WHEN coalesce(n, 0) <> loaded OR gone OR changed THEN coalesce(present, '') WHEN fresh > 0 THEN fresh_months ELSE '' END AS months FROM y LEFT JOIN counts c ON y.year = c.year""",
)
def reconcile_plan(spark, sf_dir):
    disk, manifest = _manifest(spark, sf_dir)
    counts = manifest.groupBy("year").agg((F.sum("row_count") + F.when(F.col("year") == 1997, 1).otherwise(0)).alias("table_rows"))
    return load.reconcile(disk, manifest, counts).withColumn("months", F.array_join("months", ","))


@query(
    "pending_months",
    """WITH span AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS a, CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS b FROM orders),
    every AS (SELECT CAST(unnest(generate_series(a - INTERVAL 2 MONTH, b + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m FROM span)
    SELECT CAST(extract(year FROM m) AS INTEGER) AS year, CAST(extract(month FROM m) AS INTEGER) AS month FROM every WHERE m NOT IN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders)""",
)
def pending_months(spark, sf_dir):
    return pending(read(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("day")), 2, 2)


@query("year_table_counts", "SELECT 'orders_' || CAST(extract(year FROM o_orderdate) AS VARCHAR) AS table_name, count(*) AS n FROM orders GROUP BY 1")
def year_table_counts(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(F.concat(F.lit("orders_"), F.year("o_orderdate")).alias("table_name")).agg(F.count("*").alias("n"))


@query("manifest_integrity", f"WITH disk AS ({_DISK_SQL}), manifest AS ({_MANIFEST_SQL}) SELECT coalesce(d.year, m.year) AS year, coalesce(d.month, m.month) AS month, coalesce(rows = row_count, false) AS intact FROM disk d FULL JOIN manifest m ON d.year = m.year AND d.month = m.month")
def manifest_integrity(spark, sf_dir):
    disk, manifest = _manifest(spark, sf_dir)
    return load.compare_months(disk, manifest).select("year", "month", "intact")


# -- orchestration -----------------------------------------------------------------------------------------------

_STATUS_SQL = "CASE WHEN code = 0 THEN 'ok' WHEN stage = 'download' THEN 'failed' WHEN stage = 'normalize' THEN CASE WHEN code IN (1, 3) THEN 'needs_review' ELSE 'failed' END WHEN code = 1 THEN 'partial' ELSE 'conn_error' END"
#: A run for each customer: exit codes of its stages, from its key and nation.
_CODES = {"download": "CAST(c_custkey % 3 AS INTEGER)", "normalize": "CAST(c_nationkey % 4 AS INTEGER)", "load": "CAST(c_custkey % 5 % 3 AS INTEGER)"}
_RUNS_SQL = "r AS (" + " UNION ALL ".join(f"SELECT c_custkey, '{stage}' AS stage, {code} AS code FROM customer" for stage, code in _CODES.items()) + f"), s AS (SELECT *, {_STATUS_SQL} AS status FROM r)"


def _outcomes(spark, sf_dir):
    """``c_custkey, outcomes``: stage, code and status of each stage of a customer's run."""
    codes = [(stage, F.expr(code)) for stage, code in _CODES.items()]
    each = F.array(*(F.struct(F.lit(stage).alias("stage"), code.alias("code"), pipeline.status_column(F.lit(stage), code).alias("status")) for stage, code in codes))
    return read(spark, sf_dir, "customer").select("c_custkey", each.alias("outcomes"))


@query("classify_outcomes", f"WITH {_RUNS_SQL} SELECT stage, code, status, count(*) AS n FROM s GROUP BY ALL")
def classify_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir).select(F.explode("outcomes").alias("o")).groupBy("o.stage", "o.code", "o.status").agg(F.count("*").alias("n"))


@query("overall_code", f"WITH {_RUNS_SQL} SELECT c_custkey, CAST(max(CASE WHEN status IN ('failed', 'partial', 'conn_error') THEN 2 WHEN status = 'needs_review' THEN 1 ELSE 0 END) AS INTEGER) AS overall FROM s GROUP BY c_custkey")
def overall_code(spark, sf_dir):
    each = _outcomes(spark, sf_dir).select("c_custkey", F.explode("outcomes.status").alias("status"))
    return each.groupBy("c_custkey").agg(pipeline.exit_column(F.col("status")).alias("overall"))


@query(
    "type_label",
    f"""WITH {_RUNS_SQL}, w AS (SELECT c_custkey, max(CASE WHEN stage = 'download' THEN status END) AS d, max(CASE WHEN stage = 'normalize' THEN status END) AS n, max(CASE WHEN stage = 'load' THEN status END) AS l FROM s GROUP BY c_custkey)
    SELECT c_custkey, CASE WHEN d = 'failed' THEN 'DOWNLOAD FAILED' WHEN n = 'needs_review' THEN 'NEEDS REVIEW' WHEN n = 'failed' THEN 'NORMALIZE ERROR' WHEN l = 'ok' THEN 'LOADED' WHEN l = 'partial' THEN 'LOAD PARTIAL' WHEN l = 'conn_error' THEN 'LOAD ERROR' ELSE 'OK' END AS label FROM w""",
)
def type_label(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("c_custkey", pipeline.label_column(F.col("outcomes")).alias("label"))


_BODY = "CASE l_returnflag WHEN 'A' THEN '<Code>AccessDenied</Code>' WHEN 'N' THEN 'no such key: NoSuchKey' ELSE 'slow down' END"


@query("http_classify", f"WITH a AS (SELECT CAST(200 + l_partkey % 500 AS INTEGER) AS status, {_BODY} AS body FROM lineitem) SELECT status, body, CASE WHEN status = 404 OR status = 403 AND (contains(lower(body), 'accessdenied') OR contains(lower(body), 'nosuchkey')) THEN 'notfound' WHEN status IN (403, 429) OR status BETWEEN 500 AND 599 THEN 'ratelimit' ELSE 'neterror' END AS result, count(*) AS n FROM a GROUP BY ALL")
def http_classify(spark, sf_dir):
    answers = read(spark, sf_dir, "lineitem").select(F.expr("CAST(200 + l_partkey % 500 AS INTEGER)").alias("status"), F.expr(_BODY).alias("body"))
    return answers.withColumn("result", classify_column(F.col("status"), F.col("body"))).groupBy("status", "body", "result").agg(F.count("*").alias("n"))
