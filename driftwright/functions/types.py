"""SQL type names of file schemas, their Spark types, families, ranges and target-database types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class TypeMappingError(ValueError):
    """A type that the target database has no counterpart for."""


#: SQL names of Spark's simple types.
_NAMES = {
    T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE", T.BinaryType: "BLOB",
}
#: Other names of the same types.
_ALIASES = {
    "INT8": "TINYINT", "INT16": "SMALLINT", "INT32": "INTEGER", "INT": "INTEGER", "REAL": "FLOAT", "TEXT": "VARCHAR", "STRING": "VARCHAR", "CHAR": "VARCHAR",
    "BPCHAR": "VARCHAR", "BOOL": "BOOLEAN", "TIMESTAMP_S": "TIMESTAMP", "TIMESTAMP_MS": "TIMESTAMP", "TIMESTAMP_NS": "TIMESTAMP", "TIMESTAMP_TZ": "TIMESTAMP WITH TIME ZONE",
}
#: The target database's type for each SQL type.
TARGET_TYPES = {
    "BIGINT": "BIGINT", "INTEGER": "INT", "INT": "INT", "INT32": "INT", "DOUBLE": "FLOAT", "FLOAT": "REAL", "REAL": "REAL", "VARCHAR": "NVARCHAR(MAX)",
    "TEXT": "NVARCHAR(MAX)", "STRING": "NVARCHAR(MAX)", "TIMESTAMP": "DATETIME2", "TIMESTAMP_NS": "DATETIME2", "TIMESTAMP_S": "DATETIME2", "TIMESTAMP_MS": "DATETIME2",
    "TIMESTAMP WITH TIME ZONE": "DATETIMEOFFSET", "TIMESTAMP_TZ": "DATETIMEOFFSET", "BOOLEAN": "BIT", "BOOL": "BIT", "DATE": "DATE", "SMALLINT": "SMALLINT",
    "INT16": "SMALLINT", "TINYINT": "TINYINT", "INT8": "TINYINT", "HUGEINT": "DECIMAL(38,0)",
}
#: Bits of the signed integer types.
INTEGER_BITS = {"TINYINT": 8, "SMALLINT": 16, "INTEGER": 32, "BIGINT": 64}
INTEGERS = (*INTEGER_BITS, "HUGEINT")
FLOATS = ("DOUBLE", "FLOAT", "REAL", "DECIMAL")
STRINGS = ("VARCHAR", "CHAR", "TEXT", "STRING", "BPCHAR")
TEMPORALS = ("DATE", "TIME", "TIMESTAMP")
_DECIMAL = re.compile(r"(?:DECIMAL|NUMERIC)\((\d+),\s*(\d+)\)")


def sql_name(kind: T.DataType) -> str:
    """The SQL name of a Spark type; nested types keep Spark's own notation, in capitals."""
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    return _NAMES.get(type(kind), kind.simpleString().upper())


def spark_type(name: str) -> T.DataType:
    """The Spark type of a SQL name."""
    low = name.strip().upper()
    low = _ALIASES.get(low, low)
    if found := _DECIMAL.fullmatch(low):
        return T.DecimalType(int(found[1]), int(found[2]))
    if low == "HUGEINT":
        return T.DecimalType(38, 0)
    if low.startswith("VARCHAR("):
        return T.StringType()
    for kind, own in _NAMES.items():
        if own == low:
            return kind()
    raise TypeMappingError(f"no Spark type for {name!r}")


def target_type(name: str) -> str:
    """The target database's type, without regard to case; decimals keep precision and scale."""
    low = name.strip().upper()
    if low in TARGET_TYPES:
        return TARGET_TYPES[low]
    if found := re.match(r"DECIMAL\((\d+),\s*(\d+)\)", low):
        return f"DECIMAL({found[1]},{found[2]})"
    raise TypeMappingError(f"the target database has no type for {name!r}")


def target_type_column(name: Column) -> Column:
    """As ``target_type``, over a column; unmapped types are null."""
    low = F.upper(F.trim(name))
    lookup = F.create_map(*(F.lit(x) for pair in TARGET_TYPES.items() for x in pair))
    decimal = F.concat(F.lit("DECIMAL("), F.regexp_extract(low, r"^DECIMAL\((\d+),", 1), F.lit(","), F.regexp_extract(low, r",\s*(\d+)\)", 1), F.lit(")"))
    return F.coalesce(lookup[low], F.when(low.rlike(r"^DECIMAL\(\d+,\s*\d+\)"), decimal))


def is_integer(name: str) -> bool:
    return name.upper().startswith(INTEGERS)


def is_float(name: str) -> bool:
    return name.upper().startswith(FLOATS)


def is_string(name: str) -> bool:
    return name.upper().startswith(STRINGS)


def family(name: str) -> str:
    """string, numeric, temporal, bool or other, by the beginning of the name."""
    low = (name or "").upper()
    for label, begins in (("string", STRINGS), ("numeric", (*INTEGERS, "INT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT", *FLOATS)), ("temporal", TEMPORALS), ("bool", ("BOOL",))):
        if low.startswith(begins):
            return label
    return "other"


def cast_runs(source: str, target: str) -> bool:
    """Whether a cast succeeds whatever the values: to a string, or within a family."""
    return family(target) == "string" or family(source) == family(target)


def fits(low, high, longest: int | None, target: str) -> tuple[bool, str]:
    """Whether values from ``low`` to ``high`` (texts up to ``longest``) fit a type; what speaks against it.

    Only signed integers and sized texts are judged; every other target counts as fitting.
    """
    name = target.upper()
    if name in INTEGER_BITS:
        least, most = -(1 << INTEGER_BITS[name] - 1), (1 << INTEGER_BITS[name] - 1) - 1
        known = [v for v in (low, high) if v is not None]
        if any(isinstance(v, str) or not isinstance(v, (int, float)) for v in known):
            return False, f"{low!r} to {high!r} cannot be compared with {name}"
        if low is not None and low < least:
            return False, f"least value {low} is under the range of {name}"
        if high is not None and high > most:
            return False, f"greatest value {high} is over the range of {name}"
    elif sized := re.fullmatch(r"VARCHAR\((\d+)\)", name):
        if longest is not None and longest > int(sized[1]):
            return False, f"texts of {longest} characters exceed {name}"
    return True, ""


def fits_column(low: Column, high: Column, target: str) -> Column:
    """As ``fits`` for numeric bounds."""
    name = target.upper()
    if name not in INTEGER_BITS:
        return F.lit(True)
    # bounds are compared as decimals: a double cannot hold the ends of BIGINT
    wide = "decimal(38,6)"
    least, most = F.lit(str(-(1 << INTEGER_BITS[name] - 1))).cast(wide), F.lit(str((1 << INTEGER_BITS[name] - 1) - 1)).cast(wide)
    return F.coalesce(low.cast(wide) >= least, F.lit(True)) & F.coalesce(high.cast(wide) <= most, F.lit(True))


#: Types that may stand for each other.
INTERCHANGEABLE = [
    ["INTEGER", "BIGINT", "DOUBLE", "FLOAT", "DECIMAL", "NUMERIC", "INT"],
    ["VARCHAR", "TEXT", "STRING", "CHAR"],
    ["TIMESTAMP", "DATETIME", "DATE", "TIME"],
]


def compatible(a: Column, b: Column) -> Column:
    """Equal types, or two of one interchangeable group; names with parameters only match themselves."""
    either = a == b
    for group in INTERCHANGEABLE:
        either = either | (F.upper(a).isin(group) & F.upper(b).isin(group))
    return either
