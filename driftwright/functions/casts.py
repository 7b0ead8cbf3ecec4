"""Casts with the rounding that file normalisation promises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import is_float, is_integer, is_string, spark_type


def exact_cast(value: Column, source: str, target: str) -> Column:
    """Cast ``value`` from one SQL type to another.

    Floating point to integer rounds half to even; decimals and texts with a fraction or an
    exponent to integer round half away from zero. Values out of range fail.
    """
    kind = spark_type(target)
    if is_integer(target):
        if source.upper().startswith("DECIMAL"):
            return F.round(value, 0).cast(kind)
        if is_float(source):
            return F.rint(value).cast(kind)
        if is_string(source):
            number = F.trim(value)
            return F.when(number.rlike(r"^[+-]?\d+$"), number.cast(kind)).otherwise(F.round(number.cast("decimal(38,15)"), 0).cast(kind))
    return value.cast(kind)


def loses_precision(value: Column, target: str) -> Column:
    """True where a number is not the same after the cast to an integer type; null stays false."""
    return F.coalesce(value != F.rint(value), F.lit(False)) if is_integer(target) else F.lit(False)
