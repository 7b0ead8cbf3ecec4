"""Hashes of rows that any engine can repeat, for choices that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import column


def row_hash(keys: list[str], seed: int | None = None) -> Column:
    """The md5, in hexadecimal, of the keys as text, after the seed if there is one. Nulls are empty texts."""
    parts = [F.coalesce(column(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *([F.lit(str(seed))] if seed is not None else []), *parts).cast("binary"))


def least_hash(share: float) -> str:
    """The hexadecimal digits below which this share of all hashes lies."""
    place = int(share * 2**32)
    return f"{place:08x}" if place < 2**32 else "g"
