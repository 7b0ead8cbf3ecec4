"""How alike two columns are by their data, over two profile structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _measures(a: Column, b: Column) -> dict[str, Column]:
    """The differences that both scores rest on; null where a pair cannot be compared."""

    def share(p: Column) -> tuple[Column, Column]:
        gaps = F.when(p["total_count"] > 0, 1 - p["non_null_count"] / p["total_count"])
        kinds = F.when(p["non_null_count"] > 0, p["unique_count"] / p["non_null_count"])
        return gaps, F.when(kinds > 0, kinds)

    (gap_a, kinds_a), (gap_b, kinds_b) = share(a), share(b)
    ranged = a["min"].isNotNull() & b["min"].isNotNull()
    width = lambda p: F.when(p["max"] == p["min"], 1.0).otherwise(p["max"] - p["min"])
    shared = F.least(a["max"], b["max"]) - F.greatest(a["min"], b["min"])
    return {
        "nulls": F.abs(gap_a - gap_b),
        "kinds": F.abs(F.log10(kinds_a + 0.001) - F.log10(kinds_b + 0.001)),
        "overlap": F.when(ranged, F.when(shared >= 0, shared / F.greatest(width(a), width(b))).otherwise(0.0)),
        "mean": F.when(ranged, F.abs(a["avg"] - b["avg"]) / F.greatest(F.abs(a["avg"]), F.abs(b["avg"]), F.lit(1.0))),
        "common": F.when((F.size(F.coalesce(a["top_values"], F.array().cast("array<string>"))) > 0) & (F.size(F.coalesce(b["top_values"], F.array().cast("array<string>"))) > 0), F.size(F.array_intersect(a["top_values"], b["top_values"]))),
        "widest": F.greatest(F.size(a["top_values"]), F.size(b["top_values"])),
        "few": (a["unique_count"] < 20) & (b["unique_count"] < 20),
    }


def score(a: Column, b: Column) -> Column:
    """Mean of the comparable terms, 0 to 1; the range counts twice. 0 where nothing can be compared."""
    m = _measures(a, b)
    zero = F.lit(0.0)
    terms = F.array_compact(
        F.array(
            F.when(m["nulls"].isNotNull(), F.greatest(zero, 1 - 2 * m["nulls"])), F.when(m["kinds"].isNotNull(), F.greatest(zero, 1 - m["kinds"])), m["overlap"], m["overlap"],
            F.when(m["mean"].isNotNull(), F.greatest(zero, 1 - m["mean"])), m["common"] / m["widest"],
        )
    )
    total = F.aggregate(terms, zero, lambda s, x: s + x)
    return F.when(F.size(terms) == 0, 0.0).otherwise(total / F.size(terms))


def verified(a: Column, b: Column) -> Column:
    """Whether two columns hold the same kind of data: points over weights of at least a half; null if unknown."""
    m = _measures(a, b)
    part = lambda known, gained, weight: (F.when(known & gained, weight).otherwise(0.0), F.when(known, weight).otherwise(0.0))
    parts = [
        part(m["nulls"].isNotNull(), m["nulls"] < 0.1, 1.0),
        part(m["kinds"].isNotNull(), m["kinds"] < 0.5, 1.0),
        part(m["overlap"].isNotNull(), m["overlap"] > 0.5, 1.5),
        part(m["mean"].isNotNull(), m["mean"] < 0.2, 1.0),
    ]
    met = m["common"] > 0
    parts.append((F.when(met, m["common"] / 5).otherwise(0.0), F.when(met | (m["common"].isNotNull() & m["few"]), 1.0).otherwise(0.0)))
    points, weights = (sum((p[k] for p in parts[1:]), parts[0][k]) for k in (0, 1))
    return F.when(weights > 0, points / weights >= 0.5)
