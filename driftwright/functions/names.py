"""Similarity of column names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for others in column names; prefixes without meaning become empty.
EXPANSIONS = {
    "amt": "amount", "lat": "latitude", "lon": "longitude", "long": "longitude", "fwd": "forward", "id": "id", "num": "number", "cnt": "count", "dist": "distance",
    "dt": "datetime", "ts": "timestamp", "pu": "pickup", "do": "dropoff", "loc": "location", "src": "source", "dst": "destination", "pax": "passenger",
    "surchg": "surcharge", "start": "pickup", "end": "dropoff", "origin": "pickup", "destination": "dropoff", "trip": "", "tpep": "", "lpep": "",
}
#: Parts of names that put a column into a category.
CATEGORIES = {
    "pickup": ["pickup", "start", "origin", "pu_", "_pu", "pulocation"],
    "dropoff": ["dropoff", "drop_off", "end", "destination", "do_", "_do", "dolocation"],
    "coordinate": ["lat", "lon"],
    "location_id": ["locationid", "location_id"],
    "amount": ["amount", "amt", "fare", "fee", "surcharge", "tax", "tip", "toll"],
    "datetime": ["date", "time"],
}
#: Categories that two names must share if either has one and the other has any.
EXCLUSIVE = ("coordinate", "location_id", "amount", "datetime")


def tokens(name: Column) -> Column:
    """Words of a name, expanded."""
    lookup = F.create_map(*(F.lit(x) for pair in EXPANSIONS.items() for x in pair))
    words = F.filter(F.split(F.regexp_replace(F.lower(name), "_", " "), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.coalesce(lookup[w], w))


def normalized(name: Column) -> Column:
    return F.array_join(tokens(name), "")


def categories(name: Column) -> Column:
    """The categories of a name, in the order of CATEGORIES."""
    low = F.lower(name)
    found = [F.when(low.rlike("|".join(parts)), F.lit(label)) for label, parts in CATEGORIES.items()]
    return F.array_compact(F.array(*found))


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, row by row of the usual table."""
    xs, ys = F.filter(F.split(a, ""), lambda c: c != ""), F.filter(F.split(b, ""), lambda c: c != "")
    first = F.array_repeat(F.lit(0), F.size(ys) + 1)
    places = F.sequence(F.lit(1), F.size(ys))

    def next_row(row: Column, x: Column) -> Column:
        def cell(made: Column, j: Column) -> Column:
            value = F.when(F.element_at(ys, j) == x, row[j - 1] + 1).otherwise(F.greatest(row[j], made[j - 1]))
            return F.concat(made, F.array(value))

        return F.aggregate(places, F.array(F.lit(0)), cell)

    table = F.aggregate(xs, first, next_row)
    return F.when((F.size(xs) == 0) | (F.size(ys) == 0), 0).otherwise(F.element_at(table, -1))


def similarity(a: Column, b: Column) -> Column:
    """Similarity of two column names, 0 to 1.

    Names of conflicting categories score 0, equal normalised names 1, contained ones the ratio of lengths, others the
    greater of the tokens' Jaccard similarity and the ratio of the longest common subsequence.
    """
    ca, cb = categories(a), categories(b)
    has = F.array_contains
    conflict = (has(ca, "pickup") & has(cb, "dropoff")) | (has(ca, "dropoff") & has(cb, "pickup"))
    for label in EXCLUSIVE:
        conflict = conflict | (has(ca, label) & ~has(cb, label) & (F.size(cb) > 0)) | (has(cb, label) & ~has(ca, label) & (F.size(ca) > 0))
    na, nb = normalized(a), normalized(b)
    la, lb = F.length(na), F.length(nb)
    ta, tb = (F.array_distinct(F.filter(tokens(n), lambda w: w != "")) for n in (a, b))
    jaccard = F.size(F.array_intersect(ta, tb)) / F.greatest(F.size(F.array_union(ta, tb)), F.lit(1))
    sequence = F.when((la > 0) & (lb > 0), 2 * common_subsequence(na, nb) / (la + lb)).otherwise(0.0)
    apart = F.when((F.size(ta) == 0) | (F.size(tb) == 0), 0.0).otherwise(F.greatest(jaccard, sequence))
    inside = na.contains(nb) | nb.contains(na)
    return F.when(conflict, 0.0).when(na == nb, 1.0).when(inside, F.least(la, lb) / F.greatest(la, lb)).otherwise(apart)
