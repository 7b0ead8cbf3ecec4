"""Benchmark decontamination by size-partitioned MinHash containment search, with DataFrame functions only.

Test items are short and documents long, so their Jaccard similarity is small even where the item is copied whole;
what counts is containment: the share of an item's word shingles that the document has. Items are partitioned by
the size of their shingle set, in powers of two. The sketch of an item holds its k least hashes, k being one more than
the largest item of its partition may lack. A document that contains an item of n shingles lacks n - need of them at
most, so it holds at least k - (n - need) of the sketch: one or more, and the more the smaller the item is within its
partition. Documents with so many sketch hits are candidates (none that contains the item is missed), and all
shingles of the item then decide.

Words are runs of letters and digits, lower-cased; shingles are SHINGLE words, hashed to 64 bits. Neither documents
nor their shingles are shuffled while the sketches are within BROADCAST_ROWS, which is counted first; beyond,
the same joins go by shuffle. Matches are counted per (document, item), so no passage, source or item is hot.

Defined results: items of fewer than SHINGLE words (empty or null ones too) match nothing; null or empty documents
match nothing; a pair is given once however often the passage, the document row or the item row is repeated, rows of
one item id making one item; texts of any length are read whole; columns of the input may have any names;
rows without an id match nothing; empty tables give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean, stash

SHINGLE = 5
#: Share of an item's shingles that a document must hold.
THRESHOLD = 0.8
#: Rows that may be broadcast (16 bytes each, some 64 MB); larger sides are shuffled.
BROADCAST_ROWS = 2_000_000


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the word shingles of a text, in order; empty where there are fewer words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = lambda ws: F.transform(F.sequence(F.lit(0), F.size(ws) - size), lambda i: F.xxhash64(*(ws[i + k] for k in range(size))))
    # binding the words by a one-element transform keeps them from being split again for every shingle
    bound = F.transform(F.array(words), lambda ws: F.when(F.size(ws) >= size, grams(ws)).otherwise(F.array().cast("array<bigint>")))
    return bound[0]


def small(df: DataFrame, rows: int) -> DataFrame:
    """A hint to broadcast, given only where the counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def index_items(items: DataFrame, item_id: str, text_col: str, threshold: float, size: int) -> DataFrame:
    """One row per item: its shingle set, its size, the least number to share, its sketch and the hits it must get."""
    grams = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), F.explode(shingles(clean(text_col), size)).alias("h")).distinct()
    sets = grams.groupBy("item").agg(F.array_sort(F.collect_list("h")).alias("all")).withColumn("n", F.size("all"))
    sets = sets.withColumn("need", F.ceil(F.col("n") * threshold - 1e-9).cast("int"))
    # the partition is named by the power of two that no size in it exceeds
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n")))).cast("int")
    length = F.least(F.floor(upper * (1 - threshold) + 1e-9).cast("int") + 1, F.col("n"))
    sets = sets.withColumn("sketch", F.slice("all", F.lit(1), length))
    return sets.withColumn("least_hits", F.greatest(F.lit(1), F.size("sketch") - (F.col("n") - F.col("need"))))


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", item_text: str = "text", threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Pairs ``doc_id, item_id, shared, n_shingles, containment`` with containment of at least ``threshold``."""
    index = stash(index_items(items, item_id, item_text, threshold, size))
    sketch = index.select("item", "least_hits", F.explode("sketch").alias("h"))
    full = index.select("item", F.explode("all").alias("h"))
    n_sketch, n_full = index.select(F.sum(F.size("sketch")), F.sum("n")).first()
    known = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text_col).alias("text"))
    # every document: which items have enough of their sketch here (repeated shingles only add hits)
    seen = known.select("doc", F.explode(shingles(clean("text"), size)).alias("h")).join(small(sketch, n_sketch or 0), "h")
    candidates = stash(seen.groupBy("doc", "item", "least_hits").agg(F.count("*").alias("hits")).where("hits >= least_hits").select("doc", "item"))
    # candidate documents only: all shingles of the items decide
    wanted = candidates.select("doc").distinct()
    some = known.join(small(wanted, wanted.count()), "doc", "left_semi")
    shared = some.select("doc", F.explode(shingles(clean("text"), size)).alias("h")).join(small(full, n_full or 0), "h")
    counts = shared.groupBy("doc", "item", "h").agg(F.lit(1).alias("one")).groupBy("doc", "item").agg(F.count("*").alias("shared"))
    counts = counts.join(candidates, ["doc", "item"], "left_semi")
    judged = counts.join(small(index.select("item", "n", "need"), n_sketch or 0), "item").where("shared >= need")
    return judged.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "shared", F.col("n").cast("long").alias("n_shingles"), (F.col("shared") / F.col("n")).alias("containment"))


def remove(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The documents that contain no item; rows without an id stay."""
    hit = stash(contained(docs, items, doc_id, **options).select(doc_id).distinct())
    return docs.join(small(hit, hit.count()), doc_id, "left_anti").select(*(f"`{c}`" for c in docs.columns))
