"""Substring deduplication: paragraphs by MinHash banding, verified by Jaccard, clustered by components.

Texts are cut into paragraphs by their own words: a cut stands where the hash of a pair of words is the least among
REACH pairs to either side, so a passage is cut alike wherever it stands, at line starts or inside other text. A
paragraph's shingles are five words. Paragraphs of equal shingles in order are one content from the start. Contents are
banded (BANDS bands of one row: at a similarity of 0.8 a pair meets with a chance of 0.96, and a passage has several
paragraphs), those that meet are verified on their full shingle sets, and linked contents are clustered by components.
Of each cluster that comes in several documents, the document of the smallest id keeps its occurrences; in the
others they are removed. Neighbouring removals make a run. Each run is extended to the left and right over the words that
equal those around the kept occurrence (WINDOW words at most), past edits of up to GAP words that five equal words
follow, so it reaches to the ends of the passage. Runs that touch, or that are GAP words or fewer apart and kept in one document, become one; then runs of MIN_WORDS
words or more are reported, so an edited passage is found whole and a chance phrase is not. A run that a larger
neighbour reaches over is kept where that one is. Where a document keeps several
occurrences of a paragraph, the first one extends the run.

Texts are cut once into rows of numbers; only paragraphs that share a key with another document go on. Texts are read
again for the shingle sets of contents that met, one document showing each, and for the words around runs and kept
occurrences; they are shuffled for it where what is asked of them is too much to broadcast (BROADCAST_ROWS entries).
Keys are counted with aggregation before the shuffle; buckets are compared with leaders, then under the rarest shingles,
never pair by pair.

Defined results: null and empty texts have no paragraph; what repeats within one document only is no repeat; rows
with a null id take no part; rows that share an id count as one document, so what they repeat of each other is no
repeat; texts of any length are read whole; of equal contents the smallest id keeps, of its occurrences the first is
shown; an empty table gives an empty table. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import claim, drop_stash, ship, slices, stash, trimmed
from .components import components
from .near_dup import _ADD, _ODD, BROADCAST_ROWS, rolling
from .words import _M1, Words, hash_words, mixed, text_slices

SHINGLE = 5
PERCENT = 80
REACH = 5
BANDS = 2
MIN_WORDS = 15
#: Words to either side that a run may be extended by, and the longest unmatched gap that is joined over.
WINDOW, GAP = 64, 5
_MOST = np.uint64(2**64 - 1)


def padded(words: Words, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes with ``pad`` empty places after each text, where each text begins there, and the pairs' marks."""
    begins = np.concatenate(([0], np.cumsum(words.counts + pad)[:-1])) if len(words.counts) else np.empty(0, np.int64)
    first = np.concatenate(([0], np.cumsum(words.counts)[:-1])) if len(words.counts) else np.empty(0, np.int64)
    place = np.arange(len(words.ids)) + np.repeat(begins - first, words.counts)
    ids = np.zeros(len(words.ids) + pad * len(words.counts), np.uint64)
    ids[place] = words.ids
    return ids, begins, place


def least_around(x: np.ndarray, reach: int) -> np.ndarray:
    """The least value among ``reach`` to either side, and the value itself: windows doubled, not tried one by one."""
    wide = np.concatenate([np.full(reach, _MOST), x, np.full(reach, _MOST)])
    width, low = 1, wide
    while 2 * width <= 2 * reach + 1:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    rest = 2 * reach + 1 - width
    return np.minimum(low[: len(x)], low[rest : rest + len(x)])


class Paragraphs(NamedTuple):
    """The paragraphs of several texts: text, first word, words; shingles end to end, their begin and number."""

    text: np.ndarray
    at: np.ndarray
    words: np.ndarray
    first: np.ndarray
    n: np.ndarray
    shingles: np.ndarray

    def contents(self) -> np.ndarray:
        """One hash per paragraph, of its shingles in order."""
        place = np.arange(len(self.shingles)) - np.repeat(self.first, self.n)
        return np.add.reduceat(mixed(self.shingles + place.astype(np.uint64)), self.first) if len(self.first) else np.empty(0, np.uint64)

    def least(self, k: int) -> np.ndarray:
        """The k-th MinHash of each paragraph."""
        return np.minimum.reduceat(self.shingles * _ODD[k] + _ADD[k], self.first) if len(self.first) else np.empty(0, np.uint64)


def cut(column: pa.Array, reach: int = REACH) -> Paragraphs:
    """Texts cut where the hash of a pair of words is the least among ``reach`` pairs to either side."""
    words = hash_words(column, strip=True)
    ids, begins, place = padded(words, reach + 1)
    pair = np.full(len(ids), _MOST)
    open_ = np.zeros(len(ids), bool)
    open_[place] = True
    open_[begins + words.counts - 1] = False  # a text's last word begins no pair
    open_ &= np.repeat(words.counts > 2 * reach, words.counts + reach + 1)
    inner = np.flatnonzero(open_)
    pair[inner] = mixed(ids[inner] * _M1 + ids[inner + 1])
    ends_here = np.flatnonzero((pair == least_around(pair, reach)) & open_) + 1
    # equal minima closer than the reach: only the first cuts
    if len(ends_here):
        ends_here = ends_here[np.concatenate(([True], np.diff(ends_here) > reach))]
    full = words.counts > 0
    starts = np.sort(np.concatenate([begins[full], ends_here]))
    stops = np.sort(np.concatenate([ends_here, (begins + words.counts)[full]]))
    long = stops - starts >= SHINGLE
    starts, stops = starts[long], stops[long]
    text = np.searchsorted(begins, starts, side="right") - 1
    n = stops - starts - SHINGLE + 1
    first = np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else np.empty(0, np.int64)
    inside = np.repeat(starts - first, n) + np.arange(int(n.sum()))
    return Paragraphs(text, starts - begins[text], stops - starts, first, n, rolling(ids, SHINGLE)[inside])


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(df.sparkSession)
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))


def paragraphs(texts: DataFrame) -> DataFrame:
    """One row per paragraph of ``id, text``: ``id, content, key0, key1, at, words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for part in text_slices(batches):
            p = cut(part.column("text"))
            keys = [mixed(p.least(k) + np.uint64(k)) for k in range(BANDS)]
            hashes = [pa.array(x.view(np.int64)) for x in (p.contents(), *keys)]
            yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(p.text)), *hashes, pa.array(p.at.astype(np.int32)), pa.array(p.words.astype(np.int32))], names=["id", "content", "key0", "key1", "at", "words"])

    return texts.mapInArrow(trimmed(run), "id bigint, content bigint, key0 bigint, key1 bigint, at int, words int")


def with_texts(texts: DataFrame, asked: DataFrame, size: str) -> DataFrame:
    """``texts`` joined with what is asked of them by id; broadcast while the asked entries are within BROADCAST_ROWS."""
    n = asked.select(F.sum(F.size(size))).first()[0] or 0
    return texts.join(F.broadcast(asked) if n <= BROADCAST_ROWS else asked, "id")


def shown_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, hashes`` of the wanted contents (``content, low``), each read from the document ``low``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for part in text_slices(batches):
            p = cut(part.column("text"))
            lists, contents = part.column("contents"), p.contents()
            asked = mixed(lists.flatten().to_numpy().view(np.uint64)) + np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()).astype(np.uint64)
            own, first = np.unique(mixed(contents) + p.text.astype(np.uint64), return_index=True)
            kept = np.sort(first[np.isin(own, asked)])
            n = p.n[kept]
            ends = np.concatenate(([0], np.cumsum(n)))
            inside = np.repeat(p.first[kept] - ends[:-1], n) + np.arange(ends[-1])
            yield pa.RecordBatch.from_arrays([pa.array(contents[kept].view(np.int64)), pa.ListArray.from_arrays(ends.astype(np.int32), p.shingles[inside].view(np.int64))], names=["id", "hashes"])

    by_text = stash(wanted.groupBy(F.col("low").alias("id")).agg(F.collect_set("content").alias("contents")))
    made = with_texts(texts, by_text, "contents").mapInArrow(trimmed(run), "id bigint, hashes array<bigint>")
    return made.select("id", F.array_distinct("hashes").alias("hashes"))


def alike(one: Column, other: Column) -> Column:
    """Exact Jaccard similarity of PERCENT or more; sizes are looked at first."""
    n, m = F.size(one), F.size(other)
    shared = F.size(F.array_intersect(one, other))
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (100 * shared >= PERCENT * (n + m - shared))


def rare_shingles(nodes: DataFrame) -> DataFrame:
    """``id, rare`` of ``id, hashes``: two sets as alike as PERCENT share one of their rarest shingles.

    Of n shingles that may lack n - ceil(n * PERCENT / 100), the rarest of one number more are enough to look under;
    of these, those that no other node has lead nowhere.
    """
    each = nodes.select("id", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    often = each.groupBy("h").agg(F.count("*").alias("often"))
    ranked = each.join(often, "h").groupBy("id").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "h"))).alias("order"))
    first = F.slice("order", F.lit(1), (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int"))
    return ranked.select("id", F.explode(F.filter(first, lambda x: x["often"] > 1)["h"]).alias("rare"))


def content_clusters(texts: DataFrame, contents: DataFrame) -> DataFrame | None:
    """``node, component`` of the contents (``content, key0, key1, low, times``) that are linked with others.

    In each bucket the content that comes most often leads and is compared with all. Contents of buckets that lie in
    several components by then are joined on their rare shingles, where they share a bucket: a bucket that many unlike
    paragraphs fill, as around a much repeated passage, makes no pairs.
    """
    keyed = contents.select(F.col("content").alias("id"), "low", "times", F.explode(F.array("key0", "key1")).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key")
    met = stash(keyed.join(shared, "key"))
    if met.isEmpty():
        return None
    wanted = met.groupBy(F.col("id").alias("content")).agg(F.min("low").alias("low"))
    sets = stash(shown_sets(texts, wanted))
    leaders = met.groupBy("key").agg(F.max_by("id", F.col("times") * 65536 + F.pmod("id", F.lit(65536))).alias("a"))
    ahead = leaders.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ahead")), "a").select("a", "ahead", F.xxhash64("key").alias("bucket"))
    own = met.select("id", F.xxhash64("key").alias("bucket")).join(sets, "id")
    links = stash(own.join(ahead, "bucket").where((F.col("id") != F.col("a")) & alike(F.col("hashes"), F.col("ahead"))).select("a", F.col("id").alias("b")))
    label = None if links.isEmpty() else components(links)
    placed = met.select("id", "key")
    if label is None:
        placed = placed.withColumn("comp", F.col("id"))
    else:
        placed = placed.join(label.select(F.col("node").alias("id"), "component"), "id", "left").select("id", "key", F.coalesce("component", "id").alias("comp"))
    placed = stash(placed)
    several = placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b").select("key")
    open_ = placed.join(several, "key").groupBy("id").agg(F.min("comp").alias("comp"), F.collect_set("key").alias("keys"))
    nodes = stash(open_.join(sets, "id").dropDuplicates(["id"]))
    looked = nodes.join(rare_shingles(nodes), "id")
    a, b = looked.alias("a"), looked.alias("b")
    meet = (F.col("a.rare") == F.col("b.rare")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.comp") != F.col("b.comp")) & F.arrays_overlap("a.keys", "b.keys")
    more = stash(a.join(b, meet & alike(F.col("a.hashes"), F.col("b.hashes"))).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
    return label if more.isEmpty() else components(links.union(more))


def windows(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """``id, place, right, here, near, edge`` of the asked ``id, place, right``: the outer edge, in code points, of the
    word at the place; hashes (32 bits) of the words from there outward, nearest first, and their outer edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substring_dedup")
        for part in text_slices(batches):
            words = hash_words(part.column("text"), strip=True)
            letters = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
            first = np.concatenate(([0], np.cumsum(words.counts)))
            lists = part.column("places")
            which = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            asked = lists.flatten().to_numpy()  # twice the word position, one more to the right
            place, right = asked >> 1, (asked & 1).astype(bool)
            at = first[which] + place
            n = np.where(right, np.minimum(first[which + 1] - at, WINDOW), np.minimum(place, WINDOW))
            ends = np.concatenate(([0], np.cumsum(n)))
            step = np.arange(ends[-1]) - np.repeat(ends[:-1], n)
            word = np.repeat(np.where(right, at, at - 1), n) + step * np.repeat(np.where(right, 1, -1), n)
            begin = letters[words.offsets[which]]
            edge = np.where(np.repeat(right, n), letters[words.ends[word]], letters[words.starts[word]]) - np.repeat(begin, n)
            # a place is that of a paragraph's first word, or follows its last
            here = np.where(right, letters[words.ends[np.maximum(at - 1, 0)]], letters[words.starts[np.minimum(at, len(words.ids) - 1)]]) - begin if len(at) else at
            near, bounds = (words.ids[word] >> np.uint64(32)).astype(np.uint32).view(np.int32), pa.array(ends.astype(np.int32))
            columns = [part.column("id").take(pa.array(which)), pa.array(place), pa.array(right), pa.array(here), pa.ListArray.from_arrays(bounds, pa.array(near)), pa.ListArray.from_arrays(bounds, pa.array(edge.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "place", "right", "here", "near", "edge"])

    by_text = stash(asked.groupBy("id").agg(F.collect_set(F.col("place") * 2 + F.col("right").cast("int")).alias("places")))
    made = stash(with_texts(texts, by_text, "places").mapInArrow(trimmed(run), "id bigint, place bigint, right boolean, here bigint, near array<int>, edge array<int>"))
    # rows that share an id answer more than once
    return made if made.count() == by_text.select(F.sum(F.size("places"))).first()[0] else made.dropDuplicates(["id", "place", "right"])


#: Edits that a run may go past: words to skip in the run's own text and in the kept one, the least first.
EDITS = np.array(sorted(((a, b) for a in range(GAP + 1) for b in range(GAP + 1)), key=lambda ab: (ab[0] + ab[1], ab)))


def square(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The lists as rows of WINDOW places, -1 - row and beyond where they end; and their lengths."""
    sizes = lists.value_lengths().to_numpy()
    out = np.full((len(lists), WINDOW + GAP + SHINGLE), -1, np.int64)
    out[np.repeat(np.arange(len(lists)), sizes), np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy().view(np.uint32)
    return out, sizes


def reach(own: pa.ListArray, kept: pa.ListArray) -> np.ndarray:
    """For every row, how many words of ``own`` equal those of ``kept``, edits of at most GAP words to either side
    included where SHINGLE equal words follow them."""
    (x, n), (y, m) = square(own), square(kept)
    grams = []
    for words, sizes in ((x, n), (y, m)):
        rolled = np.zeros((len(words), WINDOW + GAP), np.uint64)
        for k in range(SHINGLE):
            rolled = rolled * _M1 + words[:, k : k + rolled.shape[1]].astype(np.uint64)
        grams.append((mixed(rolled), np.arange(rolled.shape[1]) + SHINGLE <= sizes[:, None]))
    i, j = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    rows, steps = np.arange(len(x)), np.arange(WINDOW)
    while len(rows):
        at, to = np.minimum(i[rows, None] + steps, WINDOW), np.minimum(j[rows, None] + steps, WINDOW)
        differs = (x[rows[:, None], at] != y[rows[:, None], to]) | (i[rows, None] + steps >= n[rows, None]) | (j[rows, None] + steps >= m[rows, None])
        same = np.where(differs.any(1), differs.argmax(1), WINDOW)
        i[rows] += same
        j[rows] += same
        a, b = i[rows, None] + EDITS[:, 0], j[rows, None] + EDITS[:, 1]
        inside = (a < n[rows, None]) & (b < m[rows, None])
        a, b = np.minimum(a, WINDOW - 1), np.minimum(b, WINDOW - 1)
        meets = inside & grams[0][1][rows[:, None], a] & grams[1][1][rows[:, None], b] & (grams[0][0][rows[:, None], a] == grams[1][0][rows[:, None], b])
        past, first = meets.any(1), meets.argmax(1)
        rows, first = rows[past], first[past]
        i[rows] += EDITS[first, 0]
        j[rows] += EDITS[first, 1]
    return i


def extended(texts: DataFrame, runs: DataFrame, kept: DataFrame) -> DataFrame:
    """Runs with ``at`` and ``until`` moved outward over what equals the kept occurrence, and ``start`` and ``stop``.

    runs: ``id, run, at, until`` and the outer paragraphs ``first`` and ``last``, struct(content, cluster, kept_in);
    kept: ``content, cluster, at, until`` of the kept occurrences.
    """
    # by hashes made after the aggregation: the joins' sides then pass exchanges of their own, so a hot cluster is split
    place, group = F.xxhash64("cluster", "content").alias("place_of"), F.xxhash64("cluster").alias("group_of")
    exact = kept.groupBy("cluster", "content").agg(F.min(F.struct("at", "until")).alias("exact")).select(place, "exact")
    near = kept.groupBy("cluster").agg(F.min(F.struct("at", "until")).alias("like")).select(group, "like")
    side = lambda name, place, right: runs.select("id", "run", f"{name}.*", F.col(place).alias("place"), F.lit(right).alias("right"))
    edges = side("first", "at", False).union(side("last", "until", True))
    edges = edges.select("*", place, group).join(exact, "place_of", "left").join(near, "group_of")
    found = F.coalesce("exact", "like")
    edges = stash(edges.select("id", "run", "place", "right", "kept_in", F.when(F.col("right"), found["until"]).otherwise(found["at"]).alias("kept_place")))
    asked = edges.select("id", "place", "right").union(edges.select("kept_in", "kept_place", "right")).distinct()
    seen = windows(texts, asked)
    there = seen.select(F.col("id").alias("kept_in"), F.col("place").alias("kept_place"), "right", F.col("near").alias("kept_near"))
    both = edges.join(seen, ["id", "place", "right"]).join(there, ["kept_in", "kept_place", "right"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            more = reach(part.column("near"), part.column("kept_near"))
            edges = part.column("edge")
            first = edges.offsets.to_numpy()[:-1] - edges.offsets[0].as_py()
            flat = np.append(edges.flatten().to_numpy(), 0)
            edge = np.where(more > 0, flat[np.minimum(first + np.maximum(more - 1, 0), len(flat) - 1)], part.column("here").to_numpy())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "run", "right")), pa.array(more, pa.int64()), pa.array(edge, pa.int64())], names=["id", "run", "right", "more", "edge"])

    both = both.select("id", "run", "right", "here", "near", "kept_near", "edge").mapInArrow(trimmed(run), "id bigint, run bigint, right boolean, more bigint, edge bigint")
    moved = both.groupBy("id", "run").agg(*(F.max(F.when(F.col("right") == r, F.col(c))).alias(f"{c}_{name}") for r, name in ((False, "left"), (True, "right")) for c in ("more", "edge")))
    out = runs.join(moved, ["id", "run"])
    return out.select("id", "run", (F.col("at") - F.col("more_left")).alias("at"), (F.col("until") + F.col("more_right")).alias("until"), F.col("edge_left").alias("start"), F.col("edge_right").alias("stop"), "kept_in", "clusters", F.struct("at", "until", (F.col("until") - F.col("at")).alias("n")).alias("core"))


def live(paras: DataFrame) -> DataFrame:
    """The paragraphs that share a key with one of another document; all others can neither repeat nor be alike."""
    out = paras
    for k in range(BANDS):
        key = f"key{k}"
        met = paras.groupBy(key).agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select(key, F.lit(True).alias(f"met{k}"))
        # sorted and merged, so that no side must fit in memory; a hot key's paragraphs are split by the skew join
        out = out.join(met, key, "left")
    return out.where(" or ".join(f"met{k}" for k in range(BANDS))).select(paras.columns)


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed run: id, ``start`` and ``stop`` (code points), ``n_words``, ``kept_in`` and ``clusters``."""
    texts = texts_of(df, id_col, text_col)
    every = stash(paragraphs(texts), dictionary=False)
    paras = stash(live(every), dictionary=False)
    drop_stash(every)
    contents = stash(paras.groupBy("content").agg(F.min("key0").alias("key0"), F.min("key1").alias("key1"), F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("times")))
    label = content_clusters(texts, contents)
    if label is None:
        repeated = contents.where("low < high").select("content", F.col("content").alias("cluster"), F.col("low").alias("kept_in"))
    else:
        known = contents.select("content", "low", "high").join(label.select(F.col("node").alias("content"), "component"), "content", "left").where("component is not null or low < high")
        known = known.withColumn("cluster", F.coalesce("component", "content"))
        owners = known.groupBy("cluster").agg(F.min("low").alias("kept_in"), F.max("high").alias("last")).where("kept_in < last")
        repeated = known.select("content", "cluster").join(owners.select("cluster", "kept_in"), "cluster")
    repeated = stash(repeated.select("content", "cluster", "kept_in"))
    shown = paras.select("id", "content", "at", "words").join(repeated, "content")
    shown = stash(shown.withColumn("at", F.col("at").cast("bigint")).withColumn("until", F.col("at") + F.col("words")).drop("words"))
    gone = shown.where("id <> kept_in")
    # neighbours: within a document, a paragraph follows another where that one's last word ends
    order = Window.partitionBy("id").orderBy("at")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = order.rowsBetween(Window.unboundedPreceding, 0)
    new = F.coalesce(((F.lag("until").over(order) != F.col("at")) | (F.lag("kept_in").over(order) != F.col("kept_in"))).cast("int"), F.lit(1))
    outer = F.struct("content", "cluster", "kept_in")
    runs = gone.withColumn("new", new).withColumn("run", F.sum("new").over(numbered)).groupBy("id", "run").agg(
        F.min("at").alias("at"), F.max("until").alias("until"), F.min_by(outer, "at").alias("first"), F.max_by(outer, "at").alias("last"),
        F.min("kept_in").alias("kept_in"), F.collect_set("cluster").alias("clusters"),
    )
    runs = extended(texts, stash(runs), shown.where("id = kept_in").select("content", "cluster", "at", "until"))
    gap = F.col("at") - F.max("until").over(before)
    other = F.lag("kept_in").over(order) != F.col("kept_in")
    # a run that a larger neighbour covers, but for GAP words, is kept where that one is
    by_last = (F.col("core.until") - F.greatest(F.lag("until").over(order), "core.at") <= GAP) & (F.lag("core.n").over(order) >= F.col("core.n"))
    by_next = (F.least(F.lead("at").over(order), "core.until") - F.col("core.at") <= GAP) & (F.lead("core.n").over(order) > F.col("core.n"))
    covered = F.coalesce(by_last, F.lit(False)) | F.coalesce(by_next, F.lit(False))
    apart = F.coalesce(((gap > GAP) | ((gap > 0) & other)).cast("int"), F.lit(1))
    joined = runs.withColumn("new", apart).withColumn("covered", covered).withColumn("run", F.sum("new").over(numbered))
    found = joined.groupBy("id", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max("until") - F.min("at")).alias("n_words"),
        F.array_sort(F.collect_set(F.when(~F.col("covered"), F.col("kept_in")))).alias("kept_in"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("clusters")))).alias("clusters"),
    )
    return found.where(F.col("n_words") >= min_words).select(F.col("id").alias(id_col), "start", "stop", "n_words", "kept_in", "clusters")
