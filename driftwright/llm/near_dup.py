"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A signature has SYMBOLS MinHash values of 16 bits; its distance is the number of symbols that differ. Signatures
are split into CHUNKS chunks. Two signatures within RADIUS agree, by pigeonhole, in some chunk but for at most
``RADIUS // CHUNKS`` symbols, so each chunk is looked up once for every way of leaving that many symbols out: all
pairs within RADIUS meet. At a Jaccard similarity of 0.85 the distance exceeds RADIUS with a chance of 1e-4.
Beyond RADIUS, pairs that have a chunk with one symbol or none apart still meet: at 0.8 all but 3e-5. Shingle size and
threshold can be given; the signature distance that is let through follows the threshold (``short_radius``).
Links are then confirmed on the full sets of shingle hashes (64 bits).

Groups never become all their pairs. Equal sets are one node from the start. Nodes that meet in a bucket are first
compared with one leader per bucket and size band, of several leaders the nearest; first leads the node that shares most with others,
as the text does that they were copied from. A bucket whose nodes are all in one component by then is done. After
STAR_ROUNDS such rounds, with other leaders and bands, only pairs between different components are left; these are
joined under the signature distance, the size bound and the distance of long signatures, so that no link between
components is lost (but for four deviations of the estimate), and few other pairs are made.

Defined results: words are split at ASCII white space, A-Z lower-cased. Texts of fewer words than a shingle are one shingle;
null, empty and blank texts have none and are linked with nothing. A null id takes no part (component null, kept).
Repeated rows belong together. In ``link`` rows that share an id count as one node; ``keep_one`` tells them apart by their
texts. An empty table gives an empty table. Columns of the input may have any names but those that begin with ``driftwright_``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, drop_stash, ship, slices, stash, trimmed
from .components import components
from .words import _M1, _M2, hash_words, mixed, text_slices

SHINGLE = 3
#: 100 * intersection >= PERCENT * union
PERCENT = 85
SYMBOLS, CHUNKS, RADIUS = 40, 8, 15
STAR_ROUNDS = 3
#: Symbols of the long signatures that judge what the rounds with leaders leave over.
LONG = 1020
BROADCAST_ROWS = 2_000_000
_ODD = np.random.RandomState(20240229).randint(1, 2**62, SYMBOLS, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.RandomState(7).randint(1, 2**62, SYMBOLS, dtype=np.int64).astype(np.uint64)


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each place on."""
    rolled = np.zeros(max(len(ids) - size + 1, 0), np.uint64)
    for k in range(size):
        rolled += ids[k : k + len(rolled)] * np.uint64((int(_M1) + 2 * k) % 2**64)
    return mixed(rolled)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of the word shingles of every text."""
    words = hash_words(column)
    rolled, sets, at = rolling(words.ids, size), [], 0
    for n in words.counts.tolist():
        if n >= size:
            sets.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            sets.append(mixed(rolling(words.ids[at : at + n], n) + np.uint64(n * int(_M2) % 2**64)))
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    return shingle_sets(pa.array([text], pa.string()), size)[0]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SYMBOLS values of 16 bits for each set."""
    least = np.full((len(sets), SYMBOLS), np.iinfo(np.uint64).max, np.uint64)
    full = np.flatnonzero([len(s) for s in sets])
    if len(full):
        flat = np.concatenate([sets[k] for k in full])
        first = np.concatenate(([0], np.cumsum([len(sets[k]) for k in full])[:-1]))
        for k in range(SYMBOLS):
            least[full, k] = np.minimum.reduceat(flat * _ODD[k] + _ADD[k], first)
    return mixed(least) & np.uint64(0xFFFF)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Per signature, one 64-bit key for each chunk and each symbol left out of it."""
    width, keys = SYMBOLS // CHUNKS, []
    for c in range(CHUNKS):
        for out in range(width):
            key = np.full(len(signatures), c * width + out + 1, np.uint64)
            for k in range(width):
                if k != out:
                    key = mixed(key) + signatures[:, c * width + k]
            keys.append(mixed(key))
    return np.stack(keys, 1)


def packed(signatures: np.ndarray) -> list[np.ndarray]:
    """The lowest three bits of each symbol, 20 to an integer; fewer differ there than in the whole symbols."""
    out = []
    for half in range(0, SYMBOLS, 20):
        word = np.zeros(len(signatures), np.uint64)
        for k in range(20):
            word |= (signatures[:, half + k] & np.uint64(7)) << np.uint64(3 * k)
        out.append(word)
    return out


def sign(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, set size, two hashes of the set, the packed signature and the bucket keys."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dup")
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text"), shingle)
            marks = signatures(sets)
            one = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            two = np.array([np.bitwise_xor.reduce(mixed(s + _M1)) if len(s) else 0 for s in sets], np.uint64)
            low, high = packed(marks)
            keys = chunk_keys(marks).view(np.int64)
            keys = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), keys.ravel())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x.view(np.int64)) for x in (one, two, low, high)), keys],
                names=["id", "n", "h1", "h2", "s1", "s2", "keys"],
            )

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(trimmed(run), "id bigint, n bigint, h1 bigint, h2 bigint, s1 bigint, s2 bigint, keys array<bigint>")


def full_sets(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``id, hashes`` of the wanted ids, from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dup")
        for part in text_slices(batches, rows=128):
            sets = [s.view(np.int64) for s in shingle_sets(part.column("text"), shingle)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "hashes"])

    n = wanted.count()
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    some = rows.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, "id", "left_semi")
    return some.mapInArrow(trimmed(run), "id bigint, hashes array<bigint>").dropDuplicates(["id"])


def differing(x: Column, y: Column) -> Column:
    """Symbols whose packed bits differ."""
    either = x.bitwiseXOR(y)
    any_bit = either.bitwiseOR(F.shiftrightunsigned(either, 1)).bitwiseOR(F.shiftrightunsigned(either, 2))
    return F.bit_count(any_bit.bitwiseAND(F.lit(0o1111111111_1111111111)))


def may_link(a: str, b: str, percent: int, radius: int) -> Column:
    """Within the signature distance and the size bound; no pair over the threshold fails for its size."""
    close = differing(F.col(f"{a}.s1"), F.col(f"{b}.s1")) + differing(F.col(f"{a}.s2"), F.col(f"{b}.s2")) <= radius
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return close & (100 * F.least(n, m) >= percent * F.greatest(n, m))


def long_signatures(sets: DataFrame) -> DataFrame:
    """``id, long``: signatures of LONG symbols, three bits each, of tables with ``id, hashes``."""
    ship(sets.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.RandomState(LONG)
        odd = random.randint(1, 2**62, LONG, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        add = random.randint(1, 2**62, LONG, dtype=np.int64).astype(np.uint64)
        shifts = np.uint64(3) * np.arange(20, dtype=np.uint64)
        for part in slices(batches, 128):
            rows = []
            for hashes in part.column("hashes"):
                own = hashes.values.to_numpy().view(np.uint64)
                least = np.full(LONG, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(own), 256):
                    least = np.minimum(least, (own[at : at + 256, None] * odd + add).min(0))
                bits = np.zeros(-(-LONG // 20) * 20, np.uint64)
                bits[:LONG] = mixed(least) & np.uint64(7)
                rows.append((bits.reshape(-1, 20) << shifts).sum(1, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(rows, pa.list_(pa.int64()))], names=["id", "long"])

    return sets.mapInArrow(trimmed(run), "id bigint, long array<bigint>")


def long_radius(percent: int) -> int:
    """Symbols of a long signature that may differ at the threshold: the mean and four deviations."""
    p = (1 - percent / 100) * 7 / 8
    return int(LONG * p + 4 * np.sqrt(LONG * p * (1 - p))) + 1


def short_radius(percent: int) -> int:
    """As long_radius for the packed signatures, with one symbol more to spare; RADIUS at PERCENT."""
    p = (1 - percent / 100) * 7 / 8
    return int(SYMBOLS * p + 4 * np.sqrt(SYMBOLS * p * (1 - p))) + 2


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets meet the threshold."""
    one = pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")
    two = one.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a")
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - shared
    return two.where(100 * shared >= percent * union).select("a", "b")


def cluster(active: DataFrame, marks: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, radius: int, rounds: int = STAR_ROUNDS) -> DataFrame | None:
    """``node, component`` of the nodes that are linked; None if none is.

    active: ``id, n, s1, s2, key``, the nodes of the buckets; marks: ``id, n, s1, s2``; sets_of: from a table of ids
    to ``id, hashes``.
    """
    step = np.log(100 / percent)
    active = stash(active.withColumns({"band0": F.floor(F.log("n") / step), "band1": F.floor(F.log("n") / step + F.lit(0.5))}))
    # a text that many were copied from shares the keys that most of them have: the more it shares, the better it leads
    sizes = active.groupBy("key").agg(F.count("*").alias("size"))
    central = stash(active.select("id", "key").join(sizes, "key").groupBy("id").agg((F.sum("size") * 1024 + F.pmod(F.hash("id"), F.lit(1024))).alias("central")))
    label: DataFrame | None = None
    links: DataFrame | None = None
    for turn in range(rounds + 1):
        if label is None:
            here = active.withColumn("comp", F.col("id"))
        else:
            found = active.join(label.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
            mixed_keys = found.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
            here = stash(found.join(mixed_keys, "key").select("id", "n", "s1", "s2", "band0", "band1", "key", "comp"))
        if here.isEmpty():
            break
        if turn < rounds:
            by = ["key", f"band{turn % 2}"]
            order = F.xxhash64("id", F.lit(turn)) if turn > 1 else F.col("central")
            ordered = here if turn > 1 else here.join(central, "id")
            leaders = ordered.groupBy(*by).agg(F.max_by("id", order).alias("leader"), F.max_by("comp", order).alias("of"))
            # joined by a hash of the bucket: both sides then come from an exchange of their own, so a bucket that holds
            # much of the table is split into several tasks (skew join); the aggregation before it is partial
            leaders = leaders.select(F.xxhash64(*by).alias("bucket"), "leader", "of")
            met = here.select("id", "comp", F.xxhash64(*by).alias("bucket")).join(leaders, "bucket").where("id <> leader and comp <> of").select("id", "leader").distinct()
            near = met.join(marks.alias("a"), met["leader"] == F.col("a.id")).join(marks.alias("b"), met["id"] == F.col("b.id")).where(may_link("a", "b", percent, radius))
            far = differing(F.col("a.s1"), F.col("b.s1")) + differing(F.col("a.s2"), F.col("b.s2"))
            best = near.select(met["leader"].alias("a"), met["id"].alias("b"), far.alias("far")).groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a"))
            pairs = stash(best.select("a", "b"))
        else:
            long = stash(long_signatures(sets_of(stash(here.select("id").distinct()))))
            # a pair meets in many buckets; only the bucket of its least common key makes the row
            own = here.groupBy("id").agg(F.collect_set("key").alias("keys"))
            full = here.join(long, "id").join(own, "id")
            a, b = full.alias("a"), full.alias("b")
            apart = F.aggregate(F.zip_with("a.long", "b.long", differing), F.lit(0), lambda total, d: total + d)
            meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.comp") != F.col("b.comp"))
            once = F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")
            joined = a.join(b, meet & may_link("a", "b", percent, radius) & once & (apart <= long_radius(percent)))
            pairs = stash(joined.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct())
        if label is not None:
            drop_stash(here)
        if pairs.isEmpty():
            continue
        wanted = stash(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
        sets = stash(sets_of(wanted))
        fresh = stash(confirm(pairs, sets, percent))
        drop_stash(sets)
        links = fresh if links is None else links.union(fresh)
        label = components(links)
    drop_stash(active)
    return label


def link(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``df``: id, ``n_shingles``, ``component_id`` and ``kept``."""
    signed = stash(sign(df, id_col, text_col, shingle))
    same = ["n", "h1", "h2"]
    alone = signed.where("id is not null and n > 0")
    nodes = stash(alone.groupBy(*same).agg(F.min("id").alias("rep")))
    reps = alone.join(nodes.select(*same, F.col("rep").alias("id")), [*same, "id"], "left_semi")
    marks = reps.select("id", "n", "s1", "s2")
    rows = reps.select("id", "n", "s1", "s2", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key")
    label = cluster(rows.join(shared, "key"), marks, lambda wanted: full_sets(df, id_col, text_col, wanted, shingle), percent, short_radius(percent))
    out = signed.select("id", *same).join(nodes, same, "left")
    if label is not None:
        out = out.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    else:
        out = out.withColumn("component", F.lit(None).cast("bigint"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    out = out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group: that of the smallest id. Rows with a null id stay.

    Rows that share an id are documents of their own unless their texts are equal too: they get ids of (id, text), below
    all others, so that of a group one of them stays.
    """
    own, row = df.columns, "driftwright_row"
    counts = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("driftwright_id")).count().where("count > 1").select("driftwright_id")
    twice = stash(counts)
    shared = twice.count()
    rows = df.withColumn(row, F.col(id_col).cast("bigint"))
    if shared:
        side = F.broadcast(twice) if shared <= BROADCAST_ROWS else twice
        surrogate = F.least(F.xxhash64(id_col, text_col), F.bitwise_not(F.xxhash64(id_col, text_col)))
        rows = df.join(side, F.col(id_col) == F.col("driftwright_id"), "left").withColumn(row, F.when(F.col("driftwright_id").isNull(), F.col(id_col).cast("bigint")).otherwise(surrogate))
    result = stash(link(rows, row, text_col, shingle, percent))
    gone = result.where("not kept").select(row).distinct()
    left = rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, row, "left_anti")
    if not shared:
        return left.select(*(f"`{c}`" for c in own))
    alone = left.where(F.col("driftwright_id").isNull())
    once = left.where(F.col("driftwright_id").isNotNull()).dropDuplicates([row])
    return alone.unionByName(once).select(*(f"`{c}`" for c in own))
