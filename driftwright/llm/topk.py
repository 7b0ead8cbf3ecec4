"""Exact top-k search by inner product over multi-resolution segment statistics.

A vector is cut into segments; each keeps its mean and its deviation. For two vectors the squared distance is at
least the sum over segments of ``m * ((mean - mean)^2 + (dev - dev)^2)``, so the inner product is at most the sum
of ``m * (mean * mean + dev * dev)``. Bounds are taken coarse to fine; a candidate whose bound is under the query's
k-th score so far needs no more work, and exact scores are computed for the survivors only.

Queries are taken in blocks of about BLOCK_BYTES, each against all rows: the rows stream by once per block, and no pair
is made but in the arrays of a task. A block's first scores against a few candidates set a floor, so that tasks send
only what may still be among the best. A block's result is written, and its broadcast given up, before the next block
begins, so the driver and the executors hold one block however many there are.

Defined results: components become floor(scale * x) of the double x; vectors that are null, empty, or hold a null
or a non-finite component take no part, nor do rows with a null id; a query meets only vectors of its own length; every row
but those of the query's own id is a candidate, so a repeated row is found as often as it comes, and the rows of a
repeated query id share one list of k; ties go to the smaller id; fewer than k candidates are all returned; columns of
the input may have any names. Scores are exact below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, slices, stash, trimmed

#: Bytes of the vectors of a block of queries, as doubles.
BLOCK_BYTES = 8 << 20
SEED_ROWS = 2_048
#: Segments per level, coarse to fine.
LEVELS = (4, 16)
#: Share of survivors up to which exact scores are computed pair by pair.
SPARSE = 0.02


def whole(vectors: list, scale: float) -> np.ndarray:
    """floor(scale * x) as float64 where that is exact for every inner product, else as int64."""
    out = np.floor(np.asarray(vectors, np.float64) * scale)  # blocks of either kind may meet: see alike
    return out if not out.size or float(np.abs(out).max()) ** 2 * out.shape[1] < 2**52 else out.astype(np.int64)


def alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as integers, unless both are small enough for exact products as floating-point numbers."""
    return (a, b) if a.dtype == b.dtype else (a.astype(np.int64), b.astype(np.int64))


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Weighted means and deviations of the segments, side by side; a dot product of two rows is the bound."""
    parts = np.array_split(np.asarray(vectors, np.float64), min(segments, vectors.shape[1]), axis=1)
    sizes = np.sqrt([p.shape[1] for p in parts])
    means = np.stack([p.mean(1) for p in parts], 1)
    deviations = np.stack([p.std(1) for p in parts], 1)
    return np.concatenate([means * sizes, deviations * sizes], 1)


class Block:
    """Queries of one length with their statistics and the scores that candidates must reach."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [statistics(vectors, s) for s in LEVELS if s < vectors.shape[1]]
        self.floor = np.full(len(ids), -np.inf)

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query index, candidate index and score of every pair that reaches the floor."""
        asked, kept = np.arange(len(self.ids)), np.arange(len(ids))
        open_ = self.ids[:, None] != ids[None, :]
        for level, mine in zip(LEVELS, self.levels, strict=False):
            theirs = statistics(vectors[kept], level)
            bound = mine[asked] @ theirs.T
            # a bound is rounded in floating point; the margin is far above that error
            open_ &= bound * (1 + 1e-9 * np.sign(bound)) + 1e-6 >= self.floor[asked][:, None]
            rows, columns = open_.any(1), open_.any(0)
            open_, asked, kept = open_[rows][:, columns], asked[rows], kept[columns]
            if not open_.size:
                return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int64),)
        if open_.mean() <= SPARSE:
            q, c = np.nonzero(open_)
            mine, theirs = alike(self.vectors[asked[q]], vectors[kept[c]])
            scores = (mine * theirs).sum(1)
        else:
            mine, theirs = alike(self.vectors[asked], vectors[kept].T)
            exact = mine @ theirs
            q, c = np.nonzero(open_ & (exact >= self.floor[asked][:, None]))
            scores = exact[q, c]
        q, c = asked[q], kept[c]
        good = scores >= self.floor[q]
        return q[good], c[good], scores[good].astype(np.int64)

    def best(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best rows of each query, ties to the smaller id; raises the floor of those that have k."""
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        starts = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - starts
        last = rank == self.k - 1
        # the floor is a floating-point number: the next lower one never exceeds the score
        self.floor[q[last]] = np.maximum(self.floor[q[last]], np.nextafter(scores[last].astype(np.float64), -np.inf))
        keep = rank < self.k
        return q[keep], ids[keep], scores[keep]


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def search(df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of every row where ``is_query`` holds."""
    spark = df.sparkSession
    ship(spark)
    rows = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("asks"))
    asked = rows.where("asks").select("id", "v")
    n, longest = asked.select(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * (longest or 0) * 8 // BLOCK_BYTES))
    seeds = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SEED_ROWS).collect()
    found: DataFrame | None = None
    for at in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == at).collect()  # about BLOCK_BYTES
        made: dict[int, Block] = {}
        for length in sorted({len(r["v"]) for r in own}):
            of = [r for r in own if len(r["v"]) == length]
            block = made[length] = Block(np.array([r["id"] for r in of], np.int64), whole([r["v"] for r in of], scale), k)
            near = [r for r in seeds if len(r["v"]) == length]
            if near:
                ids = np.array([r["id"] for r in near], np.int64)
                for low in range(0, len(ids), 256):
                    q, c, s = block.search(ids[low : low + 256], whole([r["v"] for r in near[low : low + 256]], scale))
                    held = (q, ids[low + c], s) if not low else tuple(np.concatenate(x) for x in zip(held, (q, ids[low + c], s), strict=True))
                    held = block.best(*held)
        part = _against(rows.select("id", "v"), made, scale, k)
        found = part if found is None else found.unionByName(part)
    return found.select("query_id", "rank", "vec_id", "score")


def _against(rows: DataFrame, made: dict[int, Block], scale: float, k: int) -> DataFrame:
    """The k best rows of a block's queries, written; an id falls into one block only."""
    shared = rows.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {n: Block(b.ids, b.vectors, b.k) for n, b in shared.value.items()}
        for n, b in blocks.items():
            b.floor = shared.value[n].floor.copy()
        held: dict[int, tuple] = {}
        for part in slices(batches, 512):
            ids, vectors = part.column("id").to_numpy(), part.column("v")
            sizes = vectors.value_lengths().to_numpy()
            for n, block in blocks.items():
                at = np.flatnonzero(sizes == n)
                if len(at):
                    flat = vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, n)
                    q, c, s = block.search(ids[at], whole(flat, scale))
                    new = (q, ids[at][c], s)
                    old = held.get(n)
                    both = new if old is None else tuple(np.concatenate(x) for x in zip(old, new, strict=True))
                    held[n] = block.best(*both) if len(q) else both
        for n, (q, ids, scores) in held.items():
            for low in range(0, len(q), 100_000):
                cut = slice(low, low + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(blocks[n].ids[q[cut]]), pa.array(ids[cut]), pa.array(scores[cut])], names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(trimmed(run), "query_id bigint, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = stash(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
    shared.unpersist()
    return best
