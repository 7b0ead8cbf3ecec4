"""Document fingerprints: SimHash, and a search within a Hamming radius by permuted block tables.

The terms of a text are its distinct pairs of neighbouring words (a text of one word has that word); a term weighs
1 + log2 of its number of occurrences. Each term's hash of BITS bits votes with its weight, for ones and against zeros;
a bit of the fingerprint is one where the vote is positive. Words are runs of bytes other than ASCII white space, A-Z
read as a-z. The likeness of two fingerprints is the share of equal bits.

``within`` cuts fingerprints into ``blocks`` blocks. Two within ``radius`` agree in at least ``blocks - radius`` of them,
by pigeonhole, so one table for each choice of that many blocks, keyed by those blocks moved to the front, holds every
such pair together; a pair counts in the first table in which it meets. More blocks make longer keys and more tables,
for larger collections.

Defined results: null texts are empty; texts without words have no vote and the fingerprint of zeros. Equal texts have
equal fingerprints. Ids in ascending order, nulls first, rows that share an id by their text; the row after the last is the
first, of a single row itself. Repeated rows are rows of their own. An empty table gives an empty table. Other columns
are not read, so they may have any name. Whole texts count, long ones by pieces of bounded memory.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, ship, stash, trimmed
from .near_dup import rolling
from .words import hash_words, mixed, text_slices

BITS, RADIUS, BLOCKS = 256, 9, 10
#: Terms that vote at once.
PIECE = 1 << 13
#: Rows of the queries' tables, of some 100 bytes, that are broadcast rather than shuffled.
BROADCAST_ROWS = 200_000
WORDS = BITS // 64
_SALTS = [np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64) for k in range(WORDS)]
_SIGNS = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) == 1, 1.0, -1.0)
_PLACES = 256 * np.arange(BITS // 8)


def term_hashes(ids: np.ndarray) -> np.ndarray:
    """The terms of a text from its word hashes, one for each occurrence."""
    return rolling(ids, 2) if len(ids) != 1 else mixed(ids + np.uint64(1))


def vote(terms: np.ndarray) -> np.ndarray:
    """The fingerprint as BITS // 8 bytes."""
    if not len(terms):
        return np.zeros(BITS // 8, np.uint8)
    distinct, counts = np.unique(terms, return_counts=True)
    weights = 1 + np.log2(counts)
    total = np.zeros(256 * BITS // 8)  # weight of each byte value at each place
    for at in range(0, len(distinct), PIECE):
        some = distinct[at : at + PIECE]
        parts = np.stack([mixed(some * salt + salt) for salt in _SALTS], 1).view(np.uint8)
        total += np.bincount((parts + _PLACES).ravel(), np.repeat(weights[at : at + PIECE], BITS // 8), len(total))
    # summed weights depend on the order of sums in their last digits; a vote that near zero counts as none
    return np.packbits(np.round(total.reshape(-1, 256) @ _SIGNS, 6) > 0, axis=1).ravel()


def fingerprints(texts: pa.Array) -> np.ndarray:
    """One row of BITS // 8 bytes for each text of a column."""
    words = hash_words(texts)
    ends = np.cumsum(words.counts)
    return np.array([vote(term_hashes(words.ids[end - n : end])) for n, end in zip(words.counts, ends, strict=True)], np.uint8).reshape(-1, BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits, row by row."""
    return 1 - np.bitwise_count(a ^ b).sum(1, dtype=np.int64) / BITS


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ranges(df: DataFrame) -> DataFrame:
    """``id, text, order, span, extra``: rows dealt to as many spans of neighbouring ids as shuffles have partitions, one to
    a task, sorted. A span also holds the rows of the least id of the span after it (extra). Only the spans' least ids
    pass the driver."""
    spans = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select("id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("id", F.lit(-(2**63))).alias("order"))
    parts = docs.select("order").repartitionByRange(spans, "order").groupBy(F.spark_partition_id().alias("part")).agg(F.min("order").alias("least"))
    least = np.array(sorted(r.least for r in parts.select("least").collect()), np.int64)

    @F.arrow_udf("array<int>")
    def place(order: pa.Array) -> pa.Array:
        ids = order.to_numpy(zero_copy_only=False)
        at = np.searchsorted(least, ids, "right") - 1
        begins = ids == least[at]
        lists = [[k, (k - 1) % len(least)] if begin else [k] for k, begin in zip(at.tolist(), begins.tolist(), strict=True)]
        return pa.array(lists, pa.list_(pa.int32()))

    dealt = docs.select("*", F.posexplode(place("order")).alias("extra", "span"))
    return dealt.repartitionById(spans, "span").sortWithinPartitions("span", "extra", "order", "text")


def sketch(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id``, ``n_chars``, ``fingerprint``, and against the text edited with the next one ``edited_sha256``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("simhash")
        last: tuple | None = None  # a row whose next one is not read yet
        for part in text_slices(batches):
            marks = fingerprints(part.column("text"))
            rows = list(zip(part.column("span").to_pylist(), part.column("extra").to_pylist(), part.column("id").to_pylist(), part.column("text").to_pylist(), marks, strict=True))
            rows = [last, *rows] if last else rows
            pairs = [(a, b) for a, b in itertools.pairwise(rows) if not a[1] and a[0] == b[0]]
            last = rows[-1]
            changed = pa.array([edited(a[3], b[3]) for a, b in pairs], pa.string())
            after = fingerprints(changed)
            own, following = (np.array([row[4] for row in side], np.uint8).reshape(-1, BITS // 8) for side in ([a for a, _ in pairs], [b for _, b in pairs]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed.to_pylist()], pa.string()),
                    pa.array([m.tobytes().hex() for m in own], pa.string()), pa.array([m.tobytes().hex() for m in after], pa.string()),
                    pa.array(likeness(own, after)), pa.array(likeness(own, following)),
                ],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return ranges(rows).mapInArrow(trimmed(run), "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def block(fingerprint: Column, k: int, blocks: int) -> Column:
    """Block k of the hexadecimal digits."""
    digits = BITS // 4
    return F.substring(fingerprint, k * digits // blocks + 1, (k + 1) * digits // blocks - k * digits // blocks)


def differing(a: Column, b: Column) -> Column:
    """Bits that differ between two fingerprints."""
    number = lambda x, k: F.conv(F.substring(x, 16 * k + 1, 16), 16, -10).cast("bigint")
    return sum((F.bit_count(number(a, k).bitwiseXOR(number(b, k))) for k in range(1, WORDS)), F.bit_count(number(a, 0).bitwiseXOR(number(b, 0))))


def within(fingerprints_of: DataFrame, queries: Column, radius: int = RADIUS, blocks: int = BLOCKS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``fingerprint, n_within`` for the distinct fingerprints of rows that meet ``queries``: the other rows of the table
    whose fingerprint is within the radius. Equal fingerprints are one row of the tables with their number."""
    if not 0 <= radius < blocks <= BITS // 4:
        raise ValueError("0 <= radius < blocks <= digits of a fingerprint")
    kept = list(itertools.combinations(range(blocks), blocks - radius))
    same = stash(fingerprints_of.groupBy("fingerprint").agg(F.count("*").alias("rows"), F.max(F.coalesce(queries, F.lit(False))).alias("asked")))
    permuted = F.posexplode(F.array(*(F.concat(*(block(F.col("fingerprint"), k, blocks) for k in some)) for some in kept))).alias("table", "front")
    tables = same.select(F.col("fingerprint").alias("found"), "rows", permuted)
    asked = same.where("asked").select("fingerprint", permuted)
    side = F.broadcast(asked) if same.where("asked").count() * len(kept) <= broadcast_rows else asked
    equal = [block(F.col("found"), k, blocks) == block(F.col("fingerprint"), k, blocks) for k in range(blocks)]
    meets = [F.when(F.forall(F.array(*(equal[k] for k in some)), lambda x: x), t) for t, some in enumerate(kept)]
    met = tables.join(side, ["table", "front"]).where(differing(F.col("found"), F.col("fingerprint")) <= radius)
    first = met.where(F.col("table") == (F.least(*meets) if len(meets) > 1 else meets[0]))
    return first.groupBy("fingerprint").agg((F.sum("rows") - 1).alias("n_within"))
