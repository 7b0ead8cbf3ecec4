"""Spelling variants: words one code point apart, found by automata over word halves.

A word that differs from another by one inserted, deleted or replaced code point still holds one of its halves
unchanged: the left one as its beginning or the right one as its end. Every word's two halves (segments) are dealt to
shards by their hash. A shard holds an Aho-Corasick automaton of its segments, and the words that may hold one of them
are scanned with it; a hit counts if the segment's offset and the word lengths are compatible and the distance is one.

A segment that more than ``hot`` rows share is dealt by a longer one: the half that may differ is halved again and one
of its quarters is fixed as well, as often as needed, so no shard gets more of one segment; the last window is one code
point, whose words an alphabet bounds. Inside a shard, a segment's words are kept by the quarters of their other half,
so that a hit is compared with few of them. A pair that could be found by both sides of a cut counts for the left one
only, so each pair is made once.

Defined results: null and empty texts have no words; a null id counts as the empty text; repeated rows count again; an
empty table gives an empty table; ties go to the smaller word in code-point order. Only the id and the text are read,
so other columns may have any name. Texts of any length are read whole; words are counted in bounded dictionaries.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, drop_stash, ship, stash, trimmed
from .words import text_slices

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: One occurrence in so many is misspelt by ``misspelt``.
RATE = 199
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 250_000
#: Rows of one segment beyond which it is dealt by longer ones, and segments of a shard.
HOT, SHARD = 4096, 50_000


def misspelt(word: str, start: int) -> str:
    """The word without one code point if the hash of ``<id>:<word>`` says so; start: the crc32 of ``<id>:``."""
    h = zlib.crc32(word.encode(), start)
    if h % RATE:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: the words of all texts after ``misspelt``, of the least length and number."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spelling")
        find, held = re.compile(LETTERS).findall, Counter()

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for part in text_slices(batches):
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(find((text or "").encode().lower().decode())).items():
                    word = misspelt(word, start)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield give()
        yield give()

    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(trimmed(run), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def window(length: int, path: str) -> tuple[int, int, list[int]]:
    """The part of a word of this length that is not fixed, and the cuts of which the right side was fixed."""
    low, high, passed = 0, length, []
    for side in path:
        middle = (low + high) // 2
        if side == "L":
            low = middle
        else:
            high = middle
            passed.append(middle)
    return low, high, passed


def segment_rows(words: DataFrame, path: Column, of: Column) -> DataFrame:
    """``key, probe, path, length, word, n`` for the given path: the word's own segment (probe false), or those of words of
    ``of`` code points that it may hold (probe true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for word, way, length in zip(*(batch.column(c).to_pylist() for c in ("word", "path", "length")), strict=True):
                low, high, _ = window(length, way)
                tail = length - high
                keys.append(f"{way}|{length}|{word[:low]}|{word[len(word) - tail :] if tail else ''}" if low + tail <= len(word) else None)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(batch.column(c) for c in ("probe", "path", "length", "word", "n"))], names=["key", "probe", "path", "length", "word", "n"])

    made = words.select("word", "n", "probe", path.alias("path"), of.alias("length"))
    found = made.mapInArrow(run, "key string, probe boolean, path string, length int, word string, n bigint")
    return found.where("key is not null").withColumn("key", F.xxhash64("key"))


def _apart_by_one(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    n, k = len(a), 0
    while k < n and a[k] == b[k]:
        k += 1
    if len(b) > n:
        return a[k:] == b[k + 1 :]
    return k < n and a[k + 1 :] == b[k + 1 :]


class Shard:
    """An automaton over the segments of indexed words, and their words by the quarters of what is not fixed."""

    def __init__(self) -> None:
        self.patterns: dict[tuple[str, int, str, str], dict[tuple[bool, str], list[tuple[str, int]]]] = {}
        self.automaton = None

    def add(self, path: str, length: int, word: str, n: int) -> None:
        low, high, _ = window(length, path)
        by_quarter = self.patterns.setdefault((path, length, word[:low], word[high:]), defaultdict(list))
        middle = (low + high) // 2
        by_quarter[True, word[low:middle]].append((word, n))
        by_quarter[False, word[middle:high]].append((word, n))

    def build(self) -> None:
        self.automaton = ahocorasick.Automaton()
        segments = defaultdict(list)
        for (path, length, head, tail), by_quarter in self.patterns.items():
            at_begin = len(head) >= len(tail)
            low, high, passed = window(length, path)
            segments[head if at_begin else tail].append((at_begin, length, head, tail, passed, (low + high) // 2, high, by_quarter))
        for segment, held in segments.items():
            self.automaton.add_word(segment, (len(segment), held))
        if segments:
            self.automaton.make_automaton()

    def near(self, word: str) -> Iterator[tuple[str, int]]:
        """The indexed words of this shard at distance one, each once."""
        size = len(word)
        if not self.patterns:
            return
        for end, (width, held) in self.automaton.iter(word):
            for at_begin, length, head, tail, passed, middle, high, by_quarter in held:
                if not -1 <= size - length <= 1 or (end + 1 != width if at_begin else end + 1 != size):
                    continue
                if len(head) + len(tail) > size or not (word.endswith(tail) if at_begin else word.startswith(head)):
                    continue
                stop = size - len(tail)
                for left in (True, False):
                    quarter = word[len(head) : middle] if left else word[stop - (high - middle) : stop]
                    for other, n in by_quarter.get((left, quarter), ()):
                        cuts = passed if left else [*passed, middle]
                        if not any(word[:cut] == other[:cut] for cut in cuts) and _apart_by_one(word, other):
                            yield other, n


def scan(rows: DataFrame, shards: int) -> DataFrame:
    """``word, near, near_n`` from segment rows: shard by shard, the automaton first, then the words through it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spelling")
        at, shard, last = None, Shard(), None
        for batch in batches:
            found: list[tuple[str, str, int]] = []
            for number, probe, path, length, word, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "probe", "path", "length", "word", "n")), strict=True):
                if number != at:
                    at, shard, last = number, Shard(), None
                if not probe:
                    shard.add(path, length, word, n)
                    continue
                if shard.automaton is None:
                    shard.build()
                if word != last:  # a word that may hold several segments of the shard is scanned once
                    last = word
                    found += [(word, other, m) for other, m in shard.near(word)]
            words, near, counts = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(near, pa.string()), pa.array(counts, pa.int64())], names=["word", "near", "near_n"])

    dealt = rows.withColumn("shard", F.pmod("key", F.lit(shards))).drop("key")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "shard").sortWithinPartitions("shard", "probe", "word")
    return ordered.mapInArrow(trimmed(run), "word string, near string, near_n bigint")


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``word, near, near_n`` for all pairs of ``word, n`` at distance one, in both directions."""
    ship(words.sparkSession)
    own = words.withColumn("probe", F.lit(False)).withColumn("of", F.length("word"))
    others = words.withColumn("probe", F.lit(True)).withColumn("of", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.length("word") + d)))
    both = own.unionByName(others).withColumn("path", F.explode(F.array(F.lit("L"), F.lit("R"))))
    todo, settled = stash(segment_rows(both, F.col("path"), F.col("of"))), []
    while True:
        sizes = todo.groupBy("key").agg(F.count("*").alias("rows"), F.min("probe").alias("empty"), F.min(_room(F.col("path"), F.col("length"))).alias("room"))
        large = stash(sizes.where(~F.col("empty") & (F.col("rows") > hot) & (F.col("room") > 1)).select(F.col("key").alias("hot_key")))
        if large.isEmpty():
            settled.append(todo)
            break
        # joined by a key of its own exchange, which the skew join can split
        marked = stash(todo.join(large, F.col("key") == F.col("hot_key"), "left"))
        drop_stash(todo)
        settled.append(marked.where("hot_key is null").drop("hot_key"))
        again = marked.where("hot_key is not null").withColumn("side", F.explode(F.array(F.lit("L"), F.lit("R"))))
        todo = stash(segment_rows(again, F.concat("path", "side"), F.col("length")))
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    count = rows.where(~F.col("probe")).count()
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = stash(scan(rows, max(parts, -(-count // SHARD))))
    for table in settled:
        drop_stash(table)
    return pairs


def _room(path: Column, length: Column) -> Column:
    """At most the code points that are not fixed; zero or one cannot be halved."""
    return F.ceil(length / F.pow(F.lit(2), F.length(path)))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms are followed to the last by doubling the steps. Counts grow along a chain by
    ``TIMES``, so it has no ring and a few rounds do."""
    found = stash(forms.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stash(found.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        drop_stash(found)
        found = jumped
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: per word the near word of largest count, if at least ``times`` its own."""
    words = stash(count_words(df, id_col, text_col))
    pairs = near_words(words, hot)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    joined = words.join(best, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    formed = stash(joined.select("word", F.when(fits, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, -F.col("best.less")).alias("form_n")))
    last = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
