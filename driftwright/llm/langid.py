"""Language identification by interpolated Kneser-Ney character models, one per language.

The models predict the characters of words (runs of letters, lower-cased, with marks for begin and end), so a
document's log-probability is the sum over its words. N-grams of all languages share sorted arrays of hashes;
each row holds the probability and the back-off weight of every language. A document gets the language of least
cross-entropy per character. It is rejected where even that is far above what texts of the language show, the
limit being calibrated on training documents that were kept out of the counts, with room for short texts.

Fitting takes a bounded sample: ``train_docs`` whole documents per language, those with the least hash of the id.
Predicting reads every whole text, in one pass without shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0, rejected; with no labelled
document at all everything is ``und``; repeated rows give repeated rows; ties go to the alphabetically first
language; rows with a null id are never trained on. Input columns that clash with the outputs are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import claim, ship, trimmed
from .words import text_slices

_WHOLE, _RUNS = re.compile(r"\b[^\W\d_]+\b").findall, re.compile(r"[^\W\d_]+").findall
BEGIN, END = 0x110000, 0x110001
ORDER = 5
#: Languages whose sizes are broadcast; beyond, as in a column of other values, they are joined by shuffle.
LANGUAGES = 10_000
#: Documents per language that the models are fitted to.
TRAIN_DOCS = 500
#: Of these, one in so many only calibrates the rejection.
CALIBRATION = 5
#: Standard deviations above the mean cross-entropy, and bits beside, from which a document is rejected.
REJECT_SD, REJECT_BITS = 6.0, 1.0
#: Sharpness of the score: natural-log units per bit of difference in cross-entropy.
SHARPNESS = 12.0
#: Words whose scores a worker remembers.
MEMO_SIZE = 150_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def find_words(text: str) -> list[str]:
    """Lower-cased words; letter runs inside codes and numbers only where there is no other word."""
    low = text.lower()
    return _WHOLE(low) or _RUNS(low)


def _spell(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words with their marks, end to end; and each word's length with marks."""
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    out = np.empty(int(sizes.sum()), np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(words) else np.empty(0, np.int64)
    inner = np.ones(len(out), bool)
    inner[starts], inner[starts + sizes - 1] = False, False
    out[starts], out[starts + sizes - 1] = BEGIN, END
    out[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, sizes


def _grams(points: np.ndarray, sizes: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1..order: the hash of the n-gram that ends at each place, and whether it lies inside one word."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else np.empty(0, np.int64)
    depth = np.arange(len(points)) - np.repeat(starts, sizes)
    found, rolled = [], np.zeros(len(points), np.uint64)
    for n in range(1, order + 1):
        back = np.zeros(len(points), np.uint64)
        back[n - 1 :] = points[: max(len(points) - n + 1, 0)]  # a single word of one letter has fewer points than the order
        power = np.uint64(pow(int(_STEP), n - 1, 1 << 64))
        rolled = rolled + (back + np.uint64(1)) * power
        found.append((rolled.copy(), depth >= n - 1))
    return found


@dataclass
class Models:
    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    logp: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: np.ndarray | None = None
    mean: np.ndarray | None = None
    between: np.ndarray | None = None
    within: np.ndarray | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Per word: log2 probability under each language, then the number of predicted characters."""
        points, sizes = _spell(words)
        places, hit, value = None, None, np.repeat(self.floor[None, :], len(points), 0)
        grams = _grams(points, sizes, len(self.keys))
        for n, (hashes, inside) in enumerate(grams):
            keys = self.keys[n]
            at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
            found = (keys[at] == hashes) & inside if len(keys) else np.zeros(len(points), bool)
            stored = np.where(found[:, None], self.logp[n][at], np.nan) if len(keys) else np.full_like(value, np.nan)
            if n and len(self.keys[n - 1]):
                before, was = np.roll(places, 1), np.roll(hit, 1)
                weight = np.nan_to_num(np.where(was[:, None], self.backoff[n - 1][before], 0.0))
                value = np.where(inside[:, None], value + weight, value)
            value = np.where(np.isnan(stored), value, stored)
            places, hit = at, found
        value[points == BEGIN] = 0.0
        ends = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        total = np.add.reduceat(value, ends, axis=0) if len(words) else np.zeros((0, len(self.languages)))
        return np.concatenate([total, (sizes - 1)[:, None]], 1)


def _kneser_ney(words: dict[str, int], order: int, size: int) -> tuple[list[dict[str, np.ndarray]], float]:
    """Per order: the sorted hashes of the seen n-grams, their probability, and their weight as a context."""
    points, sizes = _spell(list(words))
    weight = np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)
    grams = _grams(points, sizes, order)
    seen = []
    for n, (hashes, inside) in enumerate(grams):
        use = inside & (points != BEGIN)  # the begin mark is given, never predicted
        keys, first, back = np.unique(hashes[use], return_index=True, return_inverse=True)
        place = np.flatnonzero(use)[first]
        counts = np.bincount(back, weight[use], len(keys))
        shorter = grams[n - 1][0][place] if n else None
        context = grams[n - 1][0][place - 1] if n else np.zeros(len(place), np.uint64)
        opens = points[np.maximum(place - n, 0)] == BEGIN
        seen.append({"keys": keys, "counts": counts, "shorter": shorter, "context": context, "opens": opens})
    for n in range(order - 1):  # below the top, a gram counts as often as it has different left neighbours
        keys, left = np.unique(seen[n + 1]["shorter"], return_counts=True)
        if not len(keys):  # no word is longer: nothing to count by
            continue
        at = np.minimum(np.searchsorted(keys, seen[n]["keys"]), len(keys) - 1)
        kinds = np.where(keys[at] == seen[n]["keys"], left[at], 0)
        seen[n]["counts"] = np.where(seen[n]["opens"] | (kinds == 0), seen[n]["counts"], kinds)
    lower, floor = None, 0.0
    for n, g in enumerate(seen):
        ones, twos = (g["counts"] == 1).sum(), (g["counts"] == 2).sum()
        cut = ones / (ones + 2 * twos) if ones and twos else 0.5
        contexts, back = np.unique(g["context"], return_inverse=True)
        total = np.bincount(back, g["counts"], len(contexts))
        kinds = np.bincount(back, minlength=len(contexts))
        rest = cut * kinds / total
        if n == 0:
            below, floor = np.full(len(g["keys"]), 1.0 / size), float(rest[0] / size)
        else:
            below = lower[np.searchsorted(seen[n - 1]["keys"], g["shorter"])]
        g["p"] = np.maximum(g["counts"] - cut, 0) / total[back] + rest[back] * below
        g["contexts"], g["rest"] = contexts, rest
        lower = g["p"]
    return seen, floor


def fit(counts: dict[str, dict[str, int]], order: int = ORDER) -> Models:
    """Models from word counts per language."""
    languages = sorted(lang for lang, words in counts.items() if words)
    models = Models(languages)
    if not languages:
        return models
    size = len({c for lang in languages for w in counts[lang] for c in w}) + 2
    fitted = [_kneser_ney(counts[lang], order, size) for lang in languages]
    models.floor = np.log2([floor for _, floor in fitted])
    for n in range(order):
        parts = [f[0][n] for f in fitted]
        after = [f[0][n + 1] for f in fitted] if n + 1 < order else []
        # a context may be no predicted gram itself: the begin mark alone
        keys = np.unique(np.concatenate([p["keys"] for p in parts] + [p["contexts"] for p in after]))
        logp, backoff = (np.full((len(keys), len(languages)), np.nan, np.float32) for _ in range(2))
        for k, part in enumerate(parts):
            logp[np.searchsorted(keys, part["keys"]), k] = np.log2(part["p"])
        for k, part in enumerate(after):
            backoff[np.searchsorted(keys, part["contexts"]), k] = np.log2(part["rest"])
        models.keys.append(keys)
        models.logp.append(logp)
        models.backoff.append(backoff)
    return models


def calibrate(models: Models, texts: list[tuple[str, str]]) -> None:
    """Mean cross-entropy of each language's own texts, and its variance between documents and within them."""
    found: dict[int, list[tuple[float, float]]] = {}
    for lang, text in texts:
        words = [w for w in find_words(text) if any(map(str.isalpha, w))]
        if lang in models.languages and len(words) >= 5:
            k = models.languages.index(lang)
            scores = models.word_scores(words)
            bits = -scores[:, k] / scores[:, -1]
            found.setdefault(k, []).append((-scores[:, k].sum() / scores[:, -1].sum(), float(bits.var())))
    every = [x for own in found.values() for x in own] or [(0.0, 0.0)]
    wide = len(every) > 1
    defaults = (np.mean([m for m, _ in every]) if wide else np.inf, np.var([m for m, _ in every]), np.mean([v for _, v in every]))
    rows = []
    for k in range(len(models.languages)):
        own = found.get(k, [])
        rows.append((np.mean([m for m, _ in own]), np.var([m for m, _ in own]), np.mean([v for _, v in own])) if len(own) > 1 else defaults)
    models.mean, models.between, models.within = (np.array(x, float) for x in zip(*rows, strict=True))


class Identifier:
    def __init__(self, models: Models):
        self.models = models
        self._index: dict[str, int] = {}
        self._rows = np.zeros((1024, len(models.languages) + 1))

    def _learn(self, words: list[str]) -> None:
        spoken = [w for w in words if any(map(str.isalpha, w))]
        silent = set(words).difference(spoken)
        at = len(self._index)
        while len(self._rows) < at + len(words):
            self._rows = np.concatenate([self._rows, np.zeros_like(self._rows)])
        order = [*spoken, *silent]
        self._rows[at : at + len(words)] = 0.0
        for low in range(0, len(spoken), 20_000):
            part = spoken[low : low + 20_000]
            self._rows[at + low : at + low + len(part)] = self.models.word_scores(part)
        self._index.update(zip(order, range(at, at + len(order)), strict=True))

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, cross-entropy in bits per character, rejected or not."""
        words = find_words(text or "") if self.models.languages else []
        missing = set(words).difference(self._index)
        if missing and len(self._index) > MEMO_SIZE:  # only a memo: emptying it changes no result
            self._index.clear()
            missing = set(words)
        if missing:
            self._learn(list(missing))
        at = np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))
        # whole texts in bounded pieces: the gathered rows of a very long one need no more room
        total = sum((self._rows[at[low : low + 50_000]].sum(0) for low in range(0, len(at), 50_000)), np.zeros(self._rows.shape[1]))
        if not total[-1]:
            return "und", 0.0, None, True
        bits = -total[:-1] / total[-1]
        best = int(bits.argmin())
        score = 1.0 / np.exp(np.minimum((bits[best] - bits) * SHARPNESS, 0)).sum()
        m = self.models
        limit = m.mean[best] + REJECT_SD * np.sqrt(m.between[best] + m.within[best] / len(words)) + REJECT_BITS
        return m.languages[best], float(score), float(bits[best]), bool(bits[best] > limit)


def train(df: DataFrame, held_in: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_docs: int = TRAIN_DOCS, order: int = ORDER) -> Models:
    """Fit and calibrate on ``train_docs`` whole documents per language among the rows where ``held_in`` is true."""
    hashed = df.where(held_in & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    hashed = hashed.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    first = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 33), "h", "id")
    # of a language's n documents, those whose hash is among the first 4 * train_docs / n of all hashes: some 4 * train_docs
    # rows of each language are ranked, however many there are
    sizes = hashed.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.shiftrightunsigned("h", 33) / F.lit(2.0**31)
    # one row per language, broadcast: the bound applies before any row is shuffled by language
    near = hashed.select("lang", "id", "h").join(F.broadcast(sizes) if sizes.count() <= LANGUAGES else sizes, "lang").where(place <= 4.0 * train_docs / F.col("n"))
    chosen = near.withColumn("r", F.row_number().over(first)).where(F.col("r") <= train_docs).select("lang", "id", "r")
    # at most train_docs rows of each language
    rows = hashed.join(F.broadcast(chosen), ["lang", "id"]).select("lang", "text", "r")
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    counts: dict[str, dict[str, int]] = {}
    rows = rows.persist()
    try:
        fitting = rows.where(F.col("r") % CALIBRATION != 0).select("lang", words.alias("word")).groupBy("lang", "word").count()
        for lang, word, n in fitting.toLocalIterator():
            counts.setdefault(lang, {})[word] = n
        models = fit(counts, order)
        if models.languages:
            calibrate(models, [(lang, text) for lang, text, r in rows.where(F.col("r") % CALIBRATION == 0).toLocalIterator()])
    finally:
        rows.unpersist()
    return models


OUTPUTS = {"lang_pred": (T.StringType(), pa.string()), "score": (T.DoubleType(), pa.float64()), "cross_entropy": (T.DoubleType(), pa.float64()), "rejected": (T.BooleanType(), pa.bool_())}
_identifiers: dict[str, Identifier] = {}


def identify(df: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected`` to every row."""
    ship(df.sparkSession)
    shared, token = df.sparkSession.sparkContext.broadcast(models), uuid.uuid4().hex
    kept = [f for f in df.schema.fields if f.name not in OUTPUTS]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, (kind, _) in OUTPUTS.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid", _identifiers.clear)
        own = _identifiers.get(token)
        if own is None:
            _identifiers.clear()
            own = _identifiers[token] = Identifier(shared.value)
        for part in text_slices(batches, text_col):
            made = [own.predict(x) for x in part.column(text_col).to_pylist()]
            columns = [[row[k] for row in made] for k in range(len(OUTPUTS))]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array(c, kind) for c, (_, kind) in zip(columns, OUTPUTS.values(), strict=True)],
                names=[*names, *OUTPUTS],
            )

    return df.mapInArrow(trimmed(run), schema)


def accepted(df: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not rejected, with their own columns. Without a model nothing can be told, and all stay."""
    if not models.languages:
        return df
    own = df.columns
    renamed = df.toDF(*(f"in_{k}" for k in range(len(own))))  # names of the input may clash with the outputs
    found = identify(renamed, models, f"in_{own.index(text_col)}").where(~F.col("rejected"))
    return found.select(*(F.col(f"in_{k}").alias(name) for k, name in enumerate(own)))
