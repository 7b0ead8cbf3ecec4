"""Toxicity by a weighted finite-state pattern grammar over clauses.

A first transducer reads tokens and writes symbols: insult or threat terms with their weights, targets, negations,
speech verbs, other words. Context transducers read the symbols of one clause from left to right: a negation
reaches a few tokens, reported speech the rest of the clause, a target any term of the clause, a threat counts
only when a target follows. Their composition (one automaton whose states are the tuples of theirs) gives every
matched term of a clause a factor. A document's evidence for a term is the sum of the factors of its different
forms; the score is that at least one term is meant.

Term weights are learned from labelled documents: whole words and word beginnings, seen in one form or in two, are
chosen greedily, each for the toxic documents that no earlier term covers. A term weighs as much as its precision,
with one form and with more: a beginning that ordinary words share by chance says little until a second form
comes. Copies of a document, texts of equal word sets, count once.
The fit takes a bounded sample: TOXIC_DOCS toxic and CLEAN_DOCS other whole documents, those of least id hash.
Scoring reads every whole text in one pass without a shuffle.

Defined results: null and empty texts get the score of texts without a match; rows that are labelled null are not
learned from; ids that are labelled twice take the higher label; with no labels the seed terms weigh SEED_WEIGHT;
repeated rows give repeated rows; input columns that clash with the outputs are replaced.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import claim, ship, trimmed
from .words import text_slices

TOXIC_DOCS, CLEAN_DOCS = 1_500, 4_500
#: A learned term covers so many toxic documents (or this share of them, if more) that no earlier one does.
LEAST_DOCS, LEAST_SHARE = 4, 0.002
LEAST_PRECISION = 0.6
PREFIX = (4, 12)
MOST_TERMS = 400
SEED_WEIGHT = 0.5
#: Factors of contexts before learning, and how many documents these count for.
FACTORS = {"plain": 1.0, "negated": 0.6, "reported": 0.7}
FACTOR_DOCS = 20
TARGET_POWER = 1.5
NEGATION_REACH = 3
THREAT_REACH = 4

INSULTS = "asshole bastard clown disgusting dumb fool garbage idiot idiots imbecile jerk loser moron pathetic scum scumbag stupid trash vermin worthless arschloch depp dummkopf abschaum connard imbécile ordure abruti gilipollas imbécil escoria cabrón".split()
THREATS = "kill hurt destroy shoot stab töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yourself he she him her they them du dich dir ihr euch sie tu toi vous lui eux tú te usted ustedes él ella ellos".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ni".split()
SPEECH = "said says called calls wrote claimed quoted alleged sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió".split()

_TOKENS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_BREAK = re.compile(r"[.!?;:\n]")


@dataclass
class Grammar:
    """Weights of each term for one form and for more (a final $ marks a whole word, else a term is a beginning),
    context factors, and the score of the rest."""

    terms: dict[str, tuple[float, float]]
    factors: dict[str, float] = field(default_factory=lambda: dict(FACTORS))
    threat: float = SEED_WEIGHT
    rest: float = 0.01

    def compile(self) -> Matcher:
        return Matcher(self)


class Transducer:
    """A deterministic weighted transducer over symbols: ``step(state, symbol) -> state, factor``."""

    start: tuple | int = 0

    def step(self, state, symbol: str):
        raise NotImplementedError


class Negation(Transducer):
    def __init__(self, factor: float):
        self.factor = factor

    def step(self, state: int, symbol: str):
        if symbol == "negation":
            return NEGATION_REACH, 1.0
        return max(0, state - 1), self.factor if state and symbol in ("insult", "threat") else 1.0


class Reported(Transducer):
    def __init__(self, factor: float):
        self.factor = factor

    def step(self, state: int, symbol: str):
        return int(state or symbol == "speech"), self.factor if state and symbol in ("insult", "threat") else 1.0


class Composed(Transducer):
    """The composition: states are tuples, factors multiply."""

    def __init__(self, *parts: Transducer):
        self.parts, self.start = parts, tuple(p.start for p in parts)

    def step(self, state: tuple, symbol: str):
        moved = [p.step(s, symbol) for p, s in zip(self.parts, state, strict=True)]
        return tuple(s for s, _ in moved), math.prod(f for _, f in moved)


class Matcher:
    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        whole = sorted((t[:-1] for t in grammar.terms if t.endswith("$")), key=len, reverse=True)
        begins = sorted((t for t in grammar.terms if not t.endswith("$")), key=len, reverse=True)
        parts = [rf"(?:{'|'.join(map(re.escape, [*whole, *THREATS]))})\b"] + [re.escape(t) for t in begins]
        self._hit = re.compile(rf"\b(?:{'|'.join(parts)})")
        self._context = Composed(Negation(grammar.factors["negated"]), Reported(grammar.factors["reported"]))
        self._words = {w: s for s, words in (("target", TARGETS), ("negation", NEGATIONS), ("speech", SPEECH), ("threat", THREATS)) for w in words}

    def symbol(self, token: str) -> tuple[str, list[str]]:
        """The lexicon transducer: a token's symbol and its terms."""
        terms = [t for t in (token + "$", *(token[:n] for n in range(PREFIX[0], PREFIX[1] + 1) if n <= len(token))) if t in self.grammar.terms]
        return ("insult", terms) if terms else (self._words.get(token, "other"), [])

    def clause(self, text: str) -> list[tuple[str, str, float, str, bool]]:
        """The terms that one clause matches: term, form, factor, context, aimed at a target."""
        tokens = _TOKENS.findall(text)
        symbols = [self.symbol(t) for t in tokens]
        aimed = any(kind == "target" for kind, _ in symbols)
        state, found = self._context.start, []
        for k, (kind, terms) in enumerate(symbols):
            context = "negated" if state[0] else "reported" if state[1] else "plain"
            state, factor = self._context.step(state, kind)
            if kind == "threat" and any(s == "target" for s, _ in symbols[k + 1 : k + 1 + THREAT_REACH]):
                found.append(("", tokens[k], factor, context, False))
            found.extend((term, tokens[k], factor, context, aimed) for term in terms)
        return found

    def clauses(self, text: str) -> Iterator[str]:
        """The clauses that hold a term, each once."""
        low, end, begin = text.lower(), -1, 0
        for hit in self._hit.finditer(low):
            if hit.start() < end:
                continue
            stop = _BREAK.search(low, hit.end())
            end = stop.start() if stop else len(low)
            # the last break before the term; what lies before an earlier clause's begin was looked at already
            begin = max(begin, *(low.rfind(c, begin, hit.start()) + 1 for c in ".!?;:\n"))
            yield low[begin:end]
            begin = end

    def score(self, text: str | None) -> tuple[float, int, set[str]]:
        """Score, number of matched clauses, contexts of the terms."""
        forms: dict[str, dict[str, float]] = {}
        aimed_at, contexts, found = set(), set(), 0
        for clause in self.clauses(text or ""):
            matched = self.clause(clause)
            found += bool(matched)
            for term, form, factor, context, aimed in matched:
                own = forms.setdefault(term, {})
                own[form] = max(own.get(form, 0.0), factor)
                contexts.add(context)
                if aimed:
                    aimed_at.add(term)
        miss = 1.0
        for term, own in forms.items():
            one, more = self.grammar.terms[term] if term else (self.grammar.threat, self.grammar.threat)
            n = sum(own.values())
            p = n * one if n <= 1 else one + min(n - 1, 1) * (more - one)
            miss *= (1 - min(p, 0.9999)) ** (TARGET_POWER if term in aimed_at and one > 0.5 else 1.0)
        return max(1 - miss, self.grammar.rest), found, contexts


def _features(text: str) -> set[str]:
    """Whole words (with a final $), and word beginnings with the number of their forms, one and two, after them."""
    words = set(_TOKENS.findall(text.lower()))
    begins = Counter(w[:n] for w in words for n in range(PREFIX[0], min(len(w), PREFIX[1]) + 1))
    return {w + "$1" for w in words} | {b + "1" for b in begins} | {b + "2" for b, n in begins.items() if n > 1}


def _frequent(texts: list[str], least: int) -> Callable[[str], bool]:
    """Whether a feature may be in ``least`` texts: counted by hash, so in bounded memory, and never too low."""
    counts = np.zeros(1 << 21, np.int32)
    for text in texts:
        places = np.fromiter((hash(f) & 0x1FFFFF for f in _features(text)), np.int64)
        counts[np.unique(places)] += 1
    return lambda f: counts[hash(f) & 0x1FFFFF] >= least


def _unlike(texts: Iterable[str]) -> list[str]:
    """One text of each group of copies: texts of equal word sets."""
    seen: dict[bytes, str] = {}
    for text in texts:
        words = "\n".join(sorted(set(_TOKENS.findall(text.lower()))))
        seen.setdefault(xxhash.xxh3_128_digest(words.encode("utf-8", "replace")), text)
    return list(seen.values())


def fit(toxic: list[str], clean: list[str]) -> Grammar:
    """Choose and weigh terms on labelled texts."""
    toxic, clean = _unlike(toxic), _unlike(clean)
    if not toxic:
        return Grammar({w + "$": (SEED_WEIGHT, SEED_WEIGHT) for w in INSULTS})
    least = max(LEAST_DOCS, math.ceil(LEAST_SHARE * len(toxic)))
    frequent = _frequent(toxic, least)
    sets = [set(filter(frequent, _features(t))) for t in toxic]
    support = Counter(f for s in sets for f in s)
    against: Counter = Counter()
    some = {f for f, n in support.items() if n >= least}
    for text in clean:
        against.update(_features(text) & some)
    precision = lambda f: (support[f] + 0.5) / (support[f] + against[f] + 1)
    some = {f for f in some if precision(f) >= LEAST_PRECISION}
    holders: dict[str, set[int]] = {f: set() for f in some}
    for k, s in enumerate(sets):
        for f in s & some:
            holders[f].add(k)
    terms: dict[str, tuple[float, float]] = {}
    while holders and len(terms) < MOST_TERMS:
        # most newly covered documents for their precision; of equals the longest term, then the first
        best = max(holders, key=lambda f: (len(holders[f]) * (2 * precision(f) - 1), len(f), f))
        covered = holders.pop(best)
        if len(covered) < least:
            break
        term = best[:-1]
        one, two = precision(term + "1"), term + "2"
        if not term.endswith("$"):  # documents with exactly one form
            s, a = support[term + "1"] - support[two], against[term + "1"] - against[two]
            one = (s + 0.1) / (s + a + 1)
        terms[term] = (one, max(one, precision(two))) if support[two] else (one, one)
        holders = {f: left for f, h in holders.items() if len(left := h - covered) >= least}
    low = [t.lower() for t in clean]
    for word in INSULTS:  # seeds that the labels do not speak against
        s = support[word + "$1"]
        if word + "$" not in terms and (s + 0.5) / (s + sum(word in t for t in low) + 1) >= 0.5:
            terms[word + "$"] = (SEED_WEIGHT, SEED_WEIGHT)
    grammar = Grammar(terms)
    matcher = grammar.compile()
    met: dict[str, list[float]] = {c: [0.0, 0.0] for c in FACTORS}
    missed = [0.0, 0.0]
    for label, texts in enumerate((clean, toxic)):
        for text in texts:
            value, _, contexts = matcher.score(text)
            if value <= grammar.rest:
                missed[label] += 1
            elif len(contexts) == 1:
                met[contexts.pop()][label] += 1
    plain = (met["plain"][1] + 0.5) / (sum(met["plain"]) + 1)
    for context in ("negated", "reported"):
        clean_n, toxic_n = met[context]
        grammar.factors[context] = min(1.0, (toxic_n / max(plain, 1e-9) + FACTOR_DOCS * FACTORS[context]) / (clean_n + toxic_n + FACTOR_DOCS))
    grammar.rest = (missed[1] + 0.5) / (sum(missed) + 1)
    return grammar


def train(docs: DataFrame, labels: DataFrame, held_in: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Grammar:
    """Fit on at most TOXIC_DOCS toxic and CLEAN_DOCS other documents among the rows where ``held_in`` is true."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & held_in).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    first = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = first(1, TOXIC_DOCS).union(first(0, CLEAN_DOCS))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").orderBy("id", "text").collect()
    return fit([r["text"] for r in rows if r["y"] == 1], [r["text"] for r in rows if r["y"] == 0])


OUTPUTS = {"score": (T.DoubleType(), pa.float64()), "clauses": (T.LongType(), pa.int64())}
_matchers: dict[str, Matcher] = {}


def score(df: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """Append ``score`` (0 to 1) and ``clauses`` (matched clauses) to every row."""
    ship(df.sparkSession)
    token = uuid.uuid4().hex
    names = [f.name for f in df.schema.fields if f.name not in OUTPUTS]
    schema = T.StructType([*(f for f in df.schema.fields if f.name in names), *(T.StructField(n, kind) for n, (kind, _) in OUTPUTS.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("toxicity", _matchers.clear)
        if token not in _matchers:
            _matchers.clear()
            _matchers[token] = grammar.compile()
        own = _matchers[token]
        for part in text_slices(batches, text_col):
            made = [own.score(x)[:2] for x in part.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array([float(s) for s, _ in made], pa.float64()), pa.array([n for _, n in made], pa.int64())], names=[*names, *OUTPUTS]
            )

    return df.mapInArrow(trimmed(run), schema)
