"""Conversation structure repair: the cheapest edits that make roles alternate, by layers of increasing cost.

The roles of a conversation, by their first letters, must read ``(s?(ua)+)?``. That grammar has four states; a set of
states is four bits. For each cost from zero on, a layer holds one such set per turn: the states from which the rest of
the conversation can be repaired at exactly this cost. A layer follows from the layers of lower costs by shifts along
the turns: keep (0), rerole (2) and delete (3) move one turn on, insert (2) stays; an undeleted truncated row adds 1.
The first layer that holds the start state gives the cost; following the bits forward, each time by the least letter
that stays in the layers, gives the least audit. Rows that must go cost the same on every way and are no turn of the
layers.

No conversation is held whole. Equal rows of a turn are aggregated first, rows are dealt by ranges of (conversation,
turn), and runs of at most PIECE rows are solved at once. Conversations of several pieces are solved in two steps: for each
piece the cost between every two states (four calls of the layers), combined backwards over the pieces of its
conversation into the cost of the rest from each state; then the pieces pass in order, one at a time, since digest and
audit run over the whole conversation.

Defined results: nulls count as one space, in every column but the order of turns, where they come first; a null
conversation is one of its own. Rows of one turn are taken by role, then by the md5 of ``role:text``; equal rows are
neighbours. A row whose role begins with another letter than s, u or a cannot be kept as it is. An empty table gives an
empty table. Other columns are not read. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, ship, stash, trimmed

#: Rows and characters of a piece.
PIECE, PIECE_CHARS = 256, 1 << 20
#: Rows of small tables that are broadcast.
BROADCAST_ROWS = 200_000
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEVER = 1 << 60
#: States: nothing yet, after s, after u, after a; the state after a letter.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The state after the one letter of u and a that may follow, and that letter's role.
ANY, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
ACCEPTS = (0, NEVER, NEVER, 0)


def _before(step: dict[int, int]) -> list[int]:
    """For each set of states, those from which the step leads into it."""
    return [sum(1 << s for s, t in step.items() if into >> t & 1) for into in range(16)]


BEFORE = {letter: _before(step) for letter, step in STEPS.items()}
BEFORE_ANY = _before(dict(enumerate(ANY)))
NONE = [0] * 16
_SOLID, _BLANKS = re.compile(r"[^ \t-\r]"), " \t\n\v\f\r"


def cost_layers(turns: list[tuple[str, int]], rest: tuple[int, ...], wanted: int, most: int) -> list[list[int]]:
    """Sets of states per turn for each cost, until ``wanted`` is covered or the cost is ``most``. turns: the letter and the
    extra cost of each row that may stay; rest: the cost of what follows the last from each state."""
    n, layers, covered = len(turns), [], 0
    while len(layers) <= most:
        cost = len(layers)
        row = [0] * (n + 1)
        inserted, deleted = (layers[cost - k] if cost >= k else None for k in (INSERT, DELETE))
        row[n] = sum(1 << s for s, c in enumerate(rest) if c == cost) | (BEFORE_ANY[inserted[n]] if inserted else 0)
        for i in range(n - 1, -1, -1):
            letter, extra = turns[i]
            states = BEFORE_ANY[inserted[i]] if inserted else 0
            if deleted:
                states |= deleted[i + 1]
            kept = row if not extra else layers[cost - extra] if cost >= extra else None
            if kept:
                states |= BEFORE.get(letter, NONE)[kept[i + 1]]
            if cost >= REROLE + extra:
                states |= BEFORE_ANY[layers[cost - REROLE - extra][i + 1]]
            row[i] = states
        layers.append(row)
        covered |= row[0]
        if covered & wanted == wanted:
            break
    return layers


def most_cost(turns: list[tuple[str, int]], rest: tuple[int, ...]) -> int:
    """No cheapest repair costs more: all rows deleted, two inserted, and the dearest rest."""
    return DELETE * len(turns) + 2 * INSERT + max(c for c in rest if c < NEVER)


def trace(turns: list[tuple[str, int]], rest: tuple[int, ...], state: int) -> tuple[int, list[tuple[int, str, int]]]:
    """The least cost from ``state`` and the least edits as (turn, letter, state before); an insert has the turn it precedes."""
    base = min(rest)
    rest = tuple(c - base if c < NEVER else c for c in rest)
    layers = cost_layers(turns, rest, 1 << state, most_cost(turns, rest))
    left = cost = len(layers) - 1
    i, n, edits = 0, len(turns), []
    holds = lambda c, k, s: c >= 0 and layers[c][k] >> s & 1
    while i < n or rest[state] != left:
        letter, extra = turns[i] if i < n else ("", 0)
        kept = STEPS.get(letter, {}).get(state)
        if i < n and holds(left - DELETE, i + 1, state):
            edits.append((i, "D", state))
            left, i = left - DELETE, i + 1
        elif holds(left - INSERT, i, ANY[state]):
            edits.append((i, "I", state))
            left, state = left - INSERT, ANY[state]
        elif kept is not None and holds(left - extra, i + 1, kept):
            edits.append((i, "K", state))
            left, state, i = left - extra, kept, i + 1
        else:
            edits.append((i, "R", state))
            left, state, i = left - REROLE - extra, ANY[state], i + 1
    return cost + base, edits


def between(turns: list[tuple[str, int]]) -> list[int]:
    """The least cost from each state to each, row by row, NEVER where no edits lead there."""
    costs = [NEVER] * 16
    # nothing leads back to the first two states: all rows go, or all but one kept s
    costs[0] = costs[5] = DELETE * len(turns)
    costs[1] = min((DELETE * (len(turns) - 1) + extra for letter, extra in turns if letter == "s"), default=NEVER)
    for target in (2, 3):
        rest = tuple(0 if s == target else NEVER for s in range(4))
        for cost, layer in enumerate(cost_layers(turns, rest, 15, most_cost(turns, rest))):
            for s in range(4):
                if layer[0] >> s & 1 and costs[4 * s + target] == NEVER:
                    costs[4 * s + target] = cost
    return costs


def fault(text: str, seen: bool) -> str:
    """The first fault of a row: B blank, D duplicate, T truncated, or a space."""
    if not _SOLID.search(text):
        return "B"
    return "D" if seen else " " if text.rstrip(_BLANKS)[-1] in ".!?" else "T"


@dataclass
class Mender:
    """One conversation, given piece by piece."""

    state: int = 0
    cost: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    first: int | None = None
    last: int | None = None
    letter: str | None = None
    letters: list[str] = field(default_factory=list)
    written: bool = False
    digest: object = field(default_factory=hashlib.sha256)

    def write(self, role: str, text: str) -> None:
        self.digest.update((b"\n" if self.written else b"") + f"{role}:{text}".encode())
        self.written = True

    def take(self, rows: list[dict], rest: tuple[int, ...]) -> None:
        """The next rows (turn, role, text, fault, copies) and the cost of what follows them from each state."""
        for row in rows:
            first, more = row["role"][:1], row["copies"] - 1
            self.blank += row["copies"] if row["fault"] == "B" else 0
            self.duplicate += row["copies"] if row["fault"] == "D" else 0 if row["fault"] == "B" else more
            self.truncated += row["fault"] == "T"
            self.illegal += more + (self.letter is not None and self.letter + first not in ("su", "ua", "au"))
            self.letter = first
            if row["turn"] is not None:
                self.first = row["turn"] if self.first is None else self.first
                self.distinct += row["turn"] != self.last
                self.last = row["turn"]
        live = [k for k, row in enumerate(rows) if row["fault"] in " T"]
        turns = [(rows[k]["role"][:1], TRUNCATED * (rows[k]["fault"] == "T")) for k in live]
        _, edits = trace(turns, rest, self.state)
        steps: dict[int, list[tuple[str, int]]] = {}
        for turn, letter, state in edits:
            steps.setdefault(turn, []).append((letter, state))
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter] + (turns[turn][1] if letter in "KR" else 0)
            self.state = state if letter == "D" else STEPS[turns[turn][0]][state] if letter == "K" else ANY[state]
        at = 0
        for row in rows:
            forced = row["copies"]
            if row["fault"] in " T":
                forced -= 1
                self.apply(row, steps.get(at, ()))
                at += 1
            self.letters.append("D" * forced)
            self.cost += DELETE * forced
        self.apply(None, steps.get(at, ()))

    def apply(self, row: dict | None, steps: object) -> None:
        for letter, state in steps:
            self.letters.append(letter)
            if letter == "I":
                self.write(ROLE[state], "")
            elif letter == "K":
                self.write(row["role"], row["text"])
            elif letter == "R":
                self.write(ROLE[state], row["text"])

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest()


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
ROWS = "rows array<struct<turn: bigint, role: string, text: string, fault: string, copies: bigint>>"
FIRST = "struct<known: boolean, turn: bigint, role: string, content: string, number: bigint>"
PIECES = f"conv_id bigint, first {FIRST}, {ROWS}"


def to_arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)


_ROW = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string()), ("copies", pa.int64())]))
_FIRST = pa.struct([("known", pa.bool_()), ("turn", pa.int64()), ("role", pa.string()), ("content", pa.string()), ("number", pa.int64())])
_PIECES = pa.schema([("conv_id", pa.int64()), ("first", _FIRST), ("rows", _ROW)])
_RESULT = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def small(df: DataFrame) -> DataFrame:
    """Broadcast if it has few rows, else joined as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Runs of neighbouring rows of a conversation, in the order of ``first``. rows: conv_id, turn, role, text (no null but
    in the first two)."""
    content = F.md5(F.concat_ws(":", "role", "text"))
    order = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    # a row is seen earlier if an equal one has a lower turn; of equal rows in one turn, all but one are copies
    again = rows.select("conv_id", "turn", content.alias("content")).groupBy("conv_id", "content").agg(F.min(order).alias("low"), F.max(order).alias("high")).where("low < high")
    again = stash(again.select(F.col("conv_id").alias("c"), F.col("content").alias("same"), "low"))
    again = small(again)
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("content", content)
    seen = one.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("content") == F.col("same")), "left").withColumn("seen", F.coalesce(order > F.col("low"), F.lit(False)))
    keys = ["conv_id", F.col("turn").isNotNull(), "turn", "role", "content"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = seen.select("conv_id", "turn", "role", "text", "content", "copies", "seen").repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("repair")
        conv, held, chars, number, first, begun = None, [], 0, 0, None, False
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if begun and held and (row["conv_id"] != conv or len(held) >= size or chars >= PIECE_CHARS):
                    out.append((conv, first, held))
                    held, chars = [], 0
                if not held:
                    number += 1
                    first = {"known": row["turn"] is not None, "turn": row["turn"], "role": row["role"], "content": row["content"], "number": number}
                conv, begun, chars = row["conv_id"], True, chars + len(row["text"])
                held.append({"turn": row["turn"], "role": row["role"], "text": row["text"], "fault": fault(row["text"], row["seen"]), "copies": row["copies"]})
            yield to_arrow(out, _PIECES)
        if held:
            yield to_arrow([(conv, first, held)], _PIECES)

    return dealt.mapInArrow(trimmed(run), PIECES)


def mend(ordered: DataFrame) -> DataFrame:
    """One row per conversation, whose pieces (conv_id, rest, rows) follow each other within a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("repair")
        conv, mender = None, None
        for batch in batches:
            done = []
            for piece in batch.to_pylist():
                if mender is not None and piece["conv_id"] != conv:
                    done.append((conv, *mender.result()))
                    mender = None
                mender = mender or Mender()
                conv = piece["conv_id"]
                mender.take(piece["rows"], tuple(piece["rest"] or ACCEPTS))
            yield to_arrow(done, _RESULT)
        if mender is not None:
            yield to_arrow([(conv, *mender.result())], _RESULT)

    return ordered.select("conv_id", "rest", "rows").mapInArrow(trimmed(run), RESULT)


def rests(several: DataFrame) -> DataFrame:
    """``c, f, rest``: for every piece (c, f) the least cost of all that follows it, from each state. The costs between
    states are made piece by piece, and pass once more in reverse order, one piece at a time."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [between([(r["role"][:1], TRUNCATED * (r["fault"] == "T")) for r in rows if r["fault"] in " T"]) for rows in batch.column("rows").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("first"), pa.array(costs, pa.list_(pa.int64()))], names=["c", "f", "costs"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, rest = None, None
        for batch in batches:
            found = []
            for c, costs in zip(batch.column("c").to_pylist(), batch.column("costs").to_pylist(), strict=True):
                if rest is None or c != conv:
                    conv, rest = c, list(ACCEPTS)
                found.append(rest)
                rest = [min(NEVER, *(costs[4 * s + t] + rest[t] for t in range(4))) for s in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("c"), batch.column("f"), pa.array(found, pa.list_(pa.int64()))], names=["c", "f", "rest"])

    parts = int(several.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    costs = several.select("conv_id", "first", "rows").mapInArrow(trimmed(measure), f"c bigint, f {FIRST}, costs array<bigint>")
    ordered = costs.repartition(parts, "c").sortWithinPartitions("c", F.col("f").desc())
    return ordered.mapInArrow(back, f"c bigint, f {FIRST}, rest array<bigint>")


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = PIECE) -> DataFrame:
    """``conv_id`` with faults, least cost, least audit and the digest of the repair, for every conversation of ``df``."""
    ship(df.sparkSession)
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), clean(role).alias("role"), clean(text).alias("text"))
    held = stash(pieces(rows, size))
    cut = small(stash(held.groupBy(F.col("conv_id").alias("c")).count().where("count > 1").select("c")))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    whole = held.join(cut, same, "left_anti").withColumn("rest", F.lit(None).cast("array<bigint>"))
    several = held.join(cut, same, "left_semi")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = several.join(small(stash(rests(several))), same & F.col("first").eqNullSafe(F.col("f")))
    ordered = known.select("conv_id", "first", "rest", "rows").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "first")
    return mend(whole).unionByName(mend(ordered))


def damage(df: DataFrame, kind: Column, role: str = "role", text: str = "text") -> DataFrame:
    """Rows with the fault of their ``kind``: 0 drops the row, 1 empties the text, 2 takes its sentence marks, 3 repeats the
    row, 4 makes it the user's; other kinds change nothing. Null roles and texts become one space."""
    kind = F.coalesce(kind, F.lit(-1))
    words = F.coalesce(F.col(text), F.lit(" "))
    words = F.when(kind == 1, "").when(kind == 2, F.translate(words, ".!?", "")).otherwise(words)
    speaker = F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" ")))
    times = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("driftwright_copy")
    kept = df.where(kind != 0)
    return kept.select(*(words.alias(c) if c == text else speaker.alias(c) if c == role else F.col(f"`{c}`") for c in df.columns), times).drop("driftwright_copy")


def with_unrepaired(found: DataFrame, df: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Every conversation of ``df``: those without rows in ``found`` have no faults and an empty repair."""
    ids = df.select(F.col(conv).cast("bigint").alias("c")).distinct()
    all_rows = ids.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_rows.select(F.col("c").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
