"""Spelling variants, fingerprints and conversation repair against brute force, with odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftwright.llm import queries, repair, simhash, spelling

SMALL = "/root/testdata/sf0.001"

# -- 11


def brute_variants(rows, least_count=5, times=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            counts[low if h % 199 else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least_count}
    cut = {}  # words that share a word without one code point, or without the code point at one place
    for w in words:
        for k in range(len(w)):
            cut.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    near = {w: set() for w in words}
    for short, some in cut.items():
        if short in words:
            for w in some:
                near[w].add(short)
                near[short].add(w)
        for a, b in itertools.combinations(sorted(some), 2):
            if len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1:
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def spelled(seed, n):
    """Many words of few syllables, so that halves are shared, with rarer variants of them."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ab", "ba", "aa", "bé", "c"]) for _ in range(rng.randint(3, 6))) for _ in range(250)]
    texts = []
    for _ in range(n):
        some = rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=60)
        some = [w if rng.random() > 0.1 else w[:2] + rng.choice("abc") + w[3:] for w in some]
        texts.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in some) + ", É汉x1y")
    return texts


@pytest.mark.parametrize("hot", [spelling.HOT, 3, 25])
def test_variants(spark, hot):
    rows = [*enumerate(spelled(3, 60)), (100, None), (101, ""), (102, "abcabc " * 5000), (102, "abcabd " * 3), (None, "abcabd " * 3), (7, "x" * 70_000), (103, "12 ??"), (104, "chaina " * 150 + "chainab " * 30 + "chainabc " * 6)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, word string, n int")
    found = [tuple(r) for r in spelling.variants(df, hot=hot).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    expected = brute_variants(rows)
    assert len(found) == len(expected) and set(found) == expected
    assert any(root != form for _, form, root, *_ in expected if form)  # chains of more than one step


def test_variants_of_the_query_and_of_nothing(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = [tuple(r) for r in queries.QUERIES["op11_spelling_variants"](spark, SMALL).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(found) == len(set(found)) and set(found) == brute_variants(rows)
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_words_are_counted_over_several_hand_overs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    rows = list(enumerate(spelled(4, 30)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {(r.word, r.n) for r in spelling.count_words(df).collect()} == {(w, n) for w, _, _, n, *_ in brute_variants(rows)}


# -- 12


def brute_fingerprint(text):
    """Votes term by term and bit by bit."""
    terms = simhash.term_hashes(simhash.hash_words(pa.array([text])).ids).tolist()
    votes = [0.0] * simhash.BITS
    for term, n in Counter(terms).items():
        parts = [int(simhash.mixed(np.array([term], np.uint64) * s + s)[0]) for s in simhash._SALTS]
        for k in range(simhash.BITS):
            byte = parts[k // 64].to_bytes(8, "little")[k % 64 // 8]
            votes[k] += (1 + np.log2(n)) * (1 if byte >> (7 - k % 8) & 1 else -1)
    bits = "".join("1" if round(v, 6) > 0 else "0" for v in votes)
    return int(bits, 2).to_bytes(simhash.BITS // 8, "big").hex()


def documents(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(500)]
    base = [rng.choice(words) for _ in range(300)]
    texts = []
    for k in range(120):
        some = list(base) if k % 3 else [rng.choice(words) for _ in range(rng.randint(0, 200))]
        for _ in range(k % 5 if k % 3 else 0):
            some[rng.randrange(len(some))] = rng.choice(words)
        texts.append(" ".join(some))
    return texts


def test_fingerprints_and_neighbours(spark):
    texts = [*documents(5), None, "", " \n", "Word", "word", "ünï 汉字 " * 3, "long " * 40_000]
    rows = [(3 * k, t) for k, t in enumerate(texts)] + [(None, "no id"), (0, texts[0]), (6, "same id")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id bigint, text string, fingerprint string, span string")
    found = sorted((tuple(r) for r in simhash.sketch(df).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    expected = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        marks = [brute_fingerprint(t) for t in (text, changed, following)]
        near = [1 - (int(marks[0], 16) ^ int(m, 16)).bit_count() / simhash.BITS for m in marks[1:]]
        expected.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), marks[0], marks[1], *near))
    assert found == sorted(expected, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def test_single_and_no_document(spark):
    one = simhash.sketch(spark.createDataFrame([(5, "one two three four")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].edited_sha256 == hashlib.sha256(b"one two tone two t").hexdigest()
    assert simhash.sketch(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("radius, blocks, broadcast_rows", [(9, 10, 10**6), (9, 10, 0), (6, 8, 0), (0, 1, 10**6), (20, 22, 10**6)])
def test_search_finds_all_within_the_radius(spark, radius, blocks, broadcast_rows):
    rng = random.Random(radius)
    marks = []
    for _ in range(12):
        base = rng.getrandbits(simhash.BITS)
        for _ in range(12):
            other = base
            for _ in range(rng.randint(0, 14)):
                other ^= 1 << rng.randrange(simhash.BITS)
            marks.append(other)
    marks += marks[:20]
    df = spark.createDataFrame([(k, f"{m:064x}", "x") for k, m in enumerate(marks)], "id bigint, fingerprint string, table string")
    found = {r.fingerprint: r.n_within for r in simhash.within(df, F.col("id") % 3 == 0, radius, blocks, broadcast_rows).collect()}
    assert found == {f"{m:064x}": sum((m ^ o).bit_count() <= radius for o in marks) - 1 for m in marks[::3]}


# -- 13


def brute_repair(rows):
    """rows: (role initial, fault). All edit sequences in order of cost, by the grammar as a regular expression."""
    best = None
    for plan in itertools.product("DKUA", repeat=len(rows)):
        if any(p != "D" and fault in "BD" for p, (_, fault) in zip(plan, rows, strict=True)):
            continue
        kept = [(k, rows[k][0] if p == "K" else p.lower()) for k, p in enumerate(plan) if p != "D"]
        price = sum({"D": 3, "K": 0}.get(p, 2) + (p != "D" and fault == "T") for p, (_, fault) in zip(plan, rows, strict=True))
        for inserts in range(len(rows) + 3):
            if best and price + 2 * inserts > best[0]:
                break
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserts):
                for names in itertools.product("ua", repeat=inserts):
                    cells = [[names[j] for j, place in enumerate(places) if place == k] for k in range(len(rows) + 1)]
                    roles = "".join("".join(cells[k]) + "".join(c for at, c in kept if at == k) for k in range(len(rows) + 1))
                    if re.fullmatch("(s?(ua)+)?", roles):
                        audit = "".join("I" * len(cells[k]) + ("" if k == len(rows) else "R" if plan[k] in "UA" else plan[k]) for k in range(len(rows) + 1))
                        best = min(best or (10**9, ""), (price + 2 * inserts, audit))
    return best


def test_layers_against_all_edit_sequences():
    rng = random.Random(13)
    for _ in range(120):
        rows = [(rng.choice("suaux"), rng.choice("   TBD")) for _ in range(rng.randint(0, 4))]
        mender = repair.Mender()
        mender.take([{"turn": k, "role": letter, "text": "t", "fault": f, "copies": 1} for k, (letter, f) in enumerate(rows)], repair.ACCEPTS)
        assert (mender.cost, "".join(mender.letters)) == brute_repair(rows)


def suffix_repair(rows):
    """The least (cost, audit) from each place and state, for long conversations."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {s: (0, "") if s in ("", "a") else (10**9, "") for s in ("", "s", "u", "a")}
    after = {s: next(t for (a, c), t in step.items() if a == s and c in "ua") for s in best}

    def inserted(now):
        for _ in range(3):
            now = {s: min(now[s], (now[after[s]][0] + 2, "I" + now[after[s]][1])) for s in now}
        return now

    best = inserted(best)
    for letter, fault in reversed(rows):
        cost = fault == "T"
        now = {}
        for s in best:
            ways = [(best[s][0] + 3, "D" + best[s][1])]
            if fault not in "BD":
                ways.append((best[after[s]][0] + 2 + cost, "R" + best[after[s]][1]))
                if (s, letter) in step:
                    ways.append((best[step[s, letter]][0] + cost, "K" + best[step[s, letter]][1]))
            now[s] = min(ways)
        best = inserted(now)
    return best[""]


def brute_conversations(rows):
    """Rows (conv, turn, role, text) after damage; nulls are one space."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}:{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            solid = re.findall("[^ \t-\r]", text)
            faults.append("B" if not solid else "D" if (role, text) in seen else " " if solid[-1] in ".!?" else "T")
            seen.add((role, text))
        cost, audit = suffix_repair([(r[:1], f) for (_, r, _), f in zip(own, faults, strict=True)])
        kept, state, at = [], "", 0
        for letter in audit:
            role, text = own[at][1:] if at < len(own) else ("", "")
            if letter in "IR":
                role = "assistant" if state == "u" else "user"
            if letter != "D":
                kept.append(f"{role}:{'' if letter == 'I' else text}")
                state = role[:1]
            at += letter != "I"
        turns = [t for t, _, _ in own if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, faults.count("B"), faults.count("D"), faults.count("T"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, cost string, rest string"


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(25), None]:
        for k in range(rng.randint(1, 9) if conv != 3 else 300):
            rows.append((conv, rng.choice([k, k, k, k + 1, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rng.choice(["Yes.", "No", "x\n", " \t", "", None, "ä!  ", "b?", f"t{k}."]), "x", "y"))
    return rows + [(30, 5, "user", "Again.", "x", "y")] * 500 + [(31, 2, "system", "s" * 200_000 + ".", "x", "y")]


@pytest.mark.parametrize("size, broadcast_rows", [(repair.PIECE, 10**6), (2, 0), (7, 10**6)])
def test_repair(spark, monkeypatch, size, broadcast_rows):
    monkeypatch.setattr(repair, "BROADCAST_ROWS", broadcast_rows)
    rows = conversations(size)
    df = spark.createDataFrame(rows, CONVERSATIONS)
    found = {r[0]: tuple(r)[1:] for r in repair.repair(df, size=size).collect()}
    assert found == brute_conversations([r[:4] for r in rows])
    assert repair.repair(df.limit(0)).count() == 0


def test_damage_and_the_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    expected = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in rows} | brute_conversations(damaged)
    found = [tuple(r) for r in queries.QUERIES["op13_conversation_repair"](spark, SMALL).collect()]
    assert {r[0]: r[1:] for r in found} == expected and len(found) == len(expected)
    odd = spark.createDataFrame([(None, None, None, None, "a"), (1, 1, "user", "x.", "b")], "conv_id bigint, turn bigint, role string, text string, time string")
    assert [tuple(r) for r in repair.damage(odd, F.lit(3)).collect()] == [(None, None, " ", " ", "a")] * 2 + [(1, 1, "user", "x.", "b")] * 2
    assert [tuple(r) for r in repair.with_unrepaired(repair.repair(repair.damage(odd, F.lit(0))), odd).where("conv_id is null").collect()] == [(None, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
