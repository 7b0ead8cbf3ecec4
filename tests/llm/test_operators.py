"""The corpus operators on small tables: brute force, round trips, and rows that are null, empty, repeated or long."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from driftwright.llm import bpe, components, decontaminate, html_extract, langid, license_scan, near_dup, secret_scan, substring_dedup, topk, toxicity
from driftwright.llm.common import crc_remainder

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, source string, n_tokens string, score string"


def docs(spark, texts, start=0):
    """Documents with extra columns whose names clash with outputs."""
    return spark.createDataFrame([(start + k, t, f"src{k % 2}", "x", "y") for k, t in enumerate(texts)], DOCS)


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(seed, n=4000):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n)]


# -- 3


def test_bpe_equals_the_reference_tokenizer_and_round_trips(spark):
    ranks = bpe.read_ranks(VOCABULARY)
    exact = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    odd = "".join(chr(rng.choice([rng.randint(1, 0x7FF), rng.randint(0xE000, 0xFFFF), rng.randint(0x10000, 0x1FFFF)])) for _ in range(500))
    texts = ["", None, "Hello, wörld's  end\n\n <|endoftext|>", odd, "a" * 5000, "word " * 3000, "  \x1c\x85　x", "same", "same"]
    rows = bpe.encode_decode(docs(spark, texts), VOCABULARY, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    for text, row in zip(texts, rows, strict=True):
        assert np.frombuffer(row.ids_le, "<u4").tolist() == exact.encode_ordinary(text or "")
        assert bytes(row.decoded) == (text or "").encode() and row.n_tokens == len(row.ids_le) // 4
    assert bpe.encode_decode(docs(spark, []), VOCABULARY, public_tokenizers.PATTERN).count() == 0


# -- 10


def brute_kneser_ney(words, order, size):
    """p(next | context) by the definition: interpolated, continuation counts below the top order."""
    grams = [{} for _ in range(order)]
    for w, n in words.items():
        chars = ["<", *w, ">"]
        for i in range(1, len(chars)):
            for k in range(min(order, i + 1)):
                g = tuple(chars[i - k : i + 1])
                grams[k][g] = grams[k].get(g, 0) + n
    used = []
    for k in range(order):
        if k < order - 1:
            left = {g: sum(h[1:] == g for h in grams[k + 1]) for g in grams[k]}
            used.append({g: n if g[0] == "<" or not left[g] else left[g] for g, n in grams[k].items()})
        else:
            used.append(grams[k])

    def p(c, context):
        k = min(len(context), order - 1)
        context = tuple(context[len(context) - k :])
        ones, twos = sum(v == 1 for v in used[k].values()), sum(v == 2 for v in used[k].values())
        cut = ones / (ones + 2 * twos) if ones and twos else 0.5
        after = {g: n for g, n in used[k].items() if g[:-1] == context}
        lower = p(c, context[1:]) if context else 1 / size
        if not after:
            return lower
        total = sum(after.values())
        return max(after.get((*context, c), 0) - cut, 0) / total + cut * len(after) / total * lower

    return p


def test_kneser_ney_against_the_definition():
    words = {"abab": 3, "abc": 2, "b": 1, "cab": 1, "bbb": 2}
    models, p = langid.fit({"x": words}, order=3), brute_kneser_ney(words, 3, 5)
    for word in ["abab", "a", "zab", "ccc", "bab", "abcz"]:
        chars = ["<", *word, ">"]
        expected = sum(np.log2(p(c, chars[:k])) for k, c in enumerate(chars) if k)
        assert models.word_scores([word])[0, 0] == pytest.approx(expected, abs=1e-4)
        assert models.word_scores(["b", word])[1, 1] == len(word) + 1
    assert sum(p(c, ["<", "a"]) for c in "abc>") < 1.0001


def test_language_id(spark):
    words = {"aa": vocabulary(1, 300), "bb": ["".join(reversed(w)).upper().translate(str.maketrans("ABCDEFGH", "QRSTUVWX")).lower() for w in vocabulary(2, 300)]}
    rng = random.Random(3)
    rows = [(k, prose(rng, 60, words[lang]), lang) for k, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(200, None, "aa"), (201, "", None), (202, "123 !!", "bb"), (203, "x1y2", None), (None, "null id", "aa"), (204, "汉字汉字汉字汉字 汉字汉字" * 20, None), (0, rows[0][1], "aa")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("rejected", F.lit("clash"))
    models = langid.train(df, F.coalesce(crc_remainder(F.col("doc_id")) != 2, F.lit(False)), train_docs=40)
    found = {r.doc_id: r for r in langid.identify(df, models).collect()}
    assert all(found[k].lang_pred == lang for k, _, lang in rows[:120]) and all(0 <= r.score <= 1 for r in found.values())
    assert [found[k].lang_pred for k in (200, 201, 202)] == ["und"] * 3 and found[203].lang_pred != "und" and found[204].rejected
    assert not any(found[k].rejected for k in range(120))
    kept = langid.accepted(df, models)
    assert kept.columns == df.columns and kept.where("doc_id = 204").count() == 0 and kept.where("doc_id = 0").count() == 2
    nothing = langid.train(df.limit(0), F.lit(True))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_crc(spark):
    found = spark.range(50).select(crc_remainder(F.col("id")).alias("r")).collect()
    assert [r.r for r in found] == [zlib.crc32(str(k).encode()) % 4 for k in range(50)]


# -- 5


def brute_components(texts, percent=85, size=3):
    sets = {}
    for k, t in texts:
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in sets}, {k: len(s) for k, s in sets.items()}


def edited(rng, text, rate, words):
    return " ".join(rng.choice(words) if rng.random() < rate else w for w in text.split())


def test_near_duplicates_against_brute_force(spark):
    rng, words = random.Random(11), vocabulary(7)
    texts = [None, "", " \t ", "One", "one", "one two", "One\x0btwo", "one two"]
    for _ in range(6):  # groups around one text, with similarities on both sides of the threshold
        base = prose(rng, 150, words)
        texts += [edited(rng, base, rng.choice([0, 0.005, 0.02, 0.03, 0.04]), words) for _ in range(25)]
    texts += [prose(rng, 40, words) for _ in range(30)]
    passage = prose(rng, 60, words)
    texts += [prose(rng, 60, words) + " " + passage for _ in range(20)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected, sizes = brute_components(rows)
    df = docs(spark, texts)
    found = {r.doc_id: r for r in near_dup.link(df).collect()}
    assert {k: r.component_id for k, r in found.items()} == expected and {k: r.n_shingles for k, r in found.items()} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, c in expected.items() if k == c}
    twice = near_dup.link(df.limit(3).union(df.limit(3)).union(spark.createDataFrame([(None, "one", "s", "x", "y")], DOCS)))
    assert twice.count() == 7 and twice.where("doc_id is null and kept").count() == 1
    assert near_dup.link(df.limit(0)).count() == 0


def test_bands_of_keys_guarantee_all_pairs_within_the_radius():
    rng = np.random.RandomState(1)
    a = rng.randint(0, 1 << 16, (200, near_dup.SYMBOLS)).astype(np.uint64)
    b = a.copy()
    for row in b:
        row[rng.choice(near_dup.SYMBOLS, near_dup.RADIUS, replace=False)] ^= np.uint64(1)
    keys = near_dup.chunk_keys(a), near_dup.chunk_keys(b)
    assert all(set(x) & set(y) for x, y in zip(*keys, strict=True))


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# -- 8


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_ROWS, 0])
def test_decontamination_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    rng, words = random.Random(2), vocabulary(9, 300)
    items = [prose(rng, n, words) for n in (14, 20, 33, 59, 5, 4, 300)] + [None, ""]
    texts = [prose(rng, 800, words) for _ in range(20)] + [None, "", "short text"]
    for k in range(12):
        item = items[k % 7].split()
        if k >= 7:
            item[len(item) // 2] = "changed"
        texts[k] = texts[k][:500] + " " + " ".join(item).upper() + "!! " + texts[k][500:]

    def grams(t):
        w = [x for x in re.split(r"[^\w]+", (t or "").lower().replace("_", " ")) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    texts[12] = texts[12] + " " + " ".join(items[6].split()[:250]) + " " + texts[13] * 60  # part of an item, and a long text
    expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if grams(x) and len(grams(t) & grams(x)) >= 0.8 * len(grams(x)) - 1e-9}
    assert (12, 6) in expected
    bench = spark.createDataFrame([*enumerate(items), (None, items[0]), (3, items[3]), (0, items[0])], "item_id bigint, text string")
    df = docs(spark, texts).withColumns({"h": F.lit("x"), "item": F.lit("y"), "doc": F.lit(0), "all": F.lit(None)})
    found = decontaminate.contained(df.union(df), bench).collect()
    assert len(found) == len(expected) and {(r.doc_id, r.item_id) for r in found} == expected and expected
    clean = decontaminate.remove(df, bench)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in expected} and clean.columns == df.columns
    assert decontaminate.contained(df.limit(0), bench).count() == 0 and decontaminate.contained(df, bench.limit(0)).count() == 0


# -- 9


def test_secrets_against_brute_force(spark):
    value = "Zx9" + "aB3kQ7" * 5
    texts = [
        "password: hunter2x and token='abc' secret=token:abcdef", "AKIA" + "A1" * 8 + " x AKIA12", "é" * 50 + "API_KEY = \"ab.cd/ef\" deadbeef" + "0" * 20, None, "", "nothing here",
        f"key {value} end", f"see {value}", "token=" + "0123456789abcdef" * 2, "token=" + "0123456789abcdef" * 2, "passwd=aaaaaaaa", "x" * 100_000 + " secret: abcdef", "😀 apikey:abc123",
    ]
    assign = re.compile(secret_scan.BASE_KINDS["assign"][0], re.A)

    def base(t):
        t = t or ""
        found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[1]) >= 6]
        found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]

    df = docs(spark, texts)
    rows = {r.doc_id: r.spans for r in secret_scan.scan(df, ["doc_id"]).collect()}
    for k, t in enumerate(texts):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in rows[k] if s.kind != "generic"] == base(t)
    assert not [s for s in rows[6] if s.kind == "generic"] or rows[6][0].verdict == "live"
    verdicts = {r.doc_id: r.spans[0].verdict for r in secret_scan.scan(df.where("doc_id in (8, 10)"), ["doc_id"]).collect()}
    assert verdicts == {8: "live", 10: "example"}
    masked = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert masked[0] == "<secret> and token='abc' secret=token:abcdef"
    assert masked[3] is None and masked[5] == texts[5] and masked[12] == "😀 <secret>" and masked[11].endswith("x <secret>")
    assert secret_scan.scan(df.limit(0), ["doc_id"]).count() == 0 and secret_scan.scan(df.union(df), ["doc_id"]).count() == 2 * len(texts)


def test_long_generic_runs_are_found(spark):
    run = "aB3-x9Z_" * 200
    texts = [f"key {run} end", f"key {run}/ end", "a" * 100_000 + " end"]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(docs(spark, texts), ["doc_id"]).collect()}
    assert found[0] == [("generic", 4, 1604)] and found[1] == []


def test_ownership_counts(spark):
    rows = [(k, "token=SECRETVALUE1", f"s{k}") for k in range(4)] + [(9, "token=ONLYMINE2x", "s0"), (10, "token=ONLYMINE2x", "s0"), (11, "token=TWOOWNERS3", "a"), (12, "token=TWOOWNERS3", None)]
    spans = {r.doc_id: r.spans[0] for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), ["doc_id"]).collect()}
    assert (spans[0].verdict, spans[0].n_owners, spans[0].n_repos) == ("example", 4, 4) and (spans[9].verdict, spans[9].n_repos) == ("live", 2) and spans[11].verdict == "shared"


# -- 4


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.RandomState(4)
    rows = [(k, (rng.randn(16) * (1 + k % 3)).tolist()) for k in range(300)] + [(300, None), (301, []), (302, [float("nan")] * 16), (303, [None] * 16), (None, [1.0] * 16), (304, [1.0, 2.0]), (306, [0.5, 0.25]), (5, rng.randn(16).tolist())]
    rows += [(k, rows[40][1]) for k in range(400, 440)]  # ties
    rows += [(20, rows[21][1]), (41, rows[41][1])]  # a query and a candidate that come twice
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    ints = [(k, np.floor(64 * np.array(v)).astype(np.int64)) for k, v in rows if k is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q in sorted({k for k, _ in ints if k % 20 == 0 or k == 304}):
        ranked = sorted((-int(v @ w), c) for k, v in ints if k == q for c, w in ints if c != q and len(w) == len(v))[:20]
        expected += [(q, r + 1, c, -s) for r, (s, c) in enumerate(ranked)]
    found = topk.search(df, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 304))
    assert sorted(tuple(r) for r in found.collect()) == expected
    monkeypatch.setattr(topk, "BLOCK_BYTES", 500)  # several blocks
    clash = df.withColumns({"id": F.lit("x"), "v": F.lit(1), "asks": F.lit(None), "score": F.lit(0)})
    found = topk.search(clash, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 304))
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert topk.search(df.limit(0), F.lit(True)).count() == 0


def test_bounds_hold():
    rng = np.random.RandomState(1)
    a, b = rng.randn(50, 24), rng.randn(60, 24)
    for level in topk.LEVELS:
        assert (topk.statistics(a, level) @ topk.statistics(b, level).T >= a @ b.T - 1e-9).all()


# -- 6


def test_html():
    read = lambda s: html_extract.main_text(html_extract.read(s))
    page = '<html><body><header><h1>Site</h1></header><div class="menu">a b</div><main><h1>T &amp; x</h1><p>One<p>Two <b>bold</b>text<br>more</main><aside>side</aside><div id="comments"><p>c</p></div><form>f</form><footer>z</footer>'
    assert read(page) == "T & x One Two boldtext more"
    assert read('<article><header><h1>Head</h1></header><p>Body</p><section class="comments"><p>nice</p></section><script>if(a<b)"</p>"</script></article>') == "Head Body"
    assert read("") == "" and read("<!-- open") == "" and read("plain &amp; text <b") == "plain & text <b" and read("<p>a\n\t b</p>") == "a b"


def test_templates_leave_out_what_pages_share(spark):
    page = '<body><div class="x1"><p>Every page says so here</p></div><div class="x2"><p>{}</p><p>{}</p></div><div class="x3">The end of each page</div></body>'
    rng, words = random.Random(8), vocabulary(3)
    texts = [(prose(rng, 30, words), prose(rng, 30, words)) for _ in range(12)]
    rows = [(k, f"https://a.example/{k}", page.format(*t)) for k, t in enumerate(texts)] + [(50, "https://a.example/0", page.format(*texts[0])), (60, None, None), (61, "https://b.example/", ""), (62, "https://b.example/x", "<article>Only <i>this</i></article>")]
    found = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))).collect()}
    assert all(found[k].text == " ".join(t) for k, t in enumerate(texts)) and found[50].text == found[0].text
    assert found[60].text == found[61].text == "" and found[62].text == "Only this" and found[62].n_chars == 9
    assert html_extract.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_templates_hold_inside_articles(spark):
    rng, words = random.Random(9), vocabulary(4)
    texts, rows = [(prose(rng, 30, words), prose(rng, 30, words)) for _ in range(12)], []
    for k, (one, two) in enumerate(texts):
        notes = "".join(f'<div class="x4"><b>Note</b><p>{prose(rng, 5, words)}</p></div>' for _ in range(1 + k % 3))
        often = "<p>Most pages have this line</p>" if k < 9 else ""
        some = '<div class="series"><p>Only a few pages have this part</p></div>' if k < 4 else ""
        rows.append((k, f"https://a.example/{k}", f'<body><article><p>{one}</p><p class="x1">Each article says so</p>{often}{some}{notes}<p>{two}</p></article></body>'))
        rows.append((100 + k, f"https://b.example/{k}", f'<body><div class="x2"><p>{one}</p><p>{two}</p></div><article><p>Teaser {k}</p></article></body>'))
    rows += [(200 + k, f"https://c.example/{k}", f'<body><article><p>One article for all</p></article><div class="x6">{k} x</div></body>') for k in range(5)]
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k, (one, two) in enumerate(texts):
        assert found[k].startswith(one) and found[k].endswith(two) and found[100 + k] == f"{one} {two}"
        # the notes' own words stay, their labels go
        assert len(found[k].split()) == 60 + 5 * (1 + k % 3) and not any(w in found[k] for w in ("Note", "Each", "Most", "Only"))
    assert {found[200 + k] for k in range(5)} == {"One article for all"}


# -- 7


def test_toxicity(spark):
    rng, words = random.Random(6), vocabulary(12)
    rows, labels = [], []
    for k in range(200):
        toxic = k % 5 == 0
        text = prose(rng, 40, words) + (". you are such a zorgblat person. " if toxic and k % 2 else f". quxtem{rng.choice('abcde')}x and quxtem{rng.choice('fghij')}y. " if toxic else f". one quxtem{rng.choice('abcde')} only. " if k % 7 == 0 else ". ") + prose(rng, 40, words)
        rows.append((k, text))
        labels.append((k, int(toxic)))
    rows += [(300, None), (301, ""), (302, "he said that you are no zorgblat"), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("clauses", F.lit("clash"))
    known = spark.createDataFrame([*labels, (0, 0), (5, None), (None, 1)], "doc_id bigint, toxic int")
    grammar = toxicity.train(df, known, crc_remainder(F.col("doc_id")) != 2)
    found = {r.doc_id: r.score for r in toxicity.score(df, grammar).collect()}
    assert all((found[k] >= 0.3) == (k % 5 == 0) for k in range(200)), [k for k in range(200) if (found[k] >= 0.3) != (k % 5 == 0)]
    assert found[300] == found[301] == grammar.rest < 0.3 and found[302] < found[5]
    seeds = toxicity.train(df, known.limit(0), F.lit(True))
    assert seeds.terms["idiot$"] == (toxicity.SEED_WEIGHT,) * 2 and toxicity.score(df.limit(0), seeds).count() == 0


def test_contexts_of_the_grammar():
    m = toxicity.Grammar({"idiot$": (0.9, 0.9)}).compile()
    plain, negated, reported, aimed = (m.score(t)[0] for t in ("an idiot spoke", "not an idiot", "she said idiot things", "you idiot"))
    assert negated < plain and reported < plain and aimed > plain
    assert m.score("I will kill you")[0] > m.score("kill the process")[0] == m.grammar.rest


def test_only_copies_count_as_copies():
    rng, words = random.Random(14), vocabulary(15, 60)
    texts = list(dict.fromkeys(" ".join(sorted(rng.sample(words, 40))) for _ in range(300)))
    assert toxicity._unlike([*texts, texts[0].upper() + "!", " ".join(reversed(texts[1].split()))]) == texts


def test_a_long_clause_begins_at_its_own_break():
    m = toxicity.Grammar({"idiot$": (0.9, 0.9)}).compile()
    before, clause = "she said that. ", " an idiot" + " word" * 6000
    assert list(m.clauses(before + clause)) == [" " + clause] and m.score(before + clause)[2] == {"plain"}
    assert list(m.clauses("idiot one. no; an idiot two! idiot")) == ["idiot one", " an idiot two", " idiot"]


# -- 2


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Words. Released under the MIT License. Words.", "MIT"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "GPL-3"), ("GNU General Public License version 2. You may use this or any later version.", "GPL-2-or-later"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy. The above copyright notice and this permission notice shall be included.", "MIT"),
        ("Redistributions of source code must retain this. Redistributions in binary form must reproduce it. Neither the name of X may be used.", "BSD-3-clause"),
        ("Redistributions of source code must retain this. Redistributions in binary form must reproduce it.", "BSD-2-clause"),
        ("Licensed### under%%% the&&& MIT%%% License.###", "MIT"), ("It is licensed under the Foo terms.", "UNKNOWN"), ("The mitten is nice.", ""), ("", ""), (None, ""),
        ("GNU Lesser General Public License v2.1. Also the MIT License. Again the MIT License.", "LGPL-2.1,MIT"),
    ],
)
def test_licenses(spark, text, expected):
    row = license_scan.scan(docs(spark, [text]), ["doc_id"]).first()
    assert ",".join(row.licenses) == expected


def test_licenses_in_wrapped_text(spark):
    texts = ["It is released into the public\ndomain.", "Creative\nCommons Attribution 4.0", "By CC\nBY 4.0 here", "All rights\n  reserved", "Use it under the\tterms *of* the Foo agreement.", "CC\u00a0BY-SA 4.0", "Neither\nthe name", "Any\r\nday, or any later\n version", "Under the foot of a hill."]
    found = {r.doc_id: (r.sentence_ids, r.licenses) for r in license_scan.scan(docs(spark, texts), ["doc_id"]).collect()}
    assert [found[k][0] for k in range(9)] == [["unlicense:"], ["cc_by:4.0"], ["cc_by:4.0"], ["reserved:"], ["unknown:"], ["cc_by_sa:4.0"], ["bsd_names:"], ["later:"], []]
    assert [found[k][1] for k in (0, 1, 2, 4, 5)] == [["Public-domain"], ["CC-BY-4.0"], ["CC-BY-4.0"], ["UNKNOWN"], ["CC-BY-SA-4.0"]]


# -- 1


def test_repeated_passages(spark):
    rng, words = random.Random(21), vocabulary(30)
    passage = [prose(rng, n, words) for n in (55, 80, 120)]
    texts = [prose(rng, 200, words) for _ in range(30)] + [None, "", "tiny"]
    for k in range(9):
        cut = 100 + 17 * k
        body = texts[k].split(" ")
        texts[k] = " ".join(body[: cut // 3]) + (" " if k % 2 else "\n") + passage[k % 3].upper() + ", " + " ".join(body[cut // 3 :])
    texts[12] = texts[12] + " " + texts[12]  # repeats inside one document only
    found = substring_dedup.repeats(docs(spark, texts)).collect()
    hit = {r.doc_id for r in found} | {k for r in found for k in r.kept_in}
    assert hit == set(range(9)) and {r.doc_id for r in found} == set(range(3, 9))
    for r in found:
        piece = re.sub(r"\W+", " ", texts[r.doc_id][r.start : r.stop].lower()).split()
        # the last paragraph of a passage may take a word of what follows along
        assert sum(w in passage[r.doc_id % 3] for w in piece) >= 0.9 * len(piece) == 0.9 * r.n_words and r.kept_in == [r.doc_id % 3]
    assert substring_dedup.repeats(docs(spark, []).limit(0)).count() == 0


def test_edited_passages_are_removed_whole(spark):
    rng, words, texts, spans = random.Random(22), vocabulary(31), [], {}
    for k in range(200):  # pairs: exact passages of 51 words, and those of 60 with one or two words changed
        passage = [rng.choice(words) for _ in range(51 if k % 3 == 0 else 60)]
        copy = list(passage)
        for _ in range(k % 3):
            copy[rng.randrange(5, 55)] = f"changed{k}"
        for own in (passage, copy):
            lead = [rng.choice(words) for _ in range(40)]
            spans[len(texts)] = (len(lead), len(lead) + len(own))
            texts.append(" ".join(lead + own + [rng.choice(words) for _ in range(40)]))
    got = dict.fromkeys(range(1, 400, 2), 0)
    for r in substring_dedup.repeats(docs(spark, texts)).collect():
        low, high = (len(texts[r.doc_id][:n].split()) for n in (r.start, r.stop))
        begin, end = spans[r.doc_id]
        assert r.doc_id % 2 and r.kept_in == [r.doc_id - 1] and r.n_words == high - low and begin - 8 <= low < high <= end + 8
        got[r.doc_id] += min(high, end) - max(low, begin)
    share = [n / (spans[k][1] - spans[k][0]) for k, n in got.items()]
    assert sum(s == 0 for s in share) <= 3 and sum(share) / len(share) > 0.9, (sum(s == 0 for s in share), sum(share) / len(share))


def test_digests_follow_the_contract(spark, tmp_path):
    from driftwright.llm import queries

    docs(spark, ["Hello world", None]).drop("n_tokens", "score").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.doc_id: r for r in queries.op3_byte_bpe(spark, str(tmp_path)).collect()}
    assert rows[0].decoded_sha256 == hashlib.sha256(b"Hello world").hexdigest() and rows[1].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_many_secrets_in_one_text_and_clashing_names(spark):
    text = " ".join(f"é secret: value{k:04d}" for k in range(300)) + " end"
    rows = [(1, text, "s", "b", "g", "r"), (2, "", "s", "b", "g", "r"), (3, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, base string, generic string, row string")
    found = {r.doc_id: r for r in secret_scan.scan(df, ["doc_id", "base", "generic", "row"]).collect()}
    expected = [(m.start(), m.end()) for m in re.finditer(r"secret: value\d{4}", text)]
    assert [(s.start, s.end) for s in found[1].spans] == expected and (found[1].base, found[1].generic, found[1].row) == ("b", "g", "r")
    assert found[2].spans == [] and found[3].spans == []
    masked = {r.doc_id: r for r in secret_scan.redact(df).collect()}
    assert masked[1].text == " ".join(["é <secret>"] * 300) + " end" and masked[1].row == "r" and masked[3].text is None


def test_an_operator_in_a_used_worker_finds_no_old_memo(spark):
    from driftwright.llm import common

    given_up = []
    common.claim("one", lambda: given_up.append("one"))
    common.claim("one", lambda: given_up.append("one again"))
    assert given_up == []
    common.claim("two")
    assert given_up == ["one again"]
    common.claim("three")
    assert given_up == ["one again"]


def test_word_hashes_equal_those_of_split_words():
    import pyarrow as pa

    from driftwright.llm import words

    texts = ["Hello, wörld  (foo) bar", None, "", "  x", "hello", "(HELLO)", "\x0bwörld\x0c", "...", "foo" * 300_000 + " a " + "b" * 10, "Wörld hello"]
    for strip in (False, True):
        found = words.hash_words(pa.array(texts), strip)
        split = [(t or "").encode().lower().split() for t in texts]
        assert found.counts.tolist() == [len(w) for w in split]
        flat = [w.strip(words._PUNCTUATION) if strip else w for ws in split for w in ws]
        seen = dict(zip(flat, found.ids.tolist(), strict=True))
        assert [seen[w] for w in flat] == found.ids.tolist() and len(set(seen.values())) == len(seen)
    column = pa.array(["skipped", *texts]).slice(1)
    assert (words.hash_words(column, True).ids == found.ids).all()


def test_op1_pairs_of_paragraphs_against_brute_force(spark):
    """Contents that share a bucket and are alike end in one component, and no others."""
    rng, words = random.Random(31), vocabulary(12)
    base = prose(rng, 30, words).split()
    texts = [" ".join([rng.choice(words) if rng.random() < 0.03 else w for w in base]) for _ in range(60)]
    texts += [prose(rng, 6, words) + " " + " ".join(base[:9]) + " " + prose(rng, 6, words) for _ in range(60)]
    df = docs(spark, texts)
    some = substring_dedup.texts_of(df, "doc_id", "text")
    paras = substring_dedup.paragraphs(some)
    contents = paras.groupBy("content").agg(F.min("key0").alias("key0"), F.min("key1").alias("key1"), F.min("id").alias("low"), F.count("*").alias("times"))
    keys = {r.content: (r.key0, r.key1) for r in contents.collect()}
    sets = {r.id: set(r.hashes) for r in substring_dedup.shown_sets(some, contents).collect()}
    group = {c: c for c in keys}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in keys:
        for b in keys:
            if a < b and set(keys[a]) & set(keys[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    found = {r.node: r.component for r in substring_dedup.content_clusters(some, contents).collect()}
    assert {c: found.get(c, c) for c in keys} == {c: find(c) for c in keys} and len(set(found.values())) < len(found)
