"""Main text of pages: broken and deep markup, what a template may take out, and what it must leave."""

import random
import time
import tracemalloc

import pytest
from pyspark.sql import functions as F

from driftwright.llm import html_extract

PAGES = "page_id bigint, url string, html string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


@pytest.mark.parametrize("broadcast_rows", [html_extract.BROADCAST_ROWS, 0])
def test_article_text_on_several_pages_stays(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", broadcast_rows)
    rng, rows, expected = random.Random(1), [], {}
    story, quotation, own = prose(rng, 80), "To be or not to be", [prose(rng, 20) for _ in range(12)]
    for k in range(12):
        day = f"Day {prose(rng, 3)}"
        some = f'<div class="syndicated"><p>{story}</p></div>' if k < 3 else ""
        rows.append((k, f"https://a.example/{k}", f"<body><article><h1>{day}</h1>{some}</article></body>"))
        expected[k] = f"{day} {story}" if k < 3 else day
        quoted = f"<blockquote>{quotation}</blockquote>" if k < 3 else ""
        rows.append((100 + k, f"https://b.example/{k}", f'<body><article><p>{own[k]}</p>{quoted}<p class="all">Each article ends so</p></article></body>'))
        expected[100 + k] = f"{own[k]} {quotation}" if k < 3 else own[k]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], f"{PAGES}, host string, in_0 string")
    found = html_extract.extract(df, keep=("page_id", "host", "in_0")).collect()
    assert {r.page_id: r.text for r in found} == expected and {(r.host, r.in_0) for r in found} == {("x", "y")}


def test_long_text_of_every_page_is_the_template(spark):
    rng = random.Random(2)
    note, texts = prose(rng, 30), [prose(rng, 40) for _ in range(12)]
    rows = [(k, f"https://a.example/{k}", f"<article><p>{t}</p><p>{note}</p></article>") for k, t in enumerate(texts)]
    rows += [(20 + k, f"https://b.example/{k}", f"<article><p>{t}</p><p>{note}</p></article>") for k, t in enumerate(texts[:5])]
    found = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {k: t for k, t in enumerate(texts)} | {20 + k: f"{t} {note}" for k, t in enumerate(texts[:5])}


def brute_classes(pages):
    """Constants of one host by the definition, over whole occurrence vectors."""
    paths, texts = {}, {}
    for k, source in enumerate(pages):
        page = html_extract.read(source)
        for n in page.nodes:
            paths.setdefault(n.path, {}).setdefault(k, 0)
            paths[n.path][k] += 1
        for b in page.blocks:
            vector, _ = texts.setdefault(b.token, ({}, b))
            vector[k] = vector.get(k, 0) + 1
    out = set()
    for name, (vector, b) in texts.items():
        if len(vector) < html_extract.LEAST_PAGES:
            continue
        most, short = 2 * len(vector) > len(pages), len(b.text.split(" ")) <= html_extract.FEW_WORDS
        nested = paths.get(b.holder.named) == vector or (max(vector.values()) > 1 and paths.get(b.holder.path) == vector)
        if (short and (most or nested)) or (len(vector) == len(pages) >= html_extract.ALL_PAGES):
            out.add(name)
    return out


def test_classes_against_whole_vectors(spark):
    rng = random.Random(3)
    hosts = {}
    for h in range(8):
        parts = [f'<div class="{rng.choice(["part", "box", "x1"])}{"abc"[k % 3]}"><{rng.choice("pb")}>{prose(rng, rng.choice([2, 5, 12]))}</div>' for k in range(8)]
        hosts[f"h{h}.example"] = ["<body>" + "".join(p * rng.choice([1, 1, 2]) for p in parts if rng.random() < 0.6) + f"<p>{prose(rng, 5)}</body>" for _ in range(rng.choice([2, 4, 12]))]
    rows = [(k, f"https://{h}/{k}", page) for h, pages in hosts.items() for k, page in enumerate(pages)]
    found = {r.host: set(r.constants or ()) for r in html_extract.deduce(spark.createDataFrame(rows + rows[:9], PAGES)).collect()}
    assert {h: found.get(h, set()) for h in hosts} == {h: brute_classes(pages) for h, pages in hosts.items()}
    assert any(found.values())


@pytest.mark.parametrize("source", ["<a " * 300_000, "<div>" * 100_000, "<div>x" * 50_000, "<b>" * 50_000 + "x<p>y</p>" * 50_000, "<b>" + "<div>" * 50_000 + "</b>" * 50_000, '<a ">' * 100_000 + "'", "</x>" * 100_000, "<a '\">" * 50_000])
def test_broken_pages_take_linear_time_and_memory(source):
    began = time.perf_counter()
    page = html_extract.read(source)
    html_extract.main_text(page, frozenset([1]), 2)
    assert time.perf_counter() - began < 10
    if source.startswith("<div>"):
        tracemalloc.start()
        html_extract.read(source)
        assert tracemalloc.get_traced_memory()[1] < 200e6
        tracemalloc.stop()


def test_broken_tags():
    text = lambda s: html_extract.main_text(html_extract.read(s))
    assert text('<p title="a>b">one</p><p title="a>two</p>') == "one two" and text("a <b c") == "a <b c" and text("1 < 2 </ 3") == "1 < 2 </ 3"
    assert text("<p>a<!-- <p>b --><?x y?><!doctype z>c") == "ac" and text("<script>x</script ><p>y</p><style>z") == "y"


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "https://a.example/", "<p>x</p>"), (1, None, None), (2, "not a url", "<article>" + "word " * 100_000 + "</article>")]
    found = html_extract.extract(spark.createDataFrame(rows, PAGES).withColumn("constants", F.lit("clash"))).orderBy("page_id").collect()
    assert [(r.page_id, r.n_chars) for r in found] == [(None, 1), (1, 0), (1, 0), (2, 499_999)]
