"""Main text of web pages by equivalence-class template deduction.

Pages of one host share a template. Every page is read into tokens: element paths, and text blocks with their paths.
Tokens that share their occurrence vector over the host's different pages form an equivalence class; vectors are
compared by fingerprints, sums of hashes of (page, count), so a host of any size is aggregated before it is
shuffled and no page list is ever gathered. A text is a constant of the template if most pages of the host have it,
however often, or if it is nested in an element of its own class: it then comes with that element wherever this stands,
as the labels of a repeated record and the texts of a named part that only some pages have do. Texts of more than
FEW_WORDS words are what an article may say, such as a story that several pages carry or a quotation: they are constants
only where every one of at least ALL_PAGES pages has them. Constants are taken out of every page; what remains fills the
slots. The main slot is the deepest path of most pages that holds most of the text outside
of regions named as something else. An article (or main) element is a hint: its own fillings are the main text unless
the main slot holds more than twice as much. Where constants are all that an article has, as in a host of copies
of one article, it stays whole unless the main slot holds more.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out of it.

Pages whose host has fewer than LEAST_PAGES different pages are read without a template. Templates are broadcast
while they have at most BROADCAST_ROWS hosts and constants, which are counted first; beyond, they are joined by host.

Defined results: null or empty html gives an empty text; a page without a url belongs to a host of its own name, the
empty one; broken markup is read leniently, an unclosed comment or script running to the end, a tag without an end as
text; pages are read in one pass, in time and memory in proportion to their length however deep their elements nest;
repeated rows give repeated rows; an empty table gives an empty table. Only the named columns are kept, of any name.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stash, trimmed
from .words import text_slices

LEAST_PAGES = 3
#: Words of a text that a class of few pages may take out; pages that a host needs for longer texts to be its template's.
FEW_WORDS, ALL_PAGES = 8, 10
MAIN_SHARE = 0.5
BROADCAST_ROWS = 1_000_000
#: Pages and bytes that a worker holds at once.
SLICE, SLICE_BYTES = 128, 4 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea title select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that start a block and end an open paragraph.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table td th tr ul".split())
ALIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
SIDE_TAGS = frozenset("nav aside footer form menu dialog button".split())
#: Words in class, id or role that name something other than the article.
SIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising adsense sponsor sponsored promo promoted banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side "
    "aside footer foot header masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay comment comments "
    "respond reply replies discussion disqus share sharing social related recommended newsletter subscribe subscription signup login search form pagination pager "
    "copyright widget contentinfo complementary".split()
)
MAIN_WORDS = frozenset("main article".split())

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"""[^>"']*""")
_NAMED = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[\s_\-:/]+|(?<=[a-z])(?=[A-Z])")
_BLANK = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    """An open element. block: the place in the stack of the innermost one that is no inline element, main: the number of
    the innermost article, named: the token of the innermost path step that has a name, size: text inside, sides left out."""

    tag: str
    path: int
    depth: int
    side: bool
    main: int
    block: int
    named: int
    parent: Node | None
    size: int = 0


@dataclass(slots=True)
class Block:
    """One text block: its decoded text, the element that holds it, whether it is in a side region, and its article's number."""

    text: str
    holder: Node
    side: bool
    main: int

    @property
    def token(self) -> int:
        return token(f"{self.holder.path} {self.text}")


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)


class Mark(NamedTuple):
    """A tag: where it begins and ends, whether it closes, its name and attributes; comments have no name."""

    start: int
    stop: int
    closes: bool
    tag: str
    attributes: str


def marks(source: str, at: int = 0) -> Iterator[Mark]:
    """The markup of a page, in one pass. The consumer may send the place from which to go on."""
    last = {q: source.rfind(q) for q in "\"'>"}
    lost: set[int] = set()  # quotes that, read as opening ones, lead to no end of the tag

    def end_of(start: int) -> int:
        """The place after the end of the tag whose attributes begin here: past quoted text if quotes match, else at the next >."""
        place, passed = start, []
        while True:
            place = _PLAIN.match(source, place).end()
            if place >= len(source) or place in lost:
                break
            if source[place] == ">":
                return place + 1
            passed.append(place)
            if place >= last[source[place]]:
                break
            place = source.index(source[place], place + 1) + 1
        lost.update(passed)
        return source.find(">", start) + 1

    while (at := source.find("<", at)) >= 0 and at < last[">"] or at >= 0 and source.startswith("<!--", at):
        following = source[at + 1 : at + 2]
        found = None
        if following == "!" or following == "?":
            if source.startswith("<!--", at):
                stop = source.find("-->", at + 4)
                found = Mark(at, stop + 3 if stop >= 0 else len(source), False, "", "")
            else:
                found = Mark(at, source.index(">", at) + 1, False, "", "")
        elif tag := _TAG.match(source, at + 1):
            stop = end_of(tag.end())
            found = Mark(at, stop, bool(tag[1]), tag[2].lower(), source[tag.end() : stop - 1])
        at += 1
        if found:
            at = (yield found) or found.stop


def _names(attributes: str) -> list[str]:
    return [w for m in _NAMED.finditer(attributes) for w in _SPLIT.split(m[2] or m[3] or m[4] or "") if w]


def read(source: str) -> Page:
    """Blocks and elements of a page."""
    root = Node("", 0, 0, False, 0, 0, 0, None)
    page, stack, pieces = Page(), [root], []
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    at, number = 0, 0

    def close() -> None:
        if pieces:
            text = _BLANK.sub(" ", html_lib.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                holder = stack[stack[-1].block]
                page.blocks.append(Block(text, holder, stack[-1].side, stack[-1].main))
                if not stack[-1].side:
                    holder.size += len(text)

    def leave(place: int) -> None:
        while len(stack) > place:
            opened[stack.pop().tag].pop()

    found = marks(source)
    mark = next(found, None)
    while mark is not None:
        pieces.append(source[at : mark.start])
        at, tag = mark.stop, mark.tag
        if mark.closes:
            if tag not in INLINE:
                close()
            place = opened[tag][-1] if opened.get(tag) else 0
            if place and not (tag in INLINE and stack[-1].block > place):
                leave(place)
        elif tag in RAW:
            end = re.compile(rf"</{tag}\s*>" if tag in ("textarea", "title", "select") else rf"</{tag}[\s/>]", re.I).search(source, at)
            rest = source.find(">", end.start()) if end else -1
            at = rest + 1 if rest >= 0 else len(source)
        elif tag in VOID:
            if tag in ("br", "hr"):
                close() if tag == "hr" else pieces.append(" ")
        elif tag:
            inline = tag in INLINE
            if not inline:
                close()
                inner = ALIKE.get(tag, ())
                while (place := stack[-1].block) and (stack[place].tag in inner or (stack[place].tag == "p" and tag in ENDS_P)):
                    leave(place)
            names = _names(mark.attributes)
            low = {w.lower() for w in names}
            top = stack[-1]
            main = tag in ("article", "main") or (bool(MAIN_WORDS & low) and "role" in mark.attributes.lower())
            listed = tag not in ("html", "body", "article", "main") and not inline and bool(SIDE_WORDS & low) and not (top.main and low & SIDE_WORDS <= {"header", "main"})
            side = top.side or tag in SIDE_TAGS or (tag == "header" and not top.main) or listed
            number += 1
            inside = number if main and not side else top.main
            if inline:
                node = Node(tag, top.path, top.depth, side, inside, top.block, top.named, stack[top.block])
            else:
                kept = [w for w in names if not any(c.isdigit() for c in w)]
                path = token(f"{top.path}/{tag}" + "".join(f".{w}" for w in kept))
                node = Node(tag, path, top.depth + 1, side, inside, len(stack), path if kept else top.named, stack[top.block])
                page.nodes.append(node)
            opened.setdefault(tag, []).append(len(stack))
            stack.append(node)
        try:
            mark = found.send(at)
        except StopIteration:
            mark = None
    pieces.append(source[at:])
    close()
    for node in reversed(page.nodes):  # children come after their parents
        node.parent.size += node.size
    return page


def token(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _articles(blocks: list[Block]) -> list[Block]:
    """The blocks in an article, or in several of like size."""
    sizes: dict[int, int] = {}
    for b in blocks:
        if b.main:
            sizes[b.main] = sizes.get(b.main, 0) + len(b.text)
    most = max(sizes.values(), default=0)
    return [b for b in blocks if b.main and sizes[b.main] * 4 >= most]


def _inside(page: Page, slot: int) -> list[Node]:
    """The elements of this path and all in them; parents come before their children."""
    known: set[int] = set()
    return [n for n in page.nodes if (n.path == slot or id(n.parent) in known) and not known.add(id(n))]


def main_text(page: Page, constants: frozenset[int] = frozenset(), slot: int | None = None) -> str:
    """The blocks of the main slot in page order, joined by one space."""
    plain = [b for b in page.blocks if not b.side]
    own = [b for b in plain if b.token not in constants] if constants else plain
    held_by = {id(n) for n in _inside(page, slot)} if slot is not None else set()
    inside = [b for b in own if id(b.holder) in held_by]
    held = sum(len(b.text) for b in inside)
    for hinted, share in ((_articles(own), MAIN_SHARE), (_articles(plain), 1)):
        if hinted:
            if sum(len(b.text) for b in hinted) >= share * held:
                return " ".join(b.text for b in hinted)
            break
    return " ".join(b.text for b in inside or own or plain)


def host(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def tokens_of(pages: DataFrame) -> DataFrame:
    """``host, page`` (a hash of the html) and ``tokens``: struct(token, depth, n, size, holder, named).

    depth is that of an element path, 0 for a text block; size is the text inside an element, the words of a text; holder and
    named are the paths of the element that holds a text, and of the innermost one around it that has a name. All of it is
    numbers, so that the aggregations over it hash and need no sort.
    """
    kind = "array<struct<token:bigint,depth:int,n:int,size:bigint,holder:bigint,named:bigint>>"
    numbers = [("token", pa.int64()), ("depth", pa.int32()), ("n", pa.int32()), ("size", pa.int64()), ("holder", pa.int64()), ("named", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "html", SLICE_BYTES, SLICE):
            rows = []
            for source in part.column("html").to_pylist():
                page, found = read(source or ""), {}
                for node in page.nodes:
                    own = found.setdefault(node.path, {"token": node.path, "depth": node.depth, "n": 0, "size": 0, "holder": 0, "named": 0})
                    own["n"] += 1
                    own["size"] += node.size
                for b in page.blocks:
                    name = b.token
                    own = found.setdefault(name, {"token": name, "depth": 0, "n": 0, "size": b.text.count(" ") + 1, "holder": b.holder.path, "named": b.holder.named})
                    own["n"] += 1
                rows.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([part.column("host"), part.column("page"), pa.array(rows, pa.list_(pa.struct(numbers)))], names=["host", "page", "tokens"])

    named = pages.select(host(F.col("url")).alias("host"), F.xxhash64("html").alias("page"), "html").where(F.col("html").isNotNull())
    return named.mapInArrow(trimmed(run), f"host string, page bigint, tokens {kind}")


def deduce(pages: DataFrame) -> DataFrame:
    """Per host: ``constants`` (tokens of template texts) and ``slot`` (the token of the main slot's path)."""
    found = tokens_of(pages).select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    # one row per host, page and token: copies of a page count once
    each = found.groupBy("host", "token", "page").agg(*(F.max(c).alias(c) for c in ("depth", "n", "size", "holder", "named")))
    vector = F.bit_xor(F.xxhash64("page", "n"))
    both = [F.max("depth").alias("depth"), F.count("*").alias("pages"), F.max("n").alias("high"), F.sum("size").alias("size"), F.max("size").alias("words"), F.max("holder").alias("holder"), F.max("named").alias("named")]
    classes = each.groupBy("host", "token").agg(*both, vector.alias("vector"))
    classes = stash(classes.where(F.col("pages") >= LEAST_PAGES))
    whole = classes.groupBy("host").agg(F.max("pages").alias("all"))
    known = classes.join(whole, "host").withColumn("most", 2 * F.col("pages") > F.col("all"))
    paths = known.where("depth > 0")
    texts = known.where("depth = 0")
    short = F.col("words") <= FEW_WORDS
    common = texts.where(F.when(short, F.col("most")).otherwise((F.col("pages") == F.col("all")) & (F.col("all") >= ALL_PAGES)))
    # a short text nested in an element of its class comes with that element: one that has a name, or that repeats on pages
    rare = texts.where(short & ~F.col("most"))
    elements = paths.select("host", "vector", F.col("token").alias("element"))
    named = rare.withColumn("element", F.col("named")).join(elements, ["host", "element", "vector"], "left_semi")
    repeated = rare.where("high > 1").withColumn("element", F.col("holder")).join(elements, ["host", "element", "vector"], "left_semi")
    constants = common.select("host", "token").union(named.select("host", "token")).union(repeated.select("host", "token"))
    slots = paths.where("most and high = 1")
    total = slots.groupBy("host").agg(F.max("size").alias("total"))
    deep = slots.join(total, "host").where((F.col("total") > 0) & (F.col("size") >= MAIN_SHARE * F.col("total")))
    slot = deep.groupBy("host").agg(F.max_by("token", F.struct("depth", "size", "token")).alias("slot"))
    return slot.join(constants.groupBy("host").agg(F.collect_set("token").alias("constants")), "host", "full_outer")


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, with ``text`` and ``n_chars`` (code points)."""
    ship(pages.sparkSession)
    templates = stash(deduce(pages))
    held = templates.agg(F.sum(1 + F.coalesce(F.size("constants"), F.lit(0)))).first()[0] or 0
    kept = [pages.schema[name] for name in keep]
    own = [F.col(f"`{name}`").alias(f"in_{k}") for k, name in enumerate(keep)]
    rows = pages.select(*own, "html", host(F.col("url")).alias("host")).join(F.broadcast(templates) if held <= BROADCAST_ROWS else templates, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset[int]] = {}
        for part in text_slices(batches, "html", SLICE_BYTES, SLICE):
            texts = []
            for name, source, slot, constants in zip(*(part.column(c).to_pylist() for c in ("host", "html", "slot", "constants")), strict=True):
                if name not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[name] = frozenset(constants or ())
                texts.append(main_text(read(source or ""), known[name], slot))
            yield pa.RecordBatch.from_arrays([*(part.column(f"in_{k}") for k in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return rows.mapInArrow(trimmed(run), schema)
