"""Secret scans by corpus-wide ownership, with DataFrame functions only.

Candidates are found by pattern in every whole text: assignments, access keys and long hexadecimal runs (the base
kinds, which always stay), and ``generic`` runs of mixed letters and digits. Each candidate's value is hashed, and
the hashes are counted over the corpus by distinct repository and distinct owner. A value that many owners hold
is an ``example`` that was copied around; one of a single owner is ``live``; the rest is ``shared``. A generic run
becomes a span only where it is live.

Values are aggregated per (hash, owner) before they meet by hash, so a value that fills a third of the corpus
adds one row per owner and task; the join back to the spans has one row per hash on its small side, and the skew join
can split its large one.

Defined results: a null or empty text has no spans; a null owner counts as one owner of its own, a null
repository as none; repeated rows each get their spans and count as one repository; empty tables give empty
tables. Offsets are code points, the end exclusive. Columns of the input may have any names, also those made here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean, stash

#: Fixed values of the contract: pattern, group that holds the value, least length of that group.
BASE_KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: Runs of 24 or more letters, digits, - and _ with a capital, a small letter and two digits.
GENERIC = (r"(?<![A-Za-z0-9_+/.=-])(?=[A-Za-z_-]*[0-9][A-Za-z_-]*[0-9])(?=[a-z0-9_-]*[A-Z])(?=[A-Z0-9_-]*[a-z])[A-Za-z0-9_-]{24,}+(?![A-Za-z0-9_+/.=-])", 0, 24)
KIND_ORDER = [*BASE_KINDS, "generic"]
#: A value that so many owners hold is an example.
EXAMPLE_OWNERS = 3
#: Values with so few different characters are placeholders.
PLACEHOLDER_CHARACTERS = 4

#: Matches of a text whose lengths are summed together.
BLOCK = 64

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value_hash:string,plain:boolean>>"


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """All matches of a pattern, leftmost and non-overlapping, with code-point offsets.

    The offsets follow from the pieces between the matches: match i starts after i + 1 pieces and i matches.
    """
    if kind == "hex":  # maximal runs: too short ones match nothing and are dropped at once
        pattern = f"[0-9a-f]{{{least},}}"
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    both = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), matches.alias("match"), values.alias("value"))
    sized = F.transform(both, lambda x: F.struct((F.length(x["piece"]) + F.coalesce(F.length(x["match"]), F.lit(0))).cast("bigint").alias("both"), F.length(x["match"]).alias("own"), x["value"].alias("value")))

    def ends(lengths: Column) -> Column:
        return running(lengths, lambda t, y: t + y, F.lit(0).cast("bigint"))

    def span(x: Column, end: Column) -> Column:
        return F.struct(
            (end - x["own"]).alias("start"), F.lit(KIND_ORDER.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            F.sha2(x["value"], 256).alias("value_hash"), (F.size(F.array_distinct(F.split(x["value"], ""))) <= PLACEHOLDER_CHARACTERS).alias("plain"), F.length(x["value"]).alias("size"),
        )

    spans = bound(sized, lambda own: F.zip_with(own, ends(F.transform(own, lambda x: x["both"])), span))
    found = F.filter(spans, lambda x: x["size"] >= least)
    return F.when(F.rlike(text, F.lit(pattern)), found.cast(SPAN.replace("plain:boolean", "plain:boolean,size:int"))).otherwise(F.array().cast(SPAN.replace("plain:boolean", "plain:boolean,size:int")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, as the only element of an array."""
    return F.transform(F.array(value), use)[0]


def candidates(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``base`` and ``generic``, arrays of spans in order of start and kind."""
    text = clean(text_col)
    base = F.array_sort(F.concat(*(spans_of(text, kind, *rule) for kind, rule in BASE_KINDS.items())))
    df = df.withColumn("base", base).withColumn("generic", spans_of(text, "generic", *GENERIC))
    apart = F.filter("generic", lambda g: ~F.exists("base", lambda b: (b["start"] < g["end"]) & (g["start"] < b["end"])))
    return df.withColumn("generic", apart)


def ownership(found: DataFrame, owner: str, repo: str) -> DataFrame:
    """Per value hash: distinct owners, distinct repositories, and the verdict."""
    rows = found.select(F.col(owner).alias("owner"), F.col(repo).alias("repo"), F.explode(F.concat("base", "generic")).alias("s"))
    each = rows.groupBy(F.col("s.value_hash").alias("value_hash"), "owner", "repo").agg(F.max("s.plain").alias("plain"))
    owners = each.groupBy("value_hash", "owner").agg(F.count("repo").alias("repos"), F.max("plain").alias("plain"))
    counted = owners.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.max("plain").alias("plain"))
    verdict = F.when(F.col("plain") | (F.col("n_owners") >= EXAMPLE_OWNERS), "example").when(F.col("n_owners") == 1, "live").otherwise("shared")
    return counted.select("value_hash", "n_owners", "n_repos", verdict.alias("verdict"))


def met(each: DataFrame, judged: DataFrame) -> DataFrame:
    """Spans with what is known of their value. Joined by another expression of the hash than the aggregate's: both sides
    then come from an exchange of their own, so a value that fills much of the corpus is split into tasks (skew join)."""
    whole = F.substring("value_hash", 1, 64)
    right = judged.withColumn("meet", whole).drop("value_hash")
    return each.withColumn("meet", whole).join(right, "meet").drop("meet")


def scan(df: DataFrame, keys: list[str], owner: str = "source", repo: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its ``keys`` and ``spans``, an array of spans with owners, repositories and verdict.

    The text is read once; what is kept of it is the spans.
    """
    own = {name: f"in_{k}" for k, name in enumerate(dict.fromkeys([*keys, owner, repo, text_col]))}  # names may clash with those made here
    rows = df.select(*(F.col(f"`{name}`").alias(at) for name, at in own.items()))
    wanted = [own[name] for name in dict.fromkeys([*keys, owner, repo])]
    found = stash(candidates(rows, own[text_col]).select(*wanted, F.monotonically_increasing_id().alias("row"), "base", "generic"))
    judged = ownership(found, own[owner], own[repo])
    each = found.select("row", F.explode(F.concat("base", "generic")).alias("s")).withColumn("value_hash", F.col("s.value_hash"))
    each = met(each, judged).where((F.col("s.kind") != "generic") | (F.col("verdict") == "live"))
    span = F.struct("s.start", "s.rank", "s.end", "s.kind", "value_hash", "n_owners", "n_repos", "verdict")
    spans = each.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans, "row", "left").select(*(F.col(own[k]).alias(k) for k in keys), F.coalesce("spans", empty).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def running(values: Column, combine: Callable[[Column, Column], Column], start: Column) -> Column:
    """Each element combined with all before it: whole blocks first, then within the block, so that many cost no square."""

    def total(parts: Column, first: Column | int, n: Column | int) -> Column:
        return F.aggregate(F.slice(parts, F.lit(first) if isinstance(first, int) else first, F.lit(n) if isinstance(n, int) else n), start, combine)

    def over(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int")), lambda b: total(own, b * BLOCK + 1, BLOCK))
        before = lambda sums: F.transform(sums, lambda _, b: total(sums, 1, b))
        block = lambda i: F.floor(i / BLOCK).cast("int")
        made = lambda starts: F.transform(own, lambda _, i: combine(starts[block(i)], total(own, block(i) * BLOCK + 1, i - block(i) * BLOCK + 1)))
        return bound(blocks, lambda sums: bound(before(sums), made))

    return bound(values, over)  # computed once, not for each element


def masked(text: Column, spans: Column, mask: str = "<secret>") -> Column:
    """The text with every span, or group of overlapping spans, replaced by a mask. spans: in order of their starts.

    The text is cut into its code points once, and what lies between the groups is taken from them in one pass.
    """
    ends = F.transform(spans, lambda s: s["end"])
    none = F.lit(0).cast("bigint")

    def pieces(reach: Column) -> Column:
        """reach: the furthest end of each span and those before it."""
        before = lambda i: F.when(i > 0, reach[(i - 1).cast("int")]).otherwise(none)
        opens = F.transform(spans, lambda s, i: F.struct(before(i).alias("at"), (s["start"] - before(i)).alias("n")))
        groups = F.filter(opens, lambda o: o["n"] >= 0)
        last = F.struct(reach[F.size(reach) - 1].alias("at"), F.length(text).cast("bigint").alias("n"))
        cut = lambda points: F.array_join(F.transform(F.concat(groups, F.array(last)), lambda o: F.array_join(F.slice(points, (o["at"] + 1).cast("int"), o["n"].cast("int")), "")), mask)
        return bound(F.split(text, ""), cut)

    return F.when(F.size(spans) == 0, text).otherwise(bound(running(ends, lambda a, b: F.greatest(a, b), none), pieces))


def redact(df: DataFrame, owner: str = "source", repo: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, their secrets masked: all base spans, and the generic ones that are live."""
    own = df.columns
    at = {name: f"in_{k}" for k, name in enumerate(own)}  # names of the input may clash with those made here
    owner, repo, text_col = at[owner], at[repo], at[text_col]
    # searched once: the rows are written with their spans, so that a row has one number in all that follows
    found = stash(candidates(df.toDF(*at.values()), text_col).withColumn("row", F.monotonically_increasing_id()))
    judged = ownership(found.where(F.size("base") + F.size("generic") > 0), owner, repo)
    plain = found.where(F.size("generic") == 0)
    open_ = found.where(F.size("generic") > 0)
    each = open_.select("row", F.explode("generic").alias("s")).withColumn("value_hash", F.col("s.value_hash"))
    live = met(each, judged.where("verdict = 'live'").select("value_hash")).groupBy("row").agg(F.collect_list("s").alias("live"))
    opened = open_.join(live, "row", "left").withColumn("base", F.array_sort(F.concat("base", F.coalesce("live", F.array().cast(found.schema["base"].dataType)))))
    both = plain.unionByName(opened.drop("live"))
    out = both.withColumn(text_col, F.when(F.col(text_col).isNotNull(), masked(F.col(text_col), F.col("base"))))
    return out.select(*(F.col(at[name]).alias(name) for name in own))
