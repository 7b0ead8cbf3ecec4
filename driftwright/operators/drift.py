"""Schema drift: transitions between files, differences, renames and the report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.names import similarity
from ..functions.types import compatible
from ..session import scratch
from ..sources.files import by_period, family, period_column
from ..sources.footer import read_footers
from .profile import profile, sample
from .similarity import score, verified

NAME_THRESHOLD, DATA_THRESHOLD, SURE = 0.7, 0.6, 0.95
SAMPLE_ROWS = 5000
#: Files whose names are broadcast rather than shuffled.
BROADCAST_FILES = 100_000


@dataclass(frozen=True)
class Rename:
    old: str
    new: str
    confidence: float
    data_verified: bool | None = None
    old_type: str = ""
    new_type: str = ""


@dataclass
class Change:
    period_from: str
    period_to: str
    file_from: str
    file_to: str
    added: list[tuple[str, str]] = field(default_factory=list)
    removed: list[tuple[str, str]] = field(default_factory=list)
    retyped: list[tuple[str, str, str]] = field(default_factory=list)
    renamed: list[Rename] = field(default_factory=list)

    def any(self) -> bool:
        return bool(self.added or self.removed or self.retyped or self.renamed)


@dataclass
class Analysis:
    data_type: str
    files: int
    transitions: list[tuple[str, str, list[tuple[str, str]]]]
    changes: list[Change]
    generic: bool = False


def schemas(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, period, columns``: the schema of each readable file, from the footers."""
    rows = read_footers(spark, paths).where("error is null").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("ordinal", "column", "dtype"))).alias("c"))
    return rows.select("path", period_column(F.col("path")).alias("period"), F.transform("c", lambda x: F.struct(x["column"].alias("name"), x["dtype"].alias("dtype"))).alias("columns"))


def family_schemas(spark: SparkSession, families: dict[str, list[str]]) -> DataFrame:
    """As ``schemas``, with ``data_type``, for several families in one job; no file belongs to two."""
    paths = [(p, kind) for kind, own in families.items() for p in own]
    kinds = spark.createDataFrame(paths, "path string, data_type string")
    return schemas(spark, [p for p, _ in paths]).join(F.broadcast(kinds) if len(paths) <= BROADCAST_FILES else kinds, "path")


def signature(columns: Column) -> Column:
    """Names and types in order, as one text."""
    return F.array_join(F.transform(columns, lambda c: F.concat(c["name"], F.lit(":"), c["dtype"])), ",")


def transitions(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The files whose signature differs from that of the file before, and the first; ``files`` has period and sig, and path
    where a period has several files. One window per family: ``by`` names what tells families apart."""
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy("period", *(["path"] if "path" in files.columns else []))
    return files.withColumn("before", F.lag("sig").over(order)).where("before is null or sig <> before").drop("before")


def changes(files: DataFrame, by: str = "data_type") -> DataFrame:
    """Every change of every family, in one job: the family, ``period_from, period_to, path_from, path_to``, and ``added``,
    ``removed`` and ``retyped`` columns by name. files: by, period, path, columns."""
    found = transitions(files.withColumn("sig", signature(F.col("columns"))), [by])
    order = Window.partitionBy(by).orderBy("period", "path")
    was = lambda c: F.lag(c).over(order)
    steps = found.select(by, was("period").alias("period_from"), F.col("period").alias("period_to"), was("path").alias("path_from"), F.col("path").alias("path_to"), was("columns").alias("old"), F.col("columns").alias("new")).where("old is not null")
    lacks = lambda others: lambda c: ~F.exists(others, lambda o: o["name"] == c["name"])
    type_in = lambda columns, c: F.filter(columns, lambda o: o["name"] == c["name"])[0]["dtype"]
    changed = F.filter("new", lambda c: F.exists("old", lambda o: (o["name"] == c["name"]) & (o["dtype"] != c["dtype"])))
    retyped = F.transform(changed, lambda c: F.struct(c["name"].alias("name"), type_in(F.col("old"), c).alias("old_type"), c["dtype"].alias("new_type")))
    out = steps.select(by, "period_from", "period_to", "path_from", "path_to", F.array_sort(F.filter("new", lacks(F.col("old")))).alias("added"), F.array_sort(F.filter("old", lacks(F.col("new")))).alias("removed"), F.array_sort(retyped).alias("retyped"))
    return out


def column_types(files: DataFrame, by: str = "data_type") -> DataFrame:
    """``name, types``: the families in which each column ever appears."""
    each = files.select(by, F.explode("columns").alias("c")).select(F.col("c.name").alias("name"), by).distinct()
    return each.groupBy("name").agg(F.sort_array(F.collect_list(by)).alias("types"))


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``name, change, old_type, new_type`` of the columns added, removed and retyped; one full outer join."""
    both = old.select("name", F.col("dtype").alias("old_type")).join(new.select("name", F.col("dtype").alias("new_type")), "name", "full_outer")
    change = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "type_changed")
    return both.withColumn("change", change).where("change is not null").select("name", "change", "old_type", "new_type")


def match_greedily(scored: list[tuple[float, str, str]]) -> list[tuple[float, str, str]]:
    """One-to-one pairs, best score first, ties by old and new name."""
    taken_old, taken_new, out = set(), set(), []
    for value, old, new in sorted(scored, key=lambda s: (-s[0], s[1], s[2])):
        if old not in taken_old and new not in taken_new:
            taken_old.add(old)
            taken_new.add(new)
            out.append((value, old, new))
    return out


def best_pairs(scored: DataFrame) -> DataFrame:
    """``old, new, score`` one-to-one, as taking the best pair left again and again would: ties by old and new name.

    In each round every pair that is the best of both its ends is taken, and all pairs with a taken end go; a pair like
    that would be taken before any other with its ends, so the result is the same. Rounds are few unless scores form a
    long falling chain, and each halves what is left in the usual case.
    """
    spark = scored.sparkSession
    left = _written(scored.select("old", "new", F.col("score").cast("double").alias("score")).dropDuplicates(["old", "new"]))
    taken: DataFrame | None = None
    while not left.isEmpty():
        order = F.struct((-F.col("score")).alias("s"), F.col("old").alias("o"), F.col("new").alias("n"))
        firsts = [left.groupBy(end).agg(F.min(order).alias("b")).select("b.o", "b.n", F.lit(1).alias("one")) for end in ("old", "new")]
        both = firsts[0].unionByName(firsts[1]).groupBy("o", "n").count().where("count = 2")
        now = _written(left.join(both, (F.col("old") == F.col("o")) & (F.col("new") == F.col("n")), "left_semi"))
        left = _written(left.join(now.select("old"), "old", "left_anti").join(now.select("new"), "new", "left_anti"))
        taken = now if taken is None else taken.unionByName(now)
    return taken if taken is not None else spark.createDataFrame([], "old string, new string, score double")


def _written(df: DataFrame) -> DataFrame:
    """Written once into the shared folder: a round is not computed again in the next."""
    folder = scratch(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def name_scores(spark: SparkSession, removed: list[tuple[str, str]], added: list[tuple[str, str]]) -> DataFrame:
    """``old, new, score`` for every pair of removed and added columns; schemas are small, so are the pairs."""
    pairs = [(o, ot, n, nt) for o, ot in removed for n, nt in added]
    df = spark.createDataFrame(pairs, "old string, old_type string, new string, new_type string")
    value = similarity(F.col("old"), F.col("new")) * F.when(compatible(F.col("old_type"), F.col("new_type")), 1.0).otherwise(0.7)
    return df.select("old", "new", value.alias("score"))


def renames_by_name(spark: SparkSession, removed, added, threshold: float = NAME_THRESHOLD) -> list[Rename]:
    if not removed or not added:
        return []
    rows = name_scores(spark, removed, added).where(F.col("score") >= threshold).collect()
    kinds, new_kinds = dict(removed), dict(added)
    return [Rename(o, n, s, None, kinds[o], new_kinds[n]) for s, o, n in match_greedily([(r["score"], r["old"], r["new"]) for r in rows])]


def data_pairs(spark: SparkSession, removed, added, old_path: str, new_path: str, size: int | str = SAMPLE_ROWS) -> DataFrame:
    """``old, new, score, verified`` of the type-compatible pairs, from one profile of each file's sample."""
    sides = []
    for path, columns in ((old_path, removed), (new_path, added)):
        names = list(dict.fromkeys(c for c, _ in columns))
        sides.append(profile(sample(spark.read.parquet(path).select(*(quoted(c) for c in names)), size), names))
    return profile_pairs(*sides).select("old", "new", "score", "verified")


def profile_pairs(olds: DataFrame, news: DataFrame) -> DataFrame:
    """``old, new, score, verified`` of the type-compatible pairs of profiled columns; a profile has a row per column."""
    a, b = olds.select(F.struct("*").alias("a")), news.select(F.struct("*").alias("b"))
    pairs = a.join(b, compatible(F.col("a.dtype"), F.col("b.dtype")))
    return pairs.select(F.col("a.column").alias("old"), F.col("b.column").alias("new"), score(F.col("a"), F.col("b")).alias("score"), verified(F.col("a"), F.col("b")).alias("verified"))


def renames_by_data(spark, removed, added, old_path, new_path, threshold: float = DATA_THRESHOLD, size: int | str = SAMPLE_ROWS) -> list[Rename]:
    if not removed or not added:
        return []
    rows = data_pairs(spark, removed, added, old_path, new_path, size).where(F.col("score") >= threshold).collect()
    kinds, new_kinds = dict(removed), dict(added)
    return [Rename(o, n, s, True, kinds[o], new_kinds[n]) for s, o, n in match_greedily([(r["score"], r["old"], r["new"]) for r in rows])]


def verify_renames(spark, renames: list[Rename], old_path, new_path, size: int | str = SAMPLE_ROWS) -> list[Rename]:
    """Renames that are not sure by name are held against the data; sure ones stay unverified."""
    open_ = [r for r in renames if r.confidence < SURE]
    if not open_:
        return renames
    rows = data_pairs(spark, [(r.old, r.old_type) for r in open_], [(r.new, r.new_type) for r in open_], old_path, new_path, size).collect()
    found = {(r["old"], r["new"]): r["verified"] for r in rows}
    return [r if r.confidence >= SURE else Rename(r.old, r.new, r.confidence, found.get((r.old, r.new)), r.old_type, r.new_type) for r in renames]


def analyze(spark: SparkSession, folder: str, data_type: str, verify_data: bool = False, generic: bool = False, size: int | str = SAMPLE_ROWS) -> Analysis:
    """One family: as ``analyze_all``."""
    return analyze_all(spark, {data_type: folder}, verify_data, generic, size)[0]


def analyze_all(spark: SparkSession, folders: dict[str, str], verify_data: bool = False, generic: bool = False, size: int | str = SAMPLE_ROWS) -> list[Analysis]:
    """Footers of every file of every family in one job, then data only of the files at a transition and only of the columns
    that came or went. Only transitions reach the driver."""
    paths = {kind: by_period(family(spark, folder, kind)) for kind, folder in folders.items()}
    known = {kind: own for kind, own in paths.items() if own}
    steps: dict[str, list] = {kind: [] for kind in folders}
    found: dict[str, list] = {kind: [] for kind in folders}
    if known:
        files = _written(family_schemas(spark, known))
        for r in transitions(files.withColumn("sig", signature(F.col("columns"))), ["data_type"]).orderBy("data_type", "period", "path").collect():
            steps[r["data_type"]].append((r["period"], r["path"], [(c["name"], c["dtype"]) for c in r["columns"]]))
        for r in changes(files).orderBy("data_type", "period_to", "path_to").collect():
            found[r["data_type"]].append(r)
    out = []
    for kind in folders:
        made = []
        for r in found[kind]:
            added, removed, retyped = ([tuple(c) for c in r[name]] for name in ("added", "removed", "retyped"))
            renames = renames_by_data(spark, removed, added, r["path_from"], r["path_to"], size=size) if generic else renames_by_name(spark, removed, added)
            if verify_data and not generic:
                renames = [x for x in verify_renames(spark, renames, r["path_from"], r["path_to"], size) if x.data_verified is not False]
            gone, come = {x.old for x in renames}, {x.new for x in renames}
            change = Change(r["period_from"], r["period_to"], r["path_from"], r["path_to"], [c for c in added if c[0] not in come], [c for c in removed if c[0] not in gone], retyped, renames)
            if change.any():
                made.append(change)
        out.append(Analysis(kind, len(paths[kind]), steps[kind], made, generic))
    return out


def summarize(change: Change) -> str:
    """One line: what was renamed, added, dropped and retyped between two periods."""
    parts = []
    if change.renamed:
        parts.append("renamed " + ", ".join(f"{r.old}->{r.new}" for r in change.renamed))
    if change.added:
        parts.append("added " + ", ".join(n for n, _ in change.added))
    if change.removed:
        parts.append("dropped " + ", ".join(n for n, _ in change.removed))
    if change.retyped:
        parts.append("type-changed " + ", ".join(f"{n}({a}->{b})" for n, a, b in change.retyped))
    return f"{change.period_from} -> {change.period_to}: " + "; ".join(parts)


def coverage(analyses: list[Analysis]) -> dict[str, list[str]]:
    """The data types in which each column ever appears."""
    found: dict[str, set[str]] = {}
    for a in analyses:
        for _, _, columns in a.transitions:
            for name, _ in columns:
                found.setdefault(name, set()).add(a.data_type)
    return {name: sorted(kinds) for name, kinds in sorted(found.items())}


def report(analyses: list[Analysis]) -> str:
    """Text report: per type its files, periods, versions and changes; then the columns by type."""
    out = ["Schema drift" + (" (renames by data similarity; have them reviewed)" if any(a.generic for a in analyses) else ""), ""]
    for a in analyses:
        out += [f"== {a.data_type} ==", f"files analyzed: {a.files}"]
        if not a.transitions:
            out += ["no data files", ""]
            continue
        out += [f"periods: {a.transitions[0][0]} to {a.transitions[-1][0]}", f"schema changes: {len(a.changes)}", f"first schema ({a.transitions[0][0]}):"]
        out += [f"  {name:<30} {kind}" for name, kind in a.transitions[0][2]]
        for c in a.changes:
            out.append(summarize(c))
            for r in c.renamed:
                state = {True: "verified by data", False: "not verified", None: "by name"}[r.data_verified]
                out.append(f"    {r.old} -> {r.new}: confidence {r.confidence:.2f}, {state}")
        versions = {tuple(columns): p for p, _, columns in reversed(a.transitions)}
        out += [f"different schemas: {len(versions)}", ""]
    if len(analyses) > 1:
        out += ["columns by type:"] + [f"  {name:<30} {', '.join(kinds)}" for name, kinds in coverage(analyses).items()]
    return "\n".join(out)


