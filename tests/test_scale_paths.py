"""Positions and chunks, samples, profiles, families of several schemas, drift in one job, and pairs by rounds."""

import json
import random

import pytest

from driftwright import analytics, catalog
from driftwright.functions.hashing import least_hash
from driftwright.operators import drift
from driftwright.operators.profile import profile, sample, top_values
from driftwright.session import configure
from driftwright.sources.union import common_type, expand, scan


def numbers(spark, n, parts=5):
    rng = random.Random(n)
    rows = [(rng.choice([None, 0, 0, 0, rng.randrange(50)]), k, "x" * (k % 3)) for k in range(n)]  # a hot key and nulls
    return spark.createDataFrame(rows, "g int, k int, position string").repartition(parts)


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_positions_are_exact(spark, n):
    df = numbers(spark, n).drop("position")
    found = sorted((tuple(r) for r in analytics.numbered(df, ["g", "k"]).collect()), key=lambda r: r[2])
    expected = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r[:2] for r in found] == expected and [r[2] for r in found] == list(range(n))


@pytest.mark.parametrize(("n", "size"), [(0, 10), (5, 10), (30, 10), (501, 50)])
def test_files_have_exactly_the_rows_of_a_chunk(spark, tmp_path, n, size):
    df = numbers(spark, n).drop("position")
    for _ in range(2):  # the second replaces the first
        assert analytics.export_json(df, ["g", "k"], str(tmp_path / "out"), size) == -(-n // size)
    files = sorted((tmp_path / "out").glob("chunk=*/part-*.json"), key=lambda p: int(p.parent.name[6:]))
    rows = [[json.loads(line) for line in p.read_text().splitlines()] for p in files]
    assert [len(r) for r in rows] == [size] * (n // size) + ([n % size] if n % size else [])
    assert [(r.get("g"), r["k"]) for part in rows for r in part] == sorted(((r.g, r.k) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.chunk, r.n) for r in analytics.chunks(df, size).orderBy("chunk").collect()] == [(k, len(r)) for k, r in enumerate(rows)]


def test_a_sample_does_not_depend_on_partitions(spark):
    df = numbers(spark, 2000)
    few, part = sample(df, 50), sample(df, "10%")
    assert few.count() == 50 and sorted(map(str, few.collect())) == sorted(map(str, sample(df.repartition(1), 50).collect()))
    assert 140 < part.count() < 260 and sorted(map(str, part.collect())) == sorted(map(str, sample(df.coalesce(1), "10%").collect()))
    assert sample(df, 0).count() == 2000 and sample(df, 5000).count() == 2000 and sample(df.limit(0), 5).count() == 0
    assert sample(df, 50, ["k"]).select("k").distinct().count() == 50 and least_hash(1) > "ffffffff"


def test_profile_reads_once_and_expands_nothing(spark):
    df = spark.createDataFrame([(1.5, -0.0, "a", True, b"x", [1]), (1.5, 0.0, "b", False, b"x", [1]), (None, 2.0, "b", None, b"y", [2]), (float("nan"), None, None, None, None, None)], "d double, z double, s string, b boolean, raw binary, l array<int>")
    found = {r["column"]: r for r in profile(df).collect()}
    assert [(found[c].total_count, found[c].non_null_count, found[c].unique_count) for c in ("d", "z", "s", "b", "raw", "l")] == [(4, 3, 2), (4, 3, 2), (4, 3, 2), (4, 2, 2), (4, 3, 2), (4, 3, 2)]
    assert (found["z"].min, found["z"].max, found["z"].avg, found["b"].avg) == (0.0, 2.0, pytest.approx(2 / 3), 0.5) and found["s"].top_values == ["b", "a"]
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    empty = {r["column"]: r for r in profile(df.limit(0)).collect()}
    assert (empty["d"].total_count, empty["d"].unique_count, empty["d"].top_values) == (0, 0, None) and len(empty) == 6
    wide = spark.createDataFrame([(k % 7,) for k in range(100)], "`a.b` int")
    assert top_values(wide, ["a.b"], 2).first().top_values == ["0", "1"]


@pytest.mark.parametrize(("a", "b", "c"), [("INTEGER", "BIGINT", "BIGINT"), ("BIGINT", "DOUBLE", "DOUBLE"), ("DECIMAL(5,2)", "DECIMAL(4,3)", "DECIMAL(6,3)"), ("DECIMAL(5,2)", "INTEGER", "DECIMAL(12,2)"), ("DECIMAL(38,2)", "BIGINT", "DECIMAL(38,2)"), ("DECIMAL(38,30)", "BIGINT", "DOUBLE"), ("FLOAT", "DECIMAL(5,2)", "DOUBLE"), ("DATE", "TIMESTAMP", "TIMESTAMP"), ("BIGINT", "VARCHAR", "VARCHAR"), ("BOOLEAN", "INTEGER", "VARCHAR"), ("DATE", "DATE", "DATE")])
def test_common_types(a, b, c):
    assert common_type(a, b) == common_type(b, a) == c


def test_files_of_several_schemas_are_one_table(spark, tmp_path):
    configure(spark)
    spark.createDataFrame([(1, 2)], "a int, b bigint").write.parquet(f"{tmp_path}/f1/x.parquet")
    spark.createDataFrame([(2.5, "t")], "b double, c string").write.parquet(f"{tmp_path}/f2/x.parquet")
    spark.createDataFrame([(7, "u", True)], "a bigint, c string, `odd.name` boolean").write.parquet(f"{tmp_path}/f3/x.parquet")
    df = scan(spark, [f"{tmp_path}/f[12]", f"{tmp_path}/f3/x.parquet", f"{tmp_path}/f1"])
    assert df.schema.simpleString() == "struct<a:bigint,b:double,c:string,odd.name:boolean>"
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, 2.0, None, None), (None, 2.5, "t", None), (7, None, "u", True)], key=str)
    assert expand(spark, [f"{tmp_path}/none*"]) == []
    with pytest.raises(FileNotFoundError):
        scan(spark, [f"{tmp_path}/none*"])
    plan = df.where("a > 3").select("a")._jdf.queryExecution().executedPlan().toString()
    assert "c#" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_drift_of_all_families_is_one_job(spark):
    folder = "/root/testdata/sf0.001"
    files = drift.family_schemas(spark, catalog._drifted(spark, folder))
    found = drift.changes(files).collect()
    assert {r.data_type for r in found} == {"F", "O", "P"} and all(r.period_from < r.period_to for r in found)
    plan = drift.changes(files)._jdf.queryExecution().executedPlan().toString()
    assert "data_type" in plan.split("Window")[1]


@pytest.mark.parametrize("seed", range(4))
def test_rounds_of_best_pairs_equal_the_greedy_choice(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"o{a}", f"n{b}", rng.choice([0.5, 0.6, rng.random()])) for a in range(9) for b in range(7) if rng.random() < 0.7]
    pairs = [(f"o{k}", f"n{k + d}", 1 - (2 * k + d) / 40) for k in range(9) for d in (0, 1)] if seed == 3 else pairs  # a falling chain
    found = {(r.score, r.old, r.new) for r in drift.best_pairs(spark.createDataFrame(pairs, "old string, new string, score double")).collect()}
    assert found == set(drift.match_greedily([(s, o, n) for o, n, s in pairs]))
    assert drift.best_pairs(spark.createDataFrame([], "old string, new string, score double")).count() == 0


def test_scratch_folders_are_shared(spark):
    from driftwright import session

    assert session.scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_footers_of_nested_and_dotted_columns(spark, tmp_path):
    from driftwright.sources.footer import read_footers

    rows = [(1, {"x": 1}, [(1, "a"), (2, "b")], 5, ([1, 2], 3))]
    spark.createDataFrame(rows, "`a.b` int, m map<string,int>, l array<struct<p:int,q:string>>, `a.c` bigint, s struct<v:array<int>,`w.w`:int>").coalesce(1).write.parquet(f"{tmp_path}/x")
    (path,) = expand(spark, [f"{tmp_path}/x"])
    found = {r["column"]: r for r in read_footers(spark, [path]).collect()}
    assert set(found) == {"a.b", "m", "l", "a.c", "s"} and not any(r.error for r in found.values())
    assert (found["a.b"].min_long, found["a.c"].max_long, found["a.c"].ordinal) == (1, 5, 3)
