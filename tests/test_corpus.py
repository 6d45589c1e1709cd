"""Counts, merging, patches, expectations and sampling on small fixtures and as properties."""

import random

import pytest
from pyspark.sql import functions as F

from corpusweave.operators import counts as C
from corpusweave.operators import expect as E
from corpusweave.operators import merge as M
from corpusweave.operators import sampling as S
from corpusweave.operators.ranking import rank_in_bins, uniform

FACTS = "sample string, feature string, n long"


def facts(spark, rows):
    return spark.createDataFrame(rows, FACTS)


def test_quality_control(spark):
    rows = [("s1", "a", 6), ("s1", "b", 5), ("s2", "a", 20), ("s3", "a", 4), ("s3", "b", 5), ("s4", "b", 1), ("s4", "c", 1)]
    kept = C.quality_control(facts(spark, rows), 10, 2).collect()
    assert {(r.sample, r.feature) for r in kept} == {("s1", "a"), ("s1", "b")}
    assert C.quality_control(facts(spark, []), 10, 2).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_quality_control_is_the_fixed_point(spark, seed):
    rng = random.Random(seed)
    rows = [(f"s{i}", f"f{j}", rng.randint(1, 9)) for i in range(25) for j in range(12) if rng.random() < 0.3]
    live = rows
    while True:
        total, k = {}, {}
        for s, _, n in live:
            total[s], k[s] = total.get(s, 0) + n, k.get(s, 0) + 1
        nxt = [r for r in live if total[r[0]] >= 15 and k[r[0]] >= 3]
        if nxt == live:
            break
        live = nxt
    got = C.quality_control(facts(spark, rows), 15, 3).collect()
    assert sorted(map(tuple, got)) == sorted(live)


def test_roll_up_conserves(spark):
    f = facts(spark, [("s1", "a", 3), ("s1", "b", 4), ("s2", "a", 1), ("s3", "z", 9)])
    up = C.roll_up(f, spark.createDataFrame([("a", "g1"), ("b", "g1")], "feature string, var_id string"))
    assert sorted(map(tuple, up.collect())) == [("s1", "g1", 7), ("s2", "g1", 1)]
    loss = {r.sample: (r.reads_in, r.reads_out, r.lost) for r in C.loss(f, up).collect()}
    assert loss == {"s1": (7, 7, 0.0), "s2": (1, 1, 0.0), "s3": (9, 0, 1.0)}
    assert C.loss_summary(C.loss(f, up)).head().over_half == 1
    zero = C.facts(facts(spark, [("s", "a", 0), ("s", "b", None), ("s", "c", 2), ("s", "c", 3)]), "sample", "feature", "n")
    assert [tuple(r) for r in zero.collect()] == [("s", "c", 5)]


def test_feature_stats(spark):
    f = facts(spark, [("s1", "a", 1), ("s1", "b", 3), ("s2", "a", 4)])
    v = spark.createDataFrame([("a",), ("b",), ("c",)], "feature string")
    got = {r.feature: r for r in C.feature_stats(f, v).collect()}
    assert got["a"].prevalence == 1.0 and got["a"].mean_share_when_present == pytest.approx(0.625) and got["c"].prevalence == 0 and not got["c"].observed
    assert sum(r.mass_fraction for r in got.values()) == pytest.approx(1)
    assert C.feature_stats(facts(spark, []), v).count() == 3
    s = C.shares(f).groupBy("sample").agg(F.sum("share").alias("t")).collect()
    assert all(abs(r.t - 1) < 1e-9 for r in s)


def test_merge(spark):
    a, b = spark.createDataFrame([("r1", 1)], "run string, x int"), spark.createDataFrame([("r2", "q")], "run string, y string")
    m = M.merge_samples({"MA_": a, "RM_": b}, ["run"]).collect()
    assert {tuple(r.asDict().items()) for r in m} == {(("run", "r1"), ("MA_x", 1), ("RM_y", None)), (("run", "r2"), ("MA_x", None), ("RM_y", "q"))}
    have, voc = spark.createDataFrame([("a",), ("b",), ("c",)], "feature string"), spark.createDataFrame([(x,) for x in "abcd"], "feature string")
    assert {tuple(r) for r in M.expand_vocabulary(have, voc).collect()} == {("a", True), ("b", True), ("c", True), ("d", False)}
    rows = [("r1", "A"), ("r1", "B"), ("r2", "A"), ("r2", "A"), (None, "A"), (None, "B")]
    ids = M.cross_source_ids(spark.createDataFrame(rows, "run string, db string"), "run", "db").collect()
    assert sorted((r.run or "", r.pair_id) for r in ids) == sorted([("r1", "r1"), ("r1", "r1"), ("r2", None), ("r2", None), ("", None), ("", None)], key=lambda t: (t[0], t[1] or ""))
    assert M.schema_difference(["a", "b"], ["b", "c"]) == {"common": ["b"], "only_left": ["a"], "only_right": ["c"]}


def test_patch(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "z")], "k int, p string, q string")
    patch = spark.createDataFrame([(1, None), (2, "B"), (9, "new")], "k int, p string")
    after = M.apply_patch(base, patch, "k")
    assert sorted(map(tuple, after.collect())) == [(1, None, "x"), (2, "B", None), (3, None, "z")]
    assert {tuple(r) for r in M.audit(base, after, "k", ["p", "q"]).collect()} == {("p", 2), ("q", 0)}
    again = M.apply_patch(after, patch, "k")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))


@pytest.mark.parametrize("parts", ["1", "5"])
def test_row_numbers(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = M.number_rows(spark.range(100).select((F.col("id") * 7 % 101).alias("v")), "v").collect()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [r.row_number for r in sorted(got, key=lambda r: r.v)] == list(range(1, 101))
    assert M.number_rows(spark.range(0), "id").count() == 0


def test_expectations(spark):
    df = spark.createDataFrame([(1, 2), (3, None), (5, 4)], "a int, b int")
    rules = {"order": F.col("a") <= F.col("b"), "positive": F.col("a") > 0}
    assert {tuple(r) for r in E.violations(df, rules).collect()} == {("order", 2), ("positive", 0)}
    with pytest.raises(E.ExpectationError):
        E.require(df, rules)
    assert E.require(df, {"positive": F.col("a") > 0}).count() == 3
    with pytest.raises(E.ExpectationError):
        E.require_unique(df.union(df), "a")
    with pytest.raises(E.ExpectationError):
        E.require_matched(df, df.limit(0), "a")
    assert E.unknown_tokens(spark.createDataFrame([(["gut", "alien"],)], "t array<string>"), F.col("t"), ["gut"]).collect()[0].token == "alien"


@pytest.mark.parametrize(
    "sizes,total,spread,want",
    [((100, 25, 4), 17, "even", (10, 5, 2)), ((100, 25, 4), 17, "greedy", (10, 5, 2)), ((400, 4, 1), 100, "even", (95, 4, 1)), ((400, 4, 1), 100, "greedy", (95, 4, 1)), ((2, 2), 10, "greedy", (2, 2)), ((2, 2), 10, "even", (2, 2)), ((1, 100, 64), 100, "even", (1, 55, 44)), ((1, 100, 64), 100, "greedy", (1, 57, 42)), ((5,), 0, "greedy", (0,))],
)
def test_allocation(sizes, total, spread, want):
    assert tuple(S.allocate(dict(enumerate(sizes)), total, spread).values()) == want


def test_samples(spark):
    rows = [(f"i{i}", "ab"[i % 3 == 0], f"l{i % 7}", 1) for i in range(300)] + [(None, "a", "l1", 1), ("n1", None, "l1", 1), ("n2", None, None, 1)]
    df = spark.createDataFrame(rows, "id string, g string, l string, rank int")
    got = S.stratified_sample(df, "g", 50, "id").collect()
    assert len(got) == len({r.id for r in got}) and sum(r.g is None for r in got) == 2
    two = S.two_level_sample(df.filter("g IS NOT NULL"), "g", "l", 60, "id")
    assert two.count() == 60 and two.columns == df.columns
    assert {r.id for r in two.collect()} == {r.id for r in S.two_level_sample(df.filter("g IS NOT NULL"), "g", "l", 60, "id").collect()}
    assert S.simple_sample(df, 10, "id").count() == 10 and S.simple_sample(df.limit(0), 10, "id").count() == 0
    assert {r.l for r in S.top_or_other(df.filter("l IS NOT NULL"), "l", 2).collect()} == {"l0", "l1", "Other"}
    fixed = S.bucket_sample(df, "g", "l", {"a": 21, "b": 7}, "id").groupBy("g").count().collect()
    assert {tuple(r) for r in fixed} == {("a", 21), ("b", 7)}
    pairs = spark.createDataFrame([(f"{d}{i}", f"r{i}", d, f"u{i % 3}", f"l{i % 2}") for i in range(20) for d in "AB"] + [("A99", "r99", "A", "u", "l")], "id string, run string, db string, _u string, _l string")
    both, rest = S.paired_block(pairs, "run", "db", "B", "_u", "_l", 6, "id")
    assert both.count() == 12 and rest.count() == 29 and both.select("run").distinct().count() == 6


@pytest.mark.parametrize("bins", [1, 7, 256])
def test_ranks(spark, bins):
    df = spark.createDataFrame([(("a" if i % 3 else None), str(i)) for i in range(500)], "k string, id string").withColumn("u", F.when(F.col("id") < "2", F.lit(0.25)).otherwise(uniform(1, "id")))
    got = rank_in_bins(df, ["k"], "u", ["id"], F.lit(bins)).collect()
    for k in ("a", None):
        own = sorted((r.u, r.id, r["rank"]) for r in got if r.k == k)
        assert [x[2] for x in own] == list(range(1, len(own) + 1))
