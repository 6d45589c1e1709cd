"""Seats against sorting all priorities, and the sample of the table against its targets."""

import random
from collections import Counter

import pytest

from corpusweave.llm.plans import p2_found, p2_report, p2_sample
from corpusweave.llm.proportions import TargetSample, divisor_seats, feasible
from corpusweave.operators.ranking import rank_in_bins, uniform
from pyspark.sql import functions as F


def by_sorting(counts, weights, floors, n):
    rows = [((0.0 if r <= f else 1.0), (r - 0.5) / w if w > 0 else float("inf"), i) for i, (c, w, f) in enumerate(zip(counts, weights, floors)) for r in range(1, c + 1)]
    seats = [0] * len(counts)
    for head, p, i in sorted(rows)[:n]:
        if head == 0.0 or p < float("inf"):
            seats[i] += 1
    return seats


def test_seats():
    rng = random.Random(3)
    for _ in range(400):
        k = rng.randint(1, 6)
        counts = [rng.randint(0, 30) for _ in range(k)]
        weights = [rng.choice([0, rng.random()]) for _ in range(k)]
        floors = [min(c, rng.randint(0, 3)) for c in counts]
        n = rng.randint(sum(floors), sum(floors) + 60)
        assert divisor_seats(counts, weights, floors, n) == by_sorting(counts, weights, floors, n), (counts, weights, floors, n)
    assert sum(divisor_seats([5, 5], [0.5, 0.5], [5, 5], 4)) == 4
    assert feasible({0: 0.5, 1: 0.5}, {0: 0.1, 1: 2.0}) == pytest.approx({0: 0.1, 1: 0.9})


@pytest.mark.parametrize("bins", [1, 7, 256])
def test_ranks(spark, bins):
    df = spark.createDataFrame([(("a" if i % 3 else None), str(i)) for i in range(500)], "k string, id string").withColumn("u", F.when(F.col("id") < "2", F.lit(0.25)).otherwise(uniform(1, "id")))
    got = rank_in_bins(df, ["k"], "u", ["id"], F.lit(bins)).collect()
    for k in ("a", None):
        own = sorted((r.u, r.id, r["rank"]) for r in got if r.k == k)
        assert [x[2] for x in own] == list(range(1, len(own) + 1))


def table(spark, targets):
    return spark.createDataFrame(targets, "field_name string, category string, target_permille int, min_rows int")


def test_cases(spark):
    rows = [(f"i{i}", "A" if i < 60 else " b ", "x") for i in range(90)] + [(f"n{i}", v, None) for i, v in enumerate([None, "", "-", "nan", "None", "<NA>", "NA", "other"])]
    rows += [("i0", "a", "x"), (None, "a", "x"), ("i1", "B", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "oid string, f string, g string, category string")
    t = table(spark, [("f", "a", 400, 5), ("f", "B", 300, 5), ("f", "NA", 200, 9), ("f", "none here", 100, 1), ("absent", "q", 1000, 1)])
    s = TargetSample(df, "oid", t, 0.5)
    rep = {r.category: r for r in s.report().collect()}
    assert s.total == 98 and s.n == 49
    assert (rep["a"].available, rep["B"].available, rep["NA"].available, rep["none here"].available) == (60, 31, 7, 0)
    assert [k for k, r in sorted(rep.items()) if r.unmet] == ["NA", "none here"] and rep["NA"].drawn == 7
    got = s.sample().collect()
    assert len(got) == 49 and len({r.id for r in got}) == 49 and {r.f for r in got} == {"a", "B", "NA"} and sum(r.floor for r in got) >= 17
    assert sorted(map(tuple, got)) == sorted(map(tuple, TargetSample(df, "oid", t, 0.5, bin_rows=1).sample().collect()))
    assert TargetSample(df.limit(0), "oid", t).sample().count() == 0 and TargetSample(df, "oid", t.limit(0)).sample().count() == 0
    assert TargetSample(df, "oid", t.limit(0)).report().count() == 0 and TargetSample(df.limit(0), "oid", t).report().filter("unmet").count() == 4


def test_minima_that_exceed_the_sample(spark):
    df = spark.createDataFrame([(str(i), "abcd"[i % 4]) for i in range(100)], "id string, f string")
    s = TargetSample(df, "id", table(spark, [("f", c, 250, 20) for c in "abcd"]), 0.2)
    got = [r.f for r in s.sample().collect()]
    assert s.crowded and len(got) == 20 and {got.count(c) for c in "abcd"} == {5}


def test_hot_cell_and_ranks(spark):
    """The records drawn of a cell are its first by hash, with the priorities that sorting all of them gives."""
    df = spark.range(4000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("f"))
    s = TargetSample(df, "id", table(spark, [("f", "hot", 500, 3), ("f", "cold", 500, 3)]), 0.2, bin_rows=10)
    got = s.sample().collect()
    ids = s.ids.orderBy("h").collect()
    for i, name in enumerate(("cold", "hot")):
        first = [r.id for r in ids if r.c0 == i][:400]
        own = {r.id: r for r in got if r.f == name}
        assert set(own) == set(first) and [own[x].floor for x in first] == [k < 3 for k in range(400)]
        assert all(own[x].priority == pytest.approx((k + 0.5) / 0.5) for k, x in enumerate(first) if k >= 3)


def test_joint_follows_agreeing_targets(spark):
    rows = [(f"{a}{b}{i}", a, b) for a, n in (("p", 600), ("q", 300)) for b in ("x", "y", "z") for i in range(n if b == "x" else n // 2)]
    df = spark.createDataFrame(rows, "id string, f string, g string")
    t = [("f", "p", 500, 1), ("f", "q", 500, 1), ("g", "x", 200, 1), ("g", "y", 300, 1), ("g", "z", 500, 1)]
    rep = TargetSample(df, "id", table(spark, t), 0.2).report().collect()
    assert all(abs(r.drawn_permille - r.target_permille) <= 4 for r in rep) and not any(r.missed for r in rep)


def test_contradicting_targets_share_the_miss(spark):
    df = spark.createDataFrame([(str(i), "ab"[i % 2], "xy"[i % 2]) for i in range(1000)], "id string, f string, g string")
    rep = {r.category: r for r in TargetSample(df, "id", table(spark, [("f", "a", 800, 1), ("f", "b", 200, 1), ("g", "x", 200, 1), ("g", "y", 800, 1)]), 0.2).report().collect()}
    assert rep["a"].drawn == rep["b"].drawn == rep["x"].drawn == rep["y"].drawn == 100
    assert rep["a"].missed and rep["y"].missed and not rep["b"].missed and not any(r.unmet for r in rep.values())


def test_on_the_table(spark, sf):
    rep, sample = p2_report(spark, sf).collect(), p2_sample(spark, sf).collect()
    drawn = Counter((f, r[f]) for r in sample for f in ("overview_bucket", "ma_bucket_detail", "rm_site", "stratum_id"))
    assert len({r.obs_name for r in sample}) == len(sample)
    for r in rep:
        assert drawn[r.field_name, r.category] == r.drawn
    assert {(r.field_name, r.category) for r in rep if r.unmet} == {tuple(r) for r in p2_found(spark, sf).collect()}
