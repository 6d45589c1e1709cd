"""Size, coverage and evenness of the varied subset."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusweave.functions.text import key_or_null
from corpusweave.llm.plans import VARIETY, coverage, p4_varied
from corpusweave.llm.variety import quotas, varied_subset


def test_quotas():
    assert quotas({0: 100, 1: 25, 2: 4}, 17) == {0: 10, 1: 5, 2: 2}
    assert quotas({0: 400, 1: 4, 2: 1}, 100) == {0: 95, 1: 4, 2: 1}
    assert quotas({0: 10, 1: 10, 2: 10}, 2) == {0: 1, 1: 1, 2: 0}
    assert quotas({0: 3, 1: 50}, 20, equal=True) == {0: 3, 1: 17}
    assert quotas({0: 2, 1: 2}, 10) == {0: 2, 1: 2} and quotas({}, 5) == {}


def test_even_over_groups(spark):
    rows = [(f"h{i}", "hot", "x") for i in range(3000)] + [(f"m{i}", f"mid{i % 30}", "y") for i in range(600)] + [(f"s{i}", f"one{i}", None) for i in range(40)]
    df = spark.createDataFrame([(*r, 1) for r in rows + rows[:50] + [(None, "hot", "x"), ("h0", " HOT ", "X")]], "id string, p string, q string, cluster int")
    for slices in (65_536, 100):
        got = varied_subset(df, "id", ["p", "q"], size=200, k=8, slice_rows=slices).collect()
        n = Counter(r.p for r in got)
        assert len(got) == 200 == len({r.id for r in got})
        assert n["HOT"] < 120 and len(n) > 40
    assert {r.id for r in got} == {r.id for r in varied_subset(df, "id", ["p", "q"], size=200, k=8).collect()}
    assert varied_subset(df, "id", ["p", "q"], size=10_000, k=4).count() == 3640
    assert varied_subset(df.limit(0), "id", ["p", "q"], size=5).count() == 0
    assert varied_subset(df, "id", ["p", "q"], size=0).count() == 0


@pytest.mark.parametrize("size", [1, 64, 500])
def test_exact_size(spark, size):
    df = spark.range(700).select(F.col("id").cast("string").alias("id"), (F.col("id") % 13).cast("string").alias("a"), F.floor(F.sqrt("id")).cast("string").alias("b"))
    assert varied_subset(df, "id", ["a", "b"], size=size, k=16).count() == size


def test_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    all_ = spark.read.parquet(f"{sf}/merged_gg2_with_phylo.parquet")
    total = all_.select("obs_name").distinct().count()
    got = p4_varied(spark, sf).collect()
    assert len(got) == total // 50 == len({r.obs_name for r in got})
    kinds = all_.select("obs_name", *(key_or_null(F.col(f)).alias(f) for f in VARIETY[1:])).distinct().groupBy(*VARIETY[1:]).count().orderBy(F.desc("count")).limit(2).collect()
    for top in kinds:  # the two largest kinds lose share
        assert sum((r.MA_Env_Animal_Sub, r.RM_Sample_Site) == tuple(top)[:2] for r in got) / len(got) < 0.8 * top["count"] / total
    assert len({r.RM_Sample_Site for r in got}) >= 10


def test_all_three_fields_are_covered_better_than_by_chance(spark):
    for r in coverage(spark, "/root/testdata/sf0.01").collect():
        assert r.values_subset > r.values_random, r


def test_rare_values_lead(spark):
    """Where a cluster has fewer slots than groups, the first group of each value comes before second ones."""
    rows = [(f"h{i}", f"p{i % 300}", "x") for i in range(3000)] + [(f"r{i}", "p0", f"rare{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "id string, p string, q string")
    lead = varied_subset(df, "id", ["p", "q"], size=320, k=1).collect()
    assert len({r.q for r in lead}) == 21 and len({r.p for r in lead}) == 300
