"""The mix: shares, caps, fixed size, and the cases without documents."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusweave.llm.mixing import Mix, allot, scale
from corpusweave.llm.plans import p8_found, p8_mix
from corpusweave.operators.ranking import uniform


def test_allot():
    assert allot({"a": 0.5, "b": 0.5}, {"a": 10, "b": 90}, {"a": 9, "b": 9}) == {"a": 50.0, "b": 50.0}
    assert allot({"a": 0.5, "b": 0.5}, {"a": 10, "b": 90}, {"a": 2, "b": 9}) == {"a": 20.0, "b": 80.0}
    assert allot({"a": 1.0}, {}, {"a": 3}) == {"a": 0.0}
    assert sum(allot({"a": 0.2, "b": 0.3, "c": 0.5}, {"a": 1, "b": 50, "c": 49}, {"a": 1, "b": 1, "c": 1}).values()) == pytest.approx(100)


def test_small_mix(spark):
    rows = [(i, "word " * (1 + i % 7), "A " if i % 2 else "a") for i in range(300)] + [(1000 + i, "word " * 5, "b") for i in range(10)]
    rows += [(2000, None, "a"), (2001, "", "b"), (2002, "x y", None), (2003, "x y", "unlisted"), (2004, "x", "-")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 3), ("B", 0.3, 4), ("absent", 0.2, 2), (None, 0.1, 1), ("neg", -1.0, 1)], "source string, target_weight double, max_repeats int")
    m = Mix(docs, targets)
    got = {(r.doc_id): r for r in m.documents().collect()}
    rep = {r.source: r for r in m.report().collect()}
    assert set(rep) == {"a", "B", "absent", "neg"} and {k for k, r in rep.items() if r.out_of_reach} == {"B", "absent"}
    assert rep["B"].mix_tokens == 4 * rep["B"].own_tokens and rep["B"].most_copies == 4 and rep["absent"].n_docs == 0
    assert abs(sum(r.mix_tokens for r in rep.values()) - m.total) <= 8
    assert all(r.copies <= 3 for r in got.values() if r.source == "a") and not {2000, 2001, 2002, 2003, 2004} & set(got)
    assert {k: v.copies for k, v in got.items()} == {r.doc_id: r.copies for r in Mix(docs, targets).documents().collect()}
    # a document's number of copies differs from another's of its source by one at most
    assert {r.copies for r in got.values() if r.source == "a"} <= {0, 1, 2}
    empty = Mix(docs.limit(0), targets)
    assert empty.documents().count() == 0 and empty.report().count() == 4
    assert Mix(docs, targets.limit(0)).documents().count() == 0


@pytest.mark.parametrize("rows,power", [(1, 0.0), (7, 0.5), (16_384, 1.0)])
def test_size_for_any_number_of_slices(spark, rows, power):
    docs = spark.createDataFrame([(i, "w " * (1 + (i * 37) % 50), "ab"[i % 3 == 0]) for i in range(500)], "doc_id long, text string, source string")
    m = Mix(docs, spark.createDataFrame([("a", 0.9, 5), ("b", 0.1, 5)], "source string, target_weight double, max_repeats int"), power=power, slice_rows=rows)
    for r in m.report().collect():
        assert abs(r.mix_tokens - r.target_weight * m.total) <= 51


def test_scale():
    sizes, tokens = np.array([1, 10, 100]), np.array([50, 50, 100])
    for power in (0.0, 0.5, 1.0):
        for wanted in (1.0, 60.0, 120.0, 199.0):
            assert (np.minimum(1, scale(sizes, tokens, wanted, power) * sizes**power) * tokens).sum() == pytest.approx(wanted)
    assert scale(sizes, tokens, 200.0, 0.5) == math.inf and scale(sizes, tokens, 0.0, 0.5) == 0.0


def test_inclusion_frequencies(spark):
    """Over many seeds every document comes as often as its inclusion probability says, larger ones more often."""
    docs = spark.createDataFrame([(i + 1000 * (k == "b"), "w " * [2, 8, 30, 90][i % 4], k) for i in range(80) for k in "ab"], "doc_id long, text string, source string")
    m = Mix(docs, spark.createDataFrame([("a", 0.2, 1), ("b", 0.8, 5)], "source string, target_weight double, max_repeats int"))
    seeds = 60
    m.sized = m.sized.crossJoin(spark.range(seeds).withColumnRenamed("id", "seed")).withColumn("u", uniform(7, "doc_id", "seed")).withColumn("k", F.concat("k", F.lit("#"), "seed")).drop("seed")  # a small fixture
    m.plan = m.plan.crossJoin(spark.range(seeds)).withColumn("k", F.concat("k", F.lit("#"), "id")).drop("id")
    got = m.documents().filter("source = 'a'").groupBy((F.col("doc_id") % 4).alias("size")).agg(F.count("*").alias("n"), F.avg("pi").alias("pi")).orderBy("size").collect()
    for r in got:
        assert abs(r.n / (20 * seeds) - r.pi) < 0.05, r
    assert [r.pi for r in got] == sorted(r.pi for r in got) and got[0].pi < 0.5 * got[3].pi


def test_whole_table(spark, sf):
    mix = p8_mix(spark, sf)
    caps = {r.source: r.max_repeats for r in spark.read.parquet(f"{sf}/mix_targets.parquet").collect()}
    top = {r.source: r.m for r in mix.groupBy("source").agg(F.max("copies").alias("m")).collect()}
    assert all(m <= caps[s] for s, m in top.items())
    assert mix.count() == mix.select("doc_id").distinct().count()
    assert "reserve_feed" in {r.source for r in p8_found(spark, sf).collect()}
