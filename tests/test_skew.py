"""Exact selection per key against sorting, with hot keys, ties and odd values."""

import math

import numpy as np
import pytest

from corpusweave.operators.skew import add_quantiles, exact_quantiles, key_profile
from corpusweave.plans.skew import p3_found, p3_profile

PROBS = (0.0, 0.1, 0.5, 0.9, 1.0)


def brute(vals, p):
    s = sorted(vals)
    return s[max(1, math.ceil(round(p * len(s), 9))) - 1]


@pytest.mark.parametrize("bins,hot_share", [(512, 0.001), (16, 0.3), (16, 1.0)])
def test_quantiles_against_sorting(spark, bins, hot_share):
    rng = np.random.default_rng(1)
    groups = {
        "hot": [float(x) for x in rng.lognormal(0, 6, 900)],
        "ties": [1.0] * 200 + [2.0] * 3,
        "one": [7.5],
        "wide": [-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1e-300],
        "close": [1.0, float(np.nextafter(1.0, 2)), float(np.nextafter(1.0, 0))],
    }
    rows = [("f", k, "m", v) for k, vs in groups.items() for v in vs] + [("f", "hot", "m", None), ("f", "empty", "m", None)]
    got = exact_quantiles(spark.createDataFrame(rows, "field string, key string, metric string, v double"), PROBS, bins, hot_share).collect()
    assert {(r.key, r.prob): r.value for r in got} == {(k, p): brute(vs, p) for k, vs in groups.items() for p in PROBS}
    assert {r.key: r.n for r in got} == {k: len(v) for k, v in groups.items()}


def test_profile_cases(spark):
    nan = float("nan")
    rows = [("e1", " a ", "x", 1.0), ("e1", "A", "x", 1.0), ("e2", "a", "-", 3.0), ("e3", "b", None, None), ("e4", "", "NA", nan), (None, "a", "x", 9.0), ("e5", None, None, float("inf")), ("e6", "B", "y", float("inf"))]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id string, k string, l string, v double, key string")
    got = {(r.field_name, r.key_value): r for r in key_profile(df, "id", ["k", "l"], ["v"], (0.5,), 0.3).collect()}
    assert set(got) == {("k", "A"), ("k", "B"), ("l", "X"), ("l", "Y")}
    a = got["k", "A"]
    assert (a.n_rows, a.n_samples, a.share, a.is_hot, a.v_n, a.v_p50) == (3, 2, 2 / 6, True, 2, 1.0)
    assert (got["k", "B"].n_samples, got["k", "B"].v_n, got["k", "B"].v_p50) == (2, 0, None)
    assert key_profile(df.limit(0), "id", ["k", "l"], ["v"]).count() == 0


def test_found_is_the_hot_part(spark, sf):
    all_keys = p3_profile(spark, sf)
    assert {tuple(r) for r in p3_found(spark, sf).collect()} == {(r.field_name, r.key_value) for r in all_keys.collect() if r.share > 0.02}


def test_interpolated_and_weighted_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [(g, None if i % 9 == 0 else float(x)) for g, n in (("a", 101), ("b", 40), ("c", 1), ("d", 0)) for i, x in enumerate(rng.normal(0, 3, n))] + [("d", None), ("b", float("nan")), ("b", float("inf")), (None, 4.0), (None, 5.0)]
    df = spark.createDataFrame([(*r, 1 + i % 3) for i, r in enumerate(rows)], "g string, v double, k int")
    got = {r.g: r for r in add_quantiles(df.groupBy("g").count(), df, {"mid": ("v", 0.5), "p90": ("v", 0.9)}, ["g"]).collect()}
    twice = add_quantiles(df.groupBy().count(), df, {"mid": ("v", 0.5)}, weight="k").head().mid
    real = lambda v: v is not None and math.isfinite(v)
    for g in ("a", "b", "c", "d", None):
        own = [v for h, v in rows if h == g and real(v)]
        assert got[g].mid == (pytest.approx(np.quantile(own, 0.5)) if own else None) and got[g].p90 == (pytest.approx(np.quantile(own, 0.9)) if own else None)
    assert twice == pytest.approx(np.median([v for i, (_, v) in enumerate(rows) if real(v) for _ in range(1 + i % 3)]))
