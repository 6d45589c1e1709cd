"""Percentiles against sorting, the stated error, and combining days."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from corpusweave.llm.percentiles import daily_counts, fields, kept, latest, percentiles, restatement

PROBS = (0.0, 0.01, 0.5, 0.95, 1.0)


def brute(vals, p):
    s = sorted(vals)
    return s[max(1, math.ceil(round(p * len(s), 6))) - 1]


def test_against_sorting(spark):
    rng = random.Random(2)
    vals = {("A", d): [int(10 ** rng.uniform(0, 11)) for _ in range(300)] + [7] * 50 for d in (1, 2)} | {("B", 1): [0], ("C", 2): []}
    rows = [(g, dt.date(2024, 1, d), v) for (g, d), vs in vals.items() for v in [*vs, None, -1]]
    counts = daily_counts(spark.createDataFrame(rows, "grp string, day date, m long"), ["m"])
    for keys, groups in ((("grp", "day", "metric"), {(g, dt.date(2024, 1, d)): v for (g, d), v in vals.items()}), (("grp", "metric"), {("A",): vals["A", 1] + vals["A", 2], ("B",): [0], ("C",): []})):
        got = {tuple(r[k] for k in keys if k != "metric"): r for r in percentiles(counts, keys, PROBS).collect()}
        assert set(got) == set(groups)
        for k, vs in groups.items():
            assert got[k].n == len(vs) and got[k].n_null == got[k].n_negative == (2 if k == ("A",) else 1)
            for p in PROBS:
                x = got[k][f"p{round(p * 100):02d}"]
                if not vs:
                    assert x is None
                else:
                    want = brute(vs, p)
                    assert x == want if want < 10_000 else abs(x - want) <= 0.0005 * want


def test_exact_with_all_digits(spark):
    rows = [("A", dt.date(2024, 1, 1), 10**12 + i) for i in range(101)]
    c = daily_counts(spark.createDataFrame(rows, "grp string, day date, m long"), ["m"], 19)
    assert percentiles(c, ["grp", "metric"], [0.5], 19).head().p50 == 10**12 + 50


def test_days_bound_the_counts(spark):
    df = spark.range(200_000).select(F.lit("A").alias("grp"), F.lit(dt.date(2024, 1, 1)).alias("day"), (F.col("id") * 1000).alias("m"))
    assert daily_counts(df, ["m"]).count() <= 9000 * 6


def test_latest(spark):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [("a", "X ", t(1), t(2), 5, 1), ("a", "x", t(1), t(3), 6, None), ("a", "x", t(1), t(3), 4, 9), ("b", None, t(1), None, 1, 1), ("b", "Y", t(2), t(1), 2, 2), (None, "-", t(1), t(1), 3, 3), (None, "-", t(1), t(1), 3, 3), ("c", "x", None, t(1), 3, 3)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "id string, db string, at timestamp, loaded timestamp, m long, k int, day int")
    got = sorted(map(tuple, latest(df, "id", "at", "loaded", "db", ["m", "k"]).collect()), key=str)
    d = dt.date
    assert got == sorted([("X", d(2024, 1, 1), 6, None), ("Y", d(2024, 1, 2), 2, 2), ("(none)", d(2024, 1, 1), 3, 3), ("(none)", d(2024, 1, 1), 3, 3), ("X", None, 3, 3)], key=str)
    assert percentiles(daily_counts(latest(df.limit(0), "id", "at", "loaded", "db", ["m", "k"]), ["m", "k"]), ["grp", "day", "metric"], PROBS).count() == 0


def test_restatement_across_days(spark):
    """A sample that comes again on another day leaves the old day's result; days with nothing left vanish."""
    t = lambda d: dt.datetime(2024, 1, d)
    first = [("a", "x", t(1), t(1), 5), ("b", "x", t(1), t(1), 7), ("c", "x", t(2), t(2), 9), (None, "x", t(1), t(1), 1), ("f", "x", None, t(1), 4)]
    later = [("a", "x", t(3), t(4), 50), ("c", "x", t(2), t(1), 8), ("d", "y", t(1), t(4), 3), (None, "x", t(1), t(1), 1), ("c", "x", t(4), t(5), 9)]
    make = lambda rows: kept(spark.createDataFrame(rows, "id string, db string, at timestamp, loaded timestamp, m long"), "id", "at", "loaded", "db", ["m"])
    stored, new = make(first), make(later)
    change = restatement(stored, new, ["m"])
    d = dt.date
    assert {(r.grp, r.day, r.value): r.n for r in change.collect()} == {("X", d(2024, 1, 1), 5): -1, ("X", d(2024, 1, 3), 50): 1, ("X", d(2024, 1, 2), 9): -1, ("X", d(2024, 1, 4), 9): 1, ("Y", d(2024, 1, 1), 3): 1, ("X", d(2024, 1, 1), 1): 1}
    added = daily_counts(fields(stored, ["m"]), ["m"]).unionByName(change)
    whole = daily_counts(fields(make(first + later), ["m"]), ["m"])
    for keys in (["grp", "day", "metric"], ["grp", "metric"]):
        got, want = ({tuple(r) for r in percentiles(x, keys, PROBS).collect()} for x in (added, whole))
        assert got == want
    assert ("X", None, "m", 1) in {tuple(r)[:4] for r in percentiles(whole, ["grp", "day", "metric"], [0.5]).collect()}
    assert restatement(stored, new.limit(0), ["m"]).count() == 0
