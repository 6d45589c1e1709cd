"""Coverage joins against brute force, and the notations of a position."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusweave.operators.geo import EARTH_KM, cover_ring, inside_regions, near_pairs, place, unwrap_ring, with_position
from corpusweave.plans.geo import p1_found

TEXTS = {
    "12.5 -3": (12.5, -3), "(-54.35279, -148.97523)": (-54.35279, -148.97523), "67.77813,116.78882": (67.77813, 116.78882),
    "0002.84426 -0164.45887": (2.84426, -164.45887), "-14,56040 92,75900": (-14.5604, 92.759), "-0.36661° 78.41500°": (-0.36661, 78.415),
    "20.21415 S 163.20162 W": (-20.21415, -163.20162), "10.46140W 53.19991N": (53.19991, -10.4614), "S23.22651 W87.00146": (-23.22651, -87.00146),
    "W87.5 S23.5": (-23.5, -87.5), "60°49'30\"N, 72°02'15\"W": (60.825, -72.0375), "63°30'00\"N 14 30 00 W": (63.5, -14.5), "65 30 54 N 109°15'36\"E": (65.515, 109.26),
    "lat: -46.35472, lon: -119.04248": (-46.35472, -119.04248), "lon 14.03102 lat -45.57801": (-45.57801, 14.03102), "Latitude=27.18798;Longitude=-32.99463": (27.18798, -32.99463),
    "-6.15149; 89.25888": (-6.15149, 89.25888), "63.42604 / -14.80004": (63.42604, -14.80004), "−5.5 7": (-5.5, 7),
    "56 84 5": None, "39.54 E": None, "-44.20 unknown": None, "28.70 ?": None, "not collected": None, "100.198": None, "": None, None: None, "12,34": None,
    "10 N 20 S": None, "lat 3 lat 4": None, "10 61 00 N 20 10 00 E": None, "1 2 3 4": None, "x" * 50000: None, "1 " * 20000: None,
}


def test_notations(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "raw string")
    for r in with_position(df, "raw").collect():
        want = TEXTS[r.raw]
        assert ((r._lat, r._lon) == pytest.approx(want)) if want else (r._lat is None or r._lon is None), r.raw[:60]


def km(a, b):
    (p, q), (s, t) = np.radians(a), np.radians(b)
    h = math.sin((s - p) / 2) ** 2 + math.cos(p) * math.cos(s) * math.sin((t - q) / 2) ** 2
    return 2 * EARTH_KM * math.asin(min(1, math.sqrt(h)))


def brute_near(rows, radius):
    return {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(rows) for b in rows[:i] if a[0] != b[0] and km(a[1:], b[1:]) <= radius}


def brute_inside(lat, lon, rings):
    out = set()
    for name, (la, lo) in rings.items():
        x = [lo[0]]
        for a, b in zip(lo, lo[1:]):
            x.append(x[-1] + (b - a + 180) % 360 - 180)
        n = len(x)
        for shift in (-720, -360, 0, 360, 720):
            hit = False
            for i in range(n):
                x1, y1, x2, y2 = x[i - 1], la[i - 1], x[i], la[i]
                if (y1 > lat) != (y2 > lat) and lon + shift < (x2 - x1) * (lat - y1) / (y2 - y1) + x1:
                    hit = not hit
            if hit:
                out.add(name)
    return out


@pytest.mark.parametrize("centre", [(0.0, 0.3), (45.0, 179.9995), (89.999, 10.0), (-89.995, -170.0), (60.0, -180.0)])
@pytest.mark.parametrize("hot", [4096, 7])
def test_near_against_brute_force(spark, centre, hot):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        la = min(90.0, max(-90.0, centre[0] + float(rng.normal(0, 0.008))))
        lo = (centre[1] + float(rng.normal(0, 0.008 / max(0.001, math.cos(math.radians(centre[0]))))) + 180) % 360 - 180
        rows.append((f"s{i:03}", la, lo))
    rows += [("t1", *rows[0][1:]), ("t2", *rows[0][1:]), ("t1", *rows[1][1:]), ("e", centre[0], 180.0), ("f", centre[0], -180.0)]
    df = spark.createDataFrame(rows, "id string, lat double, lon double")
    got = [tuple(r) for r in near_pairs(df, 1.0, hot).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_near(rows, 1.0)


RINGS = {
    "square": ([0.0, 0.0, 10.0, 10.0], [0.0, 10.0, 10.0, 0.0]),
    "closed": ([1.0, 1.0, 2.0, 2.0, 1.0], [1.0, 2.0, 2.0, 1.0, 1.0]),
    "meridian": ([-5.0, 5.0, 5.0, -5.0], [-178.0, -178.0, 178.0, 178.0]),
    "dent": ([20.0, 30.0, 22.0, 30.0, 20.0], [0.0, 0.0, 5.0, 10.0, 10.0]),
}


def test_inside_against_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = [(f"p{i}", float(rng.uniform(-10, 35)), float(x)) for i, x in enumerate([*rng.uniform(-12, 14, 300), *((rng.uniform(176, 184, 150) + 180) % 360 - 180)])]
    areas = [(k, *v) for k, v in RINGS.items()] + [("two", [0.0, 1.0], [0.0, 1.0]), ("hole", [0.0, None, 3.0], [0.0, 1.0, 2.0]), ("none", None, None), (None, [0.0, 1.0, 2.0], [0.0, 5.0, 0.0])]
    p, a = spark.createDataFrame(pts, "id string, lat double, lon double"), spark.createDataFrame(areas, "area string, la array<double>, lo array<double>")
    want = {(i, k) for i, la, lo in pts for k in brute_inside(la, lo, RINGS)}
    for cells, small in ((256, 50_000), (8, 50_000), (64, 0)):
        got = [tuple(r) for r in inside_regions(p, a, "area", "la", "lo", cells, small).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert inside_regions(p, a.limit(0), "area", "la", "lo").count() == 0
    assert inside_regions(p.limit(0), a, "area", "la", "lo").count() == 0


def test_ring_around_a_pole(spark):
    ring = unwrap_ring([80.0, 80.0, 80.0, 80.0], [0.0, 90.0, 180.0, -90.0])
    assert ring is not None and any(inner for _, _, inner in cover_ring(ring, 4096))
    p = spark.createDataFrame([("in", 85.0, 33.0), ("out", 70.0, 33.0), ("south", -85.0, 33.0)], "id string, lat double, lon double")
    a = spark.createDataFrame([("cap", [80.0, 80.0, 80.0, 80.0], [0.0, 90.0, 180.0, -90.0])], "area string, la array<double>, lo array<double>")
    assert {tuple(r) for r in inside_regions(p, a, "area", "la", "lo").collect()} == {("in", "cap")}


def test_place_cases(spark):
    nan = float("nan")
    rows = [("a", 1.0, 2.0, "9 9"), ("a", 1.0, 2.0, None), ("b", None, 2.0, "3 4"), ("c", 0.0, 0.0, "3 4"), ("d", 91.0, 2.0, "3 4"), ("e", nan, 1.0, "5 6"), (None, 1.0, 1.0, "1 1"), (" ", 1.0, 1.0, "1 1"), ("f", None, None, "0 0"), ("g", None, None, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k string, y double, x double, raw string, id string")
    got = sorted(tuple(r) for r in place(df, "k", "y", "x", "raw").collect())
    assert got == [("a", 1.0, 2.0), ("b", 3.0, 4.0), ("e", 5.0, 6.0)]
    assert place(df.limit(0), "k", "y", "x", "raw").count() == 0


def test_p1_on_the_table(spark, sf):
    g = spark.read.parquet(f"{sf}/gg2_full_qc_with_meta.parquet")
    rows = [tuple(r) for r in place(g, "MA_Sample_ID", "Latitude", "Longitude", "MA_Geo_Raw").collect()]
    rings = {r.area_id: (r.ring_lat, r.ring_lon) for r in spark.read.parquet(f"{sf}/geo_areas.parquet").collect()}
    want = {("near", *x) for x in brute_near(rows, 1.0)} | {("inside", i, k) for i, la, lo in rows for k in brute_inside(la, lo, rings)}
    got = [tuple(r) for r in p1_found(spark, sf).select("kind", "left_id", "right_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert g.filter(F.col("MA_Sample_ID").isNull()).count() == 0 and len(want) > 0
