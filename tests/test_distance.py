"""Trees, distances, ordination and embedding on fixtures with known values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusweave.operators import distance as D
from corpusweave.operators import kernel as K
from corpusweave.operators import ordination as O
from corpusweave.operators import tree as T
from corpusweave.session import Stage
from corpusweave.sources.newick import newick_nodes, parse_newick, write_newick

TEXT = "((t1:1,t2:1)'f__F1; g__G1':2,((t3:1)'g__G3':1,t4:1)'f__F2; g__G2':3)'d__D; p__P; c__C; o__O';"
NODES = "node long, parent long, label string, length double"


def tree(spark, rows):
    return spark.createDataFrame(rows, NODES)


def test_parse():
    got = parse_newick(TEXT)
    assert got == [(0, None, "d__D; p__P; c__C; o__O", 0.0), (1, 0, "f__F1; g__G1", 2.0), (2, 0, "f__F2; g__G2", 3.0), (3, 2, "g__G3", 1.0)]
    full = parse_newick(TEXT, keep_tips=True)
    assert [x[2] for x in full] == ["d__D; p__P; c__C; o__O", "f__F1; g__G1", "t1", "t2", "f__F2; g__G2", "g__G3", "t3", "t4"]
    assert parse_newick("(a:-1e-6,(b)c)'it''s':0;", keep_tips=True) == [(0, None, "it's", 0.0), (1, 0, "a", 0.0), (2, 0, "c", 0.0), (3, 2, "b", 0.0)]
    assert len(parse_newick("(,,(,));", keep_tips=True)) == 6 and len(parse_newick("a;", keep_tips=True)) == 1
    deep = "(" * 20000 + "x" + ":1)" * 20000 + ";"
    assert len(parse_newick(deep)) == 20000 and write_newick(parse_newick(deep, True)).count("(") == 20000
    for bad in ("(a;", "a);"):
        with pytest.raises(ValueError):
            parse_newick(bad)


def test_round_trip(spark):
    rows = parse_newick(TEXT, keep_tips=True)
    assert parse_newick(write_newick(rows), keep_tips=True) == rows
    got = newick_nodes(spark.createDataFrame([(1, TEXT), (2, None)], "tree long, t string"), "t").collect()
    assert [(r.node, r.parent, r.label, r.length) for r in sorted(got, key=lambda r: r.node)] == parse_newick(TEXT)


def test_tree_operators(spark):
    t = tree(spark, parse_newick(TEXT))
    assert tuple(T.tree_faults(t).head()) == (0, 0, 0, 0)
    genus = t.filter("label LIKE '%g\\_\\_%'")
    names = genus.selectExpr("node", "regexp_extract(label, 'g__[A-Z0-9]+', 0) AS name")
    want = {("g__G1", "g__G2"): 5.0, ("g__G1", "g__G3"): 6.0, ("g__G2", "g__G3"): 1.0}
    assert {(r.i, r.j): r.dist for r in T.patristic(t, names).collect()} == want
    voc = {r.Genus: r.var_id for r in T.vocabulary(t).collect()}
    assert voc["g__G3"] == "d__D;p__P;c__C;o__O;f__F2;g__G3" and set(voc) == {"g__G1", "g__G2", "g__G3"}
    hops = {(r.i[-2:], r.j[-2:]): r.hops for r in T.hop_distance(T.vocabulary(t)).collect()}
    assert hops == {("G2", "G3"): 1, ("G1", "G2"): 2, ("G1", "G3"): 2}
    c = T.collapse(t, genus)
    assert {(r.node, r.parent, r.length) for r in c.collect()} == {(0, None, 0.0), (1, 0, 2.0), (2, 0, 3.0), (3, 2, 1.0), (-3, 2, 0.0)}
    tips = spark.createDataFrame([(1, "g__G1"), (-3, "g__G2"), (3, "g__G3")], "node long, name string")
    assert {(r.i, r.j): r.dist for r in T.patristic(c, tips).collect()} == want


def test_closure_of_a_chain(spark):
    n = 37
    t = tree(spark, [(i, i - 1 if i else None, None, 1.0 if i else None) for i in range(n)])
    got = T.closure(t).collect()
    assert len(got) == n * (n + 1) // 2 and all(r.hops == r.node - r.ancestor == r.dist for r in got)


SHARES = [("u", "a", 0.5), ("u", "b", 0.5), ("v", "a", 0.5), ("v", "c", 0.5), ("w", "c", 1.0)]


@pytest.mark.parametrize("hot", [4096, 1])
def test_bray_curtis(spark, hot):
    s = spark.createDataFrame(SHARES, "sample string, feature string, share double")
    got = {(r.i, r.j): r.dist for r in D.bray_curtis(s, every_pair=True).collect()}
    assert got == pytest.approx({("u", "v"): 0.5, ("u", "w"): 1.0, ("v", "w"): 0.5})
    assert D.bray_curtis(s).count() == 2 and D.bray_curtis(s.limit(0), every_pair=True).count() == 0
    v = s.selectExpr("sample", "feature", "share AS v", "1.0D AS w")
    assert {(r.i, r.j): r.s for r in D.pair_sums(v, hot).collect()} == pytest.approx({("u", "v"): 0.5, ("v", "w"): 0.5})


def test_unifrac(spark):
    t = tree(spark, [(0, None, None, 0.0), (1, 0, None, 1.0), (2, 1, "a", 1.0), (3, 1, "b", 1.0), (4, 0, "c", 2.0)])
    s = spark.createDataFrame(SHARES, "sample string, feature string, share double")
    tips = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "feature string, node long")
    got = {(r.i, r.j): r.dist for r in D.weighted_unifrac(s, t, tips, every_pair=True).collect()}
    assert got["u", "v"] == pytest.approx(0.5) and got["u", "w"] == pytest.approx(1.0)


@pytest.mark.parametrize("block", [512, 1])
def test_block_sums_equal_pair_sums(spark, block):
    v = spark.createDataFrame([(*r, 1.0 + (r[1] == "c"), 2.0) for r in [*SHARES, ("x", "z", 1.0)]], "sample string, feature string, v double, w double, t double")
    want = {(r.i, r.j): r.s for r in D.pair_sums(v).collect()}
    got = D.block_sums(v, block).collect()
    assert {(r.i, r.j): r.s for r in got} == pytest.approx(want) and {r.t for r in got} == {4.0}
    assert D.block_sums(v.limit(0), block).count() == 0


def test_blocks_copy_no_rows(spark):
    """Rows are shuffled once, however many blocks there are."""
    v = spark.range(400).selectExpr("id AS sample", "explode(array(0, 1 + id % 7)) AS feature", "0.5D AS v", "1.0D AS w", "0.0D AS t")
    got = D.block_sums(v, 8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 400 * 399 // 2 and "Exchange" not in plan and "CoGroups" not in plan


def line(spark):
    x = {"a": 0.0, "b": 1.0, "c": 3.0}
    return spark.createDataFrame([(i, j, abs(x[i] - x[j])) for i in x for j in x if i < j], "i string, j string, dist double"), x


@pytest.mark.parametrize("limit", [2000, 0])
def test_pcoa_of_a_line(spark, limit):
    d, x = line(spark)
    coords, values = O.pcoa(d, axes=2, dense_limit=limit)
    v = values.orderBy("axis").collect()
    assert v[0].eigval == pytest.approx(14 / 3) and v[0].explained == pytest.approx(1.0) and all(r.eigval == pytest.approx(0, abs=1e-6) for r in v[1:])
    c = {r["name"]: r.coords[0] for r in coords.collect()}
    assert abs(abs(c["a"] - c["b"]) - 1) < 1e-6 and abs(abs(c["a"] - c["c"]) - 3) < 1e-6


def test_lanczos_equals_dense(spark):
    rng = np.random.default_rng(4)
    m = rng.random((40, 40))
    m = (m + m.T) / 2  # no metric: its spectrum has both signs
    d = spark.createDataFrame([(f"{i:02}", f"{j:02}", float(m[i, j])) for i in range(40) for j in range(i + 1, 40)], "i string, j string, dist double")
    a = [r.eigval for r in O.pcoa(d, 5)[1].orderBy("axis").collect()]
    b = [r.eigval for r in O.pcoa(d, 5, dense_limit=0, steps=39)[1].orderBy("axis").collect()]
    assert b == pytest.approx(a, rel=1e-6)
    bottom = [r.eigval for r in O.negative_spectrum(d, 3).filter("side = 'bottom'").collect()]
    assert min(bottom) < 0


def test_lanczos_goes_on_to_its_tolerance(spark):
    rng = np.random.default_rng(9)
    m = rng.random((200, 200))
    d = spark.createDataFrame([(f"{i:03}", f"{j:03}", float(m[i, j])) for i in range(200) for j in range(i + 1, 200)], "i string, j string, dist double").repartition(2).cache()
    a = [r.eigval for r in O.pcoa(d)[1].orderBy("axis").collect()]
    b = [r.eigval for r in O.pcoa(d, dense_limit=0)[1].orderBy("axis").collect()]
    assert b == pytest.approx(a, rel=1e-6)
    with pytest.raises(ValueError, match="residual"):
        O.pcoa(d, dense_limit=0, max_steps=60)


@pytest.mark.parametrize("limit", [2000, 0])
def test_pcoa_of_listed_pairs(spark, limit):
    near = {("a", "b"): 0.5, ("b", "c"): 0.25}
    names = [(x,) for x in "abcde"]  # d and e are in no pair
    some = spark.createDataFrame([(i, j, v) for (i, j), v in near.items()], "i string, j string, dist double")
    every = spark.createDataFrame([(i, j, near.get((i, j), 1.0)) for (i,) in names for (j,) in names if i < j], "i string, j string, dist double")
    points = spark.createDataFrame(names, "name string")
    coords, values = O.pcoa(some, 3, limit, points=points, missing=1.0)
    want = O.pcoa(every, 3)[1].orderBy("axis").collect()
    got = values.orderBy("axis").collect()
    assert [r.eigval for r in got] == pytest.approx([r.eigval for r in want]) and got[0].trace == pytest.approx(want[0].trace)
    assert {r["name"] for r in coords.collect()} == set("abcde")
    spectrum = lambda *a, **k: [r.eigval for r in O.negative_spectrum(*a, **k).orderBy("side", "position").collect()]
    assert spectrum(some, points=points, missing=1.0) == pytest.approx(spectrum(every))


def corpus(rng, samples, features, k):
    """Shares of samples that all have one feature, which of the rest have ``k`` each."""
    rows = []
    for i in range(samples):
        w = rng.integers(1, 6, k + 1).astype(float)  # ties
        rows += [(f"s{i:03}", f"f{f}", float(x)) for f, x in zip(["all", *rng.choice(features, k, replace=False)], w / w.sum(), strict=True)]
    return rows


@pytest.mark.parametrize("direct,memory", [(1 << 26, 1 << 28), (0, 90 * 8 * 40)])
def test_ordination_from_facts_lists_no_pairs(spark, monkeypatch, direct, memory):
    """Products from facts give the ordination of the listed distances, with a basis that outgrows its memory too."""
    s = spark.createDataFrame([*corpus(np.random.default_rng(3), 90, 60, 6), ("lone", "own", 1.0)], "sample string, feature string, share double")
    coords, want = O.pcoa(D.bray_curtis(s), points=s.selectExpr("sample AS name"), missing=1.0)
    coords, want = {r["name"]: np.array(r.coords) for r in coords.collect()}, want.orderBy("axis").collect()
    for f in ("bray_curtis", "pcoa"):
        monkeypatch.setattr(O, f, lambda *a, **k: pytest.fail("pairs were listed"))
    monkeypatch.setattr(O.BrayCurtisGram.__init__, "__defaults__", (direct, 16))
    got_coords, values = O.pcoa_bray_curtis(s, dense_limit=0, memory=memory)
    got_coords, got = {r["name"]: np.array(r.coords) for r in got_coords.collect()}, values.orderBy("axis").collect()
    assert [r.eigval for r in got] == pytest.approx([r.eigval for r in want], rel=1e-9) and got[0].trace == pytest.approx(want[0].trace, rel=1e-12)
    assert set(got_coords) == set(coords) and all(np.allclose(got_coords[k], coords[k], atol=1e-4) for k in coords)


def test_only_pairs_with_two_common_features_are_stored(spark):
    rows = [(i, f, 0.5) for i in range(300) for f in ("all", f"f{i // 2}" if i < 20 else f"own{i}")]
    s = spark.createDataFrame(rows, "sample long, feature string, share double")
    packed = spark.read.parquet(_written(spark, s))
    stored = K.common_pairs(packed, 1e5).collect()
    assert sum(len(r["w"]) for r in stored) == 8 * 10 and {round(float(w), 9) for r in stored for w in np.frombuffer(r["w"])} == {0.5}
    assert sum(len(r["v"]) for r in K.pack_facts(K.number_samples(s), 100).collect()) == 8 * len(rows)


def _written(spark, s):
    stage = Stage(spark)
    stage.put(K.pack_facts(K.number_samples(s), 100))
    return stage.kept[-1]


def test_ordination_check_writes_no_list_of_pairs(spark, sf, monkeypatch):
    """The check of the axes sums up distances in slabs of samples; pairs are neither joined nor shuffled."""
    from corpusweave.plans import distance as P

    want = P.ordination_check(spark, sf).head()  # the dense matrix of so few samples is of listed pairs
    monkeypatch.setattr(O.pcoa_bray_curtis, "__defaults__", (10, 0, *O.pcoa_bray_curtis.__defaults__[2:]))
    for m, f in ((D, "bray_curtis"), (O, "bray_curtis"), (D, "pair_sums"), (D, "block_sums")):
        monkeypatch.setattr(m, f, lambda *a, **k: pytest.fail("pairs were listed"))
    got = P.ordination_check(spark, sf).head()
    assert got == want and got.lengths and got.apart and got.eigen and got.within


@pytest.mark.parametrize("most", [1 << 21, 50])
def test_sums_over_slabs_of_pairs(spark, most):
    """Forms, stored pairs and the sum of all entries agree with brute force, also when a slab has more pairs than it holds."""
    rng = np.random.default_rng(12)
    s = spark.createDataFrame(corpus(rng, 40, 25, 5), "sample string, feature string, share double")
    g = K.BrayCurtisGram(s)
    k = {r["name"]: r["k"] for r in g.names.collect()}
    x, minima = rng.standard_normal((40, 2)), np.zeros((40, 40, 26))
    by = {}
    for r in s.collect():
        by.setdefault(r["feature"], []).append((k[r["sample"]], r["share"]))
    for f, rows in enumerate(by.values()):
        for i, a in rows:
            for j, b in rows:
                minima[i, j, f] = min(a, b)
    total = minima.sum(axis=2)
    want = sum(x[i] * x[j] * ((1 - total[i, j]) ** 2 - 1) for i in range(40) for j in range(i + 1, 40))
    coords = spark.createDataFrame([(a, [float(z) for z in x[b]]) for a, b in k.items()], "name string, coords array<double>")
    chunks = lambda: K._chunks(g.facts[0].inputFiles())
    assert g.forms(coords, 2) == pytest.approx(list(want)) and g.total() == pytest.approx(float((total - total**2 / 2).sum()))
    assert sum(K._forms(chunks(), q, 3, x, most) for q in range(3)) == pytest.approx(want)
    got = {(int(i), int(j)): w for q in range(3) for i, j, w in zip(*K._common(chunks(), q, 3, most), strict=True)}
    extra = total**2 - (minima**2).sum(axis=2)
    assert got == pytest.approx({(i, j): extra[i, j] for i in range(40) for j in range(i + 1, 40) if extra[i, j] > 1e-12})


def test_the_trace_needs_no_product(spark, monkeypatch):
    """The trace comes from the facts and the stored pairs, without a product of its own."""
    s = spark.createDataFrame(corpus(np.random.default_rng(3), 60, 40, 6), "sample string, feature string, share double")
    want = O.pcoa(D.bray_curtis(s), points=s.selectExpr("sample AS name"), missing=1.0)[1].head().trace
    widths, times = [], K.BrayCurtisGram.times
    monkeypatch.setattr(K.BrayCurtisGram, "times", lambda g, x: widths.append(x.shape[1]) or times(g, x))
    assert O.pcoa_bray_curtis(s, dense_limit=0)[1].head().trace == pytest.approx(want, rel=1e-12) and 1 not in widths


def test_repeated_eigenvalues_are_all_found(spark):
    """Three equal groups without a pair between them: every eigenvalue within them comes three times."""
    m = np.random.default_rng(5).random((60, 60))
    d = spark.createDataFrame([(f"{g}{i:02}", f"{g}{j:02}", float(m[i, j])) for g in "abc" for i in range(60) for j in range(i + 1, 60)], "i string, j string, dist double").repartition(2).cache()
    want = [r.eigval for r in O.pcoa(d, missing=1.0)[1].orderBy("axis").collect()]
    got = [r.eigval for r in O.pcoa(d, dense_limit=0, missing=1.0)[1].orderBy("axis").collect()]
    assert got == pytest.approx(want, rel=1e-6)


def test_quadratic_forms(spark):
    """Sums over listed pairs from sent coordinates, without a join of pairs and coordinates."""
    rng = np.random.default_rng(8)
    s = spark.createDataFrame(corpus(rng, 30, 20, 3), "sample string, feature string, share double")
    x = {f"s{i:03}": rng.standard_normal(2) for i in range(30)}
    coords = spark.createDataFrame([(k, [float(z) for z in v]) for k, v in x.items()], "name string, coords array<double>")
    listed = []
    got = O.quadratic_forms(lambda n: listed.append(D.bray_curtis(s.join(n, s["sample"] == n["name"]).selectExpr("k AS sample", "feature", "share"))) or listed[0], coords, 2)
    want = sum(x[r.i] * x[r.j] * (r.dist**2 - 1) for r in D.bray_curtis(s).collect())
    assert got == pytest.approx(list(want)) and O.quadratic_forms(lambda n: listed[0].limit(0), coords, 2) == [0.0, 0.0]


def test_unifrac_in_blocks_reads_the_facts_once(spark):
    rows = [(f"s{i}", "t1" if i % 2 else "t2", 0.5) for i in range(6)] + [(f"s{i}", "t3", 0.5) for i in range(6)]
    seen = spark.sparkContext.accumulator(0)
    shares = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(lambda r: seen.add(1) or r), "sample string, feature string, share double")
    nodes = tree(spark, [(0, None, "r", 0.0), (1, 0, "a", 2.0), (2, 0, "b", 1.0), (3, 0, "c", 1.0)])
    tips = spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3)], "feature string, node long")
    assert D.weighted_unifrac(shares, nodes, tips).count() == 15 and seen.value == len(rows)


def test_audit_of_all_pairs(spark):
    s = spark.createDataFrame([*SHARES, ("x", "z", 1.0)], "sample string, feature string, share double")
    assert tuple(D.audit(D.bray_curtis(s), s).select("pairs", "least", "mid", "most", "unknown", "out_of_range").head()) == (6, 0.5, 1.0, 1.0, 0, 0)
    assert tuple(D.audit(D.bray_curtis(s), s).head()) == tuple(D.audit(D.bray_curtis(s, every_pair=True)).head())


def test_whole_corpus_is_measured(spark):
    from __spark_entry__ import oracle_sql, queries

    sf = "/root/testdata/sf0.01"  # 746 samples
    assert queries()["ordination_pcoa"](spark, sf).count() == 746
    assert queries()["distance_audit_all"](spark, sf).head().pairs == 746 * 745 // 2
    assert {"distance_unifrac", "distance_audit_all"} <= set(oracle_sql())


def test_embedding(spark):
    rng = np.random.default_rng(2)
    x = rng.random((20, 3))
    d = spark.createDataFrame([(f"{i:02}", f"{j:02}", float(np.linalg.norm(x[i] - x[j]))) for i in range(20) for j in range(i + 1, 20)], "i string, j string, dist double")
    coords, scale = O.euclidean_embedding(d, dim=3, steps=1500)
    c = {r["name"]: np.array(r.coords) for r in coords.collect()}
    got = [float(np.linalg.norm(c[r.i] - c[r.j])) for r in d.collect()]
    want = [scale * r.dist for r in d.collect()]
    assert np.corrcoef(got, want)[0, 1] > 0.99


def test_kernels_agree_where_all_samples_share_a_feature(spark):
    """The join, the blocks and brute force give the same sums; the cheaper kernel is chosen from counts."""
    rng = np.random.default_rng(4)
    rows = [(f"s{i:02}", f, float(rng.random()), w) for i in range(40) for f, w in (("all", 1.0), ("most", 0.5), *((f"f{k}", 2.0) for k in range(30))) if f == "all" or (f == "most" and i % 5) or rng.random() < 0.1]
    v = spark.createDataFrame(rows, "sample string, feature string, v double, w double")
    by = {}
    for s, f, x, w in rows:
        by.setdefault(s, {})[f] = (x, w)
    want = {(a, b): sum(w * min(x, by[b][f][0]) for f, (x, w) in by[a].items() if f in by[b]) for a in by for b in by if a < b}
    for got in (D.pair_sums(v, 7), D.block_sums(v.withColumn("t", F.lit(0.0)), 16), D.sums_of_minima(v, 4), D.sums_of_minima(v, 4, 1e-9)):
        got = {(r.i, r.j): r.s for r in got.collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("block", [3, 512])
def test_paths_in_blocks(spark, block):
    """Random trees: distances in blocks equal those over common ancestors, whatever the depth and the names' order."""
    rng = np.random.default_rng(6)
    nodes = [(0, None, "n0", 0.0)] + [(i, int(rng.integers(max(0, i - 6), i)), f"n{i}", float(rng.integers(0, 5))) for i in range(1, 60)]
    t = spark.createDataFrame(nodes, "node long, parent long, label string, length double")
    names = t.filter("node % 2 = 0 or node = 0").select("node", F.col("label").alias("name"))
    got = {(r.i, r.j): r.dist for r in T.patristic(t, names, block).collect()}
    want = {(r.i, r.j): r.dist for r in T.patristic_by_ancestors(t, names).collect()}
    assert set(got) == set(want) and len(got) == 30 * 29 // 2 and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert T.patristic(t, names.limit(0)).count() == 0


def test_parents_in_a_circle(spark):
    t = spark.createDataFrame([(0, 2, "a", 1.0), (1, 0, "b", 1.0), (2, 1, "c", 1.0)], "node long, parent long, label string, length double")
    with pytest.raises(ValueError, match="circle"):
        T.closure(t)
