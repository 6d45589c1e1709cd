"""Queries over trees, sample distances, ordination and embedding.

Bray-Curtis, UniFrac, their audit and the ordination run over all samples after quality control, as pairs with a common
feature or node; other pairs have distance 1. The spectrum takes 3000 samples. The queries ``*_sampled`` and
``distance_audit`` are small: all pairs of 120 samples. The tree of features is type, brand, part, and grows with
the data; the tree of places, 31 nodes, is region and nation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusweave.functions.taxonomy import KEY_RANKS
from corpusweave.operators import counts as C
from corpusweave.operators import distance as D
from corpusweave.operators import ordination as O
from corpusweave.operators import sampling as S
from corpusweave.operators import tree as T
from corpusweave.operators.skew import add_quantiles
from corpusweave.plans.corpus import _QC, _RANKED, _qc, _taxonomy
from corpusweave.session import Stage, cut_lineage, read_table
from corpusweave.sources.newick import newick_nodes, write_newick

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_SHARE = f"{_QC}, s as (select sample, feature, n / sum(n) over (partition by sample) as share from q)"
_PICK = f"{_SHARE}, pick as (select sample from (select distinct sample from q) order by md5(concat('42|', cast(sample as varchar))) limit 120), p as (select s.* from s join pick using (sample))"


def _shares(spark, sf):
    return C.shares(_qc(spark, sf)).select("sample", "feature", "share")


def _picked(spark, sf, size=120):
    """Shares of ``size`` samples drawn without replacement."""
    s = _shares(spark, sf)
    chosen = S.simple_sample(s.select("sample").distinct(), size, "sample")
    return cut_lineage(s.join(F.broadcast(chosen), "sample"))  # size rows; every distance reads the result several times


@query(f"with {_SHARE} select a.sample as i, b.sample as j, round(1 - sum(least(a.share, b.share)), 6) as dist from s a join s b on a.feature = b.feature and a.sample < b.sample group by 1, 2")
def distance_bray_curtis(spark, sf):
    """Bray-Curtis of all pairs of samples with a common feature; all other pairs have distance 1."""
    return D.bray_curtis(_shares(spark, sf)).withColumn("dist", F.round("dist", 6))


@query(f"with {_PICK}, d as (select a.sample as i, b.sample as j, sum(least(a.share, b.share)) as s from p a join p b on a.feature = b.feature and a.sample < b.sample group by 1, 2) select x.sample as i, y.sample as j, round(1 - coalesce(s, 0), 6) as dist from pick x join pick y on x.sample < y.sample left join d on d.i = x.sample and d.j = y.sample")
def distance_bray_curtis_sampled(spark, sf):
    """Bray-Curtis of all pairs of 120 samples."""
    return D.bray_curtis(_picked(spark, sf), every_pair=True).withColumn("dist", F.round("dist", 6))


def _feature_tree(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_type", F.concat_ws("|", "p_type", "p_brand").alias("tb"))
    root = spark.createDataFrame([("root", None, "root", 0.0)], "node string, parent string, label string, length double")
    types = p.select(F.col("p_type").alias("node")).distinct().select("node", F.lit("root").alias("parent"), F.col("node").alias("label"), F.lit(1.0).alias("length"))
    brands = p.select(F.col("tb").alias("node"), F.col("p_type").alias("parent")).distinct().select("node", "parent", F.col("node").alias("label"), F.lit(0.5).alias("length"))
    parts = p.select(F.concat(F.lit("part"), "p_partkey").alias("node"), F.col("tb").alias("parent"), F.lit(None).cast("string").alias("label"), F.lit(0.25).alias("length"))
    return root.unionByName(types).unionByName(brands).unionByName(parts), p.select(F.col("p_partkey").alias("feature"), F.concat(F.lit("part"), "p_partkey").alias("node"))


_MASS = """m as (select sample, 'part' || feature as node, 0.25 as w, share as v from p union all select sample, p_type || '|' || p_brand, 0.5, sum(share) from p join part on feature = p_partkey group by 1, 2 union all select sample, p_type, 1.0, sum(share) from p join part on feature = p_partkey group by 1, 2)"""


@query(f"with {_PICK}, {_MASS}, mt as (select sample, sum(w * v) as t from m group by 1), d as (select a.sample as i, b.sample as j, sum(a.w * least(a.v, b.v)) as s from m a join m b on a.node = b.node and a.sample < b.sample group by 1, 2) select x.sample as i, y.sample as j, round(1 - 2 * coalesce(s, 0) / (x.t + y.t), 6) as dist from mt x join mt y on x.sample < y.sample left join d on d.i = x.sample and d.j = y.sample")
def distance_unifrac_sampled(spark, sf):
    """Weighted normalised UniFrac of all pairs of 120 samples over the tree of features."""
    nodes, tips = _feature_tree(spark, sf)
    return D.weighted_unifrac(_picked(spark, sf), nodes, tips, every_pair=True).withColumn("dist", F.round("dist", 6))


@query(f"with {_SHARE}, p as (select * from s), {_MASS}, mt as (select sample, sum(w * v) as t from m group by 1), d as (select a.sample as i, b.sample as j, sum(a.w * least(a.v, b.v)) as s from m a join m b on a.node = b.node and a.sample < b.sample group by 1, 2) select i, j, round(1 - 2 * d.s / (x.t + y.t) + 1e-9, 6) as dist from d join mt x on x.sample = i join mt y on y.sample = j")
def distance_unifrac(spark, sf):
    """Weighted normalised UniFrac of all pairs of samples with a common node; all other pairs have distance 1."""
    nodes, tips = _feature_tree(spark, sf)
    out = D.weighted_unifrac(Stage(spark).put(_shares(spark, sf)), nodes, tips)
    return out.withColumn("dist", F.round(F.col("dist") + 1e-9, 6))  # so that halves of the last digit, which sums in another order miss, go one way


@query(f"with {_PICK}, d as (select 1 - sum(least(a.share, b.share)) as dist from p a join p b on a.feature = b.feature and a.sample < b.sample group by a.sample, b.sample) select count(*) as pairs, round(min(dist), 6) as least, round(median(dist), 6) as mid, round(max(dist), 6) as most, 0 as unknown, 0 as out_of_range from d")
def distance_audit(spark, sf):
    """Range and faults of sampled distances."""
    a = D.audit(D.bray_curtis(_picked(spark, sf)))
    return a.select("pairs", *(F.round(c, 6).alias(c) for c in ("least", "mid", "most")), "unknown", "out_of_range")


@query(f"with {_SHARE}, k as (select distinct sample from q), c as (select a.sample as i, b.sample as j, 1 - sum(least(a.share, b.share)) as dist from s a join s b on a.feature = b.feature and a.sample < b.sample group by 1, 2), d as (select coalesce(dist, 1) as dist from k x join k y on x.sample < y.sample left join c on c.i = x.sample and c.j = y.sample) select count(*) as pairs, round(min(dist), 6) as least, round(median(dist), 6) as mid, round(max(dist), 6) as most, 0 as unknown, 0 as out_of_range from d")
def distance_audit_all(spark, sf):
    """Range and faults of the distances of all pairs of samples."""
    s = cut_lineage(_shares(spark, sf))
    a = D.audit(D.bray_curtis(s), s)
    return a.select("pairs", *(F.round(c, 6).alias(c) for c in ("least", "mid", "most")), "unknown", "out_of_range")


_PLACES = "select 0 as node, null as parent, 'world' as label, cast(0 as double) as length union all select 1 + r_regionkey, 0, r_name, cast(3 as double) from region union all select 100 + n_nationkey, 1 + n_regionkey, n_name, cast(0.5 + n_nationkey % 4 as double) from nation"


def _places(spark, sf):
    r, n = read_table(spark, sf, "region"), read_table(spark, sf, "nation")
    root = spark.createDataFrame([(0, None, "world", 0.0)], "node long, parent long, label string, length double")
    a = r.select((1 + F.col("r_regionkey")).cast("long").alias("node"), F.lit(0).cast("long").alias("parent"), F.col("r_name").alias("label"), F.lit(3.0).alias("length"))
    b = n.select((100 + F.col("n_nationkey")).cast("long").alias("node"), (1 + F.col("n_regionkey")).cast("long").alias("parent"), F.col("n_name").alias("label"), (0.5 + F.col("n_nationkey") % 4).alias("length"))
    return root.unionByName(a).unionByName(b)


@query("with b as (select distinct p_type as t, p_type || '|' || p_brand as n from part) select x.n as i, y.n as j, case when x.t = y.t then cast(1 as double) else 3 end as dist from b x join b y on x.n < y.n")
def tree_feature_paths(spark, sf):
    """Path lengths between all brands over the tree of features."""
    nodes, _ = _feature_tree(spark, sf)
    return T.patristic(nodes, nodes.filter("length = 0.5").select("node", F.col("node").alias("name")))


@query(f"with t as ({_PLACES}) select count(*) as nodes, count(parent) as edges, round(sum(length), 6) as total, (select count(distinct label) from t) as labels from t")
def tree_newick_round_trip(spark, sf):
    """A tree written as text and parsed again."""
    rows = [tuple(r) for r in _places(spark, sf).orderBy("node").collect()]  # 31 nodes
    text = spark.createDataFrame([(1, write_newick(rows))], "tree long, text string")
    n = newick_nodes(text, "text", keep_tips=True)
    return n.agg(F.count("*").alias("nodes"), F.count("parent").alias("edges"), F.round(F.sum("length"), 6).alias("total"), F.count_distinct("label").alias("labels"))


@query(f"with t as ({_PLACES}) select 0 as extra_roots, 0 as repeated_nodes, 0 as unknown_parents, count(*) filter (where parent >= node) as late_parents from t")
def tree_faults(spark, sf):
    """Broken invariants of a tree."""
    return T.tree_faults(_places(spark, sf))


@query(f"with recursive t as ({_PLACES}), c as (select node, node as ancestor, 0 as hops, cast(0 as double) as dist from t union all select c.node, t.parent, c.hops + 1, c.dist + t.length from c join t on c.ancestor = t.node where t.parent is not null) select node, ancestor, hops, round(dist, 6) as dist from c")
def tree_closure(spark, sf):
    """All ancestors of all nodes."""
    return T.closure(_places(spark, sf)).withColumn("dist", F.round("dist", 6))


@query(f"with t as ({_PLACES}), l as (select * from t where node >= 100) select a.label as i, b.label as j, round(case when a.parent = b.parent then a.length + b.length else a.length + b.length + 6 end, 6) as dist from l a join l b on a.label < b.label")
def tree_patristic(spark, sf):
    """Path lengths between the nations over the tree of places."""
    t = _places(spark, sf)
    return T.patristic(t, t.filter("node >= 100").select("node", F.col("label").alias("name"))).withColumn("dist", F.round("dist", 6))


@query("select 'd__' || split_part(r_name, ' ', 1) || ';p__;c__;o__;f__F' || (n_nationkey % 3) || ';g__' || n_name as var_id from nation join region on n_regionkey = r_regionkey")
def tree_vocabulary(spark, sf):
    """Genus nodes of a labelled tree with the ranks they inherit."""
    t = _places(spark, sf)
    label = F.when(F.col("node") >= 100, F.concat(F.lit("f__F"), (F.col("node") - 100) % 3, F.lit("; g__"), "label")).when(F.col("node") > 0, F.concat(F.lit("d__"), "label"))
    return T.vocabulary(t.withColumn("label", label)).select("var_id")




@query(f"with {_RANKED}, v as (select distinct \"Domain\" as a, \"Phylum\" as b from tx where \"Phylum\" is not null) select x.a || x.b as i, y.a || y.b as j, case when x.b = y.b then 0 when x.a = y.a then 1 else 2 end as hops from v x join v y on x.a || x.b < y.a || y.b")
def tree_hop_distance(spark, sf):
    """Hops between the paths of two ranks: levels up to the deepest equal one."""
    v = _taxonomy(spark, sf).select("Domain", "Phylum").filter("Phylum IS NOT NULL").distinct().withColumn("k", F.concat("Domain", "Phylum"))
    return T.hop_distance(v, "k", KEY_RANKS[:2]).withColumn("hops", F.col("hops").cast("int"))


@query(f"with {_RANKED}, v as (select distinct \"Domain\" as a, \"Phylum\" as b from tx where \"Phylum\" is not null), d as (select case when x.b = y.b then 0 when x.a = y.a then 1 else 2 end as hops from v x join v y on x.a || x.b < y.a || y.b) select hops, count(*) as pairs from d group by 1")
def tree_hop_histogram(spark, sf):
    """Pairs per hop distance."""
    return tree_hop_distance(spark, sf).groupBy("hops").agg(F.count("*").alias("pairs"))


@query(f"with t as ({_PLACES}) select count(*) as nodes from t where node < 100 and node in (select parent from t where node >= 100) or node = 0 or node in (select node from t where node >= 100 and (node - 100) % 2 = 0)")
def tree_marked(spark, sf):
    """Nodes above every second nation, which stay when the tree is collapsed."""
    t = _places(spark, sf)
    return T.with_marked_descendants(t, t.filter("node >= 100 AND (node - 100) % 2 = 0")).agg(F.count("*").alias("nodes"))


@query(f"with t as ({_PLACES}), c as (select case when node between 1 and 5 then null else label end as label, length from t union all select label, cast(0 as double) from t where node between 1 and 5) select count(*) as nodes, count(label) as labelled, round(sum(length), 6) as total from c")
def tree_collapse(spark, sf):
    """The tree of places with regions and nations as tips, regions as tips of length 0 beside their nations."""
    t = _places(spark, sf)
    c = T.collapse(t, t.filter("node >= 1"))
    return c.agg(F.count("*").alias("nodes"), F.count("label").alias("labelled"), F.round(F.sum("length"), 6).alias("total"))


_L2 = "sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::double - z[2]::double) * (z[1]::double - z[2]::double))))"


@query(f"select a.vec_id as i, b.vec_id as j, round({_L2}, 6) as dist from embeddings a join embeddings b on b.vec_id = a.vec_id + 1")
def distance_euclidean(spark, sf):
    """Distance of every vector to the next one."""
    e = read_table(spark, sf, "embeddings")
    a, b = e.select(F.col("vec_id").alias("i"), F.col("embedding").alias("x")), e.select((F.col("vec_id") - 1).alias("i"), F.col("vec_id").alias("j"), F.col("embedding").alias("y"))
    return a.join(b, "i").select("i", "j", F.round(D.euclidean(F.col("x"), F.col("y")), 6).alias("dist"))


@query(f"with d as (select a.label = b.label as same, {_L2} as dist from embeddings a join embeddings b on a.vec_id < b.vec_id) select same, count(*) as pairs, round(avg(dist), 6) as mean, round(median(dist), 6) as mid, coalesce(avg(dist) >= lag(avg(dist)) over (order by same), true) as rises from d group by same")
def distance_by_bucket(spark, sf):
    """Mean distance of vectors with and without a common label."""
    e = read_table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    a, b = e.toDF("i", "x", "la"), e.toDF("j", "y", "lb")
    d = a.join(b, F.col("i") < F.col("j")).select((F.col("la") == F.col("lb")).alias("same"), D.euclidean(F.col("x"), F.col("y")).alias("dist"))
    return D.by_bucket(d, "same", "dist").select("same", "pairs", F.round("mean", 6).alias("mean"), F.round("mid", 6).alias("mid"), "rises")


@query(f"with d as (select {_L2} as dist, {_L2} * 1.5 + (a.vec_id % 3) * 0.01 as other from embeddings a join embeddings b on b.vec_id = a.vec_id + 1) select count(*) as pairs, round(corr(other, dist), 6) as pearson, round(avg(abs(other - dist) / (dist + 1e-9)), 6) as relative_deviation from d where dist > 0")
def distance_agreement(spark, sf):
    """Correlation and relative deviation of two distances."""
    e = read_table(spark, sf, "embeddings")
    a, b = e.select(F.col("vec_id").alias("i"), F.col("embedding").alias("x")), e.select((F.col("vec_id") - 1).alias("i"), F.col("embedding").alias("y"))
    d = a.join(b, "i").withColumn("dist", D.euclidean(F.col("x"), F.col("y"))).withColumn("other", F.col("dist") * 1.5 + (F.col("i") % 3) * 0.01)
    return D.agreement(d, "other", "dist").select("pairs", F.round("pearson", 6).alias("pearson"), F.round("relative_deviation", 6).alias("relative_deviation"))


def _pcoa(spark, sf):
    return O.pcoa_bray_curtis(_shares(spark, sf))


@query()
def ordination_pcoa(spark, sf):
    """Ten principal coordinates of the Bray-Curtis distances of all samples."""
    return _pcoa(spark, sf)[0]


@query()
def ordination_eigenvalues(spark, sf):
    """Eigenvalues and explained shares of the ordination."""
    return _pcoa(spark, sf)[1]


@query(f"with {_SHARE}, k as (select count(distinct sample) as n from q), d as (select 1 - sum(least(a.share, b.share)) as dist from s a join s b on a.feature = b.feature and a.sample < b.sample group by a.sample, b.sample) select n as points, round((sum(dist * dist) + n * (n - 1) / 2 - count(*)) / n, 6) as trace, 10 as axes, true as lengths, true as apart, true as eigen, true as within from d, k group by n")
def ordination_check(spark, sf):
    """What the axes of the ordination must satisfy, over all samples: the trace of the distances; lengths equal to the
    eigenvalues; right angles; ``x' B x`` equal to the eigenvalue squared; explained shares of at most 1 together."""
    s = _shares(spark, sf)
    g = O.BrayCurtisGram(s)
    coords, values = O.pcoa_bray_curtis(s, gram=g)
    values = cut_lineage(values)
    coords = Stage(spark).put(coords)
    lam = [r["eigval"] for r in values.orderBy("axis").collect()]  # ten rows
    k, top = len(lam), max(lam, default=0.0)
    # the axes are centred, so distances of 1 enter as a constant and only listed pairs are summed
    forms = g.forms(coords, k)
    dots = coords.agg(*(F.sum(F.get("coords", F.lit(a)) * F.get("coords", F.lit(b))) for a in range(k) for b in range(a, k)), F.count("*")).head()
    dot = dict(zip([(a, b) for a in range(k) for b in range(a, k)], dots, strict=False))
    close = lambda u, v: abs(u - v) <= 1e-4 * max(top, 1e-9)
    lengths = all(close(dot[a, a], lam[a]) for a in range(k))
    apart = all(close(dot[a, b], 0.0) for a in range(k) for b in range(a + 1, k))
    eigen = all(abs(0.5 * dot[a, a] - forms[a] - lam[a] * lam[a]) <= 1e-4 * max(top * top, 1e-9) for a in range(k))
    return values.groupBy().agg(F.lit(dots[-1]).cast("long").alias("points"), F.round(F.max("trace"), 6).alias("trace"), F.count("*").alias("axes"), F.lit(lengths).alias("lengths"), F.lit(apart).alias("apart"), F.lit(eigen).alias("eigen"), (F.sum("explained") <= 1 + 1e-9).alias("within"))


_SPECTRUM = _PICK.replace("limit 120", "limit 3000")


@query(f"with {_SPECTRUM}, d as (select a.sample as i, b.sample as j, 1 - sum(least(a.share, b.share)) as dist from p a join p b on a.feature = b.feature and a.sample <> b.sample group by 1, 2), m as (select x.sample as i, y.sample as j, case when x.sample = y.sample then 0 else pow(coalesce(dist, 1), 2) end as q from pick x cross join pick y left join d on d.i = x.sample and d.j = y.sample), r as (select i, avg(q) as a from m group by 1), w as (select avg(q) as a from m), b as (select m.i, m.j, -0.5 * (q - x.a - y.a + w.a) as v from m join r x on x.i = m.i join r y on y.i = m.j cross join w) select count(distinct i) as points, round(sum(case when i = j then v end), 6) as trace, round(sum(v * v), 6) as squares from b")
def ordination_spectrum_check(spark, sf):
    """Sum and sum of squares of all eigenvalues, which the distances themselves must give."""
    s = _picked(spark, sf, 3000)
    return O.spectrum_sums(D.bray_curtis(s), points=s.select(F.col("sample").alias("name")), missing=1.0).select("points", F.round("trace", 6).alias("trace"), F.round("squares", 6).alias("squares"))


@query()
def ordination_spectrum(spark, sf):
    """Both ends of the spectrum of the distances of 3000 samples, the size of the reference's audit."""
    s = _picked(spark, sf, 3000)
    return O.negative_spectrum(D.bray_curtis(s), points=s.select(F.col("sample").alias("name")), missing=1.0)


@query()
def embedding_tree(spark, sf):
    """A Euclidean embedding of the path lengths between nations."""
    return O.euclidean_embedding(tree_patristic(spark, sf))[0]




@query("select label, count(*) as n, round(min(nrm), 6) as least, round(median(nrm), 6) as mid, round(quantile_cont(nrm, 0.95), 6) as p95, round(max(nrm), 6) as most from (select label, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as nrm from embeddings) group by 1")
def distance_norms(spark, sf):
    """Norms of the vectors per label."""
    x = F.col("embedding")
    e = read_table(spark, sf, "embeddings").select("label", D.euclidean(x, F.transform(x, lambda v: F.lit(0.0))).alias("nrm"))
    e = Stage(spark).put(e)
    out = add_quantiles(e.groupBy("label").agg(F.count("*").alias("n"), F.min("nrm").alias("least"), F.max("nrm").alias("most")), e, {"mid": ("nrm", 0.5), "p95": ("nrm", 0.95)}, ["label"])
    return out.select("label", "n", *(F.round(c, 6).alias(c) for c in ("least", "mid", "p95", "most")))


@query("select label as bucket, count(*) as n, round(min(embedding[1]) - 0.04 * (max(embedding[1]) - min(embedding[1])), 6) as x_from, round(max(embedding[1]) + 0.04 * (max(embedding[1]) - min(embedding[1])), 6) as x_to, round(min(embedding[2]) - 0.04 * (max(embedding[2]) - min(embedding[2])), 6) as y_from, round(max(embedding[2]) + 0.04 * (max(embedding[2]) - min(embedding[2])), 6) as y_to from embeddings group by 1")
def ordination_limits(spark, sf):
    """Counts and axis limits with a margin of 4 % for a plot of the first two axes."""
    return O.plot_limits(read_table(spark, sf, "embeddings").select(F.col("label").alias("bucket"), F.col("embedding").alias("coords")), "bucket")


@query("select cast(count(*) * (count(*) - 1) / 2 as bigint) as pairs, cast(0 as double) as worst, 0 as beyond from nation")
def tree_cross_check(spark, sf):
    """Depths less twice the depth of the lowest common ancestor against path lengths over common ancestors."""
    t = _places(spark, sf)
    names = t.filter("node >= 100").select("node", F.col("label").alias("name"))
    return D.compare(T.patristic(t, names), T.patristic_by_ancestors(t, names)).select("pairs", F.round("worst", 6).alias("worst"), "beyond")
