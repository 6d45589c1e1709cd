"""Distances between samples from one kernel: for every pair the sum of weighted minima over common features.

``|a - b| = a + b - 2 min(a, b)``, so with totals T the distance is ``1 - 2 S / (T_i + T_j)``. Bray-Curtis takes features
with weight 1; weighted normalised UniFrac takes tree nodes with the mass below them, weighted by branch length. Pairs
without a common feature have distance exactly 1 and need no work.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.operators.merge import number_rows
from corpusweave.operators.skew import add_quantiles
from corpusweave.operators.tree import clean, closure
from corpusweave.session import Stage, drop_shuffles, partitions_of, stage_frame


def pair_sums(v: DataFrame, hot_rows: int = 4096) -> DataFrame:
    """``i, j, s`` (``i < j``) from ``sample, feature, v, w``: sums of ``w * min(v_i, v_j)``, by a join on the feature.

    For features that few samples share. A feature that more than ``hot_rows`` samples share is dealt out over salts: one
    side split, the other repeated. The salts come from a window over the feature's own count, which is summed before the shuffle.
    """
    n = v.groupBy("feature").agg(F.count("*").alias("k")).filter(F.col("k") > hot_rows).select("feature", F.ceil(F.col("k") / hot_rows).cast("int").alias("salts"))
    s = v.join(n, "feature", "left")
    one = F.coalesce("salts", F.lit(1))
    a = s.select("feature", F.pmod(F.xxhash64("sample"), one).cast("int").alias("salt"), F.col("sample").alias("i"), F.col("v").alias("x"), "w")
    b = s.select("feature", F.explode(F.sequence(F.lit(0), one - 1)).alias("salt"), F.col("sample").alias("j"), F.col("v").alias("y"))
    return a.join(b, ["feature", "salt"]).filter(F.col("i") < F.col("j")).groupBy("i", "j").agg(F.sum(F.col("w") * F.least("x", "y")).alias("s"))


def block_sums(v: DataFrame, block: int = 512) -> DataFrame:
    """``i, j, s, t`` (``i < j``) from ``sample, feature, v, w, t``: the sums of ``pair_sums``, and the sum of both samples' ``t``.

    For features that most samples share, where a join has many rows per pair. Samples are dealt out over blocks of about
    ``block``, each written once as a file of the shared folder. A task reads two blocks there and adds up their minima, so
    neither pairs nor copies of rows are shuffled: disk grows with the rows, work with the pairs.
    """
    v = v.filter("sample IS NOT NULL AND feature IS NOT NULL")
    spark, kind = v.sparkSession, dict(v.dtypes)["sample"]
    blocks = -(-v.select("sample").distinct().count() // block) or 1
    codes = number_rows(v.select("feature").distinct(), "feature").select("feature", F.col("row_number").cast("int").alias("f"))
    r = v.join(codes, "feature").select("f", "sample", "v", "w", "t", F.pmod(F.xxhash64("sample"), F.lit(blocks)).cast("int").alias("own"))
    written = Stage(spark).put(r.repartition("own").sortWithinPartitions("own", "f"), "own")
    drop_shuffles(spark)  # the pairs take much longer than the blocks
    files: dict[int, list[str]] = {}
    for path in written.inputFiles():
        files.setdefault(int(re.findall(r"/own=(\d+)/", path)[-1]), []).append(path)

    def side(x: int) -> tuple | None:
        return _side(pd.concat([stage_frame(p, ["f", "sample", "v", "w", "t"]) for p in files[x]])) if x in files else None

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, left = -1, None
        for q in (int(q) for b in batches for q in b["id"]):
            u = (math.isqrt(8 * q + 1) - 1) // 2  # pairs of blocks in rows of 1, 2, 3, ...
            y = q - u * (u + 1) // 2
            if u != x:
                x, left = u, side(u)
            right = left if x == y else side(y)
            if left is None or right is None:
                continue
            (ni, ti, *a), (nj, tj, *b) = left, right
            s, common = block_minima(len(ni), a, len(nj), b)
            if x == y:
                common = np.triu(common, 1)  # names are sorted
            p, o = np.nonzero(common)
            i, j = ni[p], nj[o]
            swap = i > j
            yield pd.DataFrame({"i": np.where(swap, j, i), "j": np.where(swap, i, j), "s": s[p, o], "t": ti[p] + tj[o]})

    pairs = blocks * (blocks + 1) // 2
    return spark.range(0, pairs, 1, min(pairs, max(partitions_of(spark), min(pairs // 8, 10_000)))).mapInPandas(sums, f"i {kind}, j {kind}, s double, t double")


def _side(d: pd.DataFrame) -> tuple:
    d = d.sort_values("f", kind="stable")
    names, at = np.unique(d["sample"].to_numpy(), return_inverse=True)
    total = np.zeros(len(names))
    total[at] = d["t"]
    f, first = np.unique(d["f"].to_numpy(), return_index=True)
    return names, total, at, d["v"].to_numpy(), d["w"].to_numpy(), f, np.append(first, len(d))


def block_minima(n: int, left: list, m: int, right: list) -> tuple[np.ndarray, np.ndarray]:
    """Sums of weighted minima of ``n`` by ``m`` samples, and which pairs have a feature in common.

    A feature that many samples of both sides have is a whole column on each side, so its minima are one plain matrix
    operation; only features of few samples pay for looking up where they belong.
    """
    ai, vi, wi, fi, ei = left
    aj, vj, _, fj, ej = right
    s, common, buffer = np.zeros((n, m)), np.zeros((n, m), dtype=bool), np.empty((n, m))
    x, y = np.zeros(n), np.zeros(m)
    for p, q in zip(*np.intersect1d(fi, fj, assume_unique=True, return_indices=True)[1:], strict=True):
        k, o = slice(ei[p], ei[p + 1]), slice(ej[q], ej[q + 1])
        rows, cols = ai[k], aj[o]
        if len(rows) * len(cols) * 4 > n * m:
            x[:], y[:] = 0.0, 0.0
            x[rows], y[cols] = wi[ei[p]] * vi[k], wi[ei[p]] * vj[o]
            np.minimum(x[:, None], y[None], out=buffer)
            s += buffer
            if len(rows) * len(cols) == n * m:
                common[:] = True
            else:
                common[np.ix_(rows, cols)] = True
        else:
            at = np.ix_(rows, cols)
            s[at] += wi[ei[p]] * np.minimum(vi[k][:, None], vj[o][None])
            common[at] = True
    return s, common


def sums_of_minima(v: DataFrame, block: int = 512, pair_cost: float = 4.0) -> DataFrame:
    """``i, j, s`` by the cheaper of the two kernels, from counts of the table itself.

    The join emits a row for every feature and pair of samples that share it, ``sum(k * (k - 1) / 2)`` rows; the blocks read
    every row in as many tasks as there are blocks and compare whole blocks, which costs no shuffle. ``pair_cost``
    is what a joined row costs against a read one.
    """
    v = Stage(v.sparkSession).put(v)
    per = v.groupBy("feature").agg(F.count("*").alias("k"))
    joined, rows = per.agg(F.coalesce(F.sum(F.col("k") * (F.col("k") - 1) / 2), F.lit(0.0)), F.coalesce(F.sum("k"), F.lit(0))).head()
    blocks = v.select("sample").distinct().count() / block + 1
    if joined * pair_cost <= rows * blocks:
        return pair_sums(v)
    return block_sums(v.withColumn("t", F.lit(0.0)), block).select("i", "j", "s")


def all_pairs(samples: DataFrame, common: DataFrame, limit: int = 5000) -> DataFrame:
    """Every pair of a sampled set of at most ``limit``, which is checked, with ``s`` 0 where nothing is in common."""
    n = samples.count()
    if n > limit:
        raise ValueError(f"{n} samples; draw at most {limit}, or take the pairs with something in common: all others have distance 1")
    a, b = samples.select(F.col("sample").alias("i")), samples.select(F.col("sample").alias("j"))
    return a.join(b, F.col("i") < F.col("j")).join(common, ["i", "j"], "left").select("i", "j", F.coalesce("s", F.lit(0.0)).alias("s"))


def bray_curtis(shares: DataFrame, every_pair: bool = False) -> DataFrame:
    """``i, j, dist`` from ``sample, feature, share``; without ``every_pair`` only pairs with a common feature."""
    s = sums_of_minima(shares.select("sample", "feature", F.col("share").alias("v"), F.lit(1.0).alias("w")))
    if every_pair:
        s = all_pairs(shares.select("sample").distinct(), s)
    return s.select("i", "j", (1 - F.col("s")).alias("dist"))


def node_mass(shares: DataFrame, nodes: DataFrame, tips: DataFrame) -> DataFrame:
    """``sample, feature, v, w``: mass below every node and the node's branch length; ``tips`` maps ``feature`` to ``node``."""
    up = closure(nodes, tips).select("node", "ancestor").join(clean(nodes).select(F.col("node").alias("ancestor"), F.col("length").alias("w")), "ancestor")
    m = shares.join(tips.select("feature", "node"), "feature").join(up, "node")
    return m.groupBy("sample", F.col("ancestor").alias("feature"), "w").agg(F.sum("share").alias("v")).filter(F.col("w") > 0)


def _numbered(nodes: DataFrame, tips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tree and its tips with numbers for names; a parent that is no node is none."""
    ids = Stage(nodes.sparkSession).put(number_rows(nodes.select("node").distinct(), "node").select("node", F.col("row_number").cast("int").alias("id")))
    up = ids.select(F.col("node").alias("parent"), F.col("id").alias("up"))
    n = nodes.join(ids, "node").join(up, "parent", "left").select(F.col("id").alias("node"), F.col("up").alias("parent"), "length")
    return n, tips.join(ids, "node").select("feature", F.col("id").alias("node"))


def weighted_unifrac(shares: DataFrame, nodes: DataFrame, tips: DataFrame, every_pair: bool = False) -> DataFrame:
    """``i, j, dist``: weighted UniFrac divided by the sum of both samples' path masses; without ``every_pair`` as in ``bray_curtis``."""
    if not every_pair:
        nodes, tips = _numbered(nodes, tips)  # so no names are shuffled
    v = node_mass(shares, nodes, tips)
    if not every_pair:  # it is read several times
        drop_shuffles(v.sparkSession)
        v = Stage(v.sparkSession).put(v)
        drop_shuffles(v.sparkSession)
    t = v.groupBy("sample").agg(F.sum(F.col("w") * F.col("v")).alias("t"))
    if not every_pair:
        return block_sums(v.join(t, "sample")).select("i", "j", (1 - 2 * F.col("s") / F.nullif(F.col("t"), F.lit(0.0))).alias("dist"))
    s = all_pairs(shares.select("sample").distinct(), pair_sums(v))
    j = s.join(t.select(F.col("sample").alias("i"), F.col("t").alias("ti")), "i").join(t.select(F.col("sample").alias("j"), F.col("t").alias("tj")), "j")
    return j.select("i", "j", (1 - 2 * F.col("s") / F.nullif(F.col("ti") + F.col("tj"), F.lit(0.0))).alias("dist"))


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two vectors of equal length."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))


def audit(pairs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Range, middle and faults of distances. With ``samples``, over all their pairs: those that are not listed have
    distance 1 and come in as one row with their number."""
    d = F.col("dist").cast("double")
    p = pairs.select(d.alias("dist"), F.lit(1).cast("long").alias("k"))
    stage = Stage(pairs.sparkSession)
    p = stage.put(p)
    if samples is not None:
        n = samples.select("sample").distinct().agg((F.count("*") * (F.count("*") - 1) / 2).cast("long").alias("all"))
        rest = n.crossJoin(p.agg(F.count("*").alias("listed"))).select(F.lit(1.0).alias("dist"), (F.col("all") - F.col("listed")).alias("k")).filter("k > 0")  # one row by one row
        p = p.unionByName(rest)
    times = lambda c: F.coalesce(F.sum(F.when(c, F.col("k"))), F.lit(0)).cast("long")
    stats = p.agg(F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("pairs"), F.min("dist").alias("least"), F.max("dist").alias("most"), times(F.isnan("dist") | F.col("dist").isNull()).alias("unknown"), times((F.col("dist") < -1e-3) | (F.col("dist") > 1.001)).alias("out_of_range"))
    return add_quantiles(stats, p, {"mid": ("dist", 0.5)}, weight="k")


def compare(pairs: DataFrame, truth: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Two tables of distances: pairs in both, greatest difference, pairs beyond the tolerance."""
    j = pairs.select("i", "j", F.col("dist").alias("a")).join(truth.select("i", "j", F.col("dist").alias("b")), ["i", "j"])
    return j.agg(F.count("*").alias("pairs"), F.max(F.abs(F.col("a") - F.col("b"))).alias("worst"), F.count_if(F.abs(F.col("a") - F.col("b")) > tolerance).alias("beyond"))


def by_bucket(pairs: DataFrame, bucket: str, value: str) -> DataFrame:
    """Mean and median of one distance per value of another, and whether the mean rises."""
    p = Stage(pairs.sparkSession).put(pairs.select(bucket, value))
    g = add_quantiles(p.groupBy(bucket).agg(F.count("*").alias("pairs"), F.avg(value).alias("mean")), p, {"mid": (value, 0.5)}, [bucket])
    return g.withColumn("rises", F.coalesce(F.col("mean") >= F.lag("mean").over(W.orderBy(bucket)), F.lit(True)))  # one row per bucket


def agreement(pairs: DataFrame, got: str, wanted: str) -> DataFrame:
    """Correlation and mean relative deviation of pairs with a positive wanted distance."""
    p = pairs.filter(F.col(wanted) > 0)
    return p.agg(F.count("*").alias("pairs"), F.corr(got, wanted).alias("pearson"), F.avg(F.abs(F.col(got) - F.col(wanted)) / (F.col(wanted) + 1e-9)).alias("relative_deviation"))
