"""A subset of given size that covers the variety of the data.

Records alike in all features form a group; groups are embedded as feature vectors, and mini-batch k-means clusters the
vectors. Every cluster gets a quota by the square root of its number of records (or an equal one), no more than it has;
what a cluster cannot use is handed to the others. Within a cluster the quota is dealt out over its groups in rounds, one
record per group and round, so a large group of like records gives no more than a small one until that one is used up. A
round that cannot reach all groups starts with those that lead a value of some feature, so that rare values come out first.

Scale: vectors and clusters are computed per group, not per record. The passes of k-means send sums per cluster (``k`` rows)
to the driver; the start of the clusters comes from at most ``init_rows`` groups, a documented bound of the model alone.
Quotas within clusters are found from the distribution of group sizes by windows over (cluster, size), and records are
ranked in slices of a random number, so neither a cluster nor a group is gathered in one task.

Defined cases: records are distinct ids; rows without id are left out; of several rows of an id the greatest values count.
Features are compared trimmed and without case, every spelling of missing is one value of its own (it marks a kind of
record too). A feature with several parts between bars is the mean of its parts. Ties go by hash, then by id. If the size
exceeds the records, all come out; with no records none do.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.text import is_missing, key_or_null
from corpusweave.operators.ranking import rank_in_bins, uniform
from corpusweave.session import Stage, cut_lineage

DIM = 24


def _token(name: str, seed: int) -> np.ndarray:
    v = np.random.default_rng([zlib.crc32(name.encode()), len(name), seed]).standard_normal(DIM)
    return v / np.linalg.norm(v)


def embed(groups: DataFrame, features: Sequence[str], weights: Sequence[float], seed: int) -> DataFrame:
    """Add ``vec``: the weighted sum of one random direction per feature value, scaled to length 1."""
    cols = groups.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, np.ndarray] = {}

        def of(f: str, value: str | None) -> np.ndarray:
            key = f"{f}={value}"
            if key not in known:
                if len(known) > 200_000:
                    known.clear()
                parts = sorted({p.strip() for p in value.split("|")}) if value is not None else [None]
                known[key] = np.mean([_token(f"{f}={p}", seed) for p in parts], axis=0)
            return known[key]

        for b in batches:
            total = np.zeros((len(b), DIM))
            for f, w in zip(features, weights, strict=True):
                total += w * np.array([of(f, v) for v in b[f].where(b[f].notna(), None)]).reshape(len(b), DIM)
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            b["vec"] = list((total / np.where(norm > 0, norm, 1)).astype(np.float32))
            yield b

    kinds = ", ".join(f"`{c}` {t}" for c, t in groups.dtypes)
    return groups.mapInPandas(run, f"{kinds}, vec array<float>").select(*cols, "vec")


def _nearest(vec: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None] - 2 * vec @ centres.T, axis=1)


def _start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over a bounded number of points."""
    rng = np.random.default_rng(seed)
    centres = [points[rng.choice(len(points), p=weights / weights.sum())]]
    far = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and far.max() > 1e-9:
        p = far * weights
        centres.append(points[rng.choice(len(points), p=p / p.sum())])
        far = np.minimum(far, ((points - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def mini_batch_kmeans(groups: DataFrame, k: int, batches: int = 4, rounds: int = 3, init_rows: int = 4096, seed: int = 42) -> np.ndarray:
    """Centres from ``vec`` weighted by the square root of ``n``. Each round goes once over all groups, batch by batch; the
    groups are written in folders by batch, so a step reads its own batch alone."""
    parts = Stage(groups.sparkSession).put(groups.select("vec", "n", "h", F.pmod(F.floor(F.col("h") * (1 << 20)), F.lit(batches)).cast("int").alias("batch")), "batch")
    first = parts.select("vec", "n", "h").orderBy("h").limit(init_rows).collect()  # bounded start of the model
    if not first:
        return np.zeros((0, DIM))
    centres = _start(np.array([r["vec"] for r in first], dtype=float), np.sqrt([r["n"] for r in first]), k, seed)
    seen = np.zeros(len(centres))
    for step in range(batches * rounds):

        def sums(it: Iterator[pd.DataFrame], c: np.ndarray = centres) -> Iterator[pd.DataFrame]:
            s, w = np.zeros_like(c), np.zeros(len(c))
            for b in it:
                if len(b):
                    v, n = np.array(b["vec"].tolist(), dtype=float), np.sqrt(b["n"].to_numpy(dtype=float))
                    own = _nearest(v, c)
                    np.add.at(s, own, v * n[:, None])
                    np.add.at(w, own, n)
            at = np.flatnonzero(w)
            yield pd.DataFrame({"cluster": at, "w": w[at], "s": list(s[at])})

        part = parts.filter(F.col("batch") == step % batches).select("vec", "n")
        own = part.mapInPandas(sums, "cluster int, w double, s array<double>").groupBy("cluster").agg(F.sum("w").alias("w"), *(F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(DIM)))
        for r in own.collect():  # k rows
            seen[r["cluster"]] += r["w"]
            mean = np.array([r[f"s{i}"] for i in range(DIM)]) / r["w"]
            centres[r["cluster"]] += (mean - centres[r["cluster"]]) * (r["w"] / seen[r["cluster"]])
    return centres


def quotas(sizes: dict[int, int], total: int, equal: bool = False) -> dict[int, int]:
    """Whole quotas by square root (or equal), none above its size, unused slots handed on; the sum is exact."""
    got, open_ = dict.fromkeys(sizes, 0), {c for c, s in sizes.items() if s > 0}
    left = min(total, sum(sizes.values()))
    while left > 0 and open_:
        weight = {c: 1.0 if equal else math.sqrt(sizes[c]) for c in open_}
        unit = left / sum(weight.values())
        raw = {c: min(unit * w, sizes[c] - got[c]) for c, w in weight.items()}
        add = {c: math.floor(x) for c, x in raw.items()}
        if not any(add.values()):  # fewer slots than clusters: one each, by remainder, then by size
            for c in sorted(open_, key=lambda c: (-raw[c], -sizes[c], c))[:left]:
                add[c] = 1
        for c, a in add.items():
            got[c] += a
            left -= a
        open_ = {c for c in open_ if got[c] < sizes[c]}
    return got


def varied_subset(df: DataFrame, id_col: str, features: Sequence[str], size: int | None = None, share: float = 0.02, k: int = 64, weights: Sequence[float] | None = None, equal: bool = False, seed: int = 42, slice_rows: int = 65_536) -> DataFrame:
    """``id, cluster`` and the features of the chosen records: ``size`` of them, or ``share`` of the distinct ids rounded down."""
    names = [f"f{i}" for i in range(len(features))]
    ids = df.filter(~is_missing(F.col(id_col).cast("string"))).groupBy(F.col(id_col).cast("string").alias("id")).agg(*(F.max(key_or_null(F.col(f).cast("string"))).alias(n) for f, n in zip(features, names, strict=True)))
    ids = cut_lineage(ids.withColumn("g", F.xxhash64(F.lit(seed), *(F.coalesce(F.concat(F.lit("v"), F.col(n)), F.lit("-")) for n in names))))
    total = ids.count()
    want = min(total, size if size is not None else math.floor(total * share + 1e-9))
    groups = ids.groupBy("g", *names).agg(F.count("*").alias("n")).withColumn("h", uniform(seed, "g"))
    groups = cut_lineage(embed(groups, names, weights or [1.0] * len(names), seed))
    centres = mini_batch_kmeans(groups, k, seed=seed)

    def assign(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            b["cluster"] = _nearest(np.array(b["vec"].tolist(), dtype=float).reshape(len(b), DIM), centres) if len(b) else []
            yield b[["g", *names, "n", "h", "cluster"]]

    kinds = ", ".join(f"{n} string" for n in names)
    # the first group of every value of a feature leads: in a round that does not reach all groups of a cluster, leaders come first
    leads = None
    for n in names:
        one = groups.groupBy(n).agg(F.min_by("g", "h").alias("g")).select("g")
        leads = one if leads is None else leads.unionByName(one)
    groups = groups.join(leads.distinct().withColumn("lead", F.lit(True)), "g", "left").withColumn("h", F.when(F.col("lead"), F.col("h") / 2).otherwise((1 + F.col("h")) / 2))
    placed = cut_lineage(groups.mapInPandas(assign, f"g long, {kinds}, n long, h double, cluster int"))
    found = placed.groupBy("cluster").agg(F.sum("n").alias("n"), F.count("*").alias("groups")).collect()  # k rows
    quota = quotas({r["cluster"]: r["n"] for r in found}, want, equal)
    plan = F.broadcast(df.sparkSession.createDataFrame([(r["cluster"], quota[r["cluster"]], math.ceil(r["groups"] / slice_rows)) for r in found], "cluster int, quota long, bins int"))

    # rounds: after r rounds a cluster has given sum(min(n, r)); find the last full round and what is left for the next
    by_size = placed.groupBy("cluster", "n").agg(F.count("*").alias("m"))
    up = W.partitionBy("cluster").orderBy("n").rowsBetween(W.unboundedPreceding, -1)
    level = by_size.select("cluster", "n", F.coalesce(F.sum(F.col("n") * F.col("m")).over(up), F.lit(0)).alias("used"), F.coalesce(F.max("n").over(up), F.lit(0)).alias("prev"), F.sum("m").over(W.partitionBy("cluster").orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, W.currentRow)).alias("open"))
    level = level.join(plan, "cluster").filter((F.col("used") + F.col("prev") * F.col("open") <= F.col("quota")) & (F.col("quota") < F.col("used") + F.col("n") * F.col("open")))
    spare = F.col("quota") - F.col("used")
    level = level.select("cluster", "bins", F.floor(spare / F.col("open")).cast("long").alias("full"), (spare % F.col("open")).cast("long").alias("extra"))
    # a cluster that gives all it has reaches no such level
    seats = placed.join(F.broadcast(level), "cluster", "left")
    ranked = rank_in_bins(seats.filter(F.col("n") > F.col("full")), ["cluster"], "h", ["g", *names], F.col("bins")).select("g", *names, "n", "cluster", (F.col("full") + (F.col("rank") <= F.col("extra")).cast("long")).alias("seats"))
    whole = seats.filter(F.coalesce(F.col("n") <= F.col("full"), F.lit(True))).select("g", *names, "n", "cluster", F.col("n").alias("seats"))
    seats = ranked.unionByName(whole).filter(F.col("seats") > 0)
    # groups with more than a thousandth of the records, at most 1000 of them, are met by broadcast: their rows are not shuffled
    big = F.col("n") > max(total, 1) / 1000
    hot = F.broadcast(placed.filter(big).select("g", *names, F.lit(True).alias("hot")))
    marked = ids.alias("a").join(hot.alias("b"), (F.col("a.g") == F.col("b.g")) & _all_same(names), "left").select("a.*", "b.hot")
    hot_seats, cold_seats = F.broadcast(seats.filter(big)), seats.filter(~big)
    on = (F.col("a.g") == F.col("b.g")) & _all_same(names)
    cols = ["a.id", "a.g", *(F.col(f"a.{n}").alias(n) for n in names), "b.n", "b.cluster", "b.seats"]
    rows = marked.filter("hot").alias("a").join(hot_seats.alias("b"), on).select(*cols).unionByName(marked.filter("hot IS NULL").alias("a").join(cold_seats.alias("b"), on).select(*cols)).withColumn("u", uniform(seed, "id"))
    chosen = rank_in_bins(rows, ["g", *names], "u", ["id"], F.ceil(F.col("n") / slice_rows)).filter(F.col("rank") <= F.col("seats"))
    return chosen.select("id", "cluster", *(F.col(n).alias(f) for f, n in zip(features, names, strict=True)))


def _all_same(names: list[str]):
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    return same
