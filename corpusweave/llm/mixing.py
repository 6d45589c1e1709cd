"""Mixing sources to target weights.

Sizes are tokens. A source of own size s that shall give t tokens needs t / s copies of each document: the whole copies are
certain, the rest is a sample without replacement by Pareto order sampling with unequal probabilities. A document of size x
has the inclusion probability ``min(1, c * x ** power)``, where c is such that the expected size of the source's sample is
what it still has to give. ``power`` 0 treats documents alike, 1 treats tokens alike; the default lies between, so that a
source full of scraps is not represented by scraps. Every document gets the odds of a uniform number divided by the odds of
its inclusion probability, documents are taken in that order, and the sample's size is fixed in tokens: the last document
taken is the one whose middle still lies below the wanted sum, so a source misses its target by less than one document.

A source whose documents, each repeated ``max_repeats`` times, fall short of its weight gives all it may, and what it lacks
is given to the other sources in proportion to their weights, so that the mix is as large as all documents of the listed
sources wherever that can be reached.

Scale: the driver gets the number and tokens of the documents per source and size class (two leading digits), at most 90
rows a decade for each of at most ``MAX_SOURCES`` sources. The order is cut without sorting a source in one place: the
ratios fall into slices, whose number follows from the number of documents, token sums per source and slice name the slice
in which the cut lies, and only that slice is sorted. Pareto ratios are spread evenly enough around the cut that a slice
holds about ``slice_rows`` documents however large the source.

Defined cases: sources are compared trimmed and without case; documents of unlisted or missing sources take no
part; documents without tokens (NULL and empty texts) are never drawn; a listed source without documents gives nothing and
is reported; a weight or cap that is NULL or negative counts as 0; a source listed twice takes its first row by weight.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.text import key_or_null
from corpusweave.llm.tokenizer import token_counts
from corpusweave.operators.ranking import uniform
from corpusweave.session import Stage

MAX_SOURCES = 10_000


def allot(weights: dict[str, float], sizes: dict[str, int], caps: dict[str, int]) -> dict[str, float]:
    """Tokens wanted of each source: its weight of the whole, at most size times cap, shortfalls passed on by weight."""
    total = float(sum(sizes.get(s, 0) for s in weights))
    most = {s: float(sizes.get(s, 0) * caps[s]) for s in weights}
    got = dict.fromkeys(weights, 0.0)
    left, open_ = total, {s for s in weights if weights[s] > 0 and most[s] > 0}
    while open_ and left > 1e-9 * max(total, 1):
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if got[s] + unit * weights[s] >= most[s]}
        for s in full or open_:
            new = most[s] if full else got[s] + unit * weights[s]
            left -= new - got[s]
            got[s] = new
        if not full:
            break
        open_ -= full
    return got


def scale(sizes: np.ndarray, tokens: np.ndarray, wanted: float, power: float) -> float:
    """The factor c with ``sum(min(1, c * size ** power) * tokens) == wanted``, over size classes; infinite if all are needed."""
    if wanted >= tokens.sum():
        return math.inf
    order = np.argsort(-sizes)  # the largest reach probability 1 first
    x, t = sizes[order].astype(float) ** power, tokens[order].astype(float)
    sure = np.append(0.0, np.cumsum(t))
    rest = np.append(np.cumsum((x * t)[::-1])[::-1], 0.0)
    for k in range(len(x)):  # the first k classes are certain
        c = float(max(0.0, wanted - sure[k]) / rest[k])
        if c * x[k] <= 1:
            return c
    return math.inf


def size_class(tokens: Column) -> Column:
    """The size with its two leading digits kept."""
    step = F.pow(F.lit(10.0), F.greatest(F.length(tokens.cast("string")) - 2, F.lit(0))).cast("long")
    return tokens - tokens % step


class Mix:
    """The plan of a mix; ``documents`` and ``report`` give its parts."""

    def __init__(self, docs: DataFrame, targets: DataFrame, path: str | None = None, seed: int = 42, power: float = 0.5, slice_rows: int = 16_384):
        self.spark, self.power = docs.sparkSession, power
        rows = targets.select("source", "target_weight", "max_repeats", key_or_null(F.col("source")).alias("k")).limit(MAX_SOURCES + 1).collect()
        if len(rows) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources are listed")
        self.names, self.weights, self.caps = {}, {}, {}
        for r in sorted((r for r in rows if r.k is not None), key=lambda r: -(r.target_weight or 0)):
            if r.k not in self.names:
                self.names[r.k], self.weights[r.k], self.caps[r.k] = r.source, max(r.target_weight or 0.0, 0.0), max(r.max_repeats or 0, 0)
        listed = self.spark.createDataFrame([(k,) for k in self.names], "k string")
        d = docs.select("doc_id", "text", key_or_null(F.col("source")).alias("k"))
        d = d.join(F.broadcast(listed), "k", "left_semi")  # at most MAX_SOURCES names
        sized = token_counts(d, "doc_id", "text", ("k",), path).filter(F.col("tokens") > 0)
        self.sized = Stage(self.spark).put(sized.select(F.col("id").alias("doc_id"), F.col("k"), F.col("tokens").cast("long").alias("tokens"), uniform(seed, "id").alias("u")))
        classes = self.sized.groupBy("k", size_class(F.col("tokens")).alias("size")).agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
        found: dict[str, list[tuple[int, int, int]]] = {}
        for r in classes.collect():  # at most 90 rows a source and decade
            found.setdefault(r["k"], []).append((r["size"], r["t"], r["n"]))
        self.sizes = {k: sum(c[1] for c in found.get(k, ())) for k in self.names}
        self.counts = {k: sum(c[2] for c in found.get(k, ())) for k in self.names}
        self.total = sum(self.sizes.values())
        self.slices = max(64, math.ceil(sum(self.counts.values()) / slice_rows))
        self.wanted = allot(self.weights, self.sizes, self.caps)
        plan = []
        for k, size in self.sizes.items():
            if size:
                whole = min(math.floor(self.wanted[k] / size + 1e-9), self.caps[k])
                rest = max(0.0, self.wanted[k] - whole * size) if whole < self.caps[k] else 0.0
                own = np.array(found[k], dtype=np.int64)
                plan.append((k, self.names[k], whole, rest, scale(own[:, 0], own[:, 1], rest, power)))
        self.plan = self.spark.createDataFrame(plan, "k string, source string, whole int, rest double, c double")  # one row per source

    def ranked(self) -> DataFrame:
        """``sized`` with ``whole, rest``, the inclusion probability ``pi`` and ``v`` in [0, 1], which grows with the ratio of odds."""
        d = self.sized.join(F.broadcast(self.plan), "k")
        d = d.withColumn("pi", F.least(F.lit(1.0), F.when(F.col("rest") > 0, F.col("c") * F.pow(size_class(F.col("tokens")).cast("double"), F.lit(self.power))).otherwise(F.lit(0.0))))
        # q = (u / (1 - u)) / (pi / (1 - pi)); v = q / (1 + q)
        a, b = F.col("u") * (1 - F.col("pi")), F.col("pi") * (1 - F.col("u"))
        return d.withColumn("v", F.when(F.col("pi") <= 0, F.lit(1.0)).otherwise(a / (a + b)))

    def documents(self) -> DataFrame:
        """``doc_id, source, tokens, copies, pi`` of the documents drawn at least once; ``pi`` is that of the copy that is not certain."""
        d = self.ranked().withColumn("slice", F.least(F.floor(F.col("v") * self.slices), F.lit(self.slices - 1)).cast("int"))
        sums = d.filter("rest > 0").groupBy("k", "slice", "rest").agg(F.sum("tokens").alias("t"))
        sums = sums.withColumn("upto", F.sum("t").over(W.partitionBy("k").orderBy("slice")))
        cut = sums.filter(F.col("upto") >= F.col("rest")).groupBy("k").agg(F.min(F.struct("slice", (F.col("rest") - (F.col("upto") - F.col("t"))).alias("inside"))).alias("x"))
        cut = cut.select("k", F.col("x.slice").alias("cut"), F.col("x.inside").alias("inside"))  # one row per source
        d = d.join(F.broadcast(cut), "k", "left")
        edge = d.filter((F.col("slice") == F.col("cut")) & (F.col("rest") > 0))
        upto = F.sum("tokens").over(W.partitionBy("k").orderBy("v", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow))
        edge = edge.withColumn("more", (upto - F.col("tokens") / 2 <= F.col("inside")).cast("int"))
        # without a cut everything that is left is wanted
        rest = d.filter(~((F.col("slice") == F.coalesce("cut", F.lit(-1))) & (F.col("rest") > 0))).withColumn("more", ((F.col("rest") > 0) & F.coalesce(F.col("slice") < F.col("cut"), F.lit(True))).cast("int"))
        both = edge.unionByName(rest).withColumn("copies", F.col("whole") + F.col("more")).filter(F.col("copies") > 0)
        return both.select("doc_id", "source", "tokens", "copies", "pi")

    def report(self) -> DataFrame:
        """Per listed source: target and reached share, sizes, copies, and whether the target is out of reach.

        All but the targets and own sizes is counted from the drawn mix. A source is out of reach if the mix has all of its
        documents as often as it may, and that is less than its weight of the whole.
        """
        got = {r["source"]: r for r in self.documents().groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("t"), F.sum("copies").alias("c"), F.max("copies").alias("m")).collect()}  # one row per source
        size = sum(r["t"] for r in got.values()) or 1
        rows = []
        for k, s in self.names.items():
            r = got.get(s)
            t, c, m = (int(r["t"]), int(r["c"]), int(r["m"])) if r else (0, 0, 0)
            short = c == self.counts[k] * self.caps[k] and t < self.weights[k] * self.total
            rows.append((s, self.weights[k], self.caps[k], self.counts[k], self.sizes[k], t, c, m, t / size, short))
        return self.spark.createDataFrame(rows, "source string, target_weight double, max_repeats int, n_docs long, own_tokens long, mix_tokens long, mix_docs long, most_copies int, reached_share double, out_of_reach boolean")
