"""Sparse counts as long facts ``(sample, feature, n)`` with ``n > 0``: roll-up, quality control, shares, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.operators.skew import add_quantiles
from corpusweave.session import Stage


def facts(df: DataFrame, sample: str, feature: str, n: str) -> DataFrame:
    """Summed counts; zeros and missing counts are no facts. Sums are bigint, so an overflow cannot pass unseen."""
    out = df.groupBy(F.col(sample).alias("sample"), F.col(feature).alias("feature")).agg(F.sum(F.col(n).cast("bigint")).alias("n"))
    return out.filter(F.col("n") > 0)


def roll_up(f: DataFrame, lookup: DataFrame) -> DataFrame:
    """Facts per group: ``lookup`` maps ``feature`` to ``var_id``. Features without a group vanish (see ``loss``)."""
    joined = f.join(lookup.select("feature", "var_id"), "feature")
    return joined.groupBy("sample", F.col("var_id").alias("feature")).agg(F.sum("n").alias("n"))


def sample_totals(f: DataFrame) -> DataFrame:
    return f.groupBy("sample").agg(F.sum("n").alias("total_reads"), F.count("*").alias("n_taxa"))


def prevalence(f: DataFrame) -> DataFrame:
    return f.groupBy("feature").agg(F.count("*").alias("n_samples"))


def quality_control(f: DataFrame, min_reads: int = 1000, min_features: int = 5, keep: DataFrame | None = None) -> DataFrame:
    """Facts of the samples with at least ``min_reads`` and ``min_features``; ``keep`` first limits the features.

    A feature left without samples has no facts, so removing it changes no sample: the fixed point needs no loop.
    One shuffle by sample serves both the totals and the filter.
    """
    if keep is not None:
        f = f.join(keep.select("feature").distinct(), "feature", "left_semi")
    w = W.partitionBy("sample")
    out = f.withColumn("__cw_t", F.sum("n").over(w)).withColumn("__cw_k", F.count("*").over(w))
    return out.filter((F.col("__cw_t") >= min_reads) & (F.col("__cw_k") >= min_features)).drop("__cw_t", "__cw_k")


def shares(f: DataFrame) -> DataFrame:
    """Adds each fact's share of its sample."""
    return f.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("sample")))


def feature_stats(f: DataFrame, features: DataFrame, n_samples: int | None = None) -> DataFrame:
    """Per feature of the vocabulary: samples, prevalence, share of the corpus, mean share where present (0 if never).

    The corpus totals come from one aggregate row, which is joined back by broadcast: one row whatever the input.
    """
    w = W.partitionBy("sample")
    s = f.withColumn("share", F.col("n") / F.sum("n").over(w)).withColumn("first", (F.col("feature") == F.min("feature").over(w)).cast("long"))
    # a sample is counted at its least feature, so the number of samples needs no pass of its own
    per = s.groupBy("feature").agg(F.count("*").alias("n_samples_observed"), F.sum("n").alias("mass"), F.avg("share").alias("mean_share"), F.sum("first").alias("firsts"))
    whole = per.agg(F.sum("mass").alias("all_mass"), (F.coalesce(F.sum("firsts"), F.lit(0)) if n_samples is None else F.lit(n_samples)).alias("n_obs"))
    out = features.select("feature").join(per, "feature", "left").join(F.broadcast(whole))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(
        "feature", F.col("mass").isNotNull().alias("observed"), z("n_samples_observed").alias("n_samples_observed"),
        (z("n_samples_observed") / F.greatest(F.col("n_obs"), F.lit(1))).alias("prevalence"), (z("mass") / F.greatest(F.coalesce("all_mass", F.lit(0)), F.lit(1))).alias("mass_fraction"), F.coalesce("mean_share", F.lit(0.0)).alias("mean_share_when_present"),
    )


def loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per sample: reads before and after and the fraction lost, 0 for empty samples."""
    a, b = before.groupBy("sample").agg(F.sum("n").alias("reads_in")), after.groupBy("sample").agg(F.sum("n").alias("reads_out"))
    out = a.join(b, "sample", "left").withColumn("reads_out", F.coalesce("reads_out", F.lit(0)))
    return out.withColumn("lost", F.coalesce((F.col("reads_in") - F.col("reads_out")) / F.nullif(F.col("reads_in"), F.lit(0)), F.lit(0.0)))


def loss_summary(per_sample: DataFrame) -> DataFrame:
    """Totals, percent lost, quantiles of the samples' losses, and how many lost more than half."""
    qs = (0.5, 0.75, 0.9, 0.95, 0.99)
    p = Stage(per_sample.sparkSession).put(per_sample.select("reads_in", "reads_out", "lost"))
    stats = p.agg(
        F.sum("reads_in").alias("reads_in"), F.sum("reads_out").alias("reads_out"), (100 * (F.sum("reads_in") - F.sum("reads_out")) / F.nullif(F.sum("reads_in"), F.lit(0))).alias("lost_percent"),
        F.max("lost").alias("worst"), F.count_if(F.col("lost") > 0.5).alias("over_half"),
    )
    return add_quantiles(stats, p, {f"q{round(q * 100)}": ("lost", q) for q in qs})


def first_rows(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of every key: a minimum over a struct, so that no key is gathered or sorted."""
    cols = [c for c in df.columns if c != key]
    rest = [c for c in cols if c not in order]
    best = df.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("__cw_r"))
    return best.select(key, *(F.col(f"__cw_r.{c}").alias(c) for c in cols))


def non_null_rates(df: DataFrame) -> DataFrame:
    """``column_name, rate`` in one pass over all columns."""
    one = df.agg(*(F.count(c).alias(c) for c in df.columns), F.count("*").alias("__n"))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), (F.col(c) / F.nullif(F.col("__n"), F.lit(0))).alias("rate")) for c in df.columns))
    return one.select(F.inline(pairs))
