"""Percentiles from cumulative frequencies, by day and, from the days' results, over all days.

``daily_counts`` reduces the rows to (group, day, metric, value, n). Values keep ``digits`` significant digits, so a group
and day has at most ``9 * 10 ** (digits - 1)`` values per power of ten, however many rows it has; these counts are a day's
result, and adding the counts of days (or partitions) gives the counts of all. ``percentiles`` range-sorts the counts, adds
the sums of the partitions before to running sums in each partition, and picks the first value that reaches each rank.

The error: a value below ``10 ** digits`` is exact. A greater one is given as the middle of its step, so a percentile is off
by at most ``0.5 * 10 ** (1 - digits)`` of itself (0.05 % for 4 digits). The rank itself is exact: percentile p of n values
is the value of rank ``ceil(p * n)``, at least 1. Combining days adds no further error.

A sample delivered again on a later day changes the result of the day it first came on. ``restatement`` gives the change of
the days' results: the counts of the new rows, and negative counts of the rows that they replace. Stored results and changes
are added like days; what cancels out vanishes.

Defined cases: of rows with equal id the one loaded last counts (ties: the greater values, then the earlier day); rows
without id count each by its own values; groups are compared trimmed and without case, missing ones are ``(none)``;
rows without a day form a day of their own, NULL, and count over all days; NULL and negative counts are no values and are reported as ``n_null`` and ``n_negative``;
zero is a value. Empty input gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.text import key_or_null
from corpusweave.session import cut_lineage

DIGITS = 4


def step(v: Column, digits: int) -> Column:
    """The width of the step in which a count falls: 1 below ``10 ** digits``."""
    size = F.length(v.cast("string"))
    return F.when(size <= digits, F.lit(1).cast("long")).otherwise(F.rpad(F.lit("1"), size - digits + 1, "0").cast("long"))


def kept(df: DataFrame, id_col: str, at: str, loaded: str, group: str, metrics: Sequence[str]) -> DataFrame:
    """``id, r``: one row per id, the one loaded last, and all rows without id. No window: a maximum over a struct."""
    order = F.struct(F.col(loaded).alias("l"), *(F.col(m).cast("long").alias(m) for m in metrics), (-F.unix_micros(F.col(at).cast("timestamp"))).alias("t"), F.coalesce(key_or_null(F.col(group)), F.lit("(none)")).alias("grp"), F.to_date(at).alias("day"))
    return _best(df.select(F.col(id_col).cast("string").alias("id"), order.alias("r")))


def _best(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("r").alias("r")).unionByName(rows.filter(F.col("id").isNull()))


def fields(rows: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``grp, day`` and the metrics of kept rows."""
    return rows.select("r.grp", "r.day", *(f"r.{m}" for m in metrics))


def latest(df: DataFrame, id_col: str, at: str, loaded: str, group: str, metrics: Sequence[str]) -> DataFrame:
    """``grp, day`` and the metrics of the row of every id that was loaded last."""
    return fields(kept(df, id_col, at, loaded, group, metrics), metrics)


def restatement(stored: DataFrame, delivered: DataFrame, metrics: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """What the delivery of ``delivered`` changes in the days' results of ``stored`` (both as ``kept`` gives them): counts to
    be added to these, negative where a row is replaced. Only rows of ids that are delivered again are looked at."""
    again = delivered.filter(F.col("id").isNotNull()).select("id")
    old = stored.join(again, "id", "left_semi")
    new = daily_counts(fields(_best(old.unionByName(delivered)), metrics), metrics, digits)
    gone = daily_counts(fields(old, metrics), metrics, digits).withColumn("n", -F.col("n"))
    return new.unionByName(gone).groupBy("grp", "day", "metric", "value").agg(F.sum("n").alias("n")).filter("n <> 0")


def daily_counts(rows: DataFrame, metrics: Sequence[str], digits: int = DIGITS) -> DataFrame:
    """``grp, day, metric, value, n``: a day's result. ``value`` is NULL for missing, -1 for negative, else the step's start."""
    long = rows.select("grp", "day", F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("v")) for m in metrics))))
    v = F.col("v")
    value = F.when(v < 0, F.lit(-1).cast("long")).otherwise(v - v % step(v, digits))
    return long.select("grp", "day", "metric", value.alias("value")).groupBy("grp", "day", "metric", "value").agg(F.count("*").alias("n"))


def percentiles(counts: DataFrame, keys: Sequence[str], probs: Sequence[float], digits: int = DIGITS) -> DataFrame:
    """Per key: ``n, n_null, n_negative`` and a column per percentile (``p50`` for 0.5)."""
    keys = list(keys)
    merged = counts.groupBy(*keys, "value").agg(F.sum("n").alias("n")).filter("n <> 0")
    stats = merged.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(a) for c, a in ((F.col("value") >= 0, "n"), (F.col("value").isNull(), "n_null"), (F.col("value") < 0, "n_negative"))))
    # the partition number is kept with the rows: range bounds drawn a second time could differ
    placed = cut_lineage(merged.filter(F.col("value") >= 0).repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()))
    before = W.partitionBy(*keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # one row per group and partition: the counts before the partition, and the group's total beside them
    offset = placed.groupBy(*keys, "part").agg(F.sum("n").alias("s")).select(*keys, "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("before"), F.sum("s").over(W.partitionBy(*keys)).alias("total"))
    running = F.sum("n").over(W.partitionBy(*keys, "part").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranks = placed.withColumn("upto", running).alias("l").join(offset.alias("r"), _same([*keys, "part"])).select("l.*", "r.before", "r.total").withColumn("upto", F.col("upto") + F.col("before"))

    def rank(p: float) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.round(F.lit(p) * F.col("total"), 6)))

    w = step(F.col("value"), digits)
    value = F.col("value") + F.when(w > 1, w / 2).otherwise(0.0)
    hits = [F.max(F.when((rank(p) > F.col("upto") - F.col("n")) & (rank(p) <= F.col("upto")), value)).alias(f"p{round(p * 100):02d}") for p in probs]
    picked = ranks.groupBy(*keys).agg(*hits)
    both = stats.alias("l").join(picked.alias("r"), _same(keys), "left")
    return both.select(*(f"l.{k}" for k in keys), "n", "n_null", "n_negative", *(f"p{round(p * 100):02d}" for p in probs))


def _same(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return out
