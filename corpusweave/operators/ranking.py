"""Random orders and ranks that never bring a whole group together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

_BITS = 52


def uniform(seed: int, *cols: str) -> Column:
    """A number in [0, 1) from the hash of the seed and the columns: the same row gets the same number on every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *(F.col(c) for c in cols)), 64 - _BITS) / F.lit(float(1 << _BITS))


def rank_in_bins(df: DataFrame, keys: list[str], u: str, ties: list[str], bins: Column, out: str = "rank") -> DataFrame:
    """Add ``out`` from 1 in the order of ``u`` (in [0, 1)), then ``ties``, per key.

    A key's rows are dealt into ``bins`` equal slices of [0, 1). Rows are numbered inside a slice and the number of rows in
    the slices before is added, so a hot key is sorted by as many tasks as it has slices. ``bins`` must be the same for all
    rows of a key.
    """
    d = df.withColumn("__cw_bin", F.floor(F.col(u) * bins).cast("int"))
    counts = d.groupBy(*keys, "__cw_bin").agg(F.count("*").alias("__cw_n"))
    before = W.partitionBy(*keys).orderBy("__cw_bin").rowsBetween(W.unboundedPreceding, -1)
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "__cw_bin"]]
    offsets = counts.select(*keys, "__cw_bin", F.coalesce(F.sum("__cw_n").over(before), F.lit(0)).alias("__cw_before"))
    d = d.withColumn("__cw_rn", F.row_number().over(W.partitionBy(*keys, "__cw_bin").orderBy(u, *ties)))
    on = same[0]
    for s in same[1:]:
        on = on & s
    both = d.alias("d").join(offsets.alias("o"), on)
    return both.select(*(F.col(f"d.{c}") for c in df.columns), (F.col("__cw_rn") + F.col("__cw_before")).alias(out))
