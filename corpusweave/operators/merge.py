"""Merging corpora, expanding vocabularies, patches, and the checks around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def prefix_columns(df: DataFrame, prefix: str, common: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in common})


def merge_samples(parts: dict[str, DataFrame], common: Sequence[str]) -> DataFrame:
    """Rows appended; columns outside ``common`` get their source's prefix and are NULL in the others' rows."""
    out = None
    for prefix, df in parts.items():
        d = prefix_columns(df, prefix, common)
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def merge_facts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def set_sizes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of both, shared and one-sided keys, in one full aggregate instead of three set operations."""
    both = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).union(right.select(key, F.lit(0), F.lit(1))).groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return both.agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"), F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("n_both"), F.count_if(F.col("r") == 0).alias("only_left"), F.count_if(F.col("l") == 0).alias("only_right"), F.count("*").alias("n_union"))


def key_differences(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Keys that are not in all of the tables, with the names of those that lack them."""
    marks = None
    for name, df in tables.items():
        d = df.select(F.col(key), F.lit(name).alias("t")).distinct()
        marks = d if marks is None else marks.unionByName(d)
    names = F.array(*map(F.lit, sorted(tables)))
    got = marks.groupBy(key).agg(F.collect_set("t").alias("have"))  # at most one entry per table
    return got.select(key, F.array_join(F.array_sort(F.array_except(names, F.col("have"))), ",").alias("missing_in")).filter(F.col("missing_in") != "")


def expand_vocabulary(features: DataFrame, vocabulary: DataFrame, key: str = "feature") -> DataFrame:
    """The features as observed, and those of the vocabulary that are absent as not observed. Facts stay as they are."""
    have = features.select(key).distinct()
    more = vocabulary.select(key).distinct().join(have, key, "left_anti")
    return have.withColumn("observed", F.lit(True)).unionByName(more.withColumn("observed", F.lit(False)))


def cross_source_ids(df: DataFrame, run: str, source: str) -> DataFrame:
    """Adds ``pair_id``: the run where it occurs in at least two sources, else NULL."""
    shared = df.filter(F.col(run).isNotNull()).groupBy(run).agg(F.count_distinct(source).alias("__cw_n")).filter(F.col("__cw_n") >= 2).select(F.col(run).alias("__cw_run"))
    return df.join(shared, F.col(run) == F.col("__cw_run"), "left").withColumn("pair_id", F.col("__cw_run")).drop("__cw_run")


def schema_difference(left: Sequence[str], right: Sequence[str]) -> dict[str, list[str]]:
    return {"common": [c for c in left if c in right], "only_left": [c for c in left if c not in right], "only_right": [c for c in right if c not in left]}


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """All keys that occur more than once, with their number."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


def apply_patch(base: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """The patch's columns replace those of the rows with its keys, NULLs included; other rows stay as they are."""
    cols = [c for c in patch.columns if c != key and c in base.columns]
    p = patch.select(key, *(F.col(c).alias(f"__cw_p_{c}") for c in cols), F.lit(True).alias("__cw_hit"))
    out = base.join(p, key, "left")
    return out.select(*(F.when(F.col("__cw_hit"), F.col(f"__cw_p_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns))


def audit(before: DataFrame, after: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """``column_name, changed``: rows per column whose value differs, NULL being equal to NULL."""
    j = before.select(key, *(F.col(c).alias(f"__cw_b_{c}") for c in cols)).join(after.select(key, *cols), key)
    one = j.agg(*(F.count_if(~F.col(f"__cw_b_{c}").eqNullSafe(F.col(c))).alias(c) for c in cols))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("changed")) for c in cols))))


def number_rows(df: DataFrame, *order: str) -> DataFrame:
    """``row_number`` over the whole table without one sorting task: range partitions are numbered and offset.

    The order must be unique. The partition number is written out, because a second range partitioning may cut elsewhere.
    """
    from corpusweave.session import cut_lineage

    placed = cut_lineage(df.repartitionByRange(*order).withColumn("__cw_part", F.spark_partition_id()))
    sizes = placed.groupBy("__cw_part").agg(F.count("*").alias("__cw_n"))
    before = sizes.select("__cw_part", F.coalesce(F.sum("__cw_n").over(W.orderBy("__cw_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__cw_before"))
    out = placed.withColumn("__cw_rn", F.row_number().over(W.partitionBy("__cw_part").orderBy(*order))).join(F.broadcast(before), "__cw_part")
    return out.select(*df.columns, (F.col("__cw_rn") + F.col("__cw_before")).alias("row_number"))
