"""Stratified, two-level and paired samples with square-root quotas.

Quotas are worked out from group sizes on the driver (at most ``MAX_STRATA`` groups, checked). Which rows fill a quota is
decided by the md5 of seed and id, so every engine draws the same rows; ranks are found in slices of that order, so a large
stratum is spread over many tasks. Rows without an id are left out; a NULL stratum is a stratum of its own.
"""

from __future__ import annotations

import math
from collections.abc import Hashable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.operators.expect import ExpectationError
from corpusweave.operators.merge import number_rows
from corpusweave.operators.ranking import rank_in_bins
from corpusweave.session import Stage

MAX_STRATA = 100_000
SLICE_ROWS = 65_536


def allocate(sizes: Mapping[Hashable, int], total: int, spread: str = "greedy") -> dict:
    """Quotas by square root of size: whole parts, then the largest remainders, none above its size.

    What a full group cannot take goes to the others in the order of their remainders: ``greedy`` fills each in turn,
    ``even`` gives one to each per pass. ``greedy`` returns every size if the total is not less than their sum. Remainders
    equal to nine digits go by the group's name.
    """
    if total <= 0 or not sizes:
        return dict.fromkeys(sizes, 0)
    if spread == "greedy" and total >= sum(sizes.values()):
        return dict(sizes)
    root = {g: math.sqrt(max(n, 1)) for g, n in sizes.items()}
    whole = sum(root.values())
    raw = {g: r / whole * total for g, r in root.items()}
    quota = {g: math.floor(round(x, 9)) for g, x in raw.items()}
    order = sorted(sizes, key=lambda g: (-round(raw[g] - quota[g], 9), _name(g)))
    for g in order[: total - sum(quota.values())]:
        quota[g] += 1
    excess = sum(max(0, quota[g] - n) for g, n in sizes.items())
    quota = {g: min(q, sizes[g]) for g, q in quota.items()}
    while excess > 0:
        room = [g for g in order if quota[g] < sizes[g]]
        if not room:
            break
        for g in room:
            give = min(excess, sizes[g] - quota[g] if spread == "greedy" else 1)
            quota[g] += give
            excess -= give
    return quota


def _name(group: Hashable) -> str:
    return "\0".join(map(str, group)) if isinstance(group, tuple) else str(group)


def draw_order(seed: int, id_col: str) -> Column:
    """The md5 by which rows are drawn."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def _position(h: str) -> Column:
    """A hash as a number in [0, 1), from its first 13 digits."""
    return F.conv(F.substring(F.col(h), 1, 13), 16, 10).cast("double") / float(1 << 52)


def group_sizes(df: DataFrame, *keys: str) -> dict:
    rows = df.groupBy(*keys).count().limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    return {tuple(r[:-1]): r[-1] for r in rows}


def sample_by_quota(df: DataFrame, keys: list[str], quotas: Mapping[tuple, int], id_col: str, seed: int = 42) -> DataFrame:
    """The first ``quota`` rows of every stratum in the order of the draw."""
    spark = df.sparkSession
    types = ", ".join(f"`__cw_k{i}` {df.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    plan = spark.createDataFrame([(*k, int(q)) for k, q in quotas.items() if q > 0], f"{types}, __cw_quota int")  # at most MAX_STRATA rows
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__cw_k{i}"))
    rows = df.filter(F.col(id_col).isNotNull()).join(F.broadcast(plan), on).drop(*(f"__cw_k{i}" for i in range(len(keys))))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("__cw_n"))
    bins = F.ceil(F.col("__cw_n") / SLICE_ROWS)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}"))
    rows = rows.alias("r").join(F.broadcast(sizes).alias("s"), same).select("r.*", "s.__cw_n").withColumn("__cw_h", draw_order(seed, id_col)).withColumn("__cw_u", _position("__cw_h"))
    ranked = rank_in_bins(rows, keys, "__cw_u", ["__cw_h"], bins, "__cw_rank")
    return ranked.filter(F.col("__cw_rank") <= F.col("__cw_quota")).select(*df.columns)


def stratified_sample(df: DataFrame, key: str, total: int, id_col: str, spread: str = "greedy", seed: int = 42) -> DataFrame:
    sizes = group_sizes(df, key)
    return sample_by_quota(df, [key], allocate(sizes, total, spread), id_col, seed)


def two_level_quotas(sizes: Mapping[tuple, int], total: int, spread: str = "greedy") -> dict:
    """Quotas of the upper groups, divided again over the groups below."""
    upper: dict = {}
    for (a, b), n in sizes.items():
        upper.setdefault(a, {})[b] = n
    first = allocate({a: sum(x.values()) for a, x in upper.items()}, total, spread)
    return {(a, b): q for a, below in upper.items() for b, q in allocate(below, first[a], spread).items()}


def two_level_sample(df: DataFrame, upper: str, lower: str, total: int, id_col: str, spread: str = "greedy", seed: int = 42) -> DataFrame:
    return sample_by_quota(df, [upper, lower], two_level_quotas(group_sizes(df, upper, lower), total, spread), id_col, seed)


def bucket_sample(df: DataFrame, bucket: str, lower: str, fixed: Mapping[str, int], id_col: str, spread: str = "greedy", seed: int = 42) -> DataFrame:
    """Fixed quotas per bucket, each divided by square root over the bucket's lower groups."""
    quotas: dict = {}
    sizes = group_sizes(df, bucket, lower)
    for b, total in fixed.items():
        own = {k[1]: n for k, n in sizes.items() if k[0] == b}
        quotas |= {(b, k): q for k, q in allocate(own, total, spread).items()}
    return sample_by_quota(df, [bucket, lower], quotas, id_col, seed)


def simple_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement."""
    one = df.withColumn("__cw_all", F.lit(1))
    return sample_by_quota(one, ["__cw_all"], {(1,): n}, id_col, seed).drop("__cw_all")


def top_or_other(df: DataFrame, col: str, k: int, other: str = "Other", within: str | None = None) -> DataFrame:
    """Values outside the ``k`` most frequent (of each group, if ``within`` is given) become one; equal frequencies go by value."""
    keys = ([F.col(within).alias("__cw_g")] if within else [F.lit("").alias("__cw_g")]) + [F.col(col).alias("__cw_v")]
    n = df.groupBy(*keys).agg(F.count("*").alias("__cw_n"))
    top = n.withColumn("__cw_r", F.row_number().over(W.partitionBy("__cw_g").orderBy(F.desc("__cw_n"), "__cw_v"))).filter(F.col("__cw_r") <= k) if within else n.orderBy(F.desc("__cw_n"), "__cw_v").limit(k)
    top = top.select("__cw_g", "__cw_v", F.lit(True).alias("__cw_top"))  # k rows a group
    on = F.col(col).eqNullSafe(F.col("__cw_v")) & (F.col(within).eqNullSafe(F.col("__cw_g")) if within else F.lit(True))
    out = df.join(F.broadcast(top), on, "left")
    return out.select(*(F.when(F.col("__cw_top"), F.col(col)).otherwise(F.lit(other)).alias(col) if c == col else F.col(c) for c in df.columns))


def paired_block(df: DataFrame, run: str, source: str, main: str, upper: str, lower: str, total: int, id_col: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Both rows of ``total`` runs found in several sources, drawn in two levels by the rows of source ``main``; and the rest."""
    shared = df.filter(F.col(run).isNotNull()).groupBy(run).agg(F.count_distinct(source).alias("__cw_n")).filter("__cw_n >= 2").select(run)
    heads = df.filter(F.col(source) == main).join(shared, run, "left_semi").groupBy(run).agg(F.min(upper).alias("__cw_upper"), F.min(lower).alias("__cw_lower"))
    chosen = two_level_sample(heads, "__cw_upper", "__cw_lower", total, run, seed=seed).select(run)
    return df.join(chosen, run, "left_semi"), df.join(chosen, run, "left_anti")


#: The columns of a subset index, in order.
INDEX_COLUMNS = ("obs_name", "Database", "Run", "Project_ID", "sample_role", "overview_bucket", "ma_bucket_detail", "human_site", "rm_site", "paired_run_id", "stratum_id", "sub_stratum")


def subset_design(samples: DataFrame, paired: int, fixed: Mapping[str, int], more: int, seed: int = 42, top: int = 10) -> DataFrame:
    """The index of a subset: ``INDEX_COLUMNS`` and ``position`` from 1, by role, then name.

    ``samples`` has one row per ``obs_name`` with ``Database, Run, Project_ID, source`` (MA or RM), ``ma_bucket_detail``,
    ``overview_bucket, human_site, rm_site`` and ``sub``. First ``paired`` runs found in both sources, drawn by site and
    project, with both rows; of the rest, ``fixed`` MA samples per bucket by ``sub``, of which a bucket keeps the ``top``
    most frequent values, and ``more`` RM samples by site and project. Raises unless every part has the wanted size, as far
    as there are samples for it, and every name comes once.
    """
    both, rest = paired_block(samples, "Run", "source", "RM", "rm_site", "Project_ID", paired, "obs_name", seed)
    ma = rest.filter("source = 'MA'")
    plain = F.col("ma_bucket_detail").isin("Human", "Unknown")
    ma = ma.filter(plain).unionByName(top_or_other(ma.filter(~plain), "sub", top, within="ma_bucket_detail"))
    ma = Stage(samples.sparkSession).put(ma)
    drawn = bucket_sample(ma, "ma_bucket_detail", "sub", fixed, "obs_name", seed=seed)
    rm = two_level_sample(rest.filter("source = 'RM'"), "rm_site", "Project_ID", more, "obs_name", seed=seed)
    low = F.lower("source")
    parts = [
        both.select("*", F.concat(F.lit("paired_"), low).alias("sample_role"), F.col("Run").alias("paired_run_id"), F.concat(F.lit("paired::"), "source").alias("stratum_id"), F.col("Run").alias("sub_stratum"), F.when(F.col("source") == "MA", 1).otherwise(2).alias("part")),
        drawn.select("*", F.lit("ma_additional").alias("sample_role"), F.lit("NA").alias("paired_run_id"), F.concat(F.lit("MA::"), "ma_bucket_detail").alias("stratum_id"), F.col("sub").alias("sub_stratum"), F.lit(3).alias("part")),
        rm.select("*", F.lit("rm_additional").alias("sample_role"), F.lit("NA").alias("paired_run_id"), F.lit("RM::additional").alias("stratum_id"), F.concat_ws("|", "rm_site", "Project_ID").alias("sub_stratum"), F.lit(4).alias("part")),
    ]
    index = Stage(samples.sparkSession).put(parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*INDEX_COLUMNS, "part"))
    have = {r[0]: r[1] for r in ma.groupBy("ma_bucket_detail").count().collect()}  # one row per bucket
    got = {r[0]: r[1] for r in index.filter("part = 3").groupBy("ma_bucket_detail").count().collect()}
    wrong = {b: (got.get(b, 0), n) for b, n in fixed.items() if got.get(b, 0) != min(n, have.get(b, 0))}
    names, rows = index.agg(F.count_distinct("obs_name"), F.count("*")).head()
    if wrong or names != rows:
        raise ExpectationError(f"drawn and wanted by bucket: {wrong}; {rows} rows, {names} names")
    return number_rows(index, "part", "obs_name").select(*INDEX_COLUMNS, F.col("row_number").alias("position"))
