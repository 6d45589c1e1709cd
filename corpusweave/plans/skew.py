"""Queries of problem 3: results per project and per sample site, some of which hold most samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.operators.skew import key_profile
from corpusweave.session import read_table

KEYS = ("Project_ID", "MA_SampleSite")
METRICS = ("Latitude", "Longitude", "RM_Age", "RM_BMI")
PROBS = (0.25, 0.5, 0.75)


def p3_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and exact quartiles per key, for all keys."""
    out = key_profile(read_table(spark, sf, "merged_gg2_with_phylo"), "obs_name", KEYS, METRICS, PROBS)
    return out.withColumn("share", F.round("share", 9))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """The keys with more than 2 % of the distinct samples."""
    return p3_profile(spark, sf).filter("is_hot").select("field_name", "key_value")


_ROWS = """
 rows as (select obs_name, field, nullif(key,'') as key, n_rows, {metrics} from (
   select obs_name, field, key, count(*) as n_rows, {maxes} from (
     select obs_name, f.field as field, case when lower(trim(f.raw)) in ('','-','nan','none','<na>','na') then null else upper(trim(f.raw)) end as key, {metrics}
     from (select *, unnest([{{field:'Project_ID', raw:"Project_ID"}}, {{field:'MA_SampleSite', raw:"MA_SampleSite"}}]) as f from merged_gg2_with_phylo) where obs_name is not null)
   group by all) where key is not null),
 tot as (select count(distinct obs_name) as t from merged_gg2_with_phylo),
 counts as (select field, key, cast(sum(n_rows) as bigint) as n_rows, count(*) as n_samples from rows group by 1,2)
""".format(metrics=", ".join(METRICS), maxes=", ".join(f"max({m}) as {m}" for m in METRICS))


def _quantiles() -> str:
    long = " union all ".join(f"select field, key, '{m}' as metric, {m} as v from rows where {m} is not null" for m in METRICS)
    picks = ", ".join(
        f"max(case when metric='{m}' then n end) as {m.lower()}_n, " + ", ".join(f"max(case when metric='{m}' and r=greatest(1,ceil(round({p}*n,9))) then v end) as {m.lower()}_p{round(p * 100):02d}" for p in PROBS) for m in METRICS
    )
    return f"l as ({long}), k as (select *, row_number() over (partition by field,key,metric order by v) as r, count(*) over (partition by field,key,metric) as n from l), q as (select field, key, {picks} from k group by 1,2)"


SQL = {
    "p3_profile": f"with {_ROWS}, {_quantiles()} select c.field as field_name, c.key as key_value, n_rows, n_samples, round(n_samples / t, 9) as share, n_samples > 0.02 * t as is_hot, "
    + ", ".join(f"coalesce({m.lower()}_n, 0) as {m.lower()}_n, " + ", ".join(f"{m.lower()}_p{round(p * 100):02d}" for p in PROBS) for m in METRICS)
    + " from counts c left join q on c.field = q.field and c.key = q.key, tot",
    "p3_found": f"with {_ROWS} select field as field_name, key as key_value from counts, tot where n_samples > 0.02 * t",
}
QUERIES = {"p3_found": p3_found, "p3_profile": p3_profile}
