"""Queries that draw samples by quota."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusweave.functions.metadata import env_bucket, missing_as_na
from corpusweave.operators import sampling as S
from corpusweave.operators.expect import require_matched, require_unique
from corpusweave.session import Stage, read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _quota_sql(table: str, key: str, total: str, name: str, partition: str = "", spread: str = "greedy") -> str:
    """Square-root quotas with largest remainders; what a full group cannot take goes to the others by ``spread``."""
    p = f"partition by {partition} " if partition else ""
    over = f"over ({p.strip()})" if p else "over ()"
    cols = f"{partition + ', ' if partition else ''}{key}"
    out = f"""{name}_r as (select {cols}, count(*) as n from {table} group by all), {name}_w as (select *, sqrt(n) / sum(sqrt(n)) {over} * {total} as raw from {name}_r),
{name}_f as (select *, floor(round(raw, 9)) as whole, row_number() over ({p}order by round(raw - floor(round(raw, 9)), 9) desc, cast({key} as varchar)) as o from {name}_w),
{name}_q as (select *, cast(whole + case when o <= {total} - sum(whole) {over} then 1 else 0 end as bigint) as first_q from {name}_f),
{name}_c as (select *, least(first_q, n) as q, n - least(first_q, n) as room, sum(first_q - least(first_q, n)) {over} as excess from {name}_q),
"""
    if spread == "even":
        units = f"select {cols}, row_number() over ({p}order by j, o) as rk, excess from (select *, unnest(generate_series(1, cast(least(room, excess) as bigint))) as j from {name}_c where room > 0 and excess > 0)"
        return out + f"{name}_g as (select {cols}, count(*) as more from ({units}) where rk <= excess group by all), {name} as (select c.*, q + coalesce(more, 0) as quota from {name}_c c left join {name}_g using ({cols}))"
    return out + f"{name} as (select *, cast(q + greatest(0, least(room, excess - coalesce(sum(room) over ({p}order by o rows between unbounded preceding and 1 preceding), 0))) as bigint) as quota from {name}_c)"


def _customers(spark, sf):
    return read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")


@query("with " + _quota_sql("customer", "c_mktsegment", "100", "q") + " select c_mktsegment, n, quota from q")
def sample_sqrt_quotas(spark, sf):
    """Square-root quotas of the segments."""
    sizes = S.group_sizes(_customers(spark, sf), "c_mktsegment")
    quota = S.allocate(sizes, 100)
    return spark.createDataFrame([(k[0], sizes[k], quota[k]) for k in sizes], "c_mktsegment string, n long, quota long")


_DRAW = "md5(concat('42|', cast(c_custkey as varchar)))"


@query("with " + _quota_sql("customer", "c_mktsegment", "100", "q") + f", r as (select c.*, quota, row_number() over (partition by c_mktsegment order by {_DRAW}) as r from customer c join q using (c_mktsegment)) select c_custkey, c_mktsegment, c_nationkey from r where r <= quota")
def sample_stratified(spark, sf):
    """A hundred customers by segment."""
    return S.stratified_sample(_customers(spark, sf), "c_mktsegment", 100, "c_custkey")


@query(
    "with " + _quota_sql("customer", "c_mktsegment", "200", "q") + ", b as (select c.*, quota as top from customer c join q using (c_mktsegment)), "
    + _quota_sql("b", "c_nationkey", "top", "p", "c_mktsegment, top").replace("partition by c_mktsegment, top", "partition by c_mktsegment")
    + f", r as (select b.*, p.quota, row_number() over (partition by c_mktsegment, c_nationkey order by {_DRAW}) as r from b join p using (c_mktsegment, c_nationkey)) select c_custkey, c_mktsegment, c_nationkey from r where r <= quota"
)
def sample_two_level(spark, sf):
    """Two hundred customers by segment, then nation."""
    return S.two_level_sample(_customers(spark, sf), "c_mktsegment", "c_nationkey", 200, "c_custkey")


@query(f"select c_custkey, c_mktsegment, c_nationkey from customer order by {_DRAW} limit 50")
def sample_simple(spark, sf):
    """Fifty customers without replacement."""
    return S.simple_sample(_customers(spark, sf), 50, "c_custkey")


@query("with n as (select p_brand as v, count(*) as n from part group by 1), t as (select v from n order by n desc, v limit 5) select p_partkey, case when p_brand in (select v from t) then p_brand else 'Other' end as brand from part")
def sample_top_or_other(spark, sf):
    """Brands outside the five most frequent as one."""
    return S.top_or_other(read_table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("brand")), "brand", 5)


_SIZES = "select c_nationkey % 5 as g, c_custkey from customer union all select 5 + o_orderkey % 3, o_orderkey from orders where o_orderkey < 8"


def _unequal(spark, sf):
    """A few large groups and three of a handful of rows, whose quotas exceed them."""
    c = read_table(spark, sf, "customer").select((F.col("c_nationkey") % 5).cast("long").alias("g"), F.col("c_custkey").cast("long").alias("id"))
    o = read_table(spark, sf, "orders").filter("o_orderkey < 8").select((5 + F.col("o_orderkey") % 3).cast("long").alias("g"), F.col("o_orderkey").cast("long").alias("id"))
    return c.unionByName(o)


def _capped(spark, sf, spread):
    sizes = {k[0]: n for k, n in S.group_sizes(_unequal(spark, sf), "g").items()}
    quota = S.allocate(sizes, 100, spread)
    return spark.createDataFrame([(g, n, quota[g]) for g, n in sizes.items()], "g long, n long, quota long")


@query(f"with u as ({_SIZES}), " + _quota_sql("u", "g", "100", "q") + " select g, n, quota from q")
def sample_capped_greedy(spark, sf):
    """Quotas of groups smaller than theirs, what they cannot take given to one group after the other."""
    return _capped(spark, sf, "greedy")


@query(f"with u as ({_SIZES}), " + _quota_sql("u", "g", "100", "q", spread="even") + " select g, n, quota from q")
def sample_capped_even(spark, sf):
    """The same, given to all groups with room in turn."""
    return _capped(spark, sf, "even")


def _samples(spark, sf):
    """One row per sample: of repeated rows the least value of each column."""
    subs = ("MA_Env_Animal_Sub", "MA_Env_Soil_Sub", "MA_Env_Aquatic_Sub", "MA_Env_Plant_Sub")
    flags = [f"MA_Env_{x}" for x in ("Animal", "Soil", "Aquatic", "Plant")]
    m = read_table(spark, sf, "merged_gg2_with_phylo").filter("obs_name IS NOT NULL").groupBy("obs_name").agg(*(F.min(c).alias(c) for c in ("Database", "Run", "Project_ID", "MA_IsHuman", "MA_SampleSite", *flags, *subs, "RM_Sample_Site")))
    ma = F.col("obs_name").startswith("MA")
    bucket = F.when(ma, env_bucket(F.col("MA_IsHuman") == "Human", *map(F.col, flags))).otherwise(F.lit("NA"))
    m = m.withColumn("source", F.when(ma, "MA").otherwise("RM")).withColumn("ma_bucket_detail", bucket)
    b = F.col("ma_bucket_detail")
    sub = F.when(b == "Human", F.col("MA_SampleSite"))
    for name, c in zip(("Animal_other", "Soil", "Aquatic", "Plant"), subs, strict=True):
        sub = sub.when(b == name, F.col(c))
    human = F.when(b == "Human", missing_as_na(F.col("MA_SampleSite"))).otherwise(F.lit("NA"))
    overview = F.when(~ma, "RM").when(b.isin("Human", "Animal_other"), "Animal").otherwise(b)
    return m.select("obs_name", "Database", "Run", "source", missing_as_na(F.col("Project_ID")).alias("Project_ID"), b, overview.alias("overview_bucket"), human.alias("human_site"), F.when(ma, "NA").otherwise(missing_as_na(F.col("RM_Sample_Site"))).alias("rm_site"), missing_as_na(sub).alias("sub"))


FIXED = {"Human": 80, "Animal_other": 40, "Soil": 40, "Aquatic": 40, "Plant": 20, "Unknown": 10}
PAIRED, MORE = 20, 30


def _na(c: str) -> str:
    return f"case when {c} is null or {c} in ('nan', 'None', '<NA>') then 'NA' else {c} end"


_MIN = ", ".join(f'min("{c}") as {c}' for c in ("Database", "Run", "Project_ID", "MA_IsHuman", "MA_SampleSite", "RM_Sample_Site", *(f"MA_Env_{x}{t}" for x in ("Animal", "Soil", "Aquatic", "Plant") for t in ("", "_Sub"))))
_DETAIL = "case when obs_name not like 'MA%' then 'NA' when MA_IsHuman = 'Human' then 'Human' when MA_Env_Animal then 'Animal_other' when MA_Env_Soil then 'Soil' when MA_Env_Aquatic then 'Aquatic' when MA_Env_Plant then 'Plant' else 'Unknown' end"
_SUB = "case d when 'Human' then MA_SampleSite when 'Animal_other' then MA_Env_Animal_Sub when 'Soil' then MA_Env_Soil_Sub when 'Aquatic' then MA_Env_Aquatic_Sub when 'Plant' then MA_Env_Plant_Sub end"
_TWO = lambda t, n, k, x: _quota_sql(t, "rm_site", n, f"{x}a") + f", {x}b as (select t.*, quota as top from {t} t join {x}a using (rm_site)), " + _quota_sql(f"{x}b", "Project_ID", "top", f"{x}c", "rm_site, top").replace("partition by rm_site, top", "partition by rm_site") + f", {x} as (select * from (select b.*, c.quota, row_number() over (partition by rm_site, Project_ID order by md5('42|' || {k})) as r from {x}b b join {x}c c using (rm_site, Project_ID)) where r <= quota)"
_DESIGN = f"""with m0 as (select obs_name, {_MIN} from merged_gg2_with_phylo where obs_name is not null group by 1), m1 as (select *, {_DETAIL} as d from m0),
m as (select obs_name, Database, Run, case when obs_name like 'MA%' then 'MA' else 'RM' end as source, {_na("Project_ID")} as Project_ID, d as ma_bucket_detail,
 case when obs_name not like 'MA%' then 'RM' when d in ('Human', 'Animal_other') then 'Animal' else d end as overview_bucket, case when d = 'Human' then {_na("MA_SampleSite")} else 'NA' end as human_site,
 case when obs_name like 'MA%' then 'NA' else {_na("RM_Sample_Site")} end as rm_site, {_na(f"({_SUB})")} as sub from m1),
shared as (select Run from m where Run is not null group by 1 having count(distinct source) >= 2),
heads as (select Run, min(rm_site) as rm_site, min(Project_ID) as Project_ID from m join shared using (Run) where source = 'RM' group by 1),
{_TWO("heads", str(PAIRED), "Run", "pr")},
rest as (select * from m where Run is null or Run not in (select Run from pr)),
n as (select ma_bucket_detail, sub, row_number() over (partition by ma_bucket_detail order by count(*) desc, sub) as r from rest where source = 'MA' group by 1, 2),
ma as (select rest.* exclude (sub), case when n.r <= 10 or ma_bucket_detail in ('Human', 'Unknown') then sub else 'Other' end as sub, f.total from rest join n using (ma_bucket_detail, sub) join (values {", ".join(f"('{b}', {n})" for b, n in FIXED.items())}) f(ma_bucket_detail, total) using (ma_bucket_detail) where source = 'MA'),
{_quota_sql("ma", "sub", "total", "mq", "ma_bucket_detail, total").replace("partition by ma_bucket_detail, total", "partition by ma_bucket_detail")},
md as (select * from (select ma.*, quota, row_number() over (partition by ma_bucket_detail, sub order by md5('42|' || obs_name)) as r from ma join mq using (ma_bucket_detail, sub)) where r <= quota),
rs as (select * from rest where source = 'RM'), {_TWO("rs", str(MORE), "obs_name", "rd")},
i as (select *, 'paired_' || lower(source) as sample_role, Run as paired_run_id, 'paired::' || source as stratum_id, Run as sub_stratum, case source when 'MA' then 1 else 2 end as part from m where Run in (select Run from pr)
 union all by name select *, 'ma_additional' as sample_role, 'NA' as paired_run_id, 'MA::' || ma_bucket_detail as stratum_id, sub as sub_stratum, 3 as part from md
 union all by name select *, 'rm_additional' as sample_role, 'NA' as paired_run_id, 'RM::additional' as stratum_id, rm_site || '|' || Project_ID as sub_stratum, 4 as part from rd)
select {", ".join(S.INDEX_COLUMNS)}, row_number() over (order by part, obs_name) as position from i"""


@query(_DESIGN)
def sample_paired_design(spark, sf):
    """The index of a subset: paired runs with both rows, then fixed buckets and a two-level block from the rest, in order."""
    return S.subset_design(_samples(spark, sf), PAIRED, FIXED, MORE)


@query(_DESIGN.replace("with m0", "with idx as (with m0", 1) + "), f as (select obs_name, count(*) as n_rows, count(distinct RM_Phenotype) as phenotypes from merged_gg2_with_phylo group by 1) select idx.*, n_rows, phenotypes from idx join f using (obs_name)")
def sample_subset_ordered(spark, sf):
    """The rows of a subset looked up by its index, all of them found, with the index's labels and order."""
    index = Stage(spark).put(sample_paired_design(spark, sf))
    facts = read_table(spark, sf, "merged_gg2_with_phylo").groupBy("obs_name").agg(F.count("*").alias("n_rows"), F.count_distinct("RM_Phenotype").alias("phenotypes"))
    require_matched(index, facts, "obs_name")
    require_unique(index, "obs_name")
    return facts.join(index, "obs_name").select(*S.INDEX_COLUMNS, "position", "n_rows", "phenotypes")


@query("with m as (select distinct obs_name, case when MA_IsHuman is not null then 'Human' when coalesce(MA_Env_Animal, false) then 'Animal_other' when coalesce(MA_Env_Soil, false) then 'Soil' when coalesce(MA_Env_Aquatic, false) then 'Aquatic' when coalesce(MA_Env_Plant, false) then 'Plant' else 'Unknown' end as bucket from merged_gg2_with_phylo) select bucket, count(*) as n from m group by 1")
def sample_bucket_sizes(spark, sf):
    """Samples per environment bucket."""
    m = read_table(spark, sf, "merged_gg2_with_phylo")
    bucket = env_bucket(F.col("MA_IsHuman").isNotNull(), *(F.col(f"MA_Env_{x}") for x in ("Animal", "Soil", "Aquatic", "Plant")))
    return m.select("obs_name", bucket.alias("bucket")).distinct().groupBy("bucket").agg(F.count("*").alias("n"))


@query("select obs_name, m.sample_role, paired_run_id from (select distinct obs_name from merged_gg2_with_phylo) join (select distinct obs_name, sample_role, paired_run_id from subset_100k_index) m using (obs_name)")
def sample_subset_build(spark, sf):
    """The samples of a subset index, with its labels."""
    idx = read_table(spark, sf, "subset_100k_index").select("obs_name", "sample_role", "paired_run_id").distinct()
    return read_table(spark, sf, "merged_gg2_with_phylo").select("obs_name").distinct().join(idx, "obs_name")
