"""Queries that parse, standardise, patch and check sample metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusweave.functions import metadata as D
from corpusweave.operators import merge as M
from corpusweave.operators import standardise as S
from corpusweave.operators.expect import unknown_tokens, violations
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


def _env(spark, sf):
    return read_table(spark, sf, "samples_env_info")


def _merged(spark, sf):
    return read_table(spark, sf, "merged_gg2_with_phylo")


_TAGS = "case when coalesce(Environments, '') = '' then [] else list_transform(string_split(Environments, '|'), lambda t: {'main': split_part(t, ';', 1), 'sub': case when contains(t, ';') then substr(t, position(';' in t) + 1) else '' end}) end"


def _sub(m: str) -> str:
    return f"case when list_contains(list_transform(tags, lambda t: t.main), '{m}') then array_to_string(list_transform(list_filter(tags, lambda t: t.main = '{m}'), lambda t: t.sub), '|') end"


@query(
    f"with x as (select MAP_SID as sample_id, {_TAGS} as tags from samples_env_info) select sample_id, "
    + ", ".join(f"list_contains(list_transform(tags, lambda t: t.main), '{m}') as is_{m}, {_sub(m)} as {m}_sub" for m in D.MAINS)
    + ", case when list_contains(list_transform(list_filter(tags, lambda t: t.main = 'animal'), lambda t: t.sub), 'human') then case when len(list_filter(tags, lambda t: t.main = 'animal' and t.sub not in ('human', ''))) > 0 then 'HumanMix' else 'Human' end end as human_class from x"
)
def meta_environment(spark, sf):
    """Flags and sub-classes of the environment text, and whether the sample is human."""
    x = _env(spark, sf).select(F.col("MAP_SID").alias("sample_id"), D.env_tags(F.col("Environments")).alias("tags"))
    flags = [c for m in D.MAINS for c in (D.env_flag(F.col("tags"), m).alias(f"is_{m}"), D.env_subs(F.col("tags"), m).alias(f"{m}_sub"))]
    return x.select("sample_id", *flags, D.human_class(F.col("tags")).alias("human_class"))


@query(f"""with x as (select Environments, {_TAGS} as tags from samples_env_info), y as (select list_sort(list_distinct(list_transform(tags, lambda t: t.main || ';' || t.sub))) as a,
list_sort(list_distinct(case when coalesce(Environments, '') = '' then [] else list_transform(string_split(Environments, '|'), lambda t: case when contains(t, ';') then t else t || ';' end) end)) as b from x) select count(*) as n, count(*) filter (where a = b) as n_equal from y""")
def meta_round_trip(spark, sf):
    """Environments whose parse, written again, is the text."""
    x = _env(spark, sf).select("Environments", D.env_tags(F.col("Environments")).alias("tags"))
    return x.select(D.env_rebuilt_equal(F.col("tags"), F.col("Environments")).alias("same")).agg(F.count("*").alias("n"), F.count_if("same").alias("n_equal"))


_ALL = (*D.SITES, *D.SEXES, *D.AGES, *D.SMOKING, *D.HEALTH)
_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)
_TOK = "list_filter(string_split(coalesce(_col3, ''), ';'), lambda t: t <> '')"
_ONE = lambda xs: f"list_filter(tk, lambda t: t in ({_IN(xs)}))[1]"


@query(f"with x as (select MAP_SID as sample_id, {_TOK} as tk from samples_env_info) select sample_id, {_ONE(D.SITES)} as site, {_ONE(D.SEXES)} as sex, {_ONE(D.AGES)} as age, case when len(list_filter(tk, lambda t: t = 'smoker')) > 0 then 'Smoker' end as smoking, nullif(array_to_string(list_filter(tk, lambda t: t in ({_IN(D.HEALTH)})), ';'), '') as health from x")
def meta_slots(spark, sf):
    """Site, sex, age, smoking and health tokens of the sample text."""
    tk = D.slot_tokens(F.col("_col3"))
    x = _env(spark, sf).select(F.col("MAP_SID").alias("sample_id"), tk.alias("tk"))
    t = F.col("tk")
    return x.select("sample_id", D.pick_one(t, D.SITES).alias("site"), D.pick_one(t, D.SEXES).alias("sex"), D.pick_one(t, D.AGES).alias("age"), D.has_any(t, D.SMOKING, "Smoker").alias("smoking"), D.pick_all(t, D.HEALTH).alias("health"))


@query(f"with x as (select unnest({_TOK}) as token from samples_env_info) select token, count(*) as \"count\" from x where token not in ({_IN(_ALL)}) group by 1")
def meta_unknown_tokens(spark, sf):
    """Tokens outside the known domain."""
    return unknown_tokens(_env(spark, sf), D.slot_tokens(F.col("_col3")), _ALL)


@query(f"with x as (select {_TOK} as tk from samples_env_info) select max(len(list_filter(tk, lambda t: t in ({_IN(D.SITES)})))) as site, max(len(list_filter(tk, lambda t: t in ({_IN(D.SEXES)})))) as sex, max(len(list_filter(tk, lambda t: t in ({_IN(D.AGES)})))) as age from x")
def meta_exclusive_slots(spark, sf):
    """Most tokens that fall in a slot for one."""
    t = D.slot_tokens(F.col("_col3"))
    return _env(spark, sf).agg(*(F.max(D.most_matches(t, xs)).alias(n) for n, xs in (("site", D.SITES), ("sex", D.SEXES), ("age", D.AGES))))


_NUMBER = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
_GEO = f"with x as (select MAP_SID as sample_id, string_split_regex(regexp_replace(coalesce(_col9, ''), '^\\s+|\\s+$', '', 'g'), '\\s+') as p from samples_env_info), y as (select sample_id, len(p) = 2 and regexp_matches(p[1], '{_NUMBER}') and regexp_matches(p[2], '{_NUMBER}') as ok, p from x)"


@query(_GEO + " select sample_id, case when ok then cast(p[1] as double) end as lat, case when ok then cast(p[2] as double) end as lon from y")
def meta_geo_pairs(spark, sf):
    """Positions written as exactly two numbers."""
    x = _env(spark, sf).select(F.col("MAP_SID").alias("sample_id"), D.geo_pair(F.col("_col9")).alias("g"))
    return x.select("sample_id", "g.lat", "g.lon")


@query("select MAP_SID as sample_id, split_part(MAP_SID, '.', 1) as run, nullif(substr(MAP_SID, position('.' in MAP_SID) + 1), '') as biosample, nullif(_col6, '') as extra from samples_env_info")
def meta_run_biosample(spark, sf):
    """Run and sample accession of the combined id."""
    c = F.col("MAP_SID")
    return _env(spark, sf).select(c.alias("sample_id"), D.split_once(c, ".", 0).alias("run"), D.split_once(c, ".", 1).alias("biosample"), D.blank_to_null(F.col("_col6")).alias("extra"))


_AGE = "case when s >= 0 and e <= 3 then '0-3' " + " ".join(f"when s > {a} and e <= {b} then '{n}'" for n, a, b in D.AGE_BINS) + " when s > 75 and e is not null then '75+' end"


@query(f"select obs_name, RM_Age_start as s, RM_Age_end as e, {_AGE.replace('s >', 'RM_Age_start >').replace('e <=', 'RM_Age_end <=').replace('e is not', 'RM_Age_end is not')} as age_group from merged_gg2_with_phylo where obs_name like 'RM%'")
def meta_age_groups(spark, sf):
    """Age bins of interval ages."""
    r = _merged(spark, sf).filter(F.col("obs_name").startswith("RM"))
    return r.select("obs_name", F.col("RM_Age_start").alias("s"), F.col("RM_Age_end").alias("e"), D.age_group(F.col("RM_Age_start"), F.col("RM_Age_end")).alias("age_group"))


@query("select obs_name, RM_Phenotype as phenotype, case when RM_Phenotype in ('Control', 'Health') then 'control' when RM_Phenotype is not null then 'case' end as role, case when RM_Phenotype = 'Health' then true when RM_Phenotype = 'Control' then null when RM_Phenotype is not null then false end as healthy from merged_gg2_with_phylo where obs_name like 'RM%'")
def meta_phenotype(spark, sf):
    """Case or control, and health as three states."""
    p = F.col("RM_Phenotype")
    return _merged(spark, sf).filter(F.col("obs_name").startswith("RM")).select("obs_name", p.alias("phenotype"), D.case_or_control(p).alias("role"), D.is_healthy(p).alias("healthy"))


@query("""with x as (select obs_name, regexp_replace(Project_ID, '^\\s+|\\s+$', '', 'g') as project, regexp_replace("Database", '^\\s+|\\s+$', '', 'g') as db, Sex from mcfcorpus_gg2) select obs_name, project, case when db = 'MicrobeAtlas' then 'MA' when db = 'ResMicroDb' then 'RM' else db end as db, case when Sex = 'female' then 'Female' when Sex = 'male' then 'Male' else Sex end as sex, case when project is null or project in ('nan', 'None', '<NA>') then 'NA' else project end as label from x""")
def meta_standardise(spark, sf):
    """Strings without outer blanks, values recoded, missing values as one label."""
    x = D.strip_strings(read_table(spark, sf, "mcfcorpus_gg2").select("obs_name", F.col("Project_ID").alias("project"), F.col("Database").alias("db"), F.col("Sex").alias("sex")))
    return x.select("obs_name", "project", D.replace_exact(F.col("db"), {"MicrobeAtlas": "MA", "ResMicroDb": "RM"}).alias("db"), D.replace_exact(F.col("sex"), {"female": "Female", "male": "Male"}).alias("sex"), D.missing_as_na(F.col("project")).alias("label"))


@query("select obs_name, case when Sequencing_Type = 'AMPLICON' then nullif(coalesce(RM_Region_16S, '-'), '-') end as region from merged_gg2_with_phylo")
def meta_gated_region(spark, sf):
    """A region only where the sequencing type allows one."""
    return _merged(spark, sf).select("obs_name", D.gated(F.col("RM_Region_16S"), F.col("Sequencing_Type"), "AMPLICON").alias("region"))


@query("select c_custkey as id, case when starts_with(c_mktsegment, 'AUTO') then 'vehicle' when starts_with(c_mktsegment, 'MACH') then 'machine' when starts_with(c_mktsegment, 'M') then 'other m' else 'rest' end as kind, case when c_mktsegment like 'B%' then substr(c_mktsegment, 2) else 'not b' end as tail, case when regexp_matches(c_name, '[#:;]') then '''' || replace(c_name, '''', '''''') || '''' else c_name end as label from customer")
def meta_prefix_classes(spark, sf):
    """Ordered prefix classes, collapsed labels and quoted tree labels."""
    s = F.col("c_mktsegment")
    label = F.when(F.col("c_name").contains("#"), F.concat(F.lit("'"), F.replace("c_name", F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(D.quoted_label(F.col("c_name")))
    return read_table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), D.first_prefix(s, (("AUTO", "vehicle"), ("MACH", "machine"), ("M", "other m")), "rest").alias("kind"), D.collapse_label(s, "B", "not b").alias("tail"), label.alias("label"))


@query("select obs_name, case when coalesce(MA_IsHuman is not null, false) then 'Human' when coalesce(MA_Env_Animal, false) then 'Animal_other' when coalesce(MA_Env_Soil, false) then 'Soil' when coalesce(MA_Env_Aquatic, false) then 'Aquatic' when coalesce(MA_Env_Plant, false) then 'Plant' else 'Unknown' end as bucket from merged_gg2_with_phylo")
def meta_env_bucket(spark, sf):
    """One environment bucket per sample, by priority."""
    b = D.env_bucket(F.col("MA_IsHuman").isNotNull(), *(F.col(f"MA_Env_{m}") for m in ("Animal", "Soil", "Aquatic", "Plant")))
    return _merged(spark, sf).select("obs_name", b.alias("bucket"))


@query("""with x as (select doc_id, unnest(string_split(regexp_extract(text, 'Identifiers: ([^\\n]*)', 1), ';')) as e from documents where contains(text, 'Identifiers: ')), y as (select doc_id, trim(split_part(e, ':', 1)) as k, trim(substr(e, position(':' in e) + 1)) as v from x where contains(e, ':')) select doc_id, max(case when k = 'BioSample' then v end) as biosample, max(case when k = 'Sample name' then v end) as name from y group by 1""")
def meta_identifiers(spark, sf):
    """Values of a key list inside texts."""
    d = read_table(spark, sf, "documents").filter(F.col("text").contains("Identifiers: ")).select("doc_id", D.pair_list(F.regexp_extract("text", r"Identifiers: ([^\n]*)", 1)).alias("m"))
    return d.filter(F.size("m") > 0).select("doc_id", F.try_element_at("m", F.lit("BioSample")).alias("biosample"), F.try_element_at("m", F.lit("Sample name")).alias("name"))


_RULES = {
    "age is its interval": "RM_Age is null or coalesce(RM_Age = RM_Age_start and RM_Age = RM_Age_end, false)",
    "age interval in order": "RM_Age is not null or RM_Age_start is null or coalesce(RM_Age_start <= RM_Age_end, false)",
    "bmi is its interval": "RM_BMI is null or coalesce(RM_BMI = RM_BMI_start and RM_BMI = RM_BMI_end, false)",
    "bmi interval in order": "RM_BMI is not null or RM_BMI_start is null or coalesce(RM_BMI_start <= RM_BMI_end, false)",
    "country with continent": "(RM_Country is null) = (RM_Continent is null)",
    "location with country": "RM_Location is null or RM_Country is not null",
    "health agrees with phenotype": "coalesce(RM_Is_Healthy, false) = coalesce(RM_Phenotype = 'Health', false)",
}


@query(" union all ".join(f"select '{k}' as rule, count(*) filter (where not coalesce({r}, false)) as broken from merged_gg2_with_phylo where obs_name like 'RM%'" for k, r in _RULES.items()))
def meta_invariants(spark, sf):
    """Rows that break an invariant, all rules counted in one pass."""
    return violations(_merged(spark, sf).filter(F.col("obs_name").startswith("RM")), {k: F.expr(r) for k, r in _RULES.items()})


_RAW = {"Sample_Site": "RM_Sample_Site", "Sample_Type": "RM_Sample_Type"} | {c: f"RM_{c}" for c in S.COLUMNS if c not in ("Run", "Project_ID", "BioSample", "Sequencing_Type", "Smoking", "Sex", "Latitude", "Longitude", *S.DERIVED)}


def _standard(spark, sf):
    """The standard form of the RM samples; of repeated rows the least value of each column counts."""
    m = _merged(spark, sf).filter(F.col("obs_name").startswith("RM"))
    cols = [_RAW.get(c, c) for c in S.COLUMNS if c not in S.DERIVED]
    one = m.groupBy("obs_name").agg(*(F.min(c).alias(c) for c in cols))
    regions = m.filter("trim(Sequencing_Type) = '16S'").groupBy(F.regexp_replace("Project_ID", r"^\s+|\s+$", "").alias("Project_ID")).agg(F.min("RM_Region_16S").alias("region"))
    return S.standardise(one, regions, S.Standard({raw: c for c, raw in _RAW.items()}))


_TRIM = lambda c: f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
_FIX = {c: f"case {{0}} {' '.join(f"when '{a}' then nullif('{b}', '')" for a, b in f.items())} else {{0}} end" for c, f in S.FIXES.items()}


def _standard_sql() -> str:
    raw = {c: _RAW.get(c, c) for c in S.COLUMNS if c not in S.DERIVED}
    least = ", ".join(f"min({r}) as {r}" for r in raw.values())
    cols = ", ".join((f"{r} as {c}" if c in S.FLOATS else _FIX.get(c, "{0}").format(_TRIM(r)) + f" as {c}") for c, r in raw.items())
    age = "case when Age_start >= 0 and Age_end <= 3 then '0-3' " + " ".join(f"when Age_start > {a} and Age_end <= {b} then '{n}'" for n, a, b in D.AGE_BINS) + " when Age_start > 75 and Age_end is not null then '75+' end"
    return f"""std as (select {", ".join(S.COLUMNS)} from (select x.*, {age} as Age_Group, case when Sequencing_Type = '16S' then nullif(coalesce(region, '-'), '-') end as Region_16S,
 case when Phenotype in ('Control', 'Health') then 'control' when Phenotype is not null then 'case' end as Case_Or_Control, case when Phenotype = 'Health' then true when Phenotype = 'Control' then null when Phenotype is not null then false end as Is_Healthy
 from (select {cols} from (select obs_name, {least} from merged_gg2_with_phylo where obs_name like 'RM%' group by 1)) x
 left join (select regexp_replace(Project_ID, '^\\s+|\\s+$', '', 'g') as p, min(RM_Region_16S) as region from merged_gg2_with_phylo where obs_name like 'RM%' and trim(Sequencing_Type) = '16S' group by 1) r on x.Project_ID = r.p))"""


@query(f"with {_standard_sql()} select * from std")
def meta_standard_form(spark, sf):
    """All 36 columns of the standard form, derived ones included."""
    return _standard(spark, sf)


_AS_SQL = {
    "age is its interval": "Age is null or coalesce(Age = Age_start and Age = Age_end, false)",
    "age interval in order": "Age is not null or Age_start is null or coalesce(Age_start <= Age_end, false)",
    "bmi is its interval": "BMI is null or coalesce(BMI = BMI_start and BMI = BMI_end, false)",
    "bmi interval in order": "BMI is not null or BMI_start is null or coalesce(BMI_start <= BMI_end, false)",
    "country with continent": "(Country is null) = (Continent is null)",
    "location with country": "Location is null or Country is not null",
    "region with its type": "Region_16S is null or coalesce(Sequencing_Type = '16S', false)",
    "healthy where health": "coalesce(Is_Healthy, false) = coalesce(Phenotype = 'Health', false)",
} | {f"{n} known": f"{c} is null or {c} in ({', '.join(f"'{v}'" for v in d)})" for n, c, d in [("region", "Region_16S", S.REGIONS), ("age group", "Age_Group", S.AGE_GROUPS), ("case or control", "Case_Or_Control", ("case", "control")), *((c, c, d) for c, d in S.DOMAINS.items())]}


@query(f"with {_standard_sql()} select 'run unique' as rule, count(*) as broken from (select Run from std group by 1 having count(*) > 1 or Run is null) " + " ".join(f"union all select '{k}', count(*) filter (where not ({r})) from std" for k, r in _AS_SQL.items()) + " union all select 'types', 0 union all select 'column order', 0")
def meta_standard_invariants(spark, sf):
    """Every invariant of the standard form and the rows that break it."""
    return S.invariants(_standard(spark, sf))


#: Which rows a patch takes, and what it sets.
_PATCHES = {
    "site": ("Sample_Site = 'Nasal' and Phenotype is null", {"Sample_Site": "'Nasopharynx'"}),
    "phenotype": ("Phenotype = 'Pneumonia'", {"Phenotype": "'Viral Pneumonia'", "Phenotype_ID": "'P0108'"}),
    "controls": ("Phenotype = 'Control'", {"Phenotype": "'Health'", "Phenotype_ID": "'P0000'", "Case_Or_Control": "'control'", "Is_Healthy": "true"}),
    "asthma": ("Phenotype = 'Asthma'", {"Phenotype": "'Asthma'", "Phenotype_ID": "'P0341'", "Case_Or_Control": "'case'", "Is_Healthy": "cast(null as boolean)"}),
}


@query(f"with {_standard_sql()} " + " union all ".join(f"select '{n}' as patch, '{c}' as column_name, count(*) as touched, count(*) filter (where {c} is distinct from {v}) as changed from std where {w}" for n, (w, sets) in _PATCHES.items() for c, v in sets.items()))
def patch_pipeline(spark, sf):
    """Four patches over the standard form, checked to be apart, to leave other rows alone and to change nothing twice."""
    base = Stage(spark).put(_standard(spark, sf))
    return S.apply_patches(base, {n: base.filter(w).select("Run", *(F.expr(v).alias(c) for c, v in sets.items())) for n, (w, sets) in _PATCHES.items()}, "Run")[1]


_PATCH = "select c_custkey, 'PATCHED' as c_mktsegment, case when c_acctbal < 0 then null else c_acctbal + 1 end as c_acctbal from customer where c_mktsegment = 'BUILDING'"


def _patched(spark, sf):
    c = read_table(spark, sf, "customer")
    patch = c.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("PATCHED").alias("c_mktsegment"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal") + 1).alias("c_acctbal"))
    return c, M.apply_patch(c, patch, "c_custkey")


@query(f"with p as ({_PATCH}) select c.c_custkey, c_name, c_nationkey, case when p.c_custkey is null then c.c_acctbal else p.c_acctbal end as c_acctbal, coalesce(p.c_mktsegment, c.c_mktsegment) as c_mktsegment from customer c left join p using (c_custkey)")
def patch_apply(spark, sf):
    """Rows of a patch replaced, NULLs included."""
    return _patched(spark, sf)[1]


@query(f"with p as ({_PATCH}) select 'c_acctbal' as column_name, count(*) filter (where p.c_acctbal is distinct from c.c_acctbal) as changed from customer c join p using (c_custkey) union all select 'c_mktsegment', count(*) filter (where p.c_mktsegment is distinct from c.c_mktsegment) from customer c join p using (c_custkey) union all select 'c_name', 0")
def patch_audit(spark, sf):
    """Changed rows per column."""
    before, after = _patched(spark, sf)
    return M.audit(before, after, "c_custkey", ["c_acctbal", "c_mktsegment", "c_name"])


@query("""with r as (select Run, count(distinct RM_Phenotype) as phenotypes, min(RM_Phenotype) as phenotype from merged_gg2_with_phylo where RM_Phenotype is not null group by 1) select m.obs_name, r.phenotype, r.Run is not null as matched from mcfcorpus_gg2 m left join r on m.Run = r.Run""")
def lookup_left(spark, sf):
    """A many-to-one lookup that keeps rows without a match."""
    r = _merged(spark, sf).filter("RM_Phenotype IS NOT NULL").groupBy("Run").agg(F.min("RM_Phenotype").alias("phenotype"))
    return read_table(spark, sf, "mcfcorpus_gg2").select("obs_name", "Run").join(r.withColumn("hit", F.lit(True)), "Run", "left").select("obs_name", "phenotype", F.coalesce("hit", F.lit(False)).alias("matched"))


@query("select n_name as project, coalesce(r_name, 'unknown') as region from nation left join (select * from region where r_name <> 'ASIA') on n_regionkey = r_regionkey")
def lookup_default(spark, sf):
    """A lookup in a small table with a default."""
    r = read_table(spark, sf, "region").filter("r_name <> 'ASIA'")
    return read_table(spark, sf, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_name").alias("project"), F.coalesce("r_name", F.lit("unknown")).alias("region"))


@query("""with z as (select c_custkey as sample, c_nationkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')), f as (select o_custkey as sample, arg_min(o_orderpriority, o_orderkey) as first_priority from orders group by 1)
select sample, case when first_priority is null then 'NO_ORDER' else 'NO_FINISHED' end as status, first_priority from z left join f using (sample)""")
def lookup_status(spark, sf):
    """Rows without facts, looked up again in the raw table by its first row, with a status."""
    o = read_table(spark, sf, "orders")
    z = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("sample")).join(o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("sample")), "sample", "left_anti")
    first = o.groupBy(F.col("o_custkey").alias("sample")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))
    return z.join(first, "sample", "left").select("sample", F.when(F.col("first_priority").isNull(), "NO_ORDER").otherwise("NO_FINISHED").alias("status"), "first_priority")


@query("select count(*) as compared, count(*) filter (where a.Project_ID is distinct from b.Project_ID) as project, count(*) filter (where a.Sex is distinct from b.Sex) as sex from (select distinct obs_name, Project_ID, Sex from merged_gg2_with_phylo) a join (select distinct obs_name, Project_ID, Sex from mcfcorpus_gg2) b using (obs_name)")
def compare_overlap(spark, sf):
    """Differences of two tables on their common rows, NULL equal to NULL."""
    a = _merged(spark, sf).select("obs_name", "Project_ID", "Sex").distinct()
    b = read_table(spark, sf, "mcfcorpus_gg2").select("obs_name", F.col("Project_ID").alias("p"), F.col("Sex").alias("s")).distinct()
    j = a.join(b, "obs_name")
    return j.agg(F.count("*").alias("compared"), F.count_if(~F.col("Project_ID").eqNullSafe(F.col("p"))).alias("project"), F.count_if(~F.col("Sex").eqNullSafe(F.col("s"))).alias("sex"))


@query("with f as (select o_orderstatus as project, l_partkey as asv, sum(l_linenumber) as n from lineitem join orders on l_orderkey = o_orderkey group by all), k as (select o_orderstatus as project, l_partkey as asv, min(l_returnflag) as mode from lineitem join orders on l_orderkey = o_orderkey where l_linenumber = 1 group by all) select f.project || '__' || f.asv as feature, n, mode from f left join k on f.project = k.project and f.asv = k.asv")
def lookup_two_keys(spark, sf):
    """A lookup by project and feature together, and the key that joins both names."""
    j = read_table(spark, sf, "lineitem").join(read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderstatus").alias("project"), F.col("l_partkey").alias("asv"), "l_linenumber", "l_returnflag")
    f = j.groupBy("project", "asv").agg(F.sum("l_linenumber").alias("n"))
    k = j.filter("l_linenumber = 1").groupBy("project", "asv").agg(F.min("l_returnflag").alias("mode"))
    return f.join(k, ["project", "asv"], "left").select(D.project_feature(F.col("project"), F.col("asv")).alias("feature"), "n", "mode")
