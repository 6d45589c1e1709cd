"""Queries over counts, taxonomy and merged corpora.

A customer is a sample, a part a feature and the summed quantity a count; a part's type, brand and name make its taxonomy
path. The sample tables of the merged corpus are used where a query needs real sample columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.metadata import surrogate_id
from corpusweave.functions.taxonomy import DEPTH_ORDER, RANKS, has_split_suffix, is_real, keep_feature, rank_token, split_key, with_ranks
from corpusweave.operators import counts as C
from corpusweave.operators import merge as M
from corpusweave.operators.skew import add_quantiles
from corpusweave.session import Stage, read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}
MIN_READS, MIN_FEATURES = 1000, 5
DOMAINS = ("d__MEDIUM", "d__STANDARD", "d__LARGE", "d__PROMO")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    j = read_table(spark, sf, "lineitem").join(read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return C.facts(j.withColumn("q", F.col("l_quantity").cast("bigint")), "o_custkey", "l_partkey", "q")


_F = "f as (select o_custkey as sample, l_partkey as feature, cast(sum(cast(l_quantity as bigint)) as bigint) as n from lineitem join orders on l_orderkey = o_orderkey group by 1, 2 having sum(cast(l_quantity as bigint)) > 0)"
_T = "t as (select sample, cast(sum(n) as bigint) as total_reads, count(*) as n_taxa from f group by 1)"
_QC = f"{_F}, {_T}, q as (select f.* from f join t using (sample) where total_reads >= {MIN_READS} and n_taxa >= {MIN_FEATURES})"


def _qc(spark: SparkSession, sf: str) -> DataFrame:
    return C.quality_control(_facts(spark, sf), MIN_READS, MIN_FEATURES)


@query(f"with {_F}, {_T} select sample, cast(total_reads as bigint) as total_reads, n_taxa from t")
def corpus_sample_totals(spark, sf):
    """Reads and features per sample."""
    return C.sample_totals(_facts(spark, sf))


@query(f"with {_F} select feature, count(*) as n_samples from f group by 1")
def corpus_prevalence(spark, sf):
    """Samples per feature."""
    return C.prevalence(_facts(spark, sf))


@query(f"with {_QC} select * from q")
def corpus_qc(spark, sf):
    """Facts after quality control."""
    return _qc(spark, sf)


@query(f"with {_QC} select count(*) as facts, count(distinct sample) as samples, count(distinct feature) as features, cast(sum(n) as bigint) as reads from q")
def corpus_qc_summary(spark, sf):
    """Size of the corpus after quality control."""
    return _qc(spark, sf).agg(F.count("*").alias("facts"), F.count_distinct("sample").alias("samples"), F.count_distinct("feature").alias("features"), F.sum("n").alias("reads"))


@query(f"with {_QC} select sample, feature, n, round(n / sum(n) over (partition by sample), 9) as share from q")
def corpus_shares(spark, sf):
    """Share of every fact in its sample."""
    return C.shares(_qc(spark, sf)).withColumn("share", F.round("share", 9))


_STATS = f"""with {_QC}, s as (select *, n / sum(n) over (partition by sample) as share from q), p as (select feature, count(*) as k, sum(n) as mass, avg(share) as ms from s group by 1)
select v.p_partkey as feature, p.feature is not null as observed, coalesce(k, 0) as n_samples_observed, round(coalesce(k, 0) / (select count(distinct sample) from q), 9) as prevalence,
round(coalesce(mass, 0) / (select sum(mass) from p), 9) as mass_fraction, round(coalesce(ms, 0), 9) as mean_share_when_present from part v left join p on p.feature = v.p_partkey"""


@query(_STATS)
def corpus_finalise_features(spark, sf):
    """Per feature of the vocabulary: prevalence, share of the corpus, mean share where present."""
    vocabulary = read_table(spark, sf, "part").select(F.col("p_partkey").alias("feature"))
    out = C.feature_stats(_qc(spark, sf), vocabulary)
    return out.select("feature", "observed", "n_samples_observed", *(F.round(c, 9).alias(c) for c in ("prevalence", "mass_fraction", "mean_share_when_present")))


@query(f"""with {_F}, {_T}, c as (select c_custkey as sample, 'R' || (c_custkey % 700) as run, c_mktsegment as source from customer), r as (select run from c group by 1 having count(distinct source) >= 2)
select c.sample, c.source, cast(coalesce(total_reads, 0) as bigint) as total_reads, coalesce(n_taxa, 0) as n_taxa, r.run as pair_id from c left join t using (sample) left join r using (run)""")
def corpus_finalise_samples(spark, sf):
    """Samples with their totals and the id that joins runs found in several sources."""
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("sample"), F.concat(F.lit("R"), F.col("c_custkey") % 700).alias("run"), F.col("c_mktsegment").alias("source"))
    out = M.cross_source_ids(c, "run", "source").join(C.sample_totals(_facts(spark, sf)), "sample", "left")
    return out.select("sample", "source", F.coalesce("total_reads", F.lit(0)).alias("total_reads"), F.coalesce("n_taxa", F.lit(0)).alias("n_taxa"), "pair_id")


@query(f"with {_F}, {_T}, c as (select c_custkey as sample from customer) select count(*) as n_samples, count(*) filter (where sample not in (select sample from f)) as n_empty from c")
def corpus_empty_samples(spark, sf):
    """Samples without a fact."""
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("sample"))
    marked = c.join(_facts(spark, sf).select("sample").distinct().withColumn("hit", F.lit(True)), "sample", "left")
    return marked.agg(F.count("*").alias("n_samples"), F.count_if(F.col("hit").isNull()).alias("n_empty"))


@query(f"with {_F}, {_T} select min(total_reads) as least, median(total_reads) as mid, max(total_reads) as most, min(n_taxa) as least_taxa, median(n_taxa) as mid_taxa, max(n_taxa) as most_taxa from t")
def corpus_summary(spark, sf):
    """Least, middle and greatest totals."""
    t = Stage(spark).put(C.sample_totals(_facts(spark, sf)))
    stats = t.agg(*(g(c).alias(a + s) for c, s in (("total_reads", ""), ("n_taxa", "_taxa")) for g, a in ((F.min, "least"), (F.max, "most"))))
    return add_quantiles(stats, t, {"mid": ("total_reads", 0.5), "mid_taxa": ("n_taxa", 0.5)})


# ---------------------------------------------------------------- taxonomy

_PATH = """case when p_partkey % 11 = 0 then 'Unassigned' when p_partkey % 17 = 0 then null when p_partkey % 7 = 0 then concat('d__', p_type, '; p__', p_brand)
 when p_partkey % 13 = 0 then concat('d__', p_type, '; p__', p_brand, ';c__C;o__O; f__Mitochondria')
 else concat('d__', p_type, '; p__', p_brand, '; c__', split_part(p_name, ' ', 2), '; o__', split_part(p_name, ' ', 1), '; f__F', p_partkey % 31, '; g__', case when p_partkey % 5 = 0 then '' else concat('G', p_partkey % 97) end, '; s__') end"""


def _taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    t = read_table(spark, sf, "part").select(F.col("p_partkey").alias("feature"), F.expr(_PATH).alias("path"))
    return with_ranks(t, "path")


_PRE = {r: p for r, p in zip(RANKS, ("d__", "p__", "c__", "o__", "f__", "g__", "s__"), strict=True)}
_PIECE = "list_filter(list_transform(string_split(path, ';'), lambda x: trim(x)), lambda x: starts_with(x, '{p}'))[1] as {r}"
_DEEP = "coalesce(" + ", ".join(f"case when {r} <> '{p}' then '{r}' end" for r, p in reversed(_PRE.items())) + ", 'None') as deepest"
_VAR = " || ';' || ".join(f"coalesce({r}, '{p}')" for r, p in list(_PRE.items())[:6]) + " as var_id"
_RANKED = f"x as (select p_partkey as feature, {_PATH} as path from part), y as (select *, {', '.join(_PIECE.format(r='\"' + r + '\"', p=p) for r, p in _PRE.items())} from x), tx as (select *, {_DEEP}, {_VAR} from y)".replace(" Order ", ' "Order" ')
_RANKED = _RANKED.replace("when Order <>", 'when "Order" <>').replace("coalesce(Order,", 'coalesce("Order",')


@query(f"with {_RANKED} select * from tx")
def taxonomy_ranks(spark, sf):
    """Ranks, deepest rank and group key of every feature."""
    return _taxonomy(spark, sf)


_DOM = "(values " + ", ".join(f"('{r}', {i})" for i, r in enumerate(DEPTH_ORDER)) + ") d(deepest, position)"


@query(f"with {_RANKED} select d.deepest, d.position, count(tx.feature) as n, round(100.0 * count(tx.feature) / (select count(*) from tx), 6) as percent from {_DOM} left join tx using (deepest) group by 1, 2")
def taxonomy_depths(spark, sf):
    """Features per deepest rank in a fixed order, absent ranks with 0."""
    t = _taxonomy(spark, sf)
    n = t.groupBy("deepest").agg(F.count("*").alias("n"))
    domain = spark.createDataFrame([(r, i) for i, r in enumerate(DEPTH_ORDER)], "deepest string, position int")
    out = domain.join(n, "deepest", "left")
    return out.join(F.broadcast(t.agg(F.count("*").alias("all")))).select("deepest", "position", F.coalesce("n", F.lit(0)).alias("n"), F.round(100 * F.coalesce("n", F.lit(0)) / F.col("all"), 6).alias("percent"))


_KEEP = "\"Domain\" in (" + ", ".join(f"'{d}'" for d in DOMAINS) + ") and not coalesce(contains(lower(path), 'mitochondri'), false) and not coalesce(contains(lower(path), 'chloroplast'), false)"


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    t = _taxonomy(spark, sf)
    return t.filter(keep_feature(F.col("path"), F.col("Domain"), DOMAINS))


@query(f"with {_RANKED} select feature, var_id, coalesce(length(\"Genus\") > 3, false) as named from tx where {_KEEP}")
def taxonomy_kept(spark, sf):
    """Features of the wanted domains that are no organelles, and whether their genus has a name."""
    return _kept(spark, sf).select("feature", "var_id", is_real(F.col("Genus")).alias("named"))


@query(f"with {_RANKED} select var_id, min(feature) as feature, arg_min(path, feature) as path from tx where {_KEEP} group by 1")
def taxonomy_first_row(spark, sf):
    """The first feature of every group key."""
    return C.first_rows(_kept(spark, sf).select("var_id", "feature", "path"), "var_id", "feature")


@query(f"with {_RANKED} select distinct var_id, " + ", ".join(f"string_split(var_id, ';')[{i + 1}] as r{i}" for i in range(6)) + " from tx")
def taxonomy_split_key(spark, sf):
    """The ranks of every group key."""
    keys = _taxonomy(spark, sf).select("var_id").distinct()
    return keys.select("var_id", *(c.alias(f"r{i}") for i, c in enumerate(split_key(F.col("var_id")))))


@query("select p_partkey as feature, nullif(regexp_extract(concat(p_name, '; g__', p_brand, case when p_partkey % 3 = 0 then '_A' else '' end), '(g__[A-Za-z0-9_.-]+)', 1), '') as token, regexp_matches(concat('g__', p_size, case when p_partkey % 3 = 0 then '_A' else '' end), '_[A-Z]$') as split_name from part")
def taxonomy_tokens(spark, sf):
    """Genus token of a label and the mark of split names."""
    p = read_table(spark, sf, "part")
    tail = F.when(F.col("p_partkey") % 3 == 0, F.lit("_A")).otherwise(F.lit(""))
    return p.select(F.col("p_partkey").alias("feature"), rank_token(F.concat("p_name", F.lit("; g__"), "p_brand", tail)).alias("token"), has_split_suffix(F.concat(F.lit("g__"), F.col("p_size"), tail)).alias("split_name"))


_ROLL = f"{_F}, {_RANKED}, lk as (select feature, var_id from tx where {_KEEP}), g as (select f.sample, lk.var_id as feature, cast(sum(n) as bigint) as n from f join lk using (feature) group by 1, 2)"


def _rolled(spark, sf):
    return C.roll_up(_facts(spark, sf), _kept(spark, sf))


@query(f"with {_ROLL} select * from g")
def rollup_counts(spark, sf):
    """Counts per sample and group key."""
    return _rolled(spark, sf)


@query(f"with {_ROLL}, a as (select sample, sum(n) as reads_in from f group by 1), b as (select sample, sum(n) as reads_out from g group by 1) select sample, cast(reads_in as bigint) as reads_in, cast(coalesce(reads_out, 0) as bigint) as reads_out, round((reads_in - coalesce(reads_out, 0)) / reads_in, 9) as lost from a left join b using (sample)")
def rollup_loss(spark, sf):
    """Reads lost per sample by the roll-up."""
    return C.loss(_facts(spark, sf), _rolled(spark, sf)).withColumn("lost", F.round("lost", 9))


@query(f"with {_ROLL}, a as (select sample, sum(n) as i from f group by 1), b as (select sample, sum(n) as o from g group by 1), l as (select i, coalesce(o, 0) as o, (i - coalesce(o, 0)) / i as lost from a left join b using (sample)) select cast(sum(i) as bigint) as reads_in, cast(sum(o) as bigint) as reads_out, round(100.0 * (sum(i) - sum(o)) / sum(i), 6) as lost_percent, " + ", ".join(f"round(quantile_cont(lost, {q}), 6) as q{round(q * 100)}" for q in (0.5, 0.75, 0.9, 0.95, 0.99)) + ", round(max(lost), 6) as worst, count(*) filter (where lost > 0.5) as over_half from l")
def rollup_loss_summary(spark, sf):
    """Loss of the whole corpus and quantiles of the samples' losses."""
    s = C.loss_summary(C.loss(_facts(spark, sf), _rolled(spark, sf)))
    return s.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in s.dtypes))


@query(f"with {_ROLL}, a as (select c_nationkey as project, sum(n) as i from f join customer on sample = c_custkey group by 1), b as (select c_nationkey as project, sum(n) as o from g join customer on sample = c_custkey group by 1) select project, cast(i as bigint) as reads_in, round((i - coalesce(o, 0)) / i, 6) as lost from a left join b using (project) order by round((i - coalesce(o, 0)) / i, 6) desc, project limit 10")
def rollup_worst_projects(spark, sf):
    """The ten projects that lose the largest part of their reads."""
    project = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("sample"), F.col("c_nationkey").alias("project"))
    per = C.loss(_facts(spark, sf), _rolled(spark, sf)).join(project, "sample").groupBy("project").agg(F.sum("reads_in").alias("reads_in"), F.sum("reads_out").alias("o"))
    return per.select("project", "reads_in", F.round((F.col("reads_in") - F.col("o")) / F.col("reads_in"), 6).alias("lost")).orderBy(F.desc("lost"), "project").limit(10)


@query(f"with {_ROLL}, kf as (select feature from tx where {_KEEP} and coalesce(length(\"Genus\") > 3, false)), h as (select f.* from f join kf using (feature)), ht as (select sample from h group by 1 having sum(n) >= 500 and count(*) >= {MIN_FEATURES}) select h.* from h join ht using (sample)")
def corpus_qc_named(spark, sf):
    """Quality control over the features whose genus has a name."""
    named = _kept(spark, sf).filter(is_real(F.col("Genus")))
    return C.quality_control(_facts(spark, sf), 500, MIN_FEATURES, keep=named)


# ---------------------------------------------------------------- merge

_COMMON = ("Database", "Run", "BioSample", "Project_ID")


@query("""with a as (select "Database", Run, BioSample, Project_ID, MA_IsHuman as L_human, null as R_site from merged_gg2_with_phylo where obs_name like 'MA%'), b as (select "Database", Run, BioSample, Project_ID, null as L_human, RM_Sample_Site as R_site from merged_gg2_with_phylo where obs_name like 'RM%') select * from a union all select * from b""")
def merge_outer(spark, sf):
    """Samples of two sources appended, each with its own columns."""
    m = read_table(spark, sf, "merged_gg2_with_phylo")
    left = m.filter(F.col("obs_name").startswith("MA")).select(*_COMMON, F.col("MA_IsHuman").alias("human"))
    right = m.filter(F.col("obs_name").startswith("RM")).select(*_COMMON, F.col("RM_Sample_Site").alias("site"))
    return M.merge_samples({"L_": left, "R_": right}, _COMMON)


_HALF = "l as (select distinct l_partkey as k from lineitem where l_returnflag = 'R'), r as (select distinct l_partkey as k from lineitem where l_returnflag = 'A')"


@query(f"with {_HALF}, u as (select k, max(s = 'l') as il, max(s = 'r') as ir from (select k, 'l' as s from l union all select k, 'r' from r) group by 1) select count(*) filter (where il) as n_left, count(*) filter (where ir) as n_right, count(*) filter (where il and ir) as n_both, count(*) filter (where not ir) as only_left, count(*) filter (where not il) as only_right, count(*) as n_union from u")
def merge_set_sizes(spark, sf):
    """Shared and one-sided features of two vocabularies: parts returned and parts accepted."""
    li = read_table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"), "l_returnflag")
    return M.set_sizes(li.filter("l_returnflag = 'R'"), li.filter("l_returnflag = 'A'"), "k")


@query("""with t as (select distinct k, s from (select p_partkey as k, 'a' as s from part where p_size < 45 union all select l_partkey, 'b' from lineitem where l_returnflag = 'R' union all select p_partkey, 'c' from part)) select k, array_to_string(list_sort(list_filter(['a', 'b', 'c'], lambda x: not list_contains(list(s), x))), ',') as missing_in from t group by k having count(*) < 3""")
def merge_key_differences(spark, sf):
    """Keys that one of several tables lacks."""
    p = read_table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_size")
    li = read_table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("k"))
    return M.key_differences({"a": p.filter("p_size < 45"), "b": li, "c": p}, "k")


@query(f"with {_QC}, h as (select distinct feature from q where n >= 45) select p_partkey as feature, h.feature is not null as observed from part left join h on p_partkey = h.feature")
def merge_expand_vocabulary(spark, sf):
    """Observed features and those that only the vocabulary has."""
    return M.expand_vocabulary(_qc(spark, sf).filter("n >= 45"), read_table(spark, sf, "part").select(F.col("p_partkey").alias("feature")))


@query("""with r as (select Run as run from merged_gg2_with_phylo where Run is not null group by 1 having count(distinct "Database") >= 2) select obs_name, m.Run as run, r.run as pair_id from merged_gg2_with_phylo m left join r on m.Run = r.run""")
def merge_pairs(spark, sf):
    """Every sample with the id that pairs its run across databases."""
    m = read_table(spark, sf, "merged_gg2_with_phylo").select("obs_name", F.col("Run").alias("run"), "Database")
    return M.cross_source_ids(m, "run", "Database").drop("Database")


@query("select obs_name, count(*) as \"count\" from merged_gg2_with_phylo group by 1 having count(*) > 1")
def merge_duplicates(spark, sf):
    """Sample names that occur more than once."""
    return M.duplicates(read_table(spark, sf, "merged_gg2_with_phylo"), "obs_name")


_SIDE = "select o_custkey as sample, l_partkey as feature, sum(cast(l_quantity as bigint)) as n from lineitem join orders on l_orderkey = o_orderkey where {0} group by 1, 2"


@query(f"with a as ({_SIDE.format("o_orderstatus = 'F'")}), b as ({_SIDE.format("o_orderstatus <> 'F'")}), m as (select sample, feature, sum(n) as n from (select * from a union all select * from b) group by 1, 2) select cast((select sum(n) from a) as bigint) as reads_left, cast((select sum(n) from b) as bigint) as reads_right, cast((select sum(n) from m) as bigint) as reads_merged, (select sum(n) from a) + (select sum(n) from b) = (select sum(n) from m) as conserved")
def merge_conservation(spark, sf):
    """Reads of two sources, finished and open orders, and of the merged corpus."""
    j = read_table(spark, sf, "lineitem").join(read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("q", F.col("l_quantity").cast("bigint"))
    left, right = (C.facts(j.filter(c), "o_custkey", "l_partkey", "q") for c in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"))
    merged = C.facts(M.merge_facts(left, right), "sample", "feature", "n")
    one = lambda f, a: f.agg(F.sum("n").alias(a))
    out = one(left, "reads_left").join(F.broadcast(one(right, "reads_right"))).join(F.broadcast(one(merged, "reads_merged")))  # single rows
    return out.withColumn("conserved", F.col("reads_left") + F.col("reads_right") == F.col("reads_merged"))


@query("select obs_name, 'MA_' || lpad(cast(row_number() over (order by obs_name) - 1 as varchar), 7, '0') as surrogate from (select distinct obs_name from merged_gg2_with_phylo where obs_name is not null)")
def merge_surrogate_ids(spark, sf):
    """Zero-padded ids in the order of the names, numbered without one sorting task."""
    d = read_table(spark, sf, "merged_gg2_with_phylo").select("obs_name").filter("obs_name IS NOT NULL").distinct()
    return M.number_rows(d, "obs_name").select("obs_name", surrogate_id("MA_", F.col("row_number")).alias("surrogate"))


@query("select RM_Continent as continent, count(*) as n from merged_gg2_with_phylo where RM_Continent is not null group by 1")
def stats_value_counts(spark, sf):
    """Rows per value, missing left out."""
    return read_table(spark, sf, "merged_gg2_with_phylo").filter("RM_Continent IS NOT NULL").groupBy(F.col("RM_Continent").alias("continent")).agg(F.count("*").alias("n"))


@query("select count(distinct Project_ID) as n_projects, count(distinct Run) as n_runs, count(distinct \"Database\") as n_databases from merged_gg2_with_phylo")
def stats_nunique(spark, sf):
    """Distinct values of several columns."""
    m = read_table(spark, sf, "merged_gg2_with_phylo")
    return m.agg(*(F.count_distinct(c).alias(a) for c, a in (("Project_ID", "n_projects"), ("Run", "n_runs"), ("Database", "n_databases"))))


_RM = ("RM_PMID", "RM_Platform", "RM_Phenotype", "RM_Age", "RM_BMI", "RM_Country", "RM_Location", "RM_Is_Healthy", "MA_Health", "MA_SampleSite", "Latitude", "Smoking")


@query("with u as (" + " union all ".join(f"select '{c}' as column_name, count({c}) / count(*) as rate from merged_gg2_with_phylo" for c in _RM) + ") select column_name, round(rate, 9) as rate from u order by round(rate, 9), column_name limit 10")
def stats_non_null(spark, sf):
    """The ten columns with the fewest filled values, counted in one pass."""
    out = C.non_null_rates(read_table(spark, sf, "merged_gg2_with_phylo").select(*_RM))
    return out.withColumn("rate", F.round("rate", 9)).orderBy("rate", "column_name").limit(10)


_TYPES = ("AMPLICON", "WGS", "RNAseq")


@query("select \"Database\" as database, " + ", ".join(f"count(*) filter (where Sequencing_Type = '{t}') as {t}" for t in _TYPES) + " from merged_gg2_with_phylo group by 1")
def stats_contingency(spark, sf):
    """Two-key counts as a table with a column per known value."""
    m = read_table(spark, sf, "merged_gg2_with_phylo").select(F.col("Database").alias("database"), "Sequencing_Type")
    out = m.groupBy("database").pivot("Sequencing_Type", list(_TYPES)).count()
    return out.select("database", *(F.coalesce(t, F.lit(0)).alias(t) for t in _TYPES))


@query("with m as (select Run as run, case when obs_name like 'MA%' then 'ma' else 'rm' end as role, min(obs_name) as o from merged_gg2_with_phylo where Run is not null group by 1, 2) select run, max(case when role = 'ma' then o end) as ma, max(case when role = 'rm' then o end) as rm from m group by 1 having count(*) = 2")
def stats_pair_pivot(spark, sf):
    """Runs with a sample in both roles, one column per role."""
    m = read_table(spark, sf, "merged_gg2_with_phylo").filter("Run IS NOT NULL").select(F.col("Run").alias("run"), F.when(F.col("obs_name").startswith("MA"), "ma").otherwise("rm").alias("role"), "obs_name")
    return m.groupBy("run").pivot("role", ["ma", "rm"]).agg(F.min("obs_name")).dropna()


@query("with n as (select Project_ID as p, count(*) as n from merged_gg2_with_phylo where Project_ID is not null group by 1), k as (select *, row_number() over (order by n desc, p) as r from n) select case when r <= 10 then p else 'Other' end as project, cast(sum(n) as bigint) as n from k group by 1")
def stats_top_other(spark, sf):
    """The ten most frequent projects, all others as one."""
    n = read_table(spark, sf, "merged_gg2_with_phylo").filter("Project_ID IS NOT NULL").groupBy(F.col("Project_ID").alias("p")).agg(F.count("*").alias("n"))
    top = F.broadcast(n.orderBy(F.desc("n"), "p").limit(10).select("p", F.lit(True).alias("top")))  # ten rows
    return n.join(top, "p", "left").groupBy(F.when(F.col("top"), F.col("p")).otherwise("Other").alias("project")).agg(F.sum("n").alias("n"))


@query(f"with {_F}, s as (select feature, n, lag(n) over (partition by sample order by n desc, feature) as prev, row_number() over (partition by sample order by n desc, feature) as r, sample from f) select sample, feature, n, r, coalesce(prev - n, 0) as gap from s where r <= 3")
def corpus_top_features(spark, sf):
    """The three largest features of every sample with the gap to the one before."""
    w = W.partitionBy("sample").orderBy(F.desc("n"), "feature")
    s = _facts(spark, sf).withColumn("r", F.row_number().over(w)).withColumn("prev", F.lag("n").over(w))
    return s.filter("r <= 3").select("sample", "feature", "n", "r", F.coalesce(F.col("prev") - F.col("n"), F.lit(0)).alias("gap"))


@query(f"with {_RANKED} select \"Family\" as family, count(distinct \"Genus\") as n, array_to_string(list_sort(list(distinct \"Genus\")), ',') as genera from tx where \"Family\" is not null and \"Genus\" is not null group by 1")
def taxonomy_family_genera(spark, sf):
    """The genera of every family; a family's distinct genera are few by the nature of the vocabulary."""
    t = _taxonomy(spark, sf).filter("Family IS NOT NULL AND Genus IS NOT NULL").select(F.col("Family").alias("family"), F.col("Genus").alias("g")).distinct()
    return t.groupBy("family").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("g")), ",").alias("genera"))


@query("select p_brand, dense_rank() over (order by p_brand) - 1 as code from (select distinct p_brand from part)")
def stats_codes(spark, sf):
    """Dense integer codes of a column's values in their order, numbered over range partitions."""
    d = read_table(spark, sf, "part").select("p_brand").distinct()
    return M.number_rows(d, "p_brand").select("p_brand", (F.col("row_number") - 1).alias("code"))


@query("select count(*) as touched from (select l_orderkey as k from lineitem where l_returnflag = 'R' union select o_orderkey from orders where o_orderstatus = 'P')")
def merge_touched(spark, sf):
    """Keys touched by either of two changes, each once."""
    a = read_table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"))
    b = read_table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("k"))
    return a.union(b).distinct().agg(F.count("*").alias("touched"))


@query("select Run as run, count(*) as n from merged_gg2_with_phylo where Run in (select Run from mcfcorpus_gg2 where total_reads > 1000000) group by 1")
def lookup_semi(spark, sf):
    """Rows whose run has a large sample in another table."""
    big = read_table(spark, sf, "mcfcorpus_gg2").filter("total_reads > 1000000").select("Run")
    return read_table(spark, sf, "merged_gg2_with_phylo").join(big, "Run", "left_semi").groupBy(F.col("Run").alias("run")).agg(F.count("*").alias("n"))
