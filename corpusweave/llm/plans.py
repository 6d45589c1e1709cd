"""Queries of the training-data operators over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.text import is_missing, key_or_null
from corpusweave.llm.mixing import Mix
from corpusweave.llm.percentiles import DIGITS, daily_counts, fields, kept, latest, percentiles, restatement
from corpusweave.llm.proportions import ROUNDS, TargetSample
from corpusweave.llm.tokenizer import encode_corpus, token_counts
from corpusweave.llm.truncation import judge_documents
from corpusweave.llm.variety import varied_subset
from corpusweave.operators.sampling import simple_sample
from corpusweave.session import Stage, read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return encode_corpus(read_table(spark, sf, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


@query
def p7_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Number of tokens of every document by byte_bpe_50k."""
    return token_counts(read_table(spark, sf, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


def _mix(spark: SparkSession, sf: str) -> Mix:
    return Mix(read_table(spark, sf, "documents"), read_table(spark, sf, "mix_targets"))


@query
def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Listed sources that cannot reach their weight even at their most repeats."""
    return _mix(spark, sf).report().filter("out_of_reach").select("source")


@query
def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of the mix, each with its number of copies."""
    return _mix(spark, sf).documents()


@query
def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    """Target and reached share of every listed source."""
    return _mix(spark, sf).report()


def _sample(spark: SparkSession, sf: str) -> TargetSample:
    return TargetSample(read_table(spark, sf, "subset_100k_index"), "obs_name", read_table(spark, sf, "subset_targets"))


@query
def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Categories whose target or minimum cannot be met."""
    return _sample(spark, sf).report().filter("unmet").select("field_name", "category")


@query
def p2_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the distinct samples, drawn to the targets of all four fields together."""
    out = _sample(spark, sf).sample().withColumnRenamed("id", "obs_name")
    return out.withColumn("priority", F.round("priority", 6))


@query
def p2_report(spark: SparkSession, sf: str) -> DataFrame:
    """Available, wanted and drawn records of every target, what is out of reach and what the sample misses."""
    r = _sample(spark, sf).report()
    return r.withColumn("drawn_permille", F.round("drawn_permille", 6)).withColumn("wanted", F.round("wanted", 6))


_FIELDS = ("ma_bucket_detail", "overview_bucket", "rm_site", "stratum_id")
_NA = "case when lower(trim(coalesce({0}, ''))) in ('', '-', 'nan', 'none', '<na>', 'na') then 'NA' else upper(trim({0})) end"
_HAS_ID = "lower(trim(coalesce(obs_name, ''))) not in ('', '-', 'nan', 'none', '<na>', 'na')"


def _sample_sql() -> str:
    """The sample by sorting: ``s`` holds the drawn records, ``a`` the available ones, ``size`` the counts."""
    c = [f"c{i}" for i in range(4)]
    cells, both = ", ".join(c), " and ".join(f"r.{x} = d.{x}" for x in c)
    return f"""with recursive
e as ({" union ".join(f"select obs_name as id, '{f}' as field, {_NA.format(f)} as k from subset_100k_index where {_HAS_ID}" for f in _FIELDS)}),
size as (select floor(count(distinct id) / 5) as n, count(distinct id) as total from e),
tg as (select field_name as field, category, upper(trim(category)) as k, greatest(target_permille, 0) / 1000 as goal, target_permille, min_rows from subset_targets),
v as (select id, md5('42|' || id) as h, e.field, e.k, min_rows from e join tg on e.field = tg.field and e.k = tg.k),
a as (select field, k, count(*) as have from v group by 1, 2),
o as (select *, row_number() over (partition by field, k order by h) as r from v),
fl as (select id, bool_or(r <= min_rows) as floor, min(case when r <= min_rows then (r - 0.5) / min_rows end) as fp from o group by id),
ids as (select e.id, md5('42|' || e.id) as h, {", ".join(f"coalesce(min(case when e.field = '{f}' and tg.k is not null then e.k end), '') as c{i}" for i, f in enumerate(_FIELDS))} from e left join tg on e.field = tg.field and e.k = tg.k group by e.id),
d as (select ids.*, coalesce(floor, false) as floor, fp from ids left join fl using (id)),
cell as (select {cells}, count(*) as cnt from d group by all),
m as ({" union all ".join(f"select '{f}' as field, c{i} as k, sum(cnt) / n as most from cell, size group by c{i}, n" for i, f in enumerate(_FIELDS))}),
x as (select tg.field, tg.k, goal, coalesce(most, 0) as most, sum(goal) over (partition by tg.field) as whole, coalesce(most, 0) / goal as ratio from tg left join m on m.field = tg.field and m.k = tg.k where goal > 0),
y as (select *, (whole - coalesce(sum(most) over b, 0)) / (whole - coalesce(sum(goal) over b, 0)) * goal >= most as filled from x window b as (partition by field order by ratio, k rows between unbounded preceding and 1 preceding)),
z as (select field, k, case when filled then most else goal * (whole - coalesce(sum(most) filter (filled) over f, 0)) / (whole - coalesce(sum(goal) filter (filled) over f, 0)) end as goal from y window f as (partition by field)),
w as (select 0 as it, {", ".join(f"cell.{x}" for x in c)}, {", ".join(f"g{i}.goal as g{i}" for i in range(4))}, cnt / total as w, cnt / n as most from cell, size, {", ".join(f"z g{i}" for i in range(4))}
 where {" and ".join(f"g{i}.field = '{f}' and g{i}.k = cell.c{i} and g{i}.goal > 0" for i, f in enumerate(_FIELDS))}
 union all select it + 1, {cells}, g0, g1, g2, g3, least(w * pow({" * ".join(f"(g{i} / sum(w) over (partition by c{i}))" for i in range(4))}, 0.25), most), most from w where it < {ROUNDS}),
r as (select {cells}, round(w, 12) as w from w where it = {ROUNDS}),
p as (select d.*, (row_number() over (partition by {", ".join(f"d.{x}" for x in c)} order by floor desc, h) - 0.5) / nullif(r.w, 0) as priority from d left join r on {both}),
q as (select p.*, row_number() over (order by floor desc, case when floor then fp else priority end, case when floor then '' else c0 end, case when floor then '' else c1 end, case when floor then '' else c2 end, case when floor then '' else c3 end, h) as place from p where floor or priority is not null),
s as (select q.* from q, size where place <= n)"""


_NAMED = ", ".join(f"coalesce((select category from tg where field = '{f}' and k = c{i}), '-') as {f}" for i, f in enumerate(_FIELDS))
SQL["p2_sample"] = f"{_sample_sql()} select id as obs_name, {_NAMED}, floor, case when floor then 0 else round(priority, 6) end as priority from s"
SQL["p2_report"] = (
    f"{_sample_sql()}, g as ({' union all '.join(f"select '{f}' as field, c{i} as k, count(*) as drawn from s group by 2" for i, f in enumerate(_FIELDS))}), "
    "t as (select tg.*, coalesce(have, 0) as available, target_permille * n / 1000 as wanted, coalesce(drawn, 0) as drawn, n from tg cross join size left join a on a.field = tg.field and a.k = tg.k left join g on g.field = tg.field and g.k = tg.k) "
    "select field as field_name, category, target_permille, min_rows, available, round(wanted, 6) as wanted, available < wanted or available < min_rows as unmet, drawn, round(1000 * drawn / n, 6) as drawn_permille, drawn < greatest(least(floor(wanted), available), least(min_rows, available)) as missed from t"
)
SQL["p2_found"] = (
    "with v as ("
    + " union ".join(f"select '{f}' as field_name, {_NA.format(f)} as k, obs_name from subset_100k_index where {_HAS_ID}" for f in _FIELDS)
    + f"), n as (select floor(count(distinct obs_name) / 5) as n from subset_100k_index where {_HAS_ID}), a as (select field_name, k, count(*) as have from v group by 1, 2) "
    "select t.field_name, t.category from subset_targets t cross join n left join a on a.field_name = t.field_name and a.k = upper(trim(t.category)) "
    "where coalesce(have, 0) < target_permille * n / 1000 or coalesce(have, 0) < min_rows"
)

METRICS = ("total_reads", "n_taxa")
PROBS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def _days(spark: SparkSession, sf: str) -> DataFrame:
    return daily_counts(latest(read_table(spark, sf, "mcfcorpus_gg2"), "obs_name", "computed_at", "loaded_at", "Database", METRICS), METRICS)


@query
def p6_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles per database, day and metric."""
    return percentiles(_days(spark, sf), ("grp", "day", "metric"), PROBS).withColumnRenamed("grp", "database")


@query
def p6_overall(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles per database and metric over all days, from the counts of the days."""
    return percentiles(_days(spark, sf), ("grp", "metric"), PROBS).withColumnRenamed("grp", "database")


@query
def p6_restated(spark: SparkSession, sf: str) -> DataFrame:
    """The same as ``p6_overall``, from the days' results of the first half of the time of loading and what the second half changes in them."""
    df = read_table(spark, sf, "mcfcorpus_gg2")
    at = F.unix_micros(F.col("loaded_at").cast("timestamp"))
    first, last = df.agg(F.min(at), F.max(at)).head()
    late = F.coalesce(at > ((first or 0) + (last or 0)) // 2, F.lit(False))
    stage = Stage(spark)
    stored, delivered = (stage.put(kept(df.filter(c), "obs_name", "computed_at", "loaded_at", "Database", METRICS)) for c in (~late, late))
    counts = daily_counts(fields(stored, METRICS), METRICS).unionByName(restatement(stored, delivered, METRICS))
    return percentiles(counts, ("grp", "metric"), PROBS).withColumnRenamed("grp", "database")


def _percentile_sql(keys: str) -> str:
    one = "select obs_name, {m} from (select *, row_number() over (partition by obs_name order by loaded_at desc, total_reads desc nulls last, n_taxa desc nulls last, computed_at) as r from mcfcorpus_gg2) where r = 1"
    rows = one.format(m="case when lower(trim(coalesce(\"Database\", ''))) in ('', '-', 'nan', 'none', '<na>', 'na') then '(none)' else upper(trim(\"Database\")) end as database, cast(computed_at as date) as day, total_reads, n_taxa")
    step = f"case when len(cast(v as varchar)) <= {DIGITS} then 1 else cast(rpad('1', cast(len(cast(v as varchar)) - {DIGITS} + 1 as integer), '0') as bigint) end"
    picks = ", ".join(f"max(case when r = greatest(1, ceil(round({p} * n, 6))) then q end) as p{round(p * 100):02d}" for p in PROBS)
    return f"""with o as ({rows}), l as (select database, day, 'total_reads' as metric, total_reads as v from o union all select database, day, 'n_taxa', n_taxa from o),
s as (select {keys}, count(*) filter (v >= 0) as n, count(*) filter (v is null) as n_null, count(*) filter (v < 0) as n_negative from l group by all),
k as (select {keys}, v - v % ({step}) + case when {step} > 1 then ({step}) / 2 else 0 end as q, row_number() over (partition by {keys} order by v) as r, count(*) over (partition by {keys}) as n from l where v >= 0),
p as (select {keys}, {picks} from k group by all)
select {keys}, n, n_null, n_negative, {", ".join(f"p{round(p * 100):02d}" for p in PROBS)} from s left join p using ({keys})"""


SQL["p6_daily"] = _percentile_sql("database, day, metric")
SQL["p6_overall"] = SQL["p6_restated"] = _percentile_sql("database, metric")

VARIETY = ("Project_ID", "MA_Env_Animal_Sub", "RM_Sample_Site")


VARIETY_CLUSTERS, VARIETY_WEIGHTS, VARIETY_EQUAL = 48, (0.3, 1.0, 1.0), True


@query
def p4_varied(spark: SparkSession, sf: str) -> DataFrame:
    """One fiftieth of the distinct samples, chosen for variety of all three fields.

    The quota of each cluster is dealt out over its kinds, the combinations of the three values, in rounds.
    """
    return varied_subset(read_table(spark, sf, "merged_gg2_with_phylo"), "obs_name", VARIETY, share=0.02, k=VARIETY_CLUSTERS, weights=VARIETY_WEIGHTS, equal=VARIETY_EQUAL).withColumnRenamed("id", "obs_name")


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per field: distinct values and share of the largest, of all samples, of the subset and of a random one of equal size."""
    m = read_table(spark, sf, "merged_gg2_with_phylo")
    ids = m.filter(~is_missing(F.col("obs_name"))).groupBy("obs_name").agg(*(F.max(key_or_null(F.col(f))).alias(f) for f in VARIETY))
    ids = Stage(spark).put(ids)
    chosen = Stage(spark).put(p4_varied(spark, sf).select("obs_name"))
    sets = {"all": ids, "subset": ids.join(chosen, "obs_name"), "random": simple_sample(ids, chosen.count(), "obs_name")}
    out = None
    for name, d in sets.items():
        n = d.select(F.inline(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("v")) for f in VARIETY)))).groupBy("field_name", "v").agg(F.count("*").alias("n"))
        n = n.groupBy("field_name").agg(F.count("*").alias(f"values_{name}"), (F.max("n") / F.sum("n")).alias(f"largest_{name}"))
        out = n if out is None else out.join(n, "field_name")
    return out


@query
def p4_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Per field: what all samples and a random subset hold, and that the chosen subset covers no fewer values."""
    return coverage(spark, sf).select("field_name", "values_all", "values_random", F.round("largest_all", 6).alias("largest_all"), F.round("largest_random", 6).alias("largest_random"), (F.col("values_subset") >= F.col("values_random")).alias("covers_more"))


_KEY_SQL = "case when lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) in ('', '-', 'nan', 'none', '<na>', 'na') then null else upper(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) end"
SQL["p4_coverage"] = (
    f"with ids as (select obs_name, {', '.join(f'max({_KEY_SQL.format(f)}) as {f}' for f in VARIETY)} from merged_gg2_with_phylo where {_HAS_ID} group by 1), "
    "pick as (select * from (select *, row_number() over (order by md5('42|' || obs_name)) as r, count(*) over () as total from ids) where r <= floor(total / 50)), "
    + ", ".join(f"{t} as (select field_name, count(*) as vals, max(n) / sum(n) as largest from (" + " union all ".join(f"select '{f}' as field_name, {f} as v, count(*) as n from {src} group by {f}" for f in VARIETY) + ") group by 1)" for t, src in (("a", "ids"), ("b", "pick")))
    + " select field_name, a.vals as values_all, b.vals as values_random, round(a.largest, 6) as largest_all, round(b.largest, 6) as largest_random, true as covers_more from a join b using (field_name)"
)


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return judge_documents(read_table(spark, sf, "documents"))


@query
def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose text was cut before its end."""
    return _judged(spark, sf).filter("cut").select("doc_id")


@query
def p9_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, cut documents and their share per source."""
    n = _judged(spark, sf).groupBy("source").agg(F.count("*").alias("n_docs"), F.count_if("cut").alias("n_cut"))
    return n.withColumn("share_cut", F.round(F.col("n_cut") / F.col("n_docs"), 6))


@query
def p9_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Cut documents per source and kind of evidence: which comparison decided."""
    return _judged(spark, sf).filter("cut").groupBy("source", "evidence").agg(F.count("*").alias("n_cut"))
