"""Queries that write a table in some form and read it back, parse record texts, and ingest a stream."""

from __future__ import annotations

import io
import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corpusweave.session import read_table, shared_folder
from corpusweave.sources import biom
from corpusweave.sources import bundle as B
from corpusweave.sources import tabular as S
from corpusweave.sources.newick import read_newick, write_newick
from corpusweave.streaming import ingest as I

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _place(spark) -> str:
    return f"{shared_folder(spark)}/tables_{uuid.uuid4().hex}"


@query("select c_custkey, c_name, case when c_nationkey = 3 then null else c_mktsegment end as c_mktsegment, c_acctbal from customer")
def source_tsv(spark, sf):
    """A table through tab-separated text, with NULLs and fixed decimals."""
    path = _place(spark)
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal")
    S.write_tsv(c, path, digits=4)
    t = S.read_tsv(spark, path, c.columns)
    return t.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment", F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("select n_nationkey, n_name from nation")
def source_utf16(spark, sf):
    """A table through UTF-16 text."""
    path = _place(spark)
    n = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("n_nationkey"), "n_name")
    n.coalesce(1).write.option("sep", "\t").option("header", True).option("encoding", "UTF-16LE").csv(path)
    return S.read_tsv(spark, path, n.columns, encoding="UTF-16LE").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


@query("select count(*) as n_records from part where p_size <> 7")
def source_fasta(spark, sf):
    """Sequence records written as text and counted."""
    path = _place(spark)
    p = read_table(spark, sf, "part").select(F.concat_ws(";", "p_type", "p_brand", "p_partkey").alias("name"), F.when(F.col("p_size") == 7, "").otherwise(F.repeat(F.lit("ACGT"), F.col("p_size"))).alias("seq"))
    S.fasta_lines(p, "name", "seq").write.text(path)
    return spark.createDataFrame([(S.count_fasta(spark, path),)], "n_records long")


_FACTS = "select o_orderstatus as project, l_partkey as feature, 's' || left(o_orderpriority, 1) as sample, cast(sum(cast(l_quantity as bigint)) as bigint) as n from lineitem join orders on l_orderkey = o_orderkey group by all"


@query(f"with f as ({_FACTS}) select project, cast(feature as varchar) as feature, sample, n from f where n > 0")
def source_projects(spark, sf):
    """Dense count tables of several project folders in one scan, as facts."""
    path = _place(spark)
    j = read_table(spark, sf, "lineitem").join(read_table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.withColumn("sample", F.concat(F.lit("s"), F.substring("o_orderpriority", 1, 1)))
    wide = j.groupBy(F.col("o_orderstatus").alias("project"), F.col("l_partkey").alias("feature")).pivot("sample", [f"s{i}" for i in range(1, 6)]).agg(F.sum(F.col("l_quantity").cast("bigint")))
    wide.write.partitionBy("project").option("sep", "\t").option("header", True).option("nullValue", "").csv(path)
    cols = ["feature", *(f"s{i}" for i in range(1, 6))]
    t = S.read_projects(spark, f"{path}/project=*", cols, r"project=([^/]+)/")
    S.require_inputs(j.select(F.col("o_orderstatus").alias("project")), t)
    return S.unpivot_counts(t, "feature", ["project"]).select("project", "feature", "sample", "n")


@query("""with d as (select doc_id, text from documents where regexp_matches(text, '^[0-9]+: [^\n]*\nIdentifiers: ')), l as (select doc_id, regexp_extract(text, '^[0-9]+: ([^\n]*)', 1) as title, regexp_extract(text, 'Identifiers: ([^\n]*)', 1) as identifiers, string_split(text, chr(10)) as ls from d),
x as (select doc_id, title, identifiers, generate_subscripts(ls, 1) as pos, regexp_extract(unnest(ls), '^\\s*/([^=]+)="([^"]*)"\\s*$', ['attribute', 'value']) as p from l) select doc_id, title, identifiers, p.attribute as attribute, arg_max(p.value, pos) as value from x where p.attribute <> '' group by 1, 2, 3, 4""")
def source_biosample(spark, sf):
    """Attributes of the record texts among the documents."""
    return S.biosample_records(read_table(spark, sf, "documents"), "doc_id", "text")


@query("select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey")
def source_bundle(spark, sf):
    """Two tables through a bundle that is verified on reading."""
    path = _place(spark)
    B.write_bundle({"nation": read_table(spark, sf, "nation"), "region": read_table(spark, sf, "region")}, path, {"step": "example"}, partition_by={"nation": "n_regionkey"})
    t = B.read_bundle(spark, path)
    return t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")


@query("select c_nationkey as project from customer group by 1 having count(*) % 2 = 1 or c_nationkey % 4 = 0")
def source_pending(spark, sf):
    """Projects that are not done, or done with another number of rows."""
    n = read_table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("project")).agg(F.count("*").alias("rows"))
    done = n.filter("project % 4 <> 0").withColumn("rows", F.col("rows") - F.col("rows") % 2)
    return B.done_work(n, done, "project").select("project")


@query("select c_name, c_comment from (select '#' || c_custkey as c_name, c_mktsegment as c_comment from customer where c_nationkey < 9)")
def source_first_comment(spark, sf):
    """Comma-separated text whose first row below the header states types; other rows may begin with the same mark."""
    path = _place(spark)
    c = read_table(spark, sf, "customer").filter("c_nationkey < 9").select(F.concat(F.lit("#"), "c_custkey").alias("c_name"), F.col("c_mktsegment").alias("c_comment"))
    lines = spark.createDataFrame([(0, "c_name,c_comment"), (1, "#q2:types,categorical")], "at int, value string").unionByName(c.select(F.lit(2).alias("at"), F.concat_ws(",", "c_name", "c_comment").alias("value")))
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return S.read_tsv(spark, path, ["c_name", "c_comment"], comment_key="c_name", sep=",")


@query("select n_name as feature, c_mktsegment as sample, cast(count(*) as double) as n from customer join nation on c_nationkey = n_nationkey group by all")
def source_biom(spark, sf):
    """Counts of nations by segment through files of the count-table format, one per region."""
    path = _place(spark).removeprefix("file:")
    c = read_table(spark, sf, "customer").join(read_table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    n = c.groupBy("n_regionkey", "n_name", "c_mktsegment").agg(F.count("*").cast("double").alias("n"))

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        f, k = sorted(rows["n_name"].unique()), sorted(rows["c_mktsegment"].unique())
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/r{rows['n_regionkey'].iloc[0]}.biom", "w", encoding="utf-8") as out:
            out.write(biom.biom_text(f, k, [(f.index(a), k.index(b), v) for a, b, v in zip(rows["n_name"], rows["c_mktsegment"], rows["n"], strict=True)]))
        return rows.iloc[:1][["n_regionkey"]].astype("int64")

    n.groupBy("n_regionkey").applyInPandas(write, "n_regionkey long").count()  # nations by segments: a group has few rows
    biom.register(spark)
    return spark.read.format("biom").load(path).select("feature", "sample", "n")


@query("select a.n_name as i, b.n_name as j, abs(a.n_nationkey - b.n_nationkey) / 10 as dist from nation a join nation b on a.n_name < b.n_name")
def source_named_arrays(spark, sf):
    """A square matrix in a named-array file as pairs."""
    names = {r.n_name: r.n_nationkey for r in read_table(spark, sf, "nation").collect()}  # 25 rows
    ids = sorted(names)
    k = np.array([names[x] for x in ids], dtype=float)
    buffer = io.BytesIO()
    np.savez(buffer, dist=np.abs(k[:, None] - k[None]) / 10, var_id=np.array(ids))
    path = _place(spark).removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/d.npz", "wb") as f:
        f.write(buffer.getvalue())
    return B.read_npz_pairs(spark, f"{path}/*.npz").select("i", "j", "dist")


@query("select cast(1 + 5 + 25 as bigint) as nodes, sum(1 + n_nationkey % 3) + 10.0 as total from nation")
def source_newick(spark, sf):
    """The tree of places through a text file."""
    r, n = read_table(spark, sf, "region").collect(), read_table(spark, sf, "nation").collect()  # 30 rows
    nodes = [(0, None, "world", 0.0), *((1 + x.r_regionkey, 0, x.r_name, 2.0) for x in r), *((100 + x.n_nationkey, 1 + x.n_regionkey, x.n_name, 1.0 + x.n_nationkey % 3) for x in n)]
    path = _place(spark)
    spark.createDataFrame([(write_newick(nodes),)], "value string").coalesce(1).write.text(path)
    return read_newick(spark, path, keep_tips=True).agg(F.count("*").alias("nodes"), F.round(F.sum("length"), 6).alias("total"))


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def stream_event_counts(spark, sf):
    """Hourly counts of the events, ingested as a stream."""
    path, e = _place(spark), read_table(spark, sf, "events")
    e.repartitionByRange(4, "ts").write.parquet(f"{path}/in")  # arrives in several files
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    counts = I.windowed_counts(stream, "ts", ["event_type"], "value", late="3650 days")
    I.run_available(counts, f"{path}/out", f"{path}/state")
    return I.current(spark, f"{path}/out", ["event_type"]).withColumns({"total": F.round("total", 4), "window_start": F.col("window_start").cast("timestamp_ntz")})
