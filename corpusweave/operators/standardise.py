"""One pass that brings a raw sample table to its standard form, the invariants of that form, and patch sets.

``standardise`` strips and renames, replaces exact values, turns blank text into NULL, casts numbers strictly and orders the
columns. ``invariants`` counts what breaks the rules of the standard form, in one pass and one aggregate over the key;
``checked`` raises on any. ``apply_patches`` applies several patches at once and checks them.

Defined cases: a text that is no number in a number column raises. A column that the table lacks raises, others are dropped.
NULL stays NULL. Patches that share a key, name a key the table lacks, or touch another number of rows than expected raise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.metadata import AGE_BINS, age_group, blank_to_null, case_or_control, gated, is_healthy, strict_float, strip_strings
from corpusweave.operators.expect import ExpectationError, require_unique
from corpusweave.operators.merge import apply_patch, audit
from corpusweave.session import Stage

# The domains of the standard form.
SEQUENCING_TYPES = ("16S", "Metagenomics", "Metatranscriptomics", "ITS", "Virome", "Full-16S", "WGTS", "RNA-Seq", "AMPLICON", "18S", "Nanopore", "MeDIP-Seq", "Tn-Seq", "miWTS")
REGIONS = ("V4", "V3-V4", "V3", "V1-V2", "V1-V3", "V3-V5", "V4-V5", "V5-V7", "V4-V6", "V5-V6", "V1-V3/V3-V5", "V1-V9", "V1-V2/V3-V4", "V6-V8", "V6-V9", "V6")
AGE_GROUPS = ("0-3", *(label for label, _, _ in AGE_BINS), "75+")
DOMAINS = {
    "Sequencing_Type": SEQUENCING_TYPES,
    "Library_Layout": ("PAIRED", "SINGLE"),
    "Platform": ("ILLUMINA", "LS454", "BGISEQ", "ION_TORRENT", "OXFORD_NANOPORE", "PACBIO_SMRT", "DNBSEQ"),
    "Sex": ("Female", "Male"),
    "Smoking": ("Smoker", "Non-smoker", "Ex-smoker"),
    "Recent_Antibiotic_Use": ("Yes", "No"),
    "Continent": ("Europe", "North America", "Asia", "Africa", "Oceania", "South America"),
}
FLOATS = ("Age", "Age_start", "Age_end", "BMI", "BMI_start", "BMI_end", "Latitude", "Longitude")
COLUMNS = (
    "Run", "Project_ID", "BioSample", "PMID", "Sequencing_Type", "Library_Layout", "Platform", "Model", "Phenotype", "Phenotype_ID", "Disease_Stage", "Complication", "Intervention",
    "Smoking", "Recent_Antibiotic_Use", "Antibiotics_Used", "Sample_Site", "Sample_Type", "Sex", "Age", "Age_start", "Age_end", "Age_Group", "BMI", "BMI_start", "BMI_end",
    "Country", "Continent", "Location", "Latitude", "Longitude", "Region_16S", "Patient_ID", "Time_Point", "Case_Or_Control", "Is_Healthy",
)
DERIVED = ("Age_Group", "Region_16S", "Case_Or_Control", "Is_Healthy")
FIXES = {"Sample_Site": {"Lung": "Lung Tissue"}, "Patient_ID": {"50.2_13.4(mean,sd)": ""}, "Time_Point": {"&gt;48": "48+"}}


@dataclass(frozen=True)
class Standard:
    """How raw columns become standard ones: ``rename`` maps raw to standard names, ``fixes`` replaces exact values."""

    rename: Mapping[str, str] = field(default_factory=dict)
    fixes: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: FIXES)
    columns: Sequence[str] = COLUMNS
    floats: Sequence[str] = FLOATS


def standardise(raw: DataFrame, regions: DataFrame, spec: Standard, sequencing: str = "16S") -> DataFrame:
    """The standard form; ``regions(Project_ID, region)`` has one row per project and says which gene region it sequenced,
    which holds for samples of type ``sequencing`` alone."""
    df = strip_strings(raw.withColumnsRenamed(dict(spec.rename)))
    cols = {}
    for c in spec.columns:
        if c in DERIVED:
            continue
        e = F.col(c)
        for old, new in spec.fixes.get(c, {}).items():
            e = F.when(e == old, F.lit(new)).otherwise(e)
        cols[c] = strict_float(e.cast("string")) if c in spec.floats else blank_to_null(e.cast("string"))
    df = df.select(*(e.alias(c) for c, e in cols.items()))
    known = require_unique(regions.filter("Project_ID IS NOT NULL"), "Project_ID").select("Project_ID", F.col("region").alias("__cw_region"))
    df = df.join(known, "Project_ID", "left")
    return df.select(*cols, age_group(F.col("Age_start"), F.col("Age_end")).alias("Age_Group"), gated(F.col("__cw_region"), F.col("Sequencing_Type"), sequencing).alias("Region_16S"), case_or_control(F.col("Phenotype")).alias("Case_Or_Control"), is_healthy(F.col("Phenotype")).alias("Is_Healthy")).select(*spec.columns)


def _interval(x: str) -> tuple[Column, Column]:
    v, a, b = F.col(x), F.col(f"{x}_start"), F.col(f"{x}_end")
    return v.isNull() | F.coalesce((v == a) & (v == b), F.lit(False)), v.isNotNull() | a.isNull() | F.coalesce(a <= b, F.lit(False))


def _within(c: str, domain: Sequence[str]) -> Column:
    return F.col(c).isNull() | F.col(c).isin(*domain)


def rules(sequencing: str = "16S") -> dict[str, Column]:
    """The conditions on single rows of the standard form."""
    age, ages = _interval("Age")
    bmi, bmis = _interval("BMI")
    return {
        "age is its interval": age,
        "age interval in order": ages,
        "bmi is its interval": bmi,
        "bmi interval in order": bmis,
        "country with continent": F.col("Country").isNull() == F.col("Continent").isNull(),
        "location with country": F.col("Location").isNull() | F.col("Country").isNotNull(),
        "region with its type": F.col("Region_16S").isNull() | F.coalesce(F.col("Sequencing_Type") == sequencing, F.lit(False)),
        "region known": _within("Region_16S", REGIONS),
        "age group known": _within("Age_Group", AGE_GROUPS),
        "case or control known": _within("Case_Or_Control", ("case", "control")),
        "healthy where health": F.coalesce(F.col("Is_Healthy"), F.lit(False)) == F.coalesce(F.col("Phenotype") == "Health", F.lit(False)),
        **{f"{c} known": _within(c, d) for c, d in DOMAINS.items()},
    }


def invariants(df: DataFrame, sequencing: str = "16S") -> DataFrame:
    """``rule, broken``: rows that break a rule; runs that are missing or repeated; columns of another type or place."""
    per = df.groupBy("Run").agg(F.count("*").alias("__cw_n"), *(F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules(sequencing).items()))
    names = list(rules(sequencing))
    runs = F.count_if((F.col("__cw_n") > 1) | F.col("Run").isNull())
    types = dict(df.dtypes)
    wrong = sum(types.get(c) != ("double" if c in FLOATS else "boolean" if c == "Is_Healthy" else "string") for c in COLUMNS)
    order = int([c for c in df.columns if c in COLUMNS] != list(COLUMNS))
    one = per.agg(runs.alias("run unique"), *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in names)).select("*", F.lit(wrong).cast("long").alias("types"), F.lit(order).cast("long").alias("column order"))
    return one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(k).alias("broken")) for k in ["run unique", *names, "types", "column order"]))))


def checked(df: DataFrame, sequencing: str = "16S") -> DataFrame:
    """The table itself, after all invariants were found to hold."""
    bad = {r["rule"]: r["broken"] for r in invariants(df, sequencing).filter("broken > 0").collect()}
    if bad:
        raise ExpectationError(f"broken by rule: {bad}")
    return df


def apply_patches(base: DataFrame, patches: Mapping[str, DataFrame], key: str, expected: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """The patched table, and ``patch, column_name, touched, changed``.

    A patch holds the key and the columns it sets, NULLs included. Keys must be in the table and in one patch alone, a patch
    must touch as many rows as ``expected`` says, other rows stay as they are, and a second application changes nothing.
    """
    spark = base.sparkSession
    parts = {name: Stage(spark).put(p) for name, p in patches.items()}
    keys = None
    for name, p in parts.items():
        k = p.select(key, F.lit(name).alias("patch"))
        keys = k if keys is None else keys.unionByName(k)
    known = base.select(key).distinct().withColumn("known", F.lit(True))
    per = keys.groupBy(key).agg(F.count("*").alias("n")).join(known, key, "left")
    shared, unknown = per.agg(F.count_if(F.col("n") > 1), F.count_if(F.col("known").isNull())).head()
    if shared or unknown:
        raise ExpectationError(f"{shared} keys are in several patches or repeated, {unknown} are not in the table")
    after = base
    for p in parts.values():
        after = apply_patch(after, p, key)
    after = Stage(spark).put(after)
    again = after
    for p in parts.values():
        again = apply_patch(again, p, key)
    audits = None
    for name, p in parts.items():
        cols = [c for c in p.columns if c != key]
        hit = base.join(p.select(key), key, "left_semi")
        a = audit(hit, after, key, cols).crossJoin(hit.agg(F.count("*").alias("touched"))).select(F.lit(name).alias("patch"), "column_name", "touched", "changed")  # few rows by one
        audits = a if audits is None else audits.unionByName(a)
    audits = Stage(spark).put(audits)
    counts = {r["patch"]: r["touched"] for r in audits.select("patch", "touched").distinct().collect()}  # one row per patch
    wrong = {n: (counts.get(n, 0), w) for n, w in (expected or {}).items() if counts.get(n, 0) != w}
    cols = [c for c in base.columns if c != key]
    rest = keys.select(key).distinct()
    moved = sum(r["changed"] for r in audit(base.join(rest, key, "left_anti"), after, key, cols).collect())
    twice = sum(r["changed"] for r in audit(after, again, key, cols).collect())
    if wrong or moved or twice:
        raise ExpectationError(f"touched and expected: {wrong}; {moved} values changed outside the patches, {twice} by applying them again")
    return after, audits
