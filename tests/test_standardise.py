"""The standard form, its invariants and patch sets: small tables with every kind of fault."""

import pytest
from pyspark.sql import functions as F

from corpusweave.operators.expect import ExpectationError
from corpusweave.operators.standardise import COLUMNS, DERIVED, FLOATS, Standard, apply_patches, checked, invariants, standardise


def raw(spark, *rows):
    names = [c for c in COLUMNS if c not in DERIVED]
    return spark.createDataFrame([tuple({**dict.fromkeys(names, ""), **r}[c] for c in names) + ("clash",) for r in rows], ", ".join(f"{c} string" for c in names) + ", Age_Group string")


GOOD = {"Run": "r1", "Project_ID": "p1", "Sequencing_Type": "16S", "Phenotype": "Health", "Age": "40", "Age_start": "40", "Age_end": "40", "Country": " x ", "Continent": "Asia", "Sample_Site": "Lung", "Time_Point": "&gt;48", "Patient_ID": "50.2_13.4(mean,sd)"}


def test_standard_form(spark):
    regions = spark.createDataFrame([("p1", "V4"), ("p2", "-")], "Project_ID string, region string")
    df = standardise(raw(spark, GOOD, {**GOOD, "Run": "r2", "Project_ID": "p2", "Phenotype": "Control", "Age": "", "Age_start": "80", "Age_end": ""}, {"Run": "r3", "Sequencing_Type": "ITS", "Project_ID": "p1", "Phenotype": "Cough", "Age_start": "10", "Age_end": "30"}), regions, Standard())
    assert df.columns == list(COLUMNS) and all(t == "double" for c, t in df.dtypes if c in FLOATS)
    a, b, c = df.orderBy("Run").collect()
    assert (a.Region_16S, a.Age_Group, a.Case_Or_Control, a.Is_Healthy, a.Country, a.Sample_Site, a.Time_Point, a.Patient_ID, a.PMID) == ("V4", "35-45", "control", True, "x", "Lung Tissue", "48+", None, None)
    assert (b.Region_16S, b.Age_Group, b.Is_Healthy) == (None, None, None) and (c.Region_16S, c.Age_Group, c.Case_Or_Control, c.Is_Healthy) == (None, None, "case", False)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        standardise(raw(spark, {**GOOD, "BMI": "fat"}), regions, Standard()).collect()
    with pytest.raises(ExpectationError):
        standardise(raw(spark, GOOD), regions.union(regions), Standard())


def test_invariants_fail_closed(spark):
    regions = spark.createDataFrame([("p1", "V4")], "Project_ID string, region string")
    good = standardise(raw(spark, GOOD), regions, Standard())
    assert checked(good).count() == 1 and invariants(good).filter("broken > 0").count() == 0 and invariants(good.limit(0)).filter("broken > 0").count() == 0
    faults = {"run unique": {"Run": ""}, "age is its interval": {"Age_end": "41"}, "age interval in order": {"Age": "", "Age_start": "50"}, "bmi is its interval": {"BMI": "20"}, "bmi interval in order": {"BMI_start": "3"}, "country with continent": {"Continent": ""}, "location with country": {"Country": "", "Continent": "", "Location": "l"}, "Sex known": {"Sex": "male"}, "Sequencing_Type known": {"Sequencing_Type": "17S"}}
    bad = standardise(raw(spark, *({**GOOD, "Run": f"b{i}", **f} for i, f in enumerate(faults.values()))), regions, Standard())
    got = {r.rule: r.broken for r in invariants(bad).collect()}
    assert {k for k, n in got.items() if n} == set(faults) and got["run unique"] == 1
    with pytest.raises(ExpectationError, match="Sex known"):
        checked(bad)
    wrong = good.withColumn("Region_16S", F.lit("V99")).withColumn("Age_Group", F.lit("old")).withColumn("Age", F.col("Age").cast("int")).withColumn("Is_Healthy", F.lit(None).cast("boolean"))
    assert {r.rule for r in invariants(wrong).filter("broken > 0").collect()} == {"region known", "age group known", "types", "healthy where health"}
    assert {r.rule for r in invariants(good.select("Sex", *(c for c in COLUMNS if c != "Sex"))).filter("broken > 0").collect()} == {"column order"}


def test_patches(spark):
    base = spark.createDataFrame([(i, "a", None if i % 2 else "b") for i in range(10)], "k int, x string, y string")
    one, two = base.filter("k < 3").select("k", F.lit("new").alias("x")), base.filter("k = 5 or k = 6").select("k", F.lit(None).cast("string").alias("y"))
    after, seen = apply_patches(base, {"one": one, "two": two}, "k", {"one": 3, "two": 2})
    assert {(r.patch, r.column_name): (r.touched, r.changed) for r in seen.collect()} == {("one", "x"): (3, 3), ("two", "y"): (2, 1)}
    assert {r.k for r in after.filter("x = 'new'").collect()} == {0, 1, 2} and after.filter("y is null").count() == 6
    for patches, expected in (({"one": one, "two": one}, None), ({"one": one.union(one)}, None), ({"one": one.withColumn("k", F.col("k") + 100)}, None), ({"one": one}, {"one": 4})):
        with pytest.raises(ExpectationError):
            apply_patches(base, patches, "k", expected)
