"""Micro-fixtures of taxonomy and metadata expressions."""

import pytest
from pyspark.sql import functions as F

from corpusweave.functions import metadata as D
from corpusweave.functions import taxonomy as X
from corpusweave.functions.text import fold, is_missing, key_or_null


def values(spark, rows, *exprs, schema="c string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [tuple(r) for r in df.coalesce(1).select(*exprs).collect()]


def test_taxonomy(spark):
    rows = ["d__Bacteria; p__P1; c__C1; o__O1; f__F1; g__G1; s__S1", "d__Bacteria;p__P1;c__C1;o__O1;f__F1;g__;s__", "d__Bacteria;p__P1;c__C1;o__O1;f__F1", "d__Bacteria; p__P1", "d__Bacteria;p__P1;c__C1;o__O1;f__Mitochondria", "d__Eukaryota;p__X", "Unassigned", None, ""]
    t = X.with_ranks(spark.createDataFrame([(r,) for r in rows], "path string").coalesce(1), "path")
    got = t.select("deepest", "var_id", X.keep_feature(F.col("path"), F.col("Domain"), ["d__Bacteria", "d__Archaea"]).alias("keep"), X.is_real(F.col("Genus")).alias("named")).collect()
    assert [r.deepest for r in got] == ["Species", "Family", "Family", "Phylum", "Family", "Phylum", "None", "None", "None"]
    assert [r.keep for r in got] == [True, True, True, True, False, False, False, False, False]
    assert got[0].var_id == "d__Bacteria;p__P1;c__C1;o__O1;f__F1;g__G1" and got[0].named and not got[1].named
    assert got[1].var_id == got[2].var_id == "d__Bacteria;p__P1;c__C1;o__O1;f__F1;g__" and got[3].var_id == "d__Bacteria;p__P1;c__;o__;f__;g__"
    assert values(spark, ["g__A_b.c-d; s__x", "f__F g__", None], X.rank_token(F.col("c"))) == [("g__A_b.c-d",), (None,), (None,)]
    assert values(spark, ["x_A", "x_a", None], X.has_split_suffix(F.col("c"))) == [(True,), (False,), (False,)]


@pytest.mark.parametrize(
    "text,animal,asub,soil,human",
    [("animal;human", True, "human", False, "Human"), ("animal;human|animal;mouse|soil;field", True, "human|mouse", True, "HumanMix"), ("animal;human|animal", True, "human|", False, "Human"), ("animal", True, "", False, None), ("", False, None, False, None), (None, False, None, False, None), ("soil;a;b", False, None, True, None)],
)
def test_environment(spark, text, animal, asub, soil, human):
    t = D.env_tags(F.col("c"))
    got = values(spark, [text], D.env_flag(t, "animal"), D.env_subs(t, "animal"), D.env_flag(t, "soil"), D.human_class(t), D.env_rebuilt_equal(t, F.col("c")))
    assert got == [(animal, asub, soil, human, True)]


def test_slots(spark):
    t = D.slot_tokens(F.col("c"))
    got = values(spark, ["gut;female;adult;disease;pneumonia", ";;smoker", None], D.pick_one(t, D.SITES), D.pick_one(t, D.SEXES), D.pick_one(t, D.AGES), D.pick_all(t, D.HEALTH), D.has_any(t, D.SMOKING, "Smoker"))
    assert got == [("gut", "female", "adult", "disease;pneumonia", None), (None, None, None, None, "Smoker"), (None,) * 5]


def test_numbers(spark):
    g = D.geo_pair(F.col("c"))
    got = values(spark, ["12.5 -3", "0 0", "002.9167 1", "-122.726", "1 x", "1 2 3", "", None, "1.0d 2", " 1\t2 "], g["lat"], g["lon"])
    assert got == [(12.5, -3.0), (0.0, 0.0), (2.9167, 1.0), (None, None), (None, None), (None, None), (None, None), (None, None), (None, None), (1.0, 2.0)]
    assert values(spark, ["", "1.5"], D.strict_float(F.col("c"))) == [(None,), (1.5,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NumberFormat"):
        values(spark, ["x"], D.strict_float(F.col("c")))
    ages = [(0.0, 3.0), (3.0, 3.0), (3.0, 5.0), (4.0, 18.0), (18.0, 18.0), (18.0, 100.0), (76.0, None), (76.0, 200.0), (75.0, 75.0), (None, 3.0)]
    assert [r[0] for r in values(spark, ages, D.age_group(F.col("a"), F.col("b")), schema="a double, b double")] == ["0-3", "0-3", None, "3-18", "3-18", None, None, "75+", "60-75", None]


def test_labels(spark):
    p = F.col("c")
    assert values(spark, ["Health", "Control", "COVID-19", None], D.case_or_control(p), D.is_healthy(p)) == [("control", True), ("control", None), ("case", False), (None, None)]
    assert values(spark, ["a.b.c", "a", None], D.split_once(p, ".", 0), D.split_once(p, ".", 1)) == [("a", "b.c"), ("a", None), (None, None)]
    assert values(spark, ["&gt;48", "x", None], D.replace_exact(p, {"&gt;48": "48+"})) == [("48+",), ("x",), (None,)]
    assert values(spark, ["TBM1", "HC", "q", None], D.first_prefix(p, (("TB", "tb"), ("HC", "control")), "other")) == [("tb",), ("control",), ("other",), ("other",)]
    assert values(spark, ["MA::x", "RM::y"], D.collapse_label(p, "MA::", "rest")) == [("x",), ("rest",)]
    assert values(spark, ["a b", "it's", "ab"], D.quoted_label(p)) == [("'a b'",), ("'it''s'",), ("ab",)]
    assert values(spark, ["k: v; x: 1:2; k: w; none", None, ""], D.pair_list(p)) == [({"k": "w", "x": "1:2"},), ({},), ({},)]
    assert values(spark, ["nan", None, "x"], D.missing_as_na(p)) == [("NA",), ("NA",), ("x",)]
    assert values(spark, [("V4", "16S"), ("-", "16S"), (None, "16S"), ("V4", "WGS")], D.gated(F.col("a"), F.col("b"), "16S"), schema="a string, b string") == [("V4",), (None,), (None,), (None,)]
    assert values(spark, [(1,), (12345678,)], D.surrogate_id("MA_", F.col("n")), schema="n long")[0] == ("MA_0000000",)
    b = D.env_bucket(*(F.col(x) for x in "abcde"))
    assert values(spark, [(None, True, True, None, None), (True, True, None, None, None), (None,) * 5], b, schema="a boolean, b boolean, c boolean, d boolean, e boolean") == [("Animal_other",), ("Human",), ("Unknown",)]


def test_keys(spark):
    c = F.col("c")
    assert values(spark, [" ab ", "Ab　", "-", "NaN", " ", None, "<NA>"], key_or_null(c), is_missing(c)) == [("AB", False), ("AB", False), (None, True), (None, True), (None, True), (None, True), (None, True)]
    assert values(spark, ["\xa0x\n"], fold(c)) == [("X",)]
