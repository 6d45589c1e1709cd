"""Files: text tables, records, bundles, arrays; and the stream."""

import datetime as dt

import numpy as np
import pytest


from corpusweave.operators.expect import ExpectationError
from corpusweave.sources import biom
from corpusweave.sources import bundle as B
from corpusweave.sources import tabular as S
from corpusweave.streaming import ingest as I


def test_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("id\tv\n#q2:types\tcategorical\nx\t\ny\tNA\n")
    assert sorted(map(tuple, S.read_tsv(spark, str(tmp_path / "a.tsv"), ["k", "v"], comment_key="k").collect())) == [("x", None), ("y", "NA")]
    df = spark.createDataFrame([("a", 1.23456), (None, None)], "k string, v double")
    S.write_tsv(df, str(tmp_path / "out"), digits=2)
    assert {tuple(r) for r in S.read_tsv(spark, str(tmp_path / "out"), ["k", "v"]).collect()} >= {("a", "1.23")}


def test_only_the_first_row_can_be_a_comment(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.tsv").write_text("id\tv\n#types\tx\n#real\t1\n")
    (tmp_path / "a" / "2.tsv").write_text("id\tv\nplain\t2\n#also real\t3\n")
    (tmp_path / "a" / "3.tsv").write_text("id\tv\n")
    assert {tuple(r) for r in S.read_tsv(spark, str(tmp_path / "a"), ["k", "v"], comment_key="k").collect()} == {("#real", "1"), ("plain", "2"), ("#also real", "3")}


def test_count_tables(spark, tmp_path):
    (tmp_path / "s.biom").write_text(biom.biom_text(["f1", "f2"], ["a", "b"], [(0, 0, 2.0), (1, 1, 3.5), (0, 1, 0.0)]))
    (tmp_path / "d.biom").write_text('{"rows": [{"id": "f"}], "columns": [{"id": "x"}, {"id": "y"}], "matrix_type": "dense", "data": [[0, 4]]}')
    biom.register(spark)
    read = lambda p: spark.read.format("biom").load(str(p))
    assert {tuple(r) for r in read(tmp_path).collect()} == {("s.biom", "f1", "a", 2.0), ("s.biom", "f2", "b", 3.5), ("d.biom", "f", "y", 4.0)}
    (tmp_path / "bad.biom").write_text(biom.biom_text(["f"], ["x"], [(3, 0, 1.0)]))
    with pytest.raises(Exception, match="has no name"):
        read(tmp_path / "bad.biom").collect()
    with pytest.raises(Exception, match="nothing"):
        read(tmp_path / "nothing.biom").collect()


def test_missing_inputs_fail(spark):
    have, want = spark.createDataFrame([("a", 1)], "project string, n int"), spark.createDataFrame([("a",), ("b",)], "project string")
    assert S.require_inputs(want.filter("project = 'a'"), have) is have
    with pytest.raises(ExpectationError, match="no input for b"):
        S.require_inputs(want, have)


def test_utf16(spark, tmp_path):
    (tmp_path / "u.tsv").write_bytes(b"\xff\xfe" + "name\tn\né\t1\n好\t\n".encode("utf-16-le"))
    got = S.read_tsv(spark, str(tmp_path / "u.tsv"), ["name", "n"], encoding="UTF-16LE").collect()
    assert [tuple(r) for r in got] == [("é", "1"), ("好", None)]


def test_projects(spark, tmp_path):
    for p, text in (("P1", "asv\ts1\ts2\na\t1\t0\nb\t2\t3\n"), ("P2", "asv\ts1\ts2\na\t\t5\n")):
        (tmp_path / p).mkdir()
        (tmp_path / p / "tab.tsv").write_text(text)
    t = S.read_projects(spark, f"{tmp_path}/*/tab.tsv", ["asv", "s1", "s2"], r"/([^/]+)/tab\.tsv")
    got = S.unpivot_counts(t, "asv", ["project"]).collect()
    assert {(r.project, r.asv, r["sample"], r.n) for r in got} == {("P1", "a", "s1", 1), ("P1", "b", "s1", 2), ("P1", "b", "s2", 3), ("P2", "a", "s2", 5)}
    want = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "project string")
    assert [r.project for r in S.missing_inputs(want, t).collect()] == ["P3"]


def test_fasta(spark, tmp_path):
    df = spark.createDataFrame([("x;y;id1", "ACGT"), ("id2", ""), ("id3", None), ("id4", "A")], "n string, s string")
    S.fasta_lines(df, "n", "s").write.text(str(tmp_path / "f"))
    assert S.count_fasta(spark, str(tmp_path / "f")) == 2


def test_biosample(spark):
    text = '12: A title\nIdentifiers: BioSample: S1; SRA: x\nOrganism: y\nAttributes:\n    /age="4"\n    /note="a=b"\n    /age="5"\n    /cut="'
    df = spark.createDataFrame([(1, text), (2, "no record"), (3, None), (4, "3: t\nIdentifiers: a: b\n")], "k long, t string")
    got = S.biosample_records(df, "k", "t").collect()
    assert {(r.k, r.title, r.attribute, r.value) for r in got} == {(1, "A title", "age", "5"), (1, "A title", "note", "a=b")}


def test_bundle(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    path = str(tmp_path / "b")
    B.write_bundle({"a": a, "empty": a.limit(0)}, path, {"seed": 42})
    assert B.manifest(spark, path)["provenance"] == {"seed": 42} and B.read_bundle(spark, path)["a"].count() == 2
    a.write.mode("append").parquet(f"{path}/a")
    with pytest.raises(ExpectationError):
        B.read_bundle(spark, path)


def test_arrays(spark, tmp_path):
    np.savez_compressed(tmp_path / "d.npz", dist=np.array([[0, 1, 2], [1, 0, 3], [2, 3, 0]], dtype=np.float32), var_id=np.array(["a", "b", "c"]))
    got = B.read_npz_pairs(spark, f"{tmp_path}/*.npz").collect()
    assert {(r.i, r.j, r.dist) for r in got} == {("a", "b", 1.0), ("a", "c", 2.0), ("b", "c", 3.0)}


def test_pending(spark):
    all_ = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, rows long")
    done = spark.createDataFrame([("a", 1), ("b", 9)], "k string, rows long")
    assert {r.k for r in B.done_work(all_, done, "k").collect()} == {"b", "c"}


def test_stream_resumes(spark, tmp_path):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    src, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"

    def arrive(rows):
        spark.createDataFrame(rows, "ts timestamp, k string, v double").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp, k string, v double").parquet(src)
        I.run_available(I.windowed_counts(stream, "ts", ["k"], "v", late="10 hours"), out, state)
        return {(r.window_start.hour, r.k): (r.n, r.total) for r in I.current(spark, out, ["k"]).collect()}

    first = arrive([(t(1), "a", 1.0), (t(1), "a", 2.0), (t(2), "b", 5.0)])
    assert sorted(first.values()) == [(1, 5.0), (2, 3.0)]
    second = arrive([(t(1), "a", 4.0), (t(3), "a", 7.0)])
    assert sorted(second.values()) == [(1, 5.0), (1, 7.0), (3, 7.0)]
