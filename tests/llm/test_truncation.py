"""Truncation: prefixes against brute force, planted cuts, and the cases without text."""

import random

import pytest

from corpusweave.llm.plans import p9_found, p9_rates
from corpusweave.llm.truncation import _closed, judge_documents, strict_prefixes


def test_prefixes_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab é") for _ in range(rng.randint(1, 9)))
    values = [(rng.choice("pq"), word()) for _ in range(500)] + [("p", "x" * 5000), ("q", "x" * 5000), ("p", "é" * 3), (None, "a" * 20), ("p", None)]
    asks = [(rng.choice("pqr"), word()) for _ in range(500)] + [("p", "x" * 4999), ("q", "x" * 5000), ("p", "é"), ("p", ""), (None, "a"), ("q", None)]
    want = {(g, v) for g, v in asks if g and v is not None and any(h == g and u is not None and u != v and u.startswith(v) for h, u in values)}
    a, b = spark.createDataFrame(asks, "g string, v string"), spark.createDataFrame(values, "g string, v string")
    for n in ("1", "4", "60"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = [tuple(r) for r in strict_prefixes(a, b, "g", "v").collect()]
        spark.conf.set("spark.sql.shuffle.partitions", old)
        assert set(got) == want and len(got) == len(want)
    assert strict_prefixes(a.limit(0), b, "g", "v").count() == 0 and strict_prefixes(a, b.limit(0), "g", "v").count() == 0


def test_long_words_and_long_rests(spark):
    """Words above 64 letters are compared like others, and a rest of more than a million blanks is read to its end."""
    long = "ha" * 60
    rows = [(i, f"The crew stored {i} shells. Then they wrote {long} below the list of day {i}.") for i in range(40)]
    rows += [(100, f"The crew stored 77 shells. Then they wrote {long[:90]}"), (101, f"The crew stored 9 shells. Then they wrote {long} below the list of d"), (102, "The crew stored 8 shells." + " " * 1_100_000 + "\ufffd")]
    got = {r.doc_id: r for r in judge_documents(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")).collect()}
    assert (got[100].cut, got[100].evidence) == (True, "word") and (got[102].cut, got[102].evidence) == (True, "broken")
    assert (got[101].cut, got[101].evidence) == (True, "prefix") and sum(r.cut for r in got.values()) == 3


@pytest.mark.parametrize("text,closed", [("a b.", True), ('x="a"', True), ('x="', False), ("a (b)", True), ("a", False), ("好。", True), ("it's", False), ("dogs'", False), ("a\nb", False), ("a;", False)])
def test_closed(text, closed):
    assert _closed(text) is closed


SUBJECTS = ["the crew", "the night team", "a visiting group", "our partner", "the lab"]
VERBS = ["counted", "stored", "weighed", "photographed", "discarded"]
THINGS = ["stones", "leaves", "feathers", "shells", "samples"]
ENDS = ["in the dry season", "after the flood", "near the river", "at low tide", "on the third visit"]


def corpus(rng, n):
    out = []
    for i in range(n):
        text = " ".join(f"{rng.choice(SUBJECTS)} {rng.choice(VERBS)} {rng.randint(2, 99)} {rng.choice(THINGS)} {rng.choice(ENDS)}.".capitalize() for _ in range(rng.randint(3, 6)))
        if i % 9 == 0:
            text = text[:-1]  # whole without a full stop
        if i % 11 == 0:
            text += f"\n-- desk {i % 7}"
        out.append(text)
    return out


def test_planted_cuts(spark):
    rng = random.Random(5)
    rows, cut = [], set()
    for i, t in enumerate(corpus(rng, 700)):
        if i % 5 == 1:
            k = rng.randint(30, len(t) - 12)
            while t[k - 1] in ". \n" or t[k : k + 1] in ". " and any(t[:k].endswith(e) for e in ENDS):
                k -= 1
            t, _ = t[:k], cut.add(i)
            t += rng.choice(["", "", " ", "\n", "…", "...", "�"])
        rows.append((i, t, ["A ", "a", "b"][i % 3], 1))
    extra = [(9000, None, "a", 1), (9001, "", "a", 1), (9002, " \n ", None, 1), (9003, "…", "b", 1), (9004, rows[1][1], None, 1), (9005, rows[0][1], "", 1), (9006, "x" * 200_000 + ".", "b", 1)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, source string, cut int")
    got = judge_documents(docs).collect()
    assert len(got) == len(rows) + len(extra) and {r.source for r in got} == {"A", "B", None}
    found = {r.doc_id for r in got if r.cut}
    assert not found & {9000, 9001, 9002, 9003, 9005, 9006} and (9004 in found) == (1 in found)
    found -= {9004}
    assert len(found & cut) / len(cut) > 0.95 and len(found & cut) / len(found) > 0.95
    assert judge_documents(docs.limit(0)).count() == 0
    assert not any(r.cut for r in judge_documents(docs.filter("doc_id >= 9000 AND doc_id < 9004")).collect())


def test_limits_decide_what_the_words_leave_open(spark):
    rng = random.Random(8)
    base = corpus(rng, 500)
    rows = [(i, t, "s") for i, t in enumerate(base)]
    rows += [(1000 + i, t[:100], "s") for i, t in enumerate(base) if len(t) > 120]
    text = ("The crew stored 7 shells. " * 9 + "Our partner counted 10 stones at low tide")[-100:]
    rows += [(5000, text, "s"), (5001, text, "other"), (5002, (text[:-1] + ".")[-100:], "s")]
    got = {r.doc_id: r.cut for r in judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[5000] and not got[5001] and not got[5002]


def test_on_the_table(spark, sf):
    found = {r.doc_id for r in p9_found(spark, sf).collect()}
    rates = {r.source: r for r in p9_rates(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found and sum(r.n_cut for r in rates.values()) == len(found) and sum(r.n_docs for r in rates.values()) == docs.count()
    assert not found & {r.doc_id for r in docs.filter("text IS NULL OR trim(text) = '' OR right(text, 1) IN ('!', '?', '。')").collect()}
