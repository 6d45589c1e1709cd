"""The rank queue against an independent implementation of the same vocabulary."""

import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from corpusweave.llm.tokenizer import ByteBpe, RankQueue, encode_corpus, token_counts

with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
    BLOB = f.read()
RANKS = {base64.b64decode(a): int(b) for a, b in (x.split() for x in BLOB.splitlines())}
REF = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BPE = ByteBpe.from_bytes(BLOB)

TEXTS = ["", " ", "a", "Hello  world\n\n x", "it's we'll 'S", "日本語 テキスト", "é ​﻿", "👩‍🔬🧫 x", "\x00\x1c\x1d\x1f\x85\xa0a", "<|endoftext|>", "١٢٣ ४५", "a" * 3000, "ab" * 5000, "\t \r\n  \x0b", "　  x", "x\x1cy \x1f z", " " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(text):
    assert BPE.encode(text) == REF.encode_ordinary(text)


def test_random_texts():
    rng = random.Random(7)
    pools = ["abc ABC'sdt.,!? \n\t", "\x00\x01\x1c\x1e\x7f\x80\x85\xa0 aé", "éèçßæ øñ 中文字データ한국어 ", "🙂👍🏽🇩🇪‍️ a", "0123456789.,- ", "عربي עברית हिन्दी ไทย "]
    for _ in range(3000):
        pool = "".join(rng.sample(pools, rng.randint(1, 3)))
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))
        assert BPE.encode(text) == REF.encode_ordinary(text), repr(text)


def test_long_pretoken_and_foreign_order():
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    assert REF.decode(BPE.encode(word)) == word
    assert BPE.encode(word[:20_000]) == REF.encode_ordinary(word[:20_000])
    # ranks in no merge order: a merge may open a lower rank
    ranks = {bytes([b]): 100 + b for b in range(256)} | {b"ab": 9, b"abc": 3, b"bc": 7, b"ca": 8}
    own = ByteBpe(ranks)

    def naive(s):
        parts = [bytes([x]) for x in s]
        while True:
            cand = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not cand:
                return [ranks[p] for p in parts]
            _, i = min(cand)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(300):
        s = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        assert own.merge(s) == naive(s), s


def test_queue():
    q, rng = RankQueue(), random.Random(2)
    want = {}
    for i in range(5000):
        r = rng.randrange(50257)
        q.push(r, i)
        want.setdefault(r, []).append(i)
    got = []
    while q.top:
        got.append(q.pop())
    assert got == sorted(want.items())


def test_frames(spark, sf):
    rows = [(1, "a b"), (2, None), (3, ""), (4, "  "), (None, "x"), (1, "a b")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, ids string")
    want = sorted((i, REF.encode_ordinary(t or "")) for i, t in rows if i is not None)
    got = encode_corpus(df, "doc_id", "text").collect()
    assert sorted((r.id, list(r.ids)) for r in got if r.id is not None) == want and len(got) == len(rows)
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0 and token_counts(df.limit(0), "doc_id", "text").count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    assert {r.id: list(r.ids) for r in encode_corpus(docs, "doc_id", "text").collect()} == {k: REF.encode_ordinary(t or "") for k, t in text.items()}
    assert {r.id: r.tokens for r in token_counts(docs, "doc_id", "text").collect()} == {k: len(REF.encode_ordinary(t or "")) for k, t in text.items()}
