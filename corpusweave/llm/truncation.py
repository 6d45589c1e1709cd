"""Texts that were cut before their end.

The method is a self-join by prefix: values are sorted, and a value that is a strict prefix of longer ones stands directly
before one of them, so neighbours are compared and no pairs are built (``strict_prefixes``). It is applied at two levels,
whatever the length of the values:

* whole texts: a text without a closing mark that is a strict prefix of a longer text was cut;
* last words: a last word that the corpus never has there inside a text was cut if it is a strict prefix of a longer word
  that follows the same word (or of any word, where the corpus knows neither the word nor its place).

What is left are texts that end between two words and of which no longer copy exists. A second signal looks at the prefixes
of fixed length that end at the text's last word: windows of one to three tokens, hashed. Longer windows elsewhere with the
same prefix show how the corpus goes on there. If it goes on (nearly) always, the text was cut; if a sentence, line or list
item ends there, it may be whole. ``evidence`` says which of the comparisons decided: ``prefix``, ``word``, ``context``,
``broken`` (a replacement character shows a cut inside a character) or ``limit``.

A text that ends in a closing mark is whole, except where it is broken. A text whose last words can end a sentence but have
no full stop is a case if it has exactly a length at which its source cuts. These lengths, in characters or bytes, are
learned from the source's certain cases: a length is a limit if at least ``LIMIT_DOCS`` and ``LIMIT_SHARE`` of them have it.

Only what the ends of texts ask for is counted: a bitmap of the hashes of all asked windows, ``ASK_BITS`` bits at any input
size, goes to the tasks, which drop other windows before anything is shuffled. Foreign windows that pass it (hashes share
bits) are dropped by the join, so the bitmap changes no result. Statistics cover all distinct texts; equal texts count once,
so many copies of a cut text prove nothing.

Defined cases: NULL, empty and blank texts are no cases. Trailing blanks, ellipses (also of dots) and replacement characters
are ignored before the last word is judged. Documents without a source are judged like others, their source being one of its own.
Repeated documents are cases together. Texts, words and rests of any length are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.text import key_or_null
from corpusweave.session import Stage, cut_lineage, partitions_of

#: Stripped from the end before a text is judged.
TRAILING = " \t\r\n\x0b\x0c\x85\xa0  　​…�"
_STOPS = set(".!?。！？…")
_CLOSERS = set("\"”»’')]）】」』")
_OPEN = set(",;:([{（，；：、=/\\-–—+&@#<*_|")
_IDEO = r"[\p{Han}\p{Hiragana}\p{Katakana}]"
_LET = rf"[[\p{{L}}\p{{M}}]--{_IDEO}]"
_ALNUM = rf"[[\p{{L}}\p{{M}}\p{{N}}]--{_IDEO}]"
_TOKEN = regex.compile(rf"{_IDEO}|{_LET}+(?:['’\-]{_LET}+)*|{_ALNUM}*\p{{N}}{_ALNUM}*(?:[.,:/\-–]\p{{N}}+)*|\n|[^\S\n]+|.", regex.S | regex.V1)
_DIGIT = regex.compile(r"\p{N}")
_LABEL = regex.compile(r"\s*\p{Lu}\p{L}*(?: \p{Ll}+)?(?: \(\p{L}+\))?: ")
#: Contexts seen less often than this yield to shorter ones.
LEAST_SEEN = 4
#: Below this share of endings among its occurrences, a last context belongs inside a sentence.
ENDS_RARELY = 0.15
LIMIT_DOCS, LIMIT_SHARE = 5, 0.05
#: Bits of the map of asked windows.
ASK_BITS = 1 << 25
#: Characters that are tokenized together.
_CHUNK_CHARS = 4_000_000
#: Distinct pieces a worker remembers.
_MEMO = 400_000


def _fold(token: str) -> str:
    """Numbers become one token; identifiers keep the number of their digits."""
    if _DIGIT.match(token):
        return "9"
    return _DIGIT.sub("9", token.lower()) if _DIGIT.search(token) else token.lower()


def _closed(core: str) -> bool:
    """Whether the text ends in a mark that closes a sentence, a quotation or a bracket."""
    last = core[-1]
    if last in _STOPS:
        return True
    if last == '"':
        return core.rsplit("\n", 1)[-1].count('"') % 2 == 0
    return last in _CLOSERS and last not in "'’"


#: Codes of the marks between lines and texts, and of a place before the first token.
_PROSE, _LABELLED, _END_CLOSED, _END_OPEN = range(4)
_FIRST = 4
_WORD, _CLOSE, _STOP, _ASK, _SEMI, _OTHER = range(6)


class _Lexicon(dict):
    """Codes of the tokens of every piece between blanks, their folded text, kind and hash; a worker's memory.

    A token never spans a blank, so a piece is tokenized once, however often it occurs.
    """

    def __init__(self) -> None:
        super().__init__()
        self.folded: list[str] = ["^"] * 4
        self.by_fold: dict[str, int] = {}
        self.kind: list[int] = [_OTHER] * 4
        self.hash: list[int] = [xxhash.xxh64_intdigest("^")] * 4

    def _code(self, raw: str) -> int:
        t = _fold(raw)
        c = self.by_fold.get(t)
        if c is None:
            c = self.by_fold[t] = len(self.folded)
            self.folded.append(t)
            self.kind.append(_SEMI if t == ";" else _CLOSE if t in _CLOSERS else _STOP if t in _STOPS else _ASK if t in _OPEN else _WORD)
            self.hash.append(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")))
        return c

    def __missing__(self, piece: str) -> tuple[int, ...]:
        out = self[piece] = tuple(self._code(t) for t in _TOKEN.findall(piece) if not t.isspace())
        return out

    def line(self, line: str) -> Iterator[int]:
        return chain.from_iterable(map(self.__getitem__, line.split()))


def _line_kind(line: str) -> int:
    return _LABELLED if _LABEL.match(line) else _PROSE


def _mix(salt: int, *parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of hashes, the same for single values and whole batches."""
    h = np.full(np.broadcast(*parts).shape, salt * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def _contexts(kind: np.ndarray, b: np.ndarray, a: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Keys of a token's contexts, longest first; the last two are the word alone and its place alone."""
    kind = kind.astype(np.uint64)
    with np.errstate(over="ignore"):
        return [x.view(np.int64) for x in (_mix(3, kind, b, a, w), _mix(2, kind, a, w), _mix(4, kind, b, w), _mix(1, kind, w), _mix(5, kind, b, a))]


def _flat(lex: _Lexicon, cores: list[str]) -> np.ndarray:
    """All tokens of the texts as codes, a mark before every line and after every text."""
    flat: list[int] = []
    for core in cores:
        for line in core.split("\n"):
            flat.append(_line_kind(line))
            flat.extend(lex.line(line))
        flat.append(_END_CLOSED if _closed(core) else _END_OPEN)
    return np.array(flat, dtype=np.int32)


def _chunks(cores: Iterator[str]) -> Iterator[list[str]]:
    """Texts in groups of bounded length, so that the working memory doesn't grow with the texts of a batch."""
    part, size = [], 0
    for core in cores:
        part.append(core)
        size += len(core)
        if size > _CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _occurrences(lex: _Lexicon, cores: list[str], asked: np.ndarray) -> tuple[list[np.ndarray], tuple[list[str], list[str]]]:
    """Of the asked windows: key, how often seen, ended, inside its text; and the distinct pairs of a word inside a text and
    the one before it."""
    arr = _flat(lex, cores)
    if not len(arr):
        return [np.zeros(0, np.int64)] * 4, ([], [])
    kinds, hashes = np.array(lex.kind, dtype=np.int8)[arr], np.array(lex.hash, dtype=np.uint64)
    mark = arr < _FIRST
    n = len(arr)
    at = np.arange(n)
    kind = arr[np.maximum.accumulate(np.where(arr <= _LABELLED, at, 0))]  # of the line at every place
    # the next token that closes no bracket or quotation
    solid = np.where(mark | (kinds != _CLOSE), at, n)
    after = np.minimum(np.append(np.minimum.accumulate(solid[::-1])[::-1][1:], n), n - 1)
    end = mark[after] | (kinds[after] == _STOP) | ((kind == _LABELLED) & (kinds[after] == _SEMI))
    inner = arr[after] != _END_OPEN
    a = np.where(np.append(True, mark[:-1]), _PROSE, np.append(_PROSE, arr[:-1]))
    b = np.where(a == _PROSE, _PROSE, np.append(_PROSE, a[:-1]))
    i = np.flatnonzero(~mark & (kinds == _WORD))
    # equal windows of three are summed up first; the shorter ones are made from these
    ka, kb, kw, kk = arr[i], a[i], b[i], kind[i]
    with np.errstate(over="ignore"):
        whole = _mix(6, kk.astype(np.uint64), hashes[kw], hashes[kb], hashes[ka])
    _, first, group = np.unique(whole, return_index=True, return_inverse=True)
    m = len(first)
    counts = [np.bincount(group, minlength=m), *(np.bincount(group, weights=x[i], minlength=m).astype(np.int64) for x in (end, inner))]
    kw, kb, ka, kk = kw[first], kb[first], ka[first], kk[first]
    keys = np.concatenate(_contexts(kk, hashes[kw], hashes[kb], hashes[ka]))
    hit = np.flatnonzero(_has(asked, keys))
    unique, group = np.unique(keys[hit], return_inverse=True)
    sums = [np.bincount(group, weights=c[hit % m], minlength=len(unique)).astype(np.int64) for c in counts]
    long = np.array([len(t) > 1 and t[0].isalnum() for t in lex.folded])
    k = np.flatnonzero((counts[2] > 0) & long[ka])
    pairs = np.unique(kb[k].astype(np.int64) * len(lex.folded) + ka[k])
    return [unique, *sums], tuple([lex.folded[c] for c in x] for x in (pairs // len(lex.folded), pairs % len(lex.folded)))


def _has(asked: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & (ASK_BITS - 1)
    return (asked[at >> 6] >> (at & 63)) & 1 == 1


def asked_windows(tails: DataFrame) -> np.ndarray:
    """The bitmap of the keys in ``keys``: its words are put together on the executors, at most ``ASK_BITS / 64`` come here."""
    at = F.col("key").bitwiseAND(F.lit(ASK_BITS - 1))
    words = tails.select(F.explode("keys").alias("key")).groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(ASK_BITS // 64, dtype=np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out


def corpus_counts(texts: DataFrame, tails: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass over ``core``: of the windows that ``tails`` ask for ``key, seen, ended, inner`` (how often each occurs, ends
    a unit, and is not last in its text), and the distinct pairs ``prev, w`` of a word inside a text and the word before it.

    Both come as partial results of the tasks, which are written out once, because two summaries read them.
    """
    asked = texts.sparkSession.sparkContext.broadcast(asked_windows(tails))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "seen", "ended", "inner", "prev", "w"]
        lex = _Lexicon()
        for part in _chunks(core for b in batches for core in b.column(0).to_pylist()):
            if len(lex) > _MEMO:
                lex = _Lexicon()
            windows, pairs = _occurrences(lex, part, asked.value)
            n, m = len(windows[0]), len(pairs[0])
            yield pa.RecordBatch.from_arrays([*map(pa.array, windows), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(m, pa.int64()) for _ in range(4)), *(pa.array(x, pa.string()) for x in pairs)], names=names)

    raw = Stage(texts.sparkSession).put(texts.select("core").mapInArrow(run, "key bigint, seen bigint, ended bigint, inner bigint, prev string, w string"))
    contexts = raw.filter("key IS NOT NULL").groupBy("key").agg(*(F.sum(c).alias(c) for c in ("seen", "ended", "inner")))
    return contexts, raw.filter("w IS NOT NULL").select("prev", "w").distinct()


def open_tails(texts: DataFrame) -> DataFrame:
    """The texts without a closing mark: ``h, open`` (ends in a mark that asks for more), the last word, the one before, the keys of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            lex = _Lexicon()
            for h, core in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if _closed(core):
                    continue
                line = core.rsplit("\n", 1)[-1]
                toks = list(lex.line(line))
                if not toks or lex.kind[toks[-1]] != _WORD:
                    out.append((h, True, None, None, None))
                else:
                    prev, before = ([_PROSE, _PROSE, *toks])[-2], ([_PROSE, _PROSE, *toks])[-3]
                    parts = (np.array([lex.hash[c]], dtype=np.uint64) for c in (before, prev, toks[-1]))
                    keys = [int(x[0]) for x in _contexts(np.array([_line_kind(line)]), *parts)]
                    out.append((h, False, lex.folded[prev], lex.folded[toks[-1]], keys))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.string(), pa.bool_(), pa.string(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["h", "open", "prev", "word", "keys"])

    return texts.select("h", "core").mapInArrow(run, "h string, open boolean, prev string, word string, keys array<bigint>")


def strict_prefixes(asks: DataFrame, values: DataFrame, group: str, value: str) -> DataFrame:
    """``group, value`` of the rows of ``asks`` whose value is a strict prefix of a value of ``values`` in the same group.

    Both are sorted together, in range partitions. The values that start with an ask come directly after it, so an ask has
    only to be compared with the first value after it that is greater. Asks that wait at the end of a partition are compared
    with the first value of the next one that has any; of asks with the same group only prefixes of one another can wait.
    NULL groups and values match nothing; repeated rows are harmless. No length is limited.
    """
    n = partitions_of(asks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["part", "kind", "g", "v"], [pa.int32(), pa.int8(), pa.string(), pa.string()]
        waiting: list[tuple[str, str]] = []
        first = part = None
        for b in batches:
            out: list[tuple] = []
            for g, v, ask, p in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                part = p
                if ask:
                    if waiting and not (waiting[-1][0] == g and v.startswith(waiting[-1][1])):
                        waiting = [w for w in waiting if w[0] == g and v.startswith(w[1])]  # no later value can start with the others
                    if not waiting or waiting[-1] != (g, v):
                        waiting.append((g, v))
                    continue
                if first is None:
                    first = (g, v)
                if waiting:
                    out.extend((p, 0, *w) for w in waiting if w[0] == g and v.startswith(w[1]) and v != w[1])
                    waiting = [(g, v)] if waiting[-1] == (g, v) else []
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*out, strict=True)) or [[]] * 4, kinds, strict=True)], names=names)
        rest = [(part, 1, *w) for w in waiting] + ([(part, 2, *first)] if first else [])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(list(zip(*rest, strict=True)) or [[]] * 4, kinds, strict=True)], names=names)

    both = asks.select(group, value, F.lit(True).alias("ask")).unionByName(values.select(group, value, F.lit(False).alias("ask"))).filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    placed = both.repartitionByRange(n, group, value).sortWithinPartitions(group, value, F.desc("ask")).withColumn("part", F.spark_partition_id())
    out = Stage(asks.sparkSession).put(placed.mapInArrow(run, "part int, kind tinyint, g string, v string"))
    # one row per partition: the first value of the next partition that has one
    firsts = out.filter("kind = 2").select(F.col("part").alias("p2"), F.col("g").alias("g2"), F.col("v").alias("v2"))
    seams = firsts.withColumn("lo", F.lag("p2", 1, -1).over(W.orderBy("p2")))
    late = out.filter("kind = 1").join(F.broadcast(seams), (F.col("part") >= F.col("lo")) & (F.col("part") < F.col("p2"))).filter((F.col("g") == F.col("g2")) & F.col("v2").startswith(F.col("v")) & (F.col("v") != F.col("v2")))
    return out.filter("kind = 0").select("g", "v").unionByName(late.select("g", "v")).distinct().toDF(group, value)


def judge_texts(texts: DataFrame) -> DataFrame:
    """``h, ends, certain, evidence`` of the open texts; ``ends`` is the share of endings at their last context, NULL if unknown."""
    tails = cut_lineage(open_tails(texts))
    contexts, pairs = corpus_counts(texts, tails)
    looked = tails.filter(F.col("keys").isNotNull()).select("h", "prev", "word", F.posexplode("keys").alias("at", "key"))
    looked = looked.join(contexts, "key", "left")
    at = lambda i, c: F.max(F.when(F.col("at") == i, F.coalesce(F.col(c), F.lit(0))))
    per = looked.groupBy("h", "prev", "word").agg(*(at(i, c).alias(f"{c}{i}") for i in range(5) for c in ("seen", "ended", "inner")))
    # the text's own last token is not evidence
    unknown = F.col("inner3") <= 0
    share = F.lit(None).cast("double")
    for i in (3, 2, 1, 0):
        seen, ended = F.col(f"seen{i}") - 1, F.col(f"ended{i}") - 1
        share = F.when(seen >= (1 if i == 3 else LEAST_SEEN), ended / F.nullif(seen, F.lit(0))).otherwise(share)
    place = F.when(F.col("seen4") - 1 >= LEAST_SEEN, (F.col("ended4") - 1) / F.nullif(F.col("seen4") - 1, F.lit(0)))
    # a short rest may be a word elsewhere, but then never after the word before it
    per = cut_lineage(per.select("h", "prev", "word", (unknown & place.isNull()).alias("alone"), (F.col("inner1") <= 0).alias("strange"), F.when(unknown, place).otherwise(share).alias("ends")))
    asks = per.filter("strange").select(F.when(F.col("alone"), F.lit("")).otherwise(F.concat(F.lit("="), "prev")).alias("place"), "word").distinct()
    values = pairs.select(F.inline(F.array(F.struct(F.concat(F.lit("="), "prev").alias("place"), F.col("w").alias("word")), F.struct(F.lit("").alias("place"), F.col("w").alias("word")))))
    longer = strict_prefixes(asks, values, "place", "word").withColumn("cut_word", F.lit(True))
    per = per.withColumn("place", F.when(F.col("alone"), F.lit("")).otherwise(F.concat(F.lit("="), "prev"))).join(longer, ["place", "word"], "left")
    word = F.coalesce("cut_word", F.lit(False)) & F.col("strange")
    low = F.coalesce(F.col("ends") < ENDS_RARELY, F.lit(False))
    judged = per.select("h", "ends", (word | low).alias("certain"), F.when(word, F.lit("word")).when(low, F.lit("context")).alias("evidence"))
    return judged.unionByName(tails.filter("open").select("h", F.lit(0.0).alias("ends"), F.lit(True).alias("certain"), F.lit("context").alias("evidence")))


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", salts: int = 16) -> DataFrame:
    """``doc_id, source, cut, evidence`` of every document; the source is folded, NULL where missing."""
    d = docs.select(F.col(id_col).alias("doc_id"), key_or_null(F.col(source_col)).alias("source"), F.col(text_col).cast("string").alias("text"))
    # several dots are an ellipsis, one is a full stop
    d = d.withColumn("core", F.rtrim("text", F.lit(TRAILING)))
    d = d.withColumn("core", F.when(F.col("core").endswith(".."), F.rtrim("core", F.lit(TRAILING + "."))).otherwise(F.col("core")))
    real = F.coalesce(F.length(F.trim("core", F.lit(TRAILING))) > 0, F.lit(False))
    d = d.withColumn("h", F.when(real, F.md5("core")))
    texts = Stage(docs.sparkSession).put(d.filter(real).select("h", "core").groupBy("h").agg(F.min("core").alias("core")))
    judged = cut_lineage(judge_texts(texts))
    whole = texts.withColumn("one", F.lit(""))
    asks = texts.join(judged.select("h"), "h", "left_semi").withColumn("one", F.lit(""))
    longer = strict_prefixes(asks, whole, "one", "core").select(F.md5("core").alias("h"), F.lit(True).alias("prefix"))
    sure = F.coalesce("prefix", F.lit(False))
    verdict = judged.join(longer, "h", "left").select("h", (F.col("certain") | sure).alias("certain"), F.when(sure, F.lit("prefix")).otherwise(F.col("evidence")).alias("evidence"))
    # equal texts may be a third of all documents: they are dealt out over salts, the few verdicts repeated
    verdict = verdict.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    broken = F.coalesce(F.substr(F.col("text"), F.length("core") + 1).contains("\ufffd"), F.lit(False)) & real
    flat = d.select("doc_id", "source", "h", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), broken.alias("broken"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))
    rows = flat.join(verdict, ["h", "salt"], "left").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "chars", "bytes", F.col("certain").isNotNull().alias("open"), (F.coalesce("certain", F.lit(False)) | F.col("broken")).alias("certain"), F.when(F.coalesce("certain", F.lit(False)), F.col("evidence")).when(F.col("broken"), F.lit("broken")).alias("evidence"))
    rows = Stage(docs.sparkSession).put(rows)
    sure = rows.filter("certain").select("source", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("chars").alias("size")), F.struct(F.lit("b").alias("unit"), F.col("bytes").alias("size")))).alias("l"))
    sizes = sure.groupBy("source", "l.unit", "l.size").agg(F.count("*").alias("n"))
    total = sizes.groupBy("source", "unit").agg(F.sum("n").alias("all"))
    # a source cuts at characters or at bytes: where both have the size, the unit with more cases is the limit
    limits = sizes.join(total, ["source", "unit"]).filter((F.col("n") >= LIMIT_DOCS) & (F.col("n") >= LIMIT_SHARE * F.col("all")))
    limits = limits.withColumn("most", F.max("n").over(W.partitionBy("source", "size"))).filter(F.col("n") == F.col("most"))
    # lengths that only come near (one wide character more than the limit) stay far below the source's main limit
    limits = limits.withColumn("top", F.max("n").over(W.partitionBy("source"))).filter(F.col("n") >= 0.3 * F.col("top"))
    maybe = rows.filter(F.col("open") & ~F.col("certain"))
    for unit, col in (("c", "chars"), ("b", "bytes")):
        lim = limits.filter(F.col("unit") == unit).select("source", F.col("size").alias(col), F.lit(True).alias(f"at_{unit}"))
        maybe = maybe.join(lim, ["source", col], "left")
    maybe = maybe.withColumn("cut", F.coalesce("at_c", F.lit(False)) | F.coalesce("at_b", F.lit(False))).select("doc_id", "source", "cut", F.when(F.col("cut"), F.lit("limit")).alias("evidence"))
    out = rows.filter(~F.col("open") | F.col("certain")).select("doc_id", "source", F.col("certain").alias("cut"), "evidence").unionByName(maybe)
    return out.select("doc_id", F.nullif("source", F.lit("")).alias("source"), "cut", "evidence")
