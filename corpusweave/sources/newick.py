"""Trees in Newick notation: reading the inner nodes, and writing a tree."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.functions.metadata import quoted_label  # noqa: F401  (the column form of quote)

_MARK = re.compile(r"[\s()\[\]{}:;,'\"]")


def parse_newick(text: str, keep_tips: bool = False) -> list[tuple[int, int | None, str | None, float]]:
    """``(node, parent, label, length)`` in preorder, the root first; tips are counted only with ``keep_tips``.

    Labels may be quoted, two quotes standing for one. A missing or negative length is 0. Text after the root's ``;`` is
    ignored. Unbalanced brackets raise.
    """
    nodes: list[list] = []
    stack: list[int] = []
    i, n = 0, len(text)
    target: int | None = None  # the node that a label or length belongs to; None: a skipped tip

    def add(is_tip: bool) -> int | None:
        if is_tip and not keep_tips:
            return None
        nodes.append([len(nodes), stack[-1] if stack else None, None, 0.0])
        return len(nodes) - 1

    fresh = True  # at a place where a tip may start
    while i < n:
        c = text[i]
        if c == "(":
            stack.append(add(False))
            fresh = True
        elif c in "),":
            if fresh:
                add(True)
            if c == ")":
                if not stack:
                    raise ValueError("a bracket is closed that was not opened")
                target = stack.pop()
            fresh = c == ","
        elif c == ";":
            break
        elif c == ":":
            j = i + 1
            while j < n and text[j] not in "(),;":
                j += 1
            if fresh:
                target, fresh = add(True), False
            if target is not None:
                nodes[target][3] = max(0.0, float(text[i + 1 : j].strip()))
            i = j - 1
        elif not c.isspace():
            if fresh:
                target, fresh = add(True), False
            if c == "'":
                j, parts = i + 1, []
                while True:
                    k = text.index("'", j)
                    parts.append(text[j:k])
                    if text[k + 1 : k + 2] != "'":
                        break
                    j = k + 2
                label, i = "'".join(parts), k
            else:
                j = i
                while j < n and text[j] not in "(),:;":
                    j += 1
                label, i = text[i:j].strip(), j - 1
            if target is not None:
                nodes[target][2] = label or None
        i += 1
    if stack:
        raise ValueError("a bracket is not closed")
    return [tuple(x) for x in nodes]


def quote(label: str | None) -> str:
    """A label as it is written: quoted where it holds a mark of the notation."""
    if not label:
        return ""
    return "'" + label.replace("'", "''") + "'" if _MARK.search(label) else label


def write_newick(nodes: list[tuple[int, int | None, str | None, float]]) -> str:
    """The text of a tree; the root has no length. Children keep the order of the nodes."""
    kids: dict = {}
    root = None
    for v, p, label, length in nodes:
        kids.setdefault(v, [])
        if p is None:
            root = (v, label, length)
        else:
            kids.setdefault(p, []).append((v, label, length))
    if root is None:
        return ";"
    out: list[str] = []
    todo: list = [("open", root, True)]
    while todo:
        what, (v, label, length), top = todo.pop()
        if what == "text":
            out.append(v)
            continue
        if what == "open" and kids[v]:
            out.append("(")
            todo.append(("close", (v, label, length), top))
            for k, child in enumerate(reversed(kids[v])):
                if k:
                    todo.append(("text", (",", None, 0), False))
                todo.append(("open", child, False))
        else:
            out.append((")" if what == "close" else "") + quote(label) + ("" if top else f":{length:.10g}"))
    return "".join(out) + ";"


def newick_nodes(texts: DataFrame, text_col: str, keep_tips: bool = False) -> DataFrame:
    """``tree, node, parent, label, length`` of every text; a text is parsed in one task, as its nesting demands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(t, *r) for t, text in zip(b["tree"], b["text"], strict=True) if text for r in parse_newick(text, keep_tips)]
            yield pd.DataFrame(rows, columns=["tree", "node", "parent", "label", "length"]).astype({"parent": "Int64"})

    src = texts.select(F.col("tree").cast("long").alias("tree"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "tree long, node long, parent long, label string, length double")


def read_newick(spark: SparkSession, path: str, keep_tips: bool = False) -> DataFrame:
    """The nodes of the trees in text files, one tree per file."""
    return newick_nodes(spark.read.text(path, wholetext=True).select(F.xxhash64(F.input_file_name()).alias("tree"), "value"), "value", keep_tips)
