"""Rank-prefixed taxonomy paths such as ``d__A; p__B; ...``: parsing, keys and filters, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rank names and their prefixes, from the top down.
RANKS = ("Domain", "Phylum", "Class", "Order", "Family", "Genus", "Species")
PREFIXES = ("d__", "p__", "c__", "o__", "f__", "g__", "s__")
KEY_RANKS = RANKS[:6]
#: The order in which deepest ranks are reported.
DEPTH_ORDER = ("Species", "Genus", "Family", "Order", "Class", "Phylum", "Domain", "None")


def parse_path(path: Column) -> list[Column]:
    """One column per rank: the first piece with the rank's prefix, trimmed, or NULL."""
    pieces = F.transform(F.split(path, ";"), lambda x: F.trim(x))

    def first(prefix: str) -> Column:
        return F.get(F.filter(pieces, lambda x: x.startswith(prefix)), F.lit(0))

    return [first(p).alias(r) for r, p in zip(RANKS, PREFIXES, strict=True)]


def deepest_rank(ranks: Sequence[Column] | None = None) -> Column:
    """Name of the deepest rank that is neither NULL nor a bare prefix, else ``None`` as text."""
    cols = ranks or [F.col(r) for r in RANKS]
    named = [F.when(c.isNotNull() & (c != p), F.lit(r)) for c, r, p in zip(cols, RANKS, PREFIXES, strict=True)]
    return F.coalesce(*reversed(named), F.lit("None"))


def group_key(ranks: Sequence[Column] | None = None) -> Column:
    """The six upper ranks joined by ``;``; a missing rank is its bare prefix, so both spellings give one key."""
    cols = ranks or [F.col(r) for r in KEY_RANKS]
    return F.concat_ws(";", *(F.coalesce(c, F.lit(p)) for c, p in zip(cols, PREFIXES, strict=False)))


def split_key(key: Column) -> list[Column]:
    """The six rank columns of a group key; NULL where the key has fewer pieces."""
    return [F.get(F.split(key, ";"), F.lit(i)).alias(r) for i, r in enumerate(KEY_RANKS)]


def is_real(rank: Column) -> Column:
    """A rank that says more than its prefix."""
    return F.coalesce(F.length(rank) > 3, F.lit(False))


def keep_feature(path: Column, domain: Column, domains: Sequence[str], unwanted: Sequence[str] = ("mitochondri", "chloroplast")) -> Column:
    """In one of ``domains`` and free of the unwanted words, compared without case; NULL text holds none of them."""
    text = F.lower(path)
    keep = F.coalesce(domain.isin(*domains), F.lit(False))
    for w in unwanted:
        keep = keep & ~F.coalesce(text.contains(w), F.lit(False))
    return keep


def rank_token(label: Column, prefix: str = "g__") -> Column:
    """The token of a rank in a tree label with at least one character after its prefix, or NULL."""
    return F.nullif(F.regexp_extract(label, rf"({prefix}[A-Za-z0-9_.-]+)", 1), F.lit(""))


def has_split_suffix(name: Column) -> Column:
    """Names that end in an underscore and one capital letter."""
    return F.coalesce(name.rlike("_[A-Z]$"), F.lit(False))


def with_ranks(df: DataFrame, path: str) -> DataFrame:
    """All rank columns, the deepest rank and the group key of a path column."""
    out = df.select("*", *parse_path(F.col(path)))
    return out.withColumn("deepest", deepest_rank()).withColumn("var_id", group_key())
