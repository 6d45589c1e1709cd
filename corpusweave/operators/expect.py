"""Expectations: named conditions over a table, counted in one pass, and failing closed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ExpectationError(ValueError):
    """A table breaks what was expected of it."""


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rule, broken``: rows for which a rule is false or unknown."""
    one = df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("rule"), F.col(k).alias("broken")) for k in rules))))


def unknown_tokens(df: DataFrame, tokens: Column, allowed: Sequence[str]) -> DataFrame:
    """Distinct tokens outside the domain, with their rows."""
    return df.select(F.explode(tokens).alias("token")).filter(~F.col("token").isin(*allowed)).groupBy("token").count()


def require(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The table itself, after all rules were found to hold."""
    bad = {r["rule"]: r["broken"] for r in violations(df, rules).collect() if r["broken"]}
    if bad:
        raise ExpectationError(f"broken rows by rule: {bad}")
    return df


def require_unique(df: DataFrame, key: str) -> DataFrame:
    n = df.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).count()
    if n:
        raise ExpectationError(f"{n} values of {key} are repeated or NULL")
    return df


def require_matched(left: DataFrame, right: DataFrame, key: str) -> None:
    n = left.join(right, key, "left_anti").count()
    if n:
        raise ExpectationError(f"{n} rows have no match by {key}")
