"""Per-key results where a few keys hold most rows.

``key_profile`` counts entities per key and finds exact quantiles of numeric columns per key, by distributed exact
selection: every (key, metric) keeps an interval known to hold the wanted rank; each pass histograms the rows inside the
intervals with mergeable counts (count, least and greatest value per bin) and narrows each interval to the bin that holds
the rank, until a single value is left. The values of a key never come together in one task: rows are first reduced to
(key, metric, value) counts, which spreads a hot key over its values, and a histogram has at most ``bins`` rows per interval.

Hot keys get their intervals by broadcast, so their rows stay where they are; at most ``1 / hot_share`` keys can be hot,
which bounds the broadcast for any input. The other keys meet their intervals in a shuffle join.

Defined cases: rows without an entity id are left out. Repeated rows of an entity under a key count once (per metric the
greatest value is taken). Missing keys give no result row, but their entities count in the share's denominator. NULL, NaN
and infinite values take part in no quantile. A quantile p of n values is the value of rank ``ceil(p * n)``, at least 1;
with no value it is NULL. Keys are compared trimmed and without case. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from corpusweave.functions.text import is_missing, key_or_null
from corpusweave.session import Stage, cut_lineage

_KEY = ("field", "key", "metric")
_ROWS = "__rows"


def entity_rows(df: DataFrame, entity: str, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per entity, key column and key: ``entity, field, key, n_rows`` and the metrics as m0, m1, ..."""
    values = [F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double")) for m in metrics]
    values = [F.when(F.abs(v) < float("inf"), v).alias(f"m{i}") for i, v in enumerate(values)]
    one = df.filter(~is_missing(F.col(entity).cast("string"))).select(
        F.col(entity).cast("string").alias("entity"),
        F.explode(F.array(*(F.struct(F.lit(k).alias("field"), key_or_null(F.col(k).cast("string")).alias("key")) for k in keys))).alias("k"),
        *values,
    )
    return one.filter(F.col("k.key").isNotNull()).groupBy("entity", F.col("k.field").alias("field"), F.col("k.key").alias("key")).agg(F.count("*").alias("n_rows"), *(F.max(f"m{i}").alias(f"m{i}") for i in range(len(metrics))))


def exact_quantiles(values: DataFrame, probs: Sequence[float], bins: int = 512, hot_share: float = 0.001, interpolate: bool = False, weight: str | None = None) -> DataFrame:
    """``field, key, metric, n, prob, value`` from ``field, key, metric, v``; see the module's text for the method.

    A row counts as often as ``weight`` says. With ``interpolate`` a quantile lies between the two values around position
    ``p * (n - 1)``, as medians of even numbers do; otherwise it is a value of the data.
    """
    finite = F.abs(F.col("v")) < float("inf")  # false for NaN
    reduced = values.filter(finite).withColumn("v", F.col("v") + F.lit(0.0)).groupBy(*_KEY, "v").agg((F.sum(F.col(weight).cast("long")) if weight else F.count("*")).alias("n"))
    reduced = Stage(values.sparkSession).put(reduced.filter("n > 0"))
    root = cut_lineage(reduced.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("distinct")))
    # hot by the reduced rows, which are what a task would have to read
    rows = root.agg(F.sum("distinct")).head()[0] or 0
    hot = F.broadcast(root.filter(F.col("distinct") > hot_share * rows).select(*_KEY, F.lit(True).alias("hot")))
    reduced = reduced.join(hot, [*_KEY], "left")
    hot_rows, cold_rows = reduced.filter(F.col("hot")), reduced.filter(F.col("hot").isNull()).drop("hot")

    prob = F.explode(F.array(*map(F.lit, probs)))
    state = root.select(*_KEY, "n", prob.alias("prob"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    if interpolate:
        at = F.round(F.col("prob") * (F.col("n") - 1), 9)
        state = state.withColumn("rank", F.explode(F.array_distinct(F.array((F.floor(at) + 1).cast("long"), (F.ceil(at) + 1).cast("long")))))
    else:
        state = state.withColumn("rank", F.least(F.col("n"), F.greatest(F.lit(1), F.ceil(F.round(F.col("prob") * F.col("n"), 9)))).cast("long"))
    stage = Stage(values.sparkSession)
    state = stage.put(state.join(hot, [*_KEY], "left"))
    while True:  # every pass parts the least value of an interval from the greatest, so it ends
        todo = state.filter(F.col("lo") < F.col("hi"))
        if todo.isEmpty():
            break
        spans = todo.select(*_KEY, "lo", "hi", "below", "hot").distinct()
        inner = F.col("v").between(F.col("lo"), F.col("hi"))
        found = hot_rows.drop("hot").join(F.broadcast(spans.filter(F.col("hot")).drop("hot")), [*_KEY]).filter(inner)
        found = found.unionByName(cold_rows.join(spans.filter(F.col("hot").isNull()).drop("hot"), [*_KEY]).filter(inner))
        wide = F.col("hi") - F.col("lo") == float("inf")
        part = F.when(wide, (F.col("v") / 2 - F.col("lo") / 2) / F.nullif(F.col("hi") / 2 - F.col("lo") / 2, F.lit(0.0))).otherwise((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        at = F.floor(part * bins)
        hist = found.groupBy(*_KEY, "lo", "below", F.least(at, F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("c"), F.min("v").alias("new_lo"), F.max("v").alias("new_hi"))
        upto = F.col("below") + F.sum("c").over(W.partitionBy(*_KEY, "lo").orderBy("bin"))
        hist = hist.withColumn("upto", upto).select(*_KEY, "lo", "new_lo", "new_hi", (F.col("upto") - F.col("c")).alias("new_below"), "upto")
        pick = (F.col("rank") > F.col("new_below")) & (F.col("rank") <= F.col("upto"))
        narrowed = todo.drop("hi", "below").join(hist, [*_KEY, "lo"]).filter(pick).select(*_KEY, "n", "prob", F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), F.col("new_below").alias("below"), "rank", "hot")
        state = stage.put(state.filter(F.col("lo") >= F.col("hi")).select(*narrowed.columns).unionByName(narrowed))
    if interpolate:
        at = F.round(F.col("prob") * (F.col("n") - 1), 9)
        value = F.min("lo") + (F.max("lo") - F.min("lo")) * F.max(at - F.floor(at))
        return state.groupBy(*_KEY, "n", "prob").agg(value.alias("value"))
    return state.select(*_KEY, "n", "prob", F.col("lo").alias("value"))


def add_quantiles(stats: DataFrame, df: DataFrame, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = (), weight: str | None = None, bins: int = 4096) -> DataFrame:
    """``stats`` with the interpolated quantiles ``wanted``: column name to (column of ``df``, probability), per ``by``.

    No task holds the values of a group, as an aggregate function would; ``df`` is read once.
    """
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    metrics = sorted({c for c, _ in wanted.values()})
    extra = [F.col(weight)] if weight else []
    long = df.select(F.lit("").alias("field"), key.alias("key"), *extra, F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics))))
    q = exact_quantiles(long, sorted({p for _, p in wanted.values()}), bins, interpolate=True, weight=weight)
    wide = q.groupBy(F.col("key").alias("__cw_q")).agg(*(F.max(F.when((F.col("metric") == m) & (F.col("prob") == p), F.col("value"))).alias(n) for n, (m, p) in wanted.items()))
    return stats.withColumn("__cw_k", key).join(wide, F.col("__cw_k") == F.col("__cw_q"), "left").drop("__cw_k", "__cw_q")


def _name(metric: str, prob: float) -> str:
    return f"{metric.lower()}_p{round(prob * 100):02d}"


def key_profile(df: DataFrame, entity: str, keys: Sequence[str], metrics: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), hot_share: float = 0.02) -> DataFrame:
    """Per key column and key: ``n_rows, n_samples, share, is_hot`` and, per metric, the count and exact quantiles."""
    rows = cut_lineage(entity_rows(df, entity, keys, metrics))
    total = df.filter(~is_missing(F.col(entity).cast("string"))).select(F.col(entity).cast("string").alias("e")).distinct().count()
    counts = rows.groupBy("field", "key").agg(F.sum("n_rows").alias("n_rows"))
    # every entity has a number of rows: the selection's own count of that metric is the number of entities
    parts = [F.struct(F.lit(_ROWS).alias("metric"), F.col("n_rows").cast("double").alias("v")), *(F.struct(F.lit(m).alias("metric"), F.col(f"m{i}").alias("v")) for i, m in enumerate(metrics))]
    long = rows.select("field", "key", F.inline(F.array(*parts)))
    q = exact_quantiles(long, probs)

    def pick(m: str, what: Column) -> Column:
        return F.max(F.when(F.col("metric") == m, what))

    wide = q.groupBy("field", "key").agg(pick(_ROWS, F.col("n")).alias("n_samples"), *(x for m in metrics for x in (pick(m, F.col("n")).alias(f"{m.lower()}_n"), *(F.max(F.when((F.col("metric") == m) & (F.col("prob") == p), F.col("value"))).alias(_name(m, p)) for p in probs))))
    share = F.col("n_samples") / F.lit(float(max(total, 1)))
    out = counts.join(wide, ["field", "key"]).select(
        F.col("field").alias("field_name"), F.col("key").alias("key_value"), "n_rows", "n_samples", share.alias("share"), (F.col("n_samples") > hot_share * total).alias("is_hot"),
        *(x for m in metrics for x in (F.coalesce(f"{m.lower()}_n", F.lit(0).cast(T.LongType())).alias(f"{m.lower()}_n"), *(F.col(_name(m, p)) for p in probs))),
    )
    return out
