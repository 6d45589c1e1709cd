"""A sample whose category shares follow targets, in several fields at once.

Divisor-method priorities: every record gets a random rank in its cell (its combination of categories). Records that fill
the minimum of a category come first, the others have the priority ``(rank - 0.5) / weight`` of their cell, and the records
with the globally smallest priorities are kept. An exhausted cell has no more records to offer, so its seats pass to the
others by themselves.

The weights of the cells follow all fields' targets together. Each field's targets are first brought within what is there,
what a category lacks being passed on in proportion. Then iterative proportional fitting multiplies every cell by the mean
(geometric, over the fields) of the factors that would mend each field's shares, ``ROUNDS`` times, never above the cell's
own records. Targets that agree are met; where targets of different fields contradict each other, this ends at the weights
with the least divergence from all of them, and ``report`` says by how much each is missed.

The priorities are never sorted as a whole. How many records of each cell lie below the cut follows from the cell counts on
the driver (at most ``MAX_CELLS`` cells, checked). Counts of hash bins then bound the last record of each cell, only records
up to it are ranked, and these in slices, so a cell with a third of all rows is spread over many tasks. Minima go the same
way: bin counts bound the ``min_rows``-th record of each category, and only records up to it are numbered.

Defined cases: records are distinct ids; rows without id are left out; an id with several values of a field counts for each
of them in ``available`` and is sampled under the first by name. Values are compared trimmed and without case; every
spelling of missing is the category ``NA``. Values that no target lists have target 0: records with one are drawn only if
they fill the minimum of another field's category. A category below its minimum gives all it has. If the records that fill minima exceed the sample, those of least
``(rank - 0.5) / min_rows`` are kept. Records are ordered by the md5 of seed and id. With no targets or no records the sample is empty.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusweave.functions.text import MISSING, fold, is_missing
from corpusweave.operators.ranking import rank_in_bins
from corpusweave.operators.sampling import SLICE_ROWS, _position, draw_order
from corpusweave.session import Stage

MAX_TARGETS = 2_000
MAX_CELLS = 200_000
OTHER = -1
ROUNDS = 200


def feasible(targets: dict[int, float], most: dict[int, float]) -> dict[int, float]:
    """Targets brought within ``most``, the excess handed to the others in proportion, as far as they can take it."""
    got, open_, left = dict.fromkeys(targets, 0.0), {c for c, t in targets.items() if t > 0}, sum(targets.values())
    while open_ and left > 1e-12:
        unit = left / sum(targets[c] for c in open_)
        full = {c for c in open_ if unit * targets[c] >= most.get(c, 0.0)}
        for c in full or open_:
            got[c] = most.get(c, 0.0) if full else unit * targets[c]
            left -= got[c]
        if not full:
            break
        open_ -= full
    return got


def rake(cells: list[tuple[int, ...]], counts: np.ndarray, targets: list[dict[int, float]], n: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the cells whose sums follow the targets of every field, none above the cell's own records."""
    most = counts / max(n, 1)
    w = counts / max(counts.sum(), 1)
    codes, goals = [], []
    for f, t in enumerate(targets):
        names, code = np.unique([c[f] for c in cells], return_inverse=True)
        have = np.bincount(code, weights=most)
        goal = feasible(t, {int(c): float(have[i]) for i, c in enumerate(names)})
        codes.append(code)
        goals.append(np.array([goal.get(int(c), 0.0) for c in names]))
        w = np.where(goals[-1][code] > 0, w, 0.0)
    for _ in range(rounds if len(targets) else 0):
        factor = np.ones(len(w))
        for code, goal in zip(codes, goals, strict=True):
            s = np.bincount(code, weights=w)
            factor *= np.divide(goal, s, out=np.zeros(len(s)), where=s > 0)[code]
        w = np.minimum(w * factor ** (1 / len(targets)), most)
    return np.round(w, 12)


def divisor_seats(counts: Sequence[int], weights: Sequence[float], floors: Sequence[int], n: int) -> list[int]:
    """Records of each cell among the ``n`` of smallest priority, the first ``floors`` of each cell before all others."""
    floors = [min(f, c) for f, c in zip(floors, counts, strict=True)]
    if sum(floors) >= n:  # the floors themselves by their own priorities
        heap = [((k + 0.5) / f, i) for i, f in enumerate(floors) for k in range(f)]
        seats = [0] * len(floors)
        for _, i in heapq.nsmallest(n, heap):
            seats[i] += 1
        return seats

    def at(cut: float) -> list[int]:
        return [max(f, min(c, math.floor(cut * w + 0.5))) for f, c, w in zip(floors, counts, weights, strict=True)]

    lo, hi = 0.0, 1.0
    reachable = sum(max(f, c if w > 0 else 0) for f, c, w in zip(floors, counts, weights, strict=True))
    if reachable <= n:
        return [max(f, c if w > 0 else 0) for f, c, w in zip(floors, counts, weights, strict=True)]
    while sum(at(hi)) <= n:
        lo, hi = hi, hi * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(at(mid)) <= n:
            lo = mid
        else:
            hi = mid
    seats = at(lo)
    heap = [((s + 0.5) / w, i) for i, (s, c, w) in enumerate(zip(seats, counts, weights, strict=True)) if w > 0 and s < c]
    heapq.heapify(heap)
    while sum(seats) < n and heap:
        _, i = heapq.heappop(heap)
        seats[i] += 1
        if seats[i] < counts[i]:
            heapq.heappush(heap, ((seats[i] + 0.5) / weights[i], i))
    return seats


class TargetSample:
    """The plan of a sample; ``sample`` and ``report`` give its parts."""

    def __init__(self, df: DataFrame, id_col: str, targets: DataFrame, fraction: float = 0.2, seed: int = 42, bin_rows: int = 16_384):
        self.spark = df.sparkSession
        rows = targets.select("field_name", "category", "target_permille", "min_rows").limit(MAX_TARGETS + 1).collect()
        if len(rows) > MAX_TARGETS:
            raise ValueError(f"more than {MAX_TARGETS} targets are listed")
        named = [(r.field_name, "NA" if (r.category or "").strip().lower() in MISSING else r.category.strip().upper(), r) for r in rows if r.field_name in df.columns]
        named = sorted({(f, k): r for f, k, r in reversed(named)}.items())  # codes go by name; a category listed twice counts once
        self.rows = [r for _, r in named]
        self.fields = sorted({f for (f, _), _ in named})
        self.codes: dict[str, dict[str, int]] = {f: {k: i for i, ((g, k), _) in enumerate(named) if g == f} for f in self.fields}
        k = len(self.fields)
        self.keys = [f"c{i}" for i in range(k)]
        ids = df.filter(~is_missing(F.col(id_col).cast("string")))
        ids = ids.groupBy(F.col(id_col).cast("string").alias("id")).agg(*(F.sort_array(F.collect_set(self._code(f))).alias(f"s{i}") for i, f in enumerate(self.fields))) if k else ids.select(F.col(id_col).cast("string").alias("id")).distinct()
        # an id's first listed category stands for it; -1 (unlisted) only if it has no other
        first = [F.coalesce(F.get(F.filter(f"s{i}", lambda x: x >= 0), F.lit(0)), F.lit(OTHER)).alias(f"c{i}") for i in range(k)]
        more = F.array_distinct(F.flatten(F.array(*(F.col(f"s{i}") for i in range(k))))) if k else F.array().cast("array<int>")
        self.ids = Stage(self.spark).put(ids.select("id", *first, more.alias("all"), draw_order(seed, "id").alias("h")).withColumn("u", _position("h")))
        self.total = self.ids.count()
        self.n = math.floor(self.total * fraction + 1e-9)
        self.bins = max(64, math.ceil(self.total / bin_rows))
        self.available = {r["code"]: r["count"] for r in self.ids.select(F.explode("all").alias("code")).groupBy("code").count().collect()}  # one row per target
        self._plan()

    def _code(self, name: str) -> Column:
        value = F.when(is_missing(F.col(name).cast("string")), F.lit("NA")).otherwise(fold(F.col(name).cast("string")))
        pairs = [x for k, v in self.codes[name].items() for x in (F.lit(k), F.lit(v))]
        return F.coalesce(F.element_at(F.create_map(*pairs), value), F.lit(OTHER))

    def _upto(self, rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
        """``key, upto``: a number in [0, 1] below which lie at least the ``wanted`` first rows of a key, and few more."""
        hist = rows.groupBy(key, F.least(F.floor(F.col("u") * self.bins), F.lit(self.bins - 1)).alias("bin")).agg(F.count("*").alias("m"))
        hist = hist.withColumn("cum", F.sum("m").over(W.partitionBy(key).orderBy("bin"))).join(F.broadcast(wanted), key)  # one row per key
        last = hist.groupBy(key).agg(F.min(F.when(F.col("cum") >= F.col("wanted"), F.col("bin"))).alias("bin"))
        return last.select(key, F.coalesce((F.col("bin") + 1) / F.lit(float(self.bins)), F.lit(1.0)).alias("upto"))

    def _plan(self) -> None:
        """Floor records, seats of the cells, and the seats of each field alone, from counts."""
        least = {c: max(self.rows[c].min_rows or 0, 0) for f in self.fields for c in self.codes[f].values()}
        # a floor record is among the first min_rows of one of its categories: below the hash of the last of them
        self.last: dict[int, str] = {c: "" for c in least}
        self.last.update({c: "g" for c, m in least.items() if m and self.available.get(c, 0) <= m})
        open_ = [(c, m) for c, m in least.items() if m and self.available.get(c, 0) > m]
        if open_:
            wanted = self.spark.createDataFrame(open_, "code int, wanted long")
            flat = self.ids.select("h", "u", F.explode("all").alias("code"))
            near = flat.join(F.broadcast(self._upto(flat, "code", wanted).join(wanted, "code")), "code").filter(F.col("u") <= F.col("upto"))
            ranked = near.withColumn("rank", F.row_number().over(W.partitionBy("code").orderBy("h"))).filter(F.col("rank") == F.col("wanted"))
            self.last.update({r["code"]: r["h"] for r in ranked.select("code", "h").collect()})  # one row per target
        self.edges = F.create_map(*(x for c, h in self.last.items() for x in (F.lit(c), F.lit(h)))) if self.last else None
        floor = F.exists("all", lambda c: F.coalesce(F.col("h") <= F.element_at(self.edges, c), F.lit(False))) if self.last else F.lit(False)
        self.marked = self.ids.withColumn("floor", floor)
        found = self.marked.groupBy(*self.keys).agg(F.count("*").alias("n"), F.count_if("floor").alias("f")).limit(MAX_CELLS + 1).collect() if self.fields else []
        if len(found) > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} combinations of categories")
        found = sorted(map(tuple, found))
        self.cells, counts, self.floors = [c[:-2] for c in found], [int(c[-2]) for c in found], [int(c[-1]) for c in found]
        goals = [{c: max(self.rows[c].target_permille or 0, 0) / 1000 for c in self.codes[f].values()} for f in self.fields]
        self.weights = [float(x) for x in rake(self.cells, np.array(counts, dtype=np.int64), goals, self.n)] if found else []
        self.crowded = sum(self.floors) > self.n
        self.seats = [] if not found else self.floors if self.crowded else divisor_seats(counts, self.weights, self.floors, self.n)
        # what each field could have without the others
        self.alone: dict[int, int] = {}
        for f, goal in zip(self.fields, goals, strict=True):
            cs = list(self.codes[f].values())
            self.alone.update(zip(cs, divisor_seats([self.available.get(c, 0) for c in cs], [goal[c] for c in cs], [0] * len(cs), self.n), strict=True))

    def sample(self) -> DataFrame:
        """``id``, the category of every field, ``floor, priority``: the records drawn."""
        names = [F.coalesce(F.element_at(F.create_map(*(x for c in self.codes[f].values() for x in (F.lit(c), F.lit(self.rows[c].category)))), F.col(k)), F.lit("-")).alias(f) for f, k in zip(self.fields, self.keys, strict=True)]
        if not self.fields or not self.total:
            return self.spark.createDataFrame([], ", ".join(["id string", *(f"`{f}` string" for f in self.fields), "floor boolean", "priority double"]))
        floors = self.marked.filter("floor")
        if self.crowded:  # at most the sum of all minima
            least = F.create_map(*(x for c in self.last for x in (F.lit(c), F.lit(max(self.rows[c].min_rows or 0, 1)))))
            own = floors.select("id", "h", F.explode("all").alias("code")).filter(F.col("h") <= F.element_at(self.edges, F.col("code")))
            own = own.withColumn("p", (F.row_number().over(W.partitionBy("code").orderBy("h")) - 0.5) / F.element_at(least, F.col("code"))).groupBy("id").agg(F.min("p").alias("p"))
            floors = floors.join(own, "id").orderBy("p", "h").limit(self.n).drop("p")
            rest = None
        else:
            plan = [(*c, i, int(s - f), int(f), float(w)) for i, (c, s, f, w) in enumerate(zip(self.cells, self.seats, self.floors, self.weights, strict=True)) if s > f]
            seats = self.spark.createDataFrame(plan, ", ".join(f"{k} int" for k in self.keys) + ", cell int, wanted long, before long, weight double")  # one row per cell
            rest = self.marked.filter(~F.col("floor")).join(F.broadcast(seats), self.keys)
            upto = self._upto(rest, "cell", seats.select("cell", "wanted"))
            near = rest.join(F.broadcast(upto), "cell").filter(F.col("u") <= F.col("upto"))
            rest = rank_in_bins(near, ["cell"], "u", ["h"], F.ceil((F.col("wanted") + SLICE_ROWS) / SLICE_ROWS / F.col("upto"))).filter(F.col("rank") <= F.col("wanted"))
            rest = rest.select("id", *names, F.lit(False).alias("floor"), ((F.col("rank") + F.col("before") - 0.5) / F.col("weight")).alias("priority"))
        floors = floors.select("id", *names, F.lit(True).alias("floor"), F.lit(0.0).alias("priority"))
        return floors if rest is None else floors.unionByName(rest)

    def report(self) -> DataFrame:
        """Per target: available, wanted and drawn records, and whether it is out of reach.

        ``drawn`` is counted from the sample. ``unmet``: the category's records were exhausted by the field's own seats
        before its target was reached, or are fewer than its minimum. ``missed``: the sample has fewer than both allow,
        because of the other fields' targets.
        """
        rows = []
        for f in self.fields:
            for key, c in self.codes[f].items():
                r, have = self.rows[c], self.available.get(c, 0)
                wanted, least = r.target_permille or 0, r.min_rows or 0
                unmet = (self.alone[c] == have and have * 1000 < wanted * self.n) or min(have, least) < least
                rows.append((f, r.category, r.category if r.category is not None else "-", wanted, least, have, wanted * self.n / 1000, bool(unmet)))
        plan = self.spark.createDataFrame(rows, "field_name string, category string, name string, target_permille int, min_rows int, available long, wanted double, unmet boolean")
        if not rows:
            return plan.drop("name").select("*", F.lit(0).cast("long").alias("drawn"), F.lit(0.0).alias("drawn_permille"), F.lit(False).alias("missed"))
        s = self.sample()
        pairs = F.inline(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("name")) for f in self.fields)))
        drawn = s.select(pairs).groupBy("field_name", "name").agg(F.count("*").alias("drawn"))  # one row per target
        out = plan.join(F.broadcast(drawn), ["field_name", "name"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)).cast("long"))
        fair = F.least(F.floor("wanted"), F.col("available"))
        return out.select("field_name", "category", "target_permille", "min_rows", "available", "wanted", "unmet", "drawn", (1000 * F.col("drawn") / F.lit(max(self.n, 1))).alias("drawn_permille"), (F.col("drawn") < F.greatest(fair, F.least("min_rows", "available"))).alias("missed"))
