"""Points near other points and points inside regions.

Both searches go through a *coverage*: the region (a polygon, or the disc of a given radius around a point) is covered by
grid cells, each marked interior (all of the cell lies in the region) or boundary. Points meet the cells in an equi-join.
A match with an interior cell is accepted at once; only matches with boundary cells get the exact test. Nothing is compared
outside a shared cell, so there is no cross join.

Defined cases: a point without identity, or whose position is missing, not a number, out of range or 0, 0, takes part in
nothing. Repeated rows count once. A ring with fewer than three corners, or with a NULL corner, contains nothing. Rings may
run in either direction, be closed or not, and cross the 180 degree meridian; a ring that winds around a pole contains that
pole. Other columns of the inputs are ignored, whatever their names. Empty inputs give an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusweave.functions.text import is_missing, strip
from corpusweave.session import Stage, cut_lineage

EARTH_KM = 6371.0088
#: Bits of the map of occupied cells; it is broadcast as at most a 64th as many rows.
_OCCUPIED = 1 << 25

_NUM = r"[+-]?\d+(?:\.\d+)?"
_ANG = r"\d+(?:\.\d+)?\s*°?|\d+,\d+\s*°?|\d+\s*[° ]\s*\d+(?:\.\d+)?\s*'|\d+\s*[° ]\s*\d+\s*[' ]\s*\d+(?:\.\d+)?\s*\"?"
_SEP = r"[\s,;/|]"
_LABELLED = rf"^\(?(LATITUDE|LAT|LONGITUDE|LONG|LON)\s*[:=]?\s*({_NUM})\s*°?[\s,;/|]+(LATITUDE|LAT|LONGITUDE|LONG|LON)\s*[:=]?\s*({_NUM})\s*°?\)?$"
_PAIR = rf"^(?![+-]?\d+,\d+$)\(?\s*({_NUM})\s*°?(?:\s*[,;/|]\s*|\s+)({_NUM})\s*°?\s*\)?$"
_COMMA = r"^\(?\s*([+-]?\d+,\d+)\s*°?(?:\s*[;/|]\s*|,?\s+)([+-]?\d+,\d+)\s*°?\s*\)?$"
_SUFFIX = rf"^\(?({_ANG})\s*([NSEW]){_SEP}*({_ANG})\s*([NSEW])\)?$"
_PREFIX = rf"^\(?([NSEW])\s*({_ANG}){_SEP}+([NSEW])\s*({_ANG})\)?$"


def with_position(df: DataFrame, raw: str) -> DataFrame:
    """Add ``_lat``, ``_lon``: what the text column ``raw`` names, or NULL unless it names one latitude and one longitude.

    Read are signed decimals with point or comma, degree signs, degrees-minutes-seconds, hemisphere letters before or after
    the angle and labels. The latitude comes first unless letters or labels say otherwise. One number, three bare numbers
    or two angles of the same kind name no position. A lone ``12,34`` is one number with a decimal comma. Minutes or seconds
    of 60 or more name no position. The steps are separate projections, so each text is matched once.
    """
    t = F.upper(strip(F.col(raw)))
    for a, b in (("−", "-"), ("º", "°"), ("’", "'"), ("′", "'"), ("”", '"'), ("″", '"')):
        t = F.replace(t, F.lit(a), F.lit(b))
    forms = {"pair": (_PAIR, 1, 0, 2, 0), "comma": (_COMMA, 1, 0, 2, 0), "suffix": (_SUFFIX, 1, 2, 3, 4), "prefix": (_PREFIX, 2, 1, 4, 3), "label": (_LABELLED, 2, 1, 4, 3)}
    out = df.withColumn("_t", t)
    which = F.lit(None).cast("string")
    for name, form in reversed(forms.items()):
        which = F.when(F.col("_t").rlike(form[0]), F.lit(name)).otherwise(which)
    out = out.withColumn("_form", which)
    for i, part in enumerate(("_a", "_la", "_b", "_lb")):
        e = F.lit(None).cast("string")
        for name, form in forms.items():
            e = F.when(F.col("_form") == name, F.regexp_extract("_t", form[0], form[i + 1]) if form[i + 1] else F.lit("")).otherwise(e)
        out = out.withColumn(part, e)
    for part, letter in (("_a", "_la"), ("_b", "_lb")):
        nums = F.transform(F.regexp_extract_all(part, F.lit(r"([+-]?\d+(?:[.,]\d+)?)"), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double"))
        out = out.withColumn(f"_n{part}", nums)
        d, m, s = (F.coalesce(F.get(f"_n{part}", F.lit(i)), F.lit(0.0)) for i in range(3))
        out = out.withColumn(f"_v{part}", F.when((m < 60) & (s < 60), (d + m / 60 + s / 3600) * F.when(F.col(letter).isin("S", "W"), -1).otherwise(1)))
    lon_a = F.col("_la").isin("E", "W") | F.col("_la").startswith("LO")
    lon_b = F.col("_lb").isin("E", "W") | F.col("_lb").startswith("LO")
    ok = F.col("_form").isin("pair", "comma") | (lon_a != lon_b)
    lat, lon = F.when(lon_a, F.col("_v_b")).otherwise(F.col("_v_a")), F.when(lon_a, F.col("_v_a")).otherwise(F.col("_v_b"))
    return out.select(*df.columns, F.when(ok, lat).alias("_lat"), F.when(ok, lon).alias("_lon"))


def place(df: DataFrame, id_col: str, lat: str, lon: str, raw: str | None = None) -> DataFrame:
    """Distinct ``(id, lat, lon)`` of the rows that have an identity and a valid position.

    The position is ``lat``, ``lon`` if both are filled (even if they turn out invalid), otherwise what ``raw`` says.
    """
    a, b = F.nanvl(F.col(lat).cast("double"), F.lit(None)), F.nanvl(F.col(lon).cast("double"), F.lit(None))
    text = F.col(raw).cast("string") if raw else F.lit(None).cast("string")
    src = df.select(F.col(id_col).cast("string").alias("id"), a.alias("x"), b.alias("y"), text.alias("raw")).filter(~is_missing(F.col("id")))
    filled = F.col("x").isNotNull() & F.col("y").isNotNull()
    out = with_position(src.withColumn("raw", F.when(~filled, F.col("raw"))), "raw")
    p = F.struct(F.when(filled, F.col("x")).otherwise(F.col("_lat")).alias("lat"), F.when(filled, F.col("y")).otherwise(F.col("_lon")).alias("lon"))
    good = lambda p: (F.abs(p["lat"]) <= 90) & (F.abs(p["lon"]) <= 180) & ~((p["lat"] == 0) & (p["lon"] == 0))
    # through an array, so that the test is not pushed below the parsing and evaluated there again
    return out.select("id", F.inline(F.filter(F.array(p), good))).distinct()


# ---------------------------------------------------------------- discs


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """sin^2 of half the angle between two points: grows with the distance, and needs no inverse function."""
    a, b = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    return a * a + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * b * b


class _Grid:
    """Bands of equal height, cut into columns so that no cell is longer than ``radius`` corner to corner."""

    def __init__(self, radius_km: float):
        self.r = radius_km
        self.edge = math.degrees(radius_km / EARTH_KM) * 0.999 / math.sqrt(2)
        self.reach = math.ceil(math.sqrt(2) / 0.999)
        self.bands = math.ceil(180 / self.edge)
        self.limit = math.sin(min(radius_km / EARTH_KM, math.pi) / 2) ** 2

    def band(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90) / self.edge), F.lit(self.bands - 1)).cast("long")

    def columns(self, band: Column) -> Column:
        lo = band * self.edge - 90
        hi = lo + self.edge
        nearest = F.when((lo <= 0) & (hi >= 0), F.lit(0.0)).otherwise(F.least(F.abs(lo), F.abs(hi)))
        return F.ceil(F.cos(F.radians(nearest)) * 360 / self.edge).cast("long")

    def key(self, band: Column, col: Column) -> Column:
        return band * F.lit(1 << 31) + col


def near_pairs(points: DataFrame, radius_km: float = 1.0, hot_rows: int = 4096) -> DataFrame:
    """``left_id < right_id`` for every two identities with positions at most ``radius_km`` apart, each pair once.

    Each point's disc is covered by its own cell and the later half of the neighbouring cells (the other half covers it in
    turn). Cells wholly inside the disc accept their points at once, the rest are tested exactly. A cell with more than
    ``hot_rows`` points is dealt out over as many salts as it needs: one side is split, the other repeated, so no task meets
    a whole hot cell. The table of hot cells is broadcast; it has at most 2000 rows whatever the input, because the
    threshold rises with the number of points. So is a bitmap of the cells that hold points, ``_OCCUPIED`` bits at any
    input, by which the empty cells of the coverage are dropped. Pairs are only made distinct where one of the two has
    several positions; the others meet in one cell alone.
    """
    g = _Grid(radius_km)
    # only identities with several positions can meet twice
    many = Stage(points.sparkSession).put(points.groupBy("id").count().filter("count > 1").select("id", F.lit(True).alias("many")))
    n_many = many.count()
    several = points.join(F.broadcast(many) if n_many <= 100_000 else many, "id", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    p = several.withColumn("band", g.band(F.col("lat"))).withColumn("n_cols", g.columns(F.col("band")))
    p = p.withColumn("cell", g.key(F.col("band"), F.least(F.floor((F.col("lon") + 180) / (360 / F.col("n_cols"))), F.col("n_cols") - 1).cast("long") % F.col("n_cols")))
    # 180 and -180 are the same meridian
    p = p.withColumn("cell", F.when(F.col("lon") == 180, g.key(F.col("band"), F.lit(0))).otherwise(F.col("cell"))).select("id", "lat", "lon", "many", "band", "cell")
    # bound: a cell counts as hot with more than n / 2000 points
    n = points.count()
    hot = p.groupBy("cell").count().filter(F.col("count") > max(hot_rows, n / 2000)).select("cell", F.ceil(F.col("count") / hot_rows).cast("int").alias("salts"))
    hot = F.broadcast(hot)

    lat, lon = F.col("lat"), F.col("lon")
    span = F.when(F.abs(lat) + math.degrees(g.r / EARTH_KM) >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(g.r / EARTH_KM)) / F.cos(F.radians(lat))))))
    probe = p.withColumn("b", F.explode(F.sequence(F.greatest(F.col("band") - g.reach, F.lit(0)), F.least(F.col("band") + g.reach, F.lit(g.bands - 1)))))
    probe = probe.withColumn("nc", g.columns(F.col("b"))).withColumn("w", 360 / F.col("nc")).withColumn("span", span)
    lo, hi = F.floor((lon - F.col("span") + 180) / F.col("w")), F.floor((lon + F.col("span") + 180) / F.col("w"))
    probe = probe.withColumn("c", F.explode(F.when(hi - lo + 1 >= F.col("nc"), F.sequence(F.lit(0).cast("long"), F.col("nc") - 1)).otherwise(F.sequence(lo, hi))))
    probe = probe.withColumn("to", g.key(F.col("b"), F.pmod(F.col("c"), F.col("nc")))).filter(F.col("to") >= F.col("cell"))
    # interior: the farthest corner is in the disc; along an edge the distance has no inner maximum
    left = (F.col("c") * F.col("w") - 180 - lon).cast("double")
    far = F.greatest(F.abs(left), F.abs(left + F.col("w")))
    bottom = F.col("b") * g.edge - 90
    inside = F.greatest(*(_half_chord(lat, F.lit(0.0), y, F.least(far, F.lit(180.0))) for y in (bottom, bottom + g.edge))) <= g.limit * (1 - 1e-6)
    probe = probe.select("id", "lat", "lon", "many", F.col("to").alias("cell"), (F.col("to") == F.col("cell")).alias("own"), inside.alias("interior"))
    # most cells around a point are empty: what no point lies in is dropped before the shuffle
    at = F.pmod(F.xxhash64("cell"), F.lit(_OCCUPIED)).cast("int")
    taken = p.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(cell), {_OCCUPIED}) as int) & 63)")).alias("bits"))
    probe = probe.withColumn("at", at).withColumn("word", F.shiftright("at", 6)).join(F.broadcast(taken), "word").filter(F.col("own") | (F.expr("shiftrightunsigned(bits, at & 63) & 1") == 1)).drop("at", "word", "bits")
    probe = probe.join(hot, "cell", "left").select("*", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).alias("salt")).drop("salts")
    home = p.select("cell", F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), F.col("many").alias("many2")).join(hot, "cell", "left")
    home = home.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))).drop("salts")
    pairs = probe.join(home, ["cell", "salt"]).filter(
        F.when(F.col("own"), F.col("id") < F.col("id2")).otherwise(F.col("id") != F.col("id2"))
        & (F.col("own") | F.col("interior") | (_half_chord(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= g.limit))
    )
    pairs = pairs.select(F.least("id", "id2").alias("left_id"), F.greatest("id", "id2").alias("right_id"), (F.col("many") | F.col("many2")).alias("many"))
    if not n_many:
        return pairs.select("left_id", "right_id")
    pairs = Stage(points.sparkSession).put(pairs)
    return pairs.filter(~F.col("many")).select("left_id", "right_id").unionByName(pairs.filter("many").select("left_id", "right_id").distinct())


# ---------------------------------------------------------------- polygons

_LEVEL0, _KEY = 3, 25


def unwrap_ring(ring_lat, ring_lon) -> np.ndarray | None:
    """Corners as an (n, 2) array of longitude, latitude with every side taking the short way round; None if unusable."""
    if ring_lat is None or ring_lon is None or len(ring_lat) != len(ring_lon):
        return None
    y, x = np.asarray(ring_lat, float), np.asarray(ring_lon, float)
    if np.isnan(y).any() or np.isnan(x).any():
        return None
    if len(y) > 1 and y[0] == y[-1] and (x[0] - x[-1]) % 360 == 0:
        y, x = y[:-1], x[:-1]
    if len(y) < 3:
        return None
    step = (np.diff(np.append(x, x[0])) + 180) % 360 - 180
    x = x[0] + np.concatenate([[0.0], np.cumsum(step)])
    if abs(x[-1] - x[0]) > 180:  # around a pole: close the ring along it
        pole = 90.0 if y.mean() >= 0 else -90.0
        return np.column_stack([np.append(x, [x[-1], x[0]]), np.append(y, [y[0], pole, pole])])
    return np.column_stack([x[:-1], y])


def _inside(ring: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    (x1, y1), (x2, y2) = ring.T[:, None, :], np.roll(ring, -1, axis=0).T[:, None, :]
    x, y = x[:, None], y[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        hit = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return hit.sum(axis=1) % 2 == 1


def cover_ring(ring: np.ndarray, max_cells: int = 256, max_level: int = 12) -> list[tuple[int, int, bool]]:
    """``(level, cell key, interior)`` of a polygon; cells on the boundary are split while ``max_cells`` allows.

    At level l a cell measures 360 / 2**l degrees; keys count rows from the south pole and columns from -180, taken modulo
    the number of columns.
    """

    def kinds(cells: np.ndarray, size: float) -> np.ndarray:
        cx, cy = -180 + (cells[:, 1] + 0.5) * size, -90 + (cells[:, 0] + 0.5) * size
        p, q = ring, np.roll(ring, -1, axis=0)
        d, mid, h = (q - p) / 2, (p + q) / 2, size / 2 + 1e-9
        mx, my = mid[None, :, 0] - cx[:, None], mid[None, :, 1] - cy[:, None]
        dx, dy = np.abs(d[None, :, 0]), np.abs(d[None, :, 1])
        cross = (np.abs(mx) <= h + dx) & (np.abs(my) <= h + dy) & (np.abs(mx * d[None, :, 1] - my * d[None, :, 0]) <= h * (dx + dy) + 1e-12)
        return np.where(cross.any(axis=1), 1, np.where(_inside(ring, cx, cy), 2, 0))

    level, size = _LEVEL0, 360 / (1 << _LEVEL0)
    lo, hi = np.floor((ring.min(axis=0) + [180, 90]) / size).astype(int), np.floor((ring.max(axis=0) + [180, 90]) / size).astype(int)
    cells = np.array([(r, c) for r in range(lo[1], hi[1] + 1) for c in range(lo[0], hi[0] + 1)])
    done: list[tuple[int, int, bool]] = []

    def keep(rows: np.ndarray, interior: bool) -> None:
        done.extend((level, (level << 2 * _KEY) + (int(r) << _KEY) + int(c) % (1 << level), interior) for r, c in rows)

    while True:
        kind = kinds(cells, size)
        keep(cells[kind == 2], True)
        edge = cells[kind == 1]
        finer = (edge[:, None, :] * 2 + np.array([(0, 0), (0, 1), (1, 0), (1, 1)])[None]).reshape(-1, 2)
        if level == max_level or len(edge) == 0 or len(done) + len(finer) > max(max_cells, 4):
            keep(edge, False)
            return sorted(set(done))
        cells, level, size = finer, level + 1, size / 2


def cover_regions(regions: DataFrame, id_col: str, ring_lat: str, ring_lon: str, max_cells: int = 256, max_level: int = 12) -> DataFrame:
    """``region, level, cell, interior`` for every region; the sides stay in ``ring_sides``, however many a ring has."""

    def run(batches):
        for b in batches:
            rows = []
            for rid, la, lo in zip(b["region"], b["la"], b["lo"], strict=True):
                ring = unwrap_ring(la, lo)
                if rid is not None and ring is not None:
                    rows.extend((rid, lv, cell, inner) for lv, cell, inner in cover_ring(ring, max_cells, max_level))
            yield pd.DataFrame(rows, columns=["region", "level", "cell", "interior"])

    src = regions.select(F.col(id_col).cast("string").alias("region"), F.col(ring_lat).alias("la"), F.col(ring_lon).alias("lo"))
    return src.mapInPandas(run, "region string, level int, cell long, interior boolean")


def ring_sides(regions: DataFrame, id_col: str, ring_lat: str, ring_lon: str) -> DataFrame:
    """``region, edges, x0``: the sides of every ring, and its westernmost longitude; several rings of one id stay apart."""

    def run(batches):
        for b in batches:
            rows = []
            for rid, la, lo in zip(b["region"], b["la"], b["lo"], strict=True):
                ring = unwrap_ring(la, lo)
                if rid is not None and ring is not None:
                    nxt = np.roll(ring, -1, axis=0)
                    rows.append((rid, [{"y1": a[1], "x1": a[0], "y2": z[1], "x2": z[0]} for a, z in zip(ring.tolist(), nxt.tolist(), strict=True)], float(ring[:, 0].min())))
            yield pd.DataFrame(rows, columns=["region", "edges", "x0"])

    src = regions.select(F.col(id_col).cast("string").alias("region"), F.col(ring_lat).alias("la"), F.col(ring_lon).alias("lo"))
    return src.mapInPandas(run, "region string, edges array<struct<y1:double,x1:double,y2:double,x2:double>>, x0 double")


def inside_regions(points: DataFrame, regions: DataFrame, id_col: str, ring_lat: str, ring_lon: str, max_cells: int = 256, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``id, region`` for every point and every region that contains it, each pair once.

    The coverage and the sides are written out once. Each is broadcast if its rows take at most ``broadcast_bytes`` in memory
    (worked out from counts, not guessed): a cell takes 64 bytes and its name, a side 32. Otherwise points and cells are
    shuffled by cell, and boundary matches and sides by region; hot keys then fall to the adaptive skew split, which is exact.
    """
    stage = Stage(points.sparkSession)
    numbered = regions.select(F.monotonically_increasing_id().cast("string").alias("ring"), F.col(id_col).cast("string").alias("name"), F.col(ring_lat).alias("la"), F.col(ring_lon).alias("lo")).filter(F.col("name").isNotNull())
    numbered = Stage(points.sparkSession).put(numbered)  # rings are told apart by number, names are looked up at the end
    cover = stage.put(cover_regions(numbered, "ring", "la", "lo", max_cells))
    sides = stage.put(ring_sides(numbered, "ring", "la", "lo"))
    levels = [r[0] for r in cover.select("level").distinct().collect()]  # at most max_level - 2 numbers
    if not levels:
        return points.select("id", F.lit(None).cast("string").alias("region")).limit(0)

    def cell(level: int) -> Column:
        size = 360 / (1 << level)
        row = F.floor((F.col("lat") + 90) / size).cast("long")
        col = F.pmod(F.floor((F.col("lon") + 180) / size).cast("long"), F.lit(1 << level))
        return F.lit(level << 2 * _KEY) + row * F.lit(1 << _KEY) + col

    def weight(df: DataFrame, size: Column) -> int:
        return df.agg(F.sum(size)).head()[0] or 0

    def small(df: DataFrame, size: Column) -> DataFrame:
        return F.broadcast(df) if weight(df, size) <= broadcast_bytes else df

    per_ring = 64 + 32 * F.size("edges")
    p = points.select("id", "lat", "lon", F.explode(F.array(*(cell(lv) for lv in levels))).alias("cell"))
    hits = p.join(small(cover.drop("level"), F.lit(96)), "cell")
    names = small(numbered.select(F.col("ring").alias("region"), "name"), 64 + F.octet_length("name"))
    x = F.col("lon") + 360 * F.ceil((F.col("x0") - F.col("lon")) / 360)
    y = F.col("lat")
    crossings = F.aggregate(
        "edges",
        F.lit(0),
        lambda n, e: n + F.when((e["y1"] > y) != (e["y2"] > y), F.when(x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"], 1).otherwise(0)).otherwise(0),
    )
    if weight(sides, per_ring) <= broadcast_bytes:
        found = hits.join(F.broadcast(sides), "region").filter(F.col("interior") | (crossings % 2 == 1)).select("id", "region")
    else:
        edge = hits.filter(~F.col("interior")).join(sides, "region").filter(crossings % 2 == 1)
        found = hits.filter("interior").select("id", "region").unionByName(edge.select("id", "region"))
    return found.join(names, "region").select("id", F.col("name").alias("region")).distinct()
