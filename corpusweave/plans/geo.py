"""Queries of problem 1: samples near other samples and inside areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusweave.operators.geo import inside_regions, near_pairs, place
from corpusweave.session import cut_lineage, read_table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """Samples within one kilometre of each other, and the areas that contain a sample."""
    pts = cut_lineage(place(read_table(spark, sf, "gg2_full_qc_with_meta"), "MA_Sample_ID", "Latitude", "Longitude", "MA_Geo_Raw"))
    near = near_pairs(pts, 1.0).select(F.lit("near").alias("kind"), "left_id", "right_id")
    inside = inside_regions(pts, read_table(spark, sf, "geo_areas"), "area_id", "ring_lat", "ring_lon")
    return near.unionByName(inside.select(F.lit("inside").alias("kind"), F.col("id").alias("left_id"), F.col("region").alias("right_id")))


_NUM = r"[+-]?[0-9]+(?:\.[0-9]+)?"
_ANG = r"[0-9]+(?:\.[0-9]+)?\s*°?|[0-9]+,[0-9]+\s*°?|[0-9]+\s*[° ]\s*[0-9]+(?:\.[0-9]+)?\s*''|[0-9]+\s*[° ]\s*[0-9]+\s*['' ]\s*[0-9]+(?:\.[0-9]+)?\s*\"?"
_LAB = r"(LATITUDE|LAT|LONGITUDE|LONG|LON)\s*[:=]?\s*"
#: Form, pattern, and the groups of the first angle, its mark, the second angle and its mark (0: none).
_FORMS = (
    ("pair", rf"^\(?\s*({_NUM})\s*°?(?:\s*[,;/|]\s*|\s+)({_NUM})\s*°?\s*\)?$", 1, 0, 2, 0),
    ("comma", r"^\(?\s*([+-]?[0-9]+,[0-9]+)\s*°?(?:\s*[;/|]\s*|,?\s+)([+-]?[0-9]+,[0-9]+)\s*°?\s*\)?$", 1, 0, 2, 0),
    ("suffix", rf"^\(?({_ANG})\s*([NSEW])[\s,;/|]*({_ANG})\s*([NSEW])\)?$", 1, 2, 3, 4),
    ("prefix", rf"^\(?([NSEW])\s*({_ANG})[\s,;/|]+([NSEW])\s*({_ANG})\)?$", 2, 1, 4, 3),
    ("label", rf"^\(?{_LAB}({_NUM})\s*°?[\s,;/|]+{_LAB}({_NUM})\s*°?\)?$", 2, 1, 4, 3),
)


def _position_sql() -> str:
    """Positions of the samples; a lone ``12,34`` is no pair, which the first condition states."""
    match = " ".join(f"when regexp_matches(t, '{f[1]}')" + (" and not regexp_matches(t, '^[+-]?[0-9]+,[0-9]+$')" if f[0] == "pair" else "") + f" then '{f[0]}'" for f in _FORMS)
    part = lambda k: "case form " + " ".join(f"when '{f[0]}' then " + (f"regexp_extract(t, '{f[1]}', {f[k]})" if f[k] else "''") for f in _FORMS) + " end"
    value = lambda a, m: f"case when coalesce({a}[2], 0) < 60 and coalesce({a}[3], 0) < 60 then (coalesce({a}[1], 0) + coalesce({a}[2], 0) / 60 + coalesce({a}[3], 0) / 3600) * case when {m} in ('S', 'W') then -1 else 1 end end"
    nums = lambda a: f"list_transform(regexp_extract_all({a}, '[+-]?[0-9]+(?:[.,][0-9]+)?'), lambda x: cast(replace(x, ',', '.') as double))"
    return f"""
g as (select MA_Sample_ID as id, Latitude as x, Longitude as y, case when Latitude is null or Longitude is null then upper(trim(MA_Geo_Raw)) end as t from gg2_full_qc_with_meta where trim(coalesce(MA_Sample_ID, '')) <> ''),
m as (select *, case {match} end as form from g),
a as (select *, {part(2)} as a, {part(3)} as la, {part(4)} as b, {part(5)} as lb from m),
v as (select *, {nums("a")} as na, {nums("b")} as nb, la in ('E', 'W') or starts_with(la, 'LO') as lon_a, lb in ('E', 'W') or starts_with(lb, 'LO') as lon_b from a),
w as (select *, {value("na", "la")} as va, {value("nb", "lb")} as vb from v),
z as (select id, case when x is not null and y is not null then x when form in ('pair', 'comma') or lon_a <> lon_b then case when lon_a then vb else va end end as lat,
 case when x is not null and y is not null then y when form in ('pair', 'comma') or lon_a <> lon_b then case when lon_a then va else vb end end as lon from w),
pts as (select distinct id, lat, lon from z where abs(lat) <= 90 and abs(lon) <= 180 and not (lat = 0 and lon = 0))"""


SQL = {
    "p1_found": f"""with {_position_sql()},
near as (select distinct least(p.id, q.id) as l, greatest(p.id, q.id) as r from pts p join pts q on p.id < q.id and q.lat between p.lat - 0.00901 and p.lat + 0.00901
 where 2 * 6371.0088 * asin(least(1, sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) <= 1),
c as (select area_id, unnest(ring_lat) as y, unnest(ring_lon) as x, generate_subscripts(ring_lat, 1) as i from geo_areas),
d as (select *, coalesce(lead(y) over w, first_value(y) over w) as y2, coalesce(lead(x) over w, first_value(x) over w) as x2 from c window w as (partition by area_id order by i)),
e as (select *, ((x2 - x + 180) % 360 + 360) % 360 - 180 as dx from d),
s as (select area_id, y as y1, y2, first_value(x) over v + coalesce(sum(dx) over (v rows between unbounded preceding and 1 preceding), 0) as x1, dx from e window v as (partition by area_id order by i)),
h as (select id, area_id, k from pts cross join (select unnest([-360, 0, 360]) as k) join s on (y1 > lat) <> (y2 > lat) and lon + k < dx * (lat - y1) / (y2 - y1) + x1 group by id, lat, lon, area_id, k having count(*) % 2 = 1)
select 'near' as kind, l as left_id, r as right_id from near union all select distinct 'inside', id, area_id from h"""
}
QUERIES = {"p1_found": p1_found}
