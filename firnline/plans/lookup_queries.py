"""Lookups against rasters, catalogues, coefficient tables and polygons built from the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators import lookups as L
from firnline.plans.tables import load, rounded
from firnline.sources.records import add_regional, flatten_blocks, patch


def _raster(spark, sf_dir) -> DataFrame:
    """40 x 40 cells of mean event values, by day number modulo 3."""
    e = load(spark, sf_dir, "events").select("event_id", "value")
    return e.groupBy((F.col("event_id") % 40).cast("int").alias("ix"), (F.floor(F.col("event_id") / 40) % 40).cast("int").alias("iy")).agg(F.round(F.avg("value"), 6).alias("v"))


def _points(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", ((F.col("o_custkey") * 7) % 410 * 0.10371).alias("px"), ((F.col("o_orderkey") * 3) % 407 * 0.10371).alias("py"))


def raster_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.nearest_cell(_points(spark, sf_dir), _raster(spark, sf_dir), F.col("px"), F.col("py"), ["v"], outside=-1.0)
    return out.select("o_orderkey", "v")


def raster_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.bilinear(_points(spark, sf_dir), _raster(spark, sf_dir), F.col("px"), F.col("py"), "v", ["o_orderkey"])
    return rounded(out.select("o_orderkey", "v"))


def raster_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = L.cubic_lookup(_points(spark, sf_dir), _raster(spark, sf_dir), "px", "py", "v", ["o_orderkey"])
    return rounded(out.select("o_orderkey", "v"))


def raster_spline(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.range(1600).select((F.col("id") % 40).cast("int").alias("ix"), F.floor(F.col("id") / 40).cast("int").alias("iy"))
    whole = cells.join(_raster(spark, sf_dir), ["ix", "iy"], "left").fillna(0.0, ["v"])
    out = L.spline_lookup(_points(spark, sf_dir), whole, "px", "py", "v", ["o_orderkey"])
    return rounded(out.select("o_orderkey", "v"))


def closest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's nearest month chart; the catalogue is that of the months of all orders."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    charts = o.select(F.trunc("day", "month").alias("chart_day")).distinct()
    out = L.closest_date(o, "day", charts, "chart_day", 16)
    return out.select("o_orderkey", F.date_format("chart_day", "yyyy-MM-dd").alias("chart_day"))


def valid_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are charts, so intervals overlap and many start on one day."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    charts = o.select("day", F.date_add("day", 7).alias("until"), F.col("o_orderkey").alias("chart_id"))
    out = L.valid_interval(o, "day", charts, "day", "until", ["chart_id"], 8)
    return out.select("o_orderkey", "chart_id")


def latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return L.latest_per_key(o, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])


def interpolate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one type interpolated at the times of all others, by user."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    ref = e.filter("event_type = 'purchase'").groupBy("user_id", "t").agg(F.avg("value").alias("level"))
    out = L.interpolate_to(e.filter("event_type <> 'purchase'").select("event_id", "user_id", "t"), ref, ["user_id"], "t", "level")
    return rounded(out.select("event_id", "level"), 4)


def monthly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.range(1, 13).select(F.col("id").cast("int").alias("month"), (F.col("id") * 1.5).alias("c0"), (F.lit(20.0) - F.col("id")).alias("c1"))
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    out = L.monthly_coefficients(o, table, F.month("o_orderdate"))
    return rounded(out.select("o_orderkey", (F.col("c0") + F.col("c1") * F.col("o_totalprice") / 99991.0).alias("fit")))


def month_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high, weight = L.between_months(F.to_date("o_orderdate"))
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", F.date_format(low, "yyyy-MM-dd").alias("low"), F.date_format(high, "yyyy-MM-dd").alias("high"), F.round(weight, 6).alias("weight"))


def polygon_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the orders in one hexagon-like ring for each region."""
    regions = load(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("polygon_id"))
    x0, y0 = F.col("polygon_id") * 8.0, F.lit(5.0)
    ring = F.array(*[F.struct((x0 + dx).cast("double").alias("x"), (y0 + dy).alias("y")) for dx, dy in ((0.0, 0.0), (6.0, -4.0), (10.0, 2.0), (9.0, 20.0), (2.0, 17.0))])
    polygons = regions.select("polygon_id", ring.alias("ring"))
    out = L.polygon_lookup(_points(spark, sf_dir), polygons, "px", "py", ["o_orderkey"], 5.0)
    return out.select("o_orderkey", "polygon_id")


def edge_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _raster(spark, sf_dir).select(F.col("iy").alias("yj"), F.col("ix").alias("xi"), F.col("v").alias("sic"))
    out = L.edge_proximity(cells, "sic", 60.0, 12.5, 4)
    return rounded(out.select("yj", "xi", "distance"))


def risk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier").select("s_suppkey", F.array(*[(F.col("s_suppkey") % k).cast("int") for k in (3, 5, 7)]).alias("codes"), F.array(*[(F.col("s_suppkey") % k).cast("double") for k in (2, 3, 4)]).alias("conc"))
    out = L.risk_index(F.col("codes"), F.col("conc"), {0: 3, 1: 2, 2: 1, 3: 0, 4: -1, 5: -2, 6: -3}, 3)
    return s.select("s_suppkey", out.alias("rio"))


def patched_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sibling product is that of the order lines, for every order that has one."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("tide"), F.col("o_custkey").alias("other"))
    sibling = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("tide"))
    return rounded(add_regional(patch(o, sibling, ["o_orderkey"], ["tide"]), sibling, ["o_orderkey"], "tide"))


def flattened_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of the vectors, whole."""
    e = load(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))
    out = flatten_blocks(e, ["a", "b"], ["vec_id"])
    return out.select("vec_id", "record_idx", F.round(F.col("a").cast("double"), 6).alias("a"), F.round(F.col("b").cast("double"), 6).alias("b"))


QUERIES = {
    f.__name__: f
    for f in (
        raster_nearest, raster_bilinear, raster_cubic, raster_spline, closest_date, valid_interval, latest_per_customer, interpolate_series, monthly_table, month_weights,
        polygon_regions, edge_proximity, risk_index, patched_product, flattened_blocks,
    )
}

_RASTER = "raster as (select cast(event_id % 40 as integer) as ix, cast((event_id // 40) % 40 as integer) as iy, round(avg(value), 6) as v from events group by 1, 2)"
_POINTS = "points as (select o_orderkey, o_custkey * 7 % 410 * 0.10371::double as px, o_orderkey * 3 % 407 * 0.10371::double as py from orders)"
_W4 = lambda t: [f"(-0.5::double * {t}**3 + {t}**2 - 0.5::double * {t})", f"(1.5::double * {t}**3 - 2.5::double * {t}**2 + 1)", f"(-1.5::double * {t}**3 + 2 * {t}**2 + 0.5::double * {t})", f"(0.5::double * {t}**3 - 0.5::double * {t}**2)"]
_PICK = lambda c, t: f"case {c} " + " ".join(f"when {k - 1} then {w}" for k, w in enumerate(_W4(t))) + " end"
_EDGES = [(0.0, 0.0), (6.0, -4.0), (10.0, 2.0), (9.0, 20.0), (2.0, 17.0)]
_CROSS = " + ".join(
    f"(case when ({5 + y0} > py) <> ({5 + y1} > py) and px < r * 8.0 + {x0} + (py - {5 + y0}) * ({x1} - {x0})::double / ({y1} - {y0}) then 1 else 0 end)"
    for (x0, y0), (x1, y1) in zip(_EDGES, _EDGES[1:] + _EDGES[:1])
)
_H = "-6 * (sqrt(3.0::double) - 2) / (1 - (sqrt(3.0::double) - 2) ** 2) * (sqrt(3.0::double) - 2) ** abs(k)"
_MIRROR = lambda i: f"(39 - abs((({i}) + 78 * 10) % 78 - 39))"  # noqa: E731  cells 0 to 39, mirrored at both ends
_B4 = lambda t: [f"(1 - 3 * {t} + 3 * {t}**2 - {t}**3) / 6", f"(4 - 6 * {t}**2 + 3 * {t}**3) / 6", f"(1 + 3 * {t} + 3 * {t}**2 - 3 * {t}**3) / 6", f"({t}**3) / 6"]
_PICK_B = lambda c, t: f"case {c} " + " ".join(f"when {k - 1} then {w}" for k, w in enumerate(_B4(t))) + " end"

SQL = {
    "raster_spline": f"""
        with {_RASTER}, {_POINTS}, w as (select x as ix, y as iy, coalesce(v, 0) as v from range(40) a(x) cross join range(40) b(y) left join raster on ix = x and iy = y),
        a as (select q.ix, q.iy, sum(r.v * ({_H})) as v from w q, range(-40, 41) h(k), w r where r.iy = q.iy and r.ix = {_MIRROR('q.ix + k')} group by 1, 2),
        s as (select q.ix, q.iy, sum(r.v * ({_H})) as v from a q, range(-40, 41) h(k), a r where r.ix = q.ix and r.iy = {_MIRROR('q.iy + k')} group by 1, 2),
        c as (
            select o_orderkey, px <= 39 and py <= 39 as inside, {_MIRROR('floor(px) + i - 1')} as cx, {_MIRROR('floor(py) + j - 1')} as cy, ({_PICK_B('i - 1', '(px - floor(px))')}) * ({_PICK_B('j - 1', '(py - floor(py))')}) as w
            from points, range(4) x(i), range(4) y(j)
        ), t as (select o_orderkey, min(inside) as inside, sum(w * v) as v from c join s on ix = cx and iy = cy group by 1)
        select o_orderkey, round(case when inside then v end, 6) + 0.0 as v from t
    """,
    "raster_nearest": f"""
        with {_RASTER}, {_POINTS}
        select o_orderkey, coalesce(v, -1.0) as v from points left join raster on ix = floor(px + 0.5) and iy = floor(py + 0.5)
    """,
    "raster_bilinear": f"""
        with {_RASTER}, {_POINTS}, c as (
            select o_orderkey, floor(px) + i as cx, floor(py) + j as cy,
                   (case i when 1 then px - floor(px) else 1 - (px - floor(px)) end) * (case j when 1 then py - floor(py) else 1 - (py - floor(py)) end) as w
            from points, range(2) a(i), range(2) b(j)
        ), h as (select c.*, v from c left join raster on ix = cx and iy = cy where w > 0)
        select o_orderkey, round(case when count(v) = count(*) then sum(w * v) end, 6) + 0.0 as v from h group by 1
    """,
    "raster_cubic": f"""
        with {_RASTER}, {_POINTS}, c as (
            select o_orderkey, floor(px) + i - 1 as cx, floor(py) + j - 1 as cy, ({_PICK('i - 1', '(px - floor(px))')}) * ({_PICK('j - 1', '(py - floor(py))')}) as w
            from points, range(4) a(i), range(4) b(j)
        ), h as (select c.*, v from c left join raster on ix = cx and iy = cy)
        select o_orderkey, round(case when count(v) = 16 then sum(w * v) end, 6) + 0.0 as v from h group by 1
    """,
    "latest_per_customer": "select o_orderkey, o_custkey, o_orderdate from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1",
    "interpolate_series": """
        with e as (select event_id, user_id, event_type, value, epoch_us(ts) as t from events),
        r as (select user_id, t, avg(value) as y from e where event_type = 'purchase' group by 1, 2),
        p as (select event_id, user_id, t from e where event_type <> 'purchase'),
        l as (select p.event_id, max_by(r.t, r.t) as t0, max_by(r.y, r.t) as y0 from p join r on p.user_id = r.user_id and r.t <= p.t group by 1),
        h as (select p.event_id, min_by(r.t, r.t) as t1, min_by(r.y, r.t) as y1 from p join r on p.user_id = r.user_id and r.t >= p.t group by 1)
        select event_id, round(case when t0 is not null and t1 is not null then coalesce(y0 + (t - t0)::double / nullif(t1 - t0, 0) * (y1 - y0), y0) end, 4) + 0.0 as level
        from p left join l using (event_id) left join h using (event_id)
    """,
    "monthly_table": "select o_orderkey, round(month(o_orderdate) * 1.5 + (20.0 - month(o_orderdate)) * o_totalprice / 99991.0::double, 6) + 0.0 as fit from orders",
    "month_weights": """
        with d as (select o_orderkey, cast(o_orderdate as date) as d from orders),
        l as (select *, cast(case when day(d) >= 15 then make_date(year(d), month(d), 15) else make_date(year(d), month(d), 15) - interval 1 month end as date) as low from d)
        select o_orderkey, strftime(low, '%Y-%m-%d') as low, strftime(low + interval 1 month, '%Y-%m-%d') as high,
               round(date_diff('day', low, d)::double / date_diff('day', low, cast(low + interval 1 month as date)), 6) as weight from l
    """,
    "polygon_regions": f"""
        with {_POINTS}, h as (select o_orderkey, min(r) as polygon_id from points, (select cast(r_regionkey as bigint) as r from region) where ({_CROSS}) % 2 = 1 group by 1)
        select o_orderkey, polygon_id from points left join h using (o_orderkey)
    """,
    "edge_proximity": f"""
        with {_RASTER}, c as (select iy as yj, ix as xi, v >= 60 as ice from raster),
        e as (select distinct a.yj, a.xi from c a join c b on not a.ice and b.ice and abs(a.yj - b.yj) <= 1 and abs(a.xi - b.xi) <= 1),
        d as (select c.yj, c.xi, min((c.yj - e.yj) ** 2 + (c.xi - e.xi) ** 2) as d2 from c join e on c.ice group by 1, 2)
        select c.yj, c.xi, case when ice then round(sqrt(d2) * 12.5, 6) else 0.0 end::double + 0.0 as distance from c left join d using (yj, xi)
    """,
    "risk_index": """
        with s as (select s_suppkey, s_suppkey % 3 as a, s_suppkey % 5 as b, s_suppkey % 7 as c, s_suppkey % 2 as ca, s_suppkey % 3 as cb, s_suppkey % 4 as cc from supplier)
        select s_suppkey, cast((3 - a) * ca + (3 - b) * cb + (3 - c) * cc + (10 - ca - cb - cc) * 3 as double) as rio from s
    """,
    "closest_date": """
        with o as (select o_orderkey, cast(o_orderdate as date) as day from orders), c as (select distinct cast(date_trunc('month', day) as date) as chart from o),
        d as (select distinct day from o), m as (
            select day, min_by(chart, abs(date_diff('day', day, chart)) * 10 + case when chart > day then 1 else 0 end) as chart
            from d join c on abs(date_diff('day', day, chart)) <= 16 group by 1
        )
        select o_orderkey, strftime(chart, '%Y-%m-%d') as chart_day from o left join m using (day)
    """,
    "valid_interval": """
        with o as (select o_orderkey, cast(o_orderdate as date) as day from orders),
        c as (select day as start, min(o_orderkey) as chart_id from o group by 1),
        h as (select d.day, c.chart_id, c.start from (select distinct day from o) d join c on d.day between c.start and c.start + 7),
        m as (select day, chart_id from h qualify row_number() over (partition by day order by start, chart_id) = 1)
        select o_orderkey, chart_id from o left join m using (day)
    """,
    "patched_product": """
        with s as (select l_orderkey as o_orderkey, max(l_extendedprice) as price from lineitem group by 1)
        select o_orderkey, round(coalesce(price * 2, o_totalprice), 6) + 0.0 as tide, o_custkey as other from orders left join s using (o_orderkey)
    """,
    "flattened_blocks": """
        select vec_id, cast(i as integer) as record_idx, round(cast(embedding[i + 1] as double), 6) as a, round(cast(embedding[i + 33] as double), 6) as b from embeddings, range(32) r(i)
    """,
}
