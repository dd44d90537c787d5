"""Lookups against side tables: nearest and interpolated raster cells, as-of and closest dates, validity intervals,
monthly coefficients, polygons. Side tables are broadcast only after their size has been checked."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BROADCAST_BYTES = 48 << 20
_WIDTH = {"long": 8, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4, "date": 4, "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1}


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most so many bytes, by its rows (the count stops at the bound) and their fixed
    width; tables with strings or nested columns count 64 bytes for each of these."""
    rows = most // max(1, sum(_WIDTH.get(kind, 64) for _, kind in df.dtypes))
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _is_broadcast(df: DataFrame) -> bool:
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def segment_day(df: DataFrame, segment: Sequence[str], time: str, out: str = "segment_day") -> DataFrame:
    """The day of the segment's first record: the key of day-wise side tables."""
    return df.withColumn(out, F.to_date(F.min(time).over(W.partitionBy(*segment))))


def nearest_cell(df: DataFrame, raster: DataFrame, ix: Column, iy: Column, values: Sequence[str], keys: Sequence[str] = (), outside=None) -> DataFrame:
    """The raster's values at the rounded fractional indices; keys (a day) join as they are. Outside: NULL or the
    given value."""
    right = raster.select(*keys, F.col("ix").alias("__ix"), F.col("iy").alias("__iy"), *[F.col(v).alias(f"__{v}") for v in values])
    base = df.withColumns({"__ix": F.floor(ix + 0.5).cast("int"), "__iy": F.floor(iy + 0.5).cast("int")})
    out = base.join(small(right), [*keys, "__ix", "__iy"], "left")
    get = lambda v: F.col(f"__{v}") if outside is None else F.coalesce(F.col(f"__{v}"), F.lit(outside))
    return out.select(*df.columns, *[get(v).alias(v) for v in values])


def bilinear(df: DataFrame, raster: DataFrame, ix: Column, iy: Column, value: str, row_key: Sequence[str], keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Bilinear interpolation; rows with a missing corner (of a weight above 0) are NULL. A small raster is looked up four
    times by map joins, so that no row moves; beyond it each row meets its four cells in one equi-join and sums weighted
    values."""
    out = out or value
    fx, fy = F.floor(ix), F.floor(iy)
    cells = small(raster.select(*keys, "ix", "iy", F.col(value).alias("__v")))
    if _is_broadcast(cells):
        plain = raster.select(*keys, "ix", "iy", F.col(value).cast("double").alias("__v"))
        base = df.withColumns({"__fx": fx.cast("int"), "__fy": fy.cast("int"), "__px": ix - fx, "__py": iy - fy})
        total = F.lit(0.0)
        for i in (0, 1):
            for j in (0, 1):
                corner = plain.select(*[F.col(k).alias(f"__k_{k}") for k in keys], (F.col("ix") - i).alias("__cx"), (F.col("iy") - j).alias("__cy"), F.col("__v").alias(f"__v{i}{j}"))
                meets = (F.col("__fx") == F.col("__cx")) & (F.col("__fy") == F.col("__cy"))
                for k in keys:
                    meets &= F.col(k) == F.col(f"__k_{k}")
                base = base.join(F.broadcast(corner), meets, "left").drop("__cx", "__cy", *[f"__k_{k}" for k in keys])
                w = (F.col("__px") if i else 1 - F.col("__px")) * (F.col("__py") if j else 1 - F.col("__py"))
                total = total + F.when(w > 0, w * F.col(f"__v{i}{j}")).when(w == 0, F.lit(0.0))
        return base.withColumn("__out", total).select(*[c for c in df.columns if c != out], F.col("__out").alias(out))
    corners = F.array(*[
        F.struct((fx + i).cast("int").alias("ix"), (fy + j).cast("int").alias("iy"),
                 (((ix - fx) if i else (1 - (ix - fx))) * ((iy - fy) if j else (1 - (iy - fy)))).alias("w"))
        for i in (0, 1) for j in (0, 1)
    ])
    points = df.select(*row_key, *keys, F.explode(corners).alias("c")).select(*row_key, *keys, "c.*").filter("w > 0")
    right = raster.select(*keys, "ix", "iy", F.col(value).alias("__v"))
    hits = points.join(small(right), [*keys, "ix", "iy"], "left").groupBy(*row_key).agg(
        F.when(F.count("__v") == F.count(F.lit(1)), F.sum(F.col("w") * F.col("__v"))).alias(out)
    )
    return df.join(hits, list(row_key), "left")


def closest_date(df: DataFrame, day: str, catalogue: DataFrame, cat_day: str, most: int, prefer: str = "before", keep: Sequence[str] = ()) -> DataFrame:
    """The catalogue entry with the smallest day difference up to `most`; of two equally near the one before (or
    after). Distinct days meet the catalogue within their window of days, by an equi-join on day buckets."""
    width = most + 1
    bucket = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width)
    days = df.select(day).distinct().filter(F.col(day).isNotNull())
    days = days.withColumn("__b", F.explode(F.array(bucket(day) - 1, bucket(day), bucket(day) + 1)))
    entries = catalogue.select(F.col(cat_day).alias("__d"), *[F.col(k) for k in keep]).withColumn("__b", bucket("__d"))
    diff = F.datediff(F.col("__d"), F.col(day))
    pairs = days.join(entries, "__b").withColumn("__diff", diff).filter(F.abs("__diff") <= most)
    order = F.struct(F.abs("__diff"), (F.col("__diff") if prefer == "before" else -F.col("__diff")), *[F.col(k) for k in keep])
    best = pairs.groupBy(day).agg(F.min_by(F.struct("__d", *keep), order).alias("__m"))
    best = best.select(day, F.col("__m.__d").alias(cat_day), *[F.col(f"__m.{k}").alias(k) for k in keep])
    return df.join(best, day, "left")


def valid_interval(df: DataFrame, day: str, catalogue: DataFrame, start: str, stop: str, values: Sequence[str], span_days: int) -> DataFrame:
    """The first entry (by start) whose closed interval holds the day. Intervals of at most span_days are sent to every
    day bucket they touch, so the range condition rides on an equi-join."""
    bucket = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / span_days)
    entries = catalogue.select(F.col(start).alias("__start"), F.col(stop).alias("__stop"), *values)
    entries = entries.withColumn("__b", F.explode(F.sequence(bucket(F.col("__start")), bucket(F.col("__stop")))))
    days = df.select(day).distinct().withColumn("__b", bucket(F.col(day)))
    hit = days.join(entries, "__b").filter(F.col(day).between(F.col("__start"), F.col("__stop")))
    best = hit.groupBy(day).agg(F.min_by(F.struct(*values), F.struct("__start", "__stop", *values)).alias("__m"))
    return df.join(best.select(day, *[F.col(f"__m.{v}").alias(v) for v in values]), day, "left")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first by the order."""
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def interpolate_to(df: DataFrame, reference: DataFrame, key: Sequence[str], x: str, value: str, out: str | None = None, outside: str = "null") -> DataFrame:
    """Linear interpolation of a coarser reference series at the rows' x (1 Hz fields at 20 Hz records): both series in
    one window, so each key is sorted once. outside: "null" or "extrapolate" by the outer two reference points."""
    out = out or value
    union = df.withColumns({"__ref": F.lit(False), "__y": F.lit(None).cast("double")}).unionByName(
        reference.filter(F.col(value).isNotNull()).select(*key, x, F.lit(True).alias("__ref"), F.col(value).cast("double").alias("__y")), allowMissingColumns=True
    )
    w = W.partitionBy(*key).orderBy(F.col(x), F.col("__ref").desc())
    before, after = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    point = F.when(F.col("__ref"), F.struct(F.col(x).cast("double").alias("x"), F.col("__y").alias("y")))
    union = union.withColumn("__p", point)
    base = union.withColumns({"__l": F.last("__p", ignorenulls=True).over(before), "__r": F.first("__p", ignorenulls=True).over(after)})
    at = F.col(x).cast("double")
    line = lambda a, b: F.coalesce(a["y"] + F.try_divide(at - a["x"], b["x"] - a["x"]) * (b["y"] - a["y"]), a["y"])
    value_at = F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), line(F.col("__l"), F.col("__r")))
    if outside == "extrapolate":
        ends = reference.filter(F.col(value).isNotNull()).select(*key, F.struct(F.col(x).cast("double").alias("x"), F.col(value).cast("double").alias("y")).alias("p"))
        rank = lambda order: F.row_number().over(W.partitionBy(*key).orderBy(order))
        ends = ends.withColumns({"a": rank(F.col("p.x").asc()), "z": rank(F.col("p.x").desc())}).filter("a <= 2 or z <= 2")
        pick = lambda c, k: F.max(F.when(F.col(c) == k, F.col("p")))
        ends = ends.groupBy(*key).agg(pick("a", 1).alias("__a1"), pick("a", 2).alias("__a2"), pick("z", 1).alias("__z1"), pick("z", 2).alias("__z2"))
        base = base.join(ends, list(key), "left")
        low = F.coalesce(line(F.col("__a1"), F.col("__a2")), F.col("__a1")["y"])
        high = F.coalesce(line(F.col("__z2"), F.col("__z1")), F.col("__z1")["y"])
        value_at = F.coalesce(value_at, F.when(F.col("__l").isNull(), low).otherwise(high))
    return base.filter(~F.col("__ref")).select(*df.columns, value_at.alias(out))


def monthly_coefficients(df: DataFrame, table: DataFrame, month: Column, key: str = "month") -> DataFrame:
    """The coefficient table joined by month; a month that it holds twice is an error."""
    twice = table.groupBy(key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"month {twice[0][key]} has several rows of coefficients")
    return df.withColumn(key, month.cast("int")).join(small(table), key, "left")


def between_months(day: Column, reference_day: int = 15) -> tuple[Column, Column, Column]:
    """(earlier reference date, later one, weight of the later): daily values between monthly fields."""
    this = F.make_date(F.year(day), F.month(day), F.lit(reference_day))
    low = F.when(day >= this, this).otherwise(F.add_months(this, -1))
    high = F.add_months(low, 1)
    return low, high, F.datediff(day, low) / F.datediff(high, low)


def code_value(code: Column, values: Sequence[float | None]) -> Column:
    """values[code], NULL beyond the table."""
    return F.get(F.array(*[F.lit(v).cast("double") for v in values]), code.cast("int"))


def risk_index(codes: Column, concentrations: Column, table: dict[int, float], open_water: float) -> Column:
    """Sum over the ice classes of risk value times concentration (tenths), the rest is open water."""
    pairs = F.map_from_arrays(F.array(*[F.lit(int(k)) for k in table]), F.array(*[F.lit(float(v)) for v in table.values()]))
    part = F.zip_with(codes, concentrations, lambda k, c: F.coalesce(F.element_at(pairs, k.cast("int")), F.lit(0.0)) * F.coalesce(c, F.lit(0.0)))
    covered = F.aggregate(concentrations, F.lit(0.0), lambda a, c: a + F.coalesce(c, F.lit(0.0)))
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) + (F.lit(10.0) - covered) * F.lit(float(open_water))


def edge_proximity(cells: DataFrame, sic: str, ice: float, dx: float, reach: int, key: Sequence[str] = ()) -> DataFrame:
    """Distance of each ice cell to the nearest open cell that touches ice, however far; 0 for all other cells, NULL for
    ice where no open cell of the key touches any. Edge cells are sent to tiles of `reach` cells and their
    neighbours, so each ice cell meets nearby edges only; a distance up to `reach` is exact, and cells without one are
    searched again with twice the reach until it spans the grid. The grid's extent is read when the plan is made."""
    base = cells.select(*key, "yj", "xi", (F.col(sic) >= ice).alias("ice")).filter("ice is not null")
    step = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    ring = base.filter("ice").select(*key, step.alias("dy"), "yj", "xi").select(*key, step.alias("dx"), "dy", "yj", "xi")
    ring = ring.select(*key, (F.col("yj") + F.col("dy")).alias("yj"), (F.col("xi") + F.col("dx")).alias("xi")).distinct()
    edges = base.filter("not ice").join(ring, [*key, "yj", "xi"], "left_semi")
    low_high = [f(c) for c in ("yj", "xi") for f in (F.min, F.max)]
    y0, y1, x0, x1 = (v or 0 for v in base.agg(*low_high).first())
    d2 = F.pow(F.col("yj") - F.col("ey"), 2) + F.pow(F.col("xi") - F.col("ex"), 2)
    near = base.filter("ice").select(*key, "yj", "xi", F.lit(None).cast("double").alias("d2"))
    while True:
        tile = lambda c, reach=reach: F.floor(F.col(c) / reach).cast("int")
        around = edges.select(*[F.col(k).alias(f"__{k}") for k in key], F.col("yj").alias("ey"), F.col("xi").alias("ex"))
        around = around.select("*", step.alias("ty")).withColumn("ty", tile("ey") + F.col("ty"))
        around = around.select("*", step.alias("tx")).withColumn("tx", tile("ex") + F.col("tx"))
        mine = near.withColumns({"my": tile("yj"), "mx": tile("xi")})
        meets = F.col("d2").isNull() & (F.col("my") == F.col("ty")) & (F.col("mx") == F.col("tx"))
        for k in key:
            meets &= F.col(k) == F.col(f"__{k}")
        found = F.min(F.when(d2 <= float(reach) ** 2, d2))
        near = mine.join(around, meets, "left").groupBy(*key, "yj", "xi").agg(F.coalesce(F.max("d2"), found).alias("d2"))
        if reach**2 >= (y1 - y0) ** 2 + (x1 - x0) ** 2:
            break
        reach *= 2
    near = near.select(*key, "yj", "xi", (F.sqrt("d2") * dx).alias("distance"))
    away = F.when(F.col(sic) >= ice, F.col("distance")).otherwise(0.0)
    return cells.join(near, [*key, "yj", "xi"], "left").withColumn("distance", away)


def inside_ring(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Even-odd rule for many points and one closed ring of (x, y) vertices."""
    x0, y0 = ring[:, 0], ring[:, 1]
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    spans = (y0[None, :] > y[:, None]) != (y1[None, :] > y[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = x0 + (y[:, None] - y0) * (x1 - x0) / (y1 - y0)
    return ((spans & (x[:, None] < cross)).sum(axis=1) % 2) == 1


def ring_distance(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Distance of points to a ring's edges."""
    a, b = ring, np.roll(ring, -1, axis=0)
    d = b - a
    with np.errstate(divide="ignore", invalid="ignore"):
        t = ((x[:, None] - a[:, 0]) * d[:, 0] + (y[:, None] - a[:, 1]) * d[:, 1]) / (d * d).sum(axis=1)
    t = np.clip(np.nan_to_num(t), 0, 1)
    return np.sqrt((x[:, None] - a[:, 0] - t * d[:, 0]) ** 2 + (y[:, None] - a[:, 1] - t * d[:, 1]) ** 2).min(axis=1)


def polygon_lookup(points: DataFrame, polygons: DataFrame, x: str, y: str, row_key: Sequence[str], cell: float, tolerance: float = 0.0) -> DataFrame:
    """polygon_id of each point: the polygon that holds it, else the nearest one within the tolerance; ties go to the
    smaller id. Polygons (polygon_id, ring: array of {x, y}) are sent to the grid cells of their bounding box,
    so points meet candidates by an equi-join; the exact test runs on Arrow batches."""
    low = lambda c: F.floor((F.array_min(F.transform("ring", lambda p: p[c])) - tolerance) / cell)
    high = lambda c: F.floor((F.array_max(F.transform("ring", lambda p: p[c])) + tolerance) / cell)
    boxes = polygons.select("polygon_id", "ring", F.explode(F.sequence(low("x"), high("x"))).alias("gx"))
    boxes = boxes.select("polygon_id", "ring", "gx", F.explode(F.sequence(low("y"), high("y"))).alias("gy"))
    at = points.select(*row_key, F.col(x).alias("__x"), F.col(y).alias("__y"))
    at = at.withColumns({"gx": F.floor(F.col("__x") / cell), "gy": F.floor(F.col("__y") / cell)})
    schema = ", ".join([f"{c} {t}" for c, t in points.select(*row_key).dtypes]) + ", polygon_id long, away double"

    def exact(frames):
        for pdf in frames:
            parts = []
            for pid, group in pdf.groupby("polygon_id", sort=True):
                ring = np.array([(p["x"], p["y"]) for p in group["ring"].iloc[0]], float)
                px, py = group["__x"].to_numpy(float), group["__y"].to_numpy(float)
                away = np.where(inside_ring(px, py, ring), 0.0, ring_distance(px, py, ring))
                parts.append(group[list(row_key)].assign(polygon_id=pid, away=away)[away <= tolerance])
            if parts:
                yield pd.concat(parts)

    hits = at.join(boxes, ["gx", "gy"]).mapInPandas(exact, schema)
    best = hits.groupBy(*row_key).agg(F.min(F.struct("away", "polygon_id"))["polygon_id"].alias("polygon_id"))
    return points.join(best, list(row_key), "left")


_REACH = 40  # the filter's weights fall by 3.7 a cell


def spline_line(values: np.ndarray) -> np.ndarray:
    """Cubic B-spline coefficients of a line of values that is mirrored at its ends: the spline passes through them."""
    if len(values) < 2:
        return values
    pole = np.sqrt(3.0) - 2.0
    weights = -6 * pole / (1 - pole**2) * pole ** np.abs(np.arange(-_REACH, _REACH + 1))
    return np.convolve(np.pad(values, _REACH, mode="reflect"), weights, "valid")


def spline_coefficients(raster: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """A raster (keys, ix, iy, value) without gaps as cubic B-spline coefficients, with a mirrored border of one cell: lines
    along ix first, then along iy. A task holds lines, never the raster."""
    schema = ", ".join([*(f"`{k}` {t}" for k, t in raster.select(*keys).dtypes), "ix int", "iy int", f"`{value}` double"])

    def along(axis: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(axis, ignore_index=True)
            v, at = spline_line(pdf[value].to_numpy(float)), pdf[axis].to_numpy()
            if len(v) > 1:
                v, at = np.concatenate([[v[1]], v, [v[-2]]]), np.concatenate([[at[0] - 1], at, [at[-1] + 1]])
            fixed = {c: pdf[c].iloc[0] for c in (*keys, "iy" if axis == "ix" else "ix")}
            return pd.DataFrame({**fixed, axis: at, value: v})[[*keys, "ix", "iy", value]]

        return run

    base = raster.select(*keys, F.col("ix").cast("int").alias("ix"), F.col("iy").cast("int").alias("iy"), F.col(value).cast("double").alias(value))
    rows = base.groupBy(*keys, "iy").applyInPandas(along("ix"), schema)
    return rows.groupBy(*keys, "ix").applyInPandas(along("iy"), schema)


def spline_lookup(points: DataFrame, raster: DataFrame, ix: str, iy: str, value: str, row_key: Sequence[str], out: str | None = None) -> DataFrame:
    """Cubic spline interpolation in a raster without gaps."""
    return cubic_lookup(points, spline_coefficients(raster, value), ix, iy, value, row_key, out, "spline")


def cubic_lookup(points: DataFrame, raster: DataFrame, ix: str, iy: str, value: str, row_key: Sequence[str], out: str | None = None, kind: str = "catmull_rom") -> DataFrame:
    """Bicubic interpolation over the 4 x 4 cells around a point, as one equi-join on cells: Catmull-Rom through the cell
    values, or (spline) the B-spline of a raster of its coefficients."""
    out = out or value

    def weights(t: Column) -> list[Column]:
        t2, t3 = t * t, t * t * t
        if kind == "spline":
            return [(1 - 3 * t + 3 * t2 - t3) / 6.0, (4 - 6 * t2 + 3 * t3) / 6.0, (1 + 3 * t + 3 * t2 - 3 * t3) / 6.0, t3 / 6.0]
        return [-0.5 * t3 + t2 - 0.5 * t, 1.5 * t3 - 2.5 * t2 + 1.0, -1.5 * t3 + 2.0 * t2 + 0.5 * t, 0.5 * t3 - 0.5 * t2]

    fx, fy = F.floor(F.col(ix)), F.floor(F.col(iy))
    wx, wy = weights(F.col(ix) - fx), weights(F.col(iy) - fy)
    cells = F.array(*[
        F.struct((fx + i - 1).cast("int").alias("ix"), (fy + j - 1).cast("int").alias("iy"), (wx[i] * wy[j]).alias("w")) for i in range(4) for j in range(4)
    ])
    asked = points.select(*row_key, F.explode(cells).alias("c")).select(*row_key, "c.*")
    if kind == "spline":
        asked = asked.filter("w <> 0")
    hits = asked.join(small(raster.select("ix", "iy", F.col(value).alias("__v"))), ["ix", "iy"], "left").groupBy(*row_key)
    return points.join(hits.agg(F.when(F.count("__v") == (F.count(F.lit(1)) if kind == "spline" else 16), F.sum(F.col("w") * F.col("__v"))).alias(out)), list(row_key), "left")
