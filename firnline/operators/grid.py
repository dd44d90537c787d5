"""Gridding: per-cell aggregates, coverage and class statistics, uncertainties, masks, status and quality flags.

All aggregates but the median and the coverage distance have partial states, so cells pre-aggregate before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.functions.predicates import mask_condition
from firnline.functions.vocab import SURFACE_TYPES

CELL = ("yj", "xi")


def _method(name: str, c: Column, sigma: Column | None = None) -> Column:
    if name == "average":
        return F.avg(c)
    if name == "median":
        return F.median(c)
    if name == "max":
        return F.max(c)
    if name == "unique":
        return F.when(F.min(c) == F.max(c), F.min(c))
    if name == "average_uncertainty":
        return F.when(F.sum(c) > 0, F.sqrt(F.lit(1.0) / F.sum(c)))
    raise ValueError(f"unknown grid method {name!r}")


def grid_parameters(df: DataFrame, methods: Mapping[str, str], least: int = 1, cell: Sequence[str] = CELL) -> DataFrame:
    """Each column's grid method over the values present in a cell; NULL under `least` of them. Columns that the data
    lacks are NULL; the method "none" gives no column."""
    wanted = {c: m for c, m in methods.items() if m != "none"}
    inside = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cell])
    out = []
    for c, method in wanted.items():
        if c in df.columns:
            out.append(F.when(F.count(c) >= least, _method(method, F.col(c))).alias(c))
        else:
            out.append(F.lit(None).cast("double").alias(c))
    return df.filter(inside).groupBy(*cell).agg(*out)


def valid_count(c: Column) -> Column:
    return F.count(c)


def surface_statistics(surface: Column, thickness: Column | None = None) -> dict[str, Column]:
    """Counts and fractions of surface types in a cell."""
    s = SURFACE_TYPES
    n_valid = F.count_if(surface.isin(s["lead"], s["sea_ice"], s["ocean"]))
    share = lambda k: F.coalesce(F.try_divide(F.count_if(surface == s[k]).cast("double"), n_valid), F.lit(0.0))
    out = {
        "n_total_waveforms": F.count(F.lit(1)), "n_valid_waveforms": n_valid,
        "valid_fraction": F.try_divide(n_valid.cast("double"), F.count(F.lit(1))), "lead_fraction": share("lead"),
        "seaice_fraction": share("sea_ice"), "ocean_fraction": share("ocean"), "is_land": F.count_if(surface == s["land"]) > 0,
    }
    if thickness is not None:
        ice = surface == s["sea_ice"]
        out["negative_thickness_fraction"] = F.try_divide(F.count_if(ice & (thickness < 0)).cast("double"), F.count_if(ice))
    return out


def temporal_coverage(df: DataFrame, day_number: Column, present: Column, period_days: int, keys: Sequence[str] = CELL) -> DataFrame:
    """How evenly records cover a period of days (day_number counts from 0): 1 - Kolmogorov-Smirnov distance to the
    uniform law, share of days with data, span over the period, centre of weight. Days are counted first, so the
    distance needs one row per cell and day."""
    days = df.filter(present).select(*keys, day_number.cast("double").alias("d")).groupBy(*keys, "d").agg(F.count(F.lit(1)).alias("k"))
    w = W.partitionBy(*keys).orderBy("d")
    upto, n = F.sum("k").over(w), F.sum("k").over(W.partitionBy(*keys))
    at = F.col("d") / float(period_days)
    far = F.greatest(upto / n - at, at - (upto - F.col("k")) / n)
    out = days.withColumn("far", far).groupBy(*keys).agg(
        (F.lit(1.0) - F.max("far")).alias("temporal_coverage_uniformity_factor"),
        (F.count_distinct(F.floor("d")) / float(period_days)).alias("temporal_coverage_day_fraction"),
        ((F.floor(F.max("d")) - F.floor(F.min("d")) + 1) / float(period_days)).alias("temporal_coverage_period_fraction"),
        (F.sum(F.col("d") * F.col("k")) / F.sum("k") / float(period_days)).alias("temporal_coverage_weighted_center"),
    )
    return out


def classifier_statistics(parameters: Sequence[str], statistics: Sequence[str], surface: Column, types: Sequence[str], least: int = 2) -> dict[str, Column]:
    """stat_<parameter>_<type>_<mean|sdev> over all combinations; rows with NULL count for `least`."""
    out = {}
    for t in types:
        mine = F.lit(True) if t == "all" else surface == SURFACE_TYPES[t]
        enough = F.count_if(mine) >= least
        for p in parameters:
            c = F.when(mine, F.col(p))
            for s in statistics:
                out[f"stat_{p}_{t}_{s}"] = F.when(enough, F.avg(c) if s == "mean" else F.stddev_pop(c))
    return out


def inverse_variance(sigma: Column, low: float | None = None, high: float | None = None) -> Column:
    """1 / sqrt(sum 1/sigma^2), clipped; sigmas of zero or less take no part."""
    out = F.lit(1.0) / F.sqrt(F.sum(F.when(sigma > 0, 1.0 / (sigma * sigma))))
    if high is not None:
        out = F.when(out.isNotNull(), F.least(out, F.lit(high)))
    if low is not None:
        out = F.when(out.isNotNull(), F.greatest(out, F.lit(low)))
    return out


def grid_uncertainties(rho_w: float = 1024.0, snow_factor: float = 0.22, most: float = 10.0) -> dict[str, Column]:
    """Freeboard, thickness and draft uncertainties of a cell from averaged columns of the grid."""
    c = F.col
    d = F.lit(rho_w) - c("sea_ice_density")
    radar = c("radar_freeboard_l3_uncertainty")
    frb = F.sqrt(F.pow(F.lit(snow_factor) * c("snow_depth_uncertainty"), 2) + radar * radar)
    parts = (
        F.lit(rho_w) / d * frb,
        (c("sea_ice_freeboard") * rho_w + c("snow_depth") * c("snow_density")) / (d * d) * c("sea_ice_density_uncertainty"),
        c("snow_density") / d * c("snow_depth_uncertainty"),
        c("snow_depth") / d * c("snow_density_uncertainty"),
    )
    sit = F.sqrt(reduce(lambda a, b: a + b, [p * p for p in parts]))
    capped = F.when(sit.isNotNull() & c("sea_ice_thickness").isNotNull(), F.least(sit, F.lit(most)))
    return {
        "sea_ice_freeboard_l3_uncertainty": F.when(c("sea_ice_freeboard").isNotNull(), frb),
        "sea_ice_thickness_l3_uncertainty": capped,
        "sea_ice_draft_l3_uncertainty": F.when(capped.isNotNull() & frb.isNotNull(), F.sqrt(capped * capped + frb * frb)),
    }


def mask_parameters(df: DataFrame, source: str, conditions: str, targets: Sequence[str], connector: str = "or", threshold: float | None = None) -> DataFrame:
    """Targets cleared where the conditions ("is_nan; is_smaller") hold: NULL for floats, -1 for whole numbers."""
    tests = [mask_condition(t, source, threshold) for t in conditions.split(";")]
    hit = reduce((lambda a, b: a & b) if connector == "and" else (lambda a, b: a | b), tests)
    kinds = dict(df.dtypes)
    value = lambda t: F.lit(None).cast(kinds[t]) if kinds[t] in ("double", "float") else F.lit(-1).cast(kinds[t])
    return df.withColumns({t: F.when(hit, value(t)).otherwise(F.col(t)) for t in targets if t in kinds})


# The grid status codes.
STATUS = {"no_data": 0, "is_pole_hole": 1, "is_land": 2, "is_sea_ice_low": 3, "retrieval_failed": 4, "has_retrieval": 5}


def status_flag(sic: Column, latitude: Column, is_land: Column, n_valid: Column, retrieval: Column, sic_least: float, orbit_latitude: float, codes=None) -> Column:
    """Later rules overlay earlier ones: no data, too little ice, pole hole, land, failed retrieval, retrieval."""
    k = codes or STATUS
    out = F.lit(k["no_data"])
    rules = (
        (sic.isNotNull() & (sic < sic_least), "is_sea_ice_low"),
        (F.abs(latitude) > orbit_latitude - 1.0, "is_pole_hole"),
        (F.coalesce(is_land, F.lit(False)), "is_land"),
        ((n_valid > 0) & retrieval.isNull() & (sic >= sic_least) & ~F.coalesce(is_land, F.lit(False)), "retrieval_failed"),
        (retrieval.isNotNull(), "has_retrieval"),
    )
    for hit, name in rules:
        out = F.when(F.coalesce(hit, F.lit(False)), F.lit(k[name])).otherwise(out)
    return out.cast("tinyint")


QUALITY_RULES = ("snow_valid", "radar_mode", "n_waveforms", "lead_fraction", "miz", "negative_thickness")


def quality_flag(thickness: Column, rules: Mapping[str, Mapping]) -> Column:
    """0 (good) to 3 (no retrieval): the worst of all rules. Rules that are not implemented are an error."""
    unknown = set(rules) - set(QUALITY_RULES)
    if unknown:
        raise ValueError(f"unknown quality rules {sorted(unknown)}")
    worst = [F.lit(0)]
    for name, r in rules.items():
        c = F.col(r["source"])
        if name == "snow_valid":
            worst.append(F.when(c < 1, r["target"]).otherwise(0))
        elif name == "radar_mode":
            worst.append(F.when(c >= 2, r["target"]).otherwise(0))
        elif name == "lead_fraction":
            worst.append(F.when(c <= r["threshold"], r["target"]).otherwise(0))
        else:  # lists of thresholds with a level each
            for limit, level in zip(r["threshold"], r["target"]):
                hit = c < limit if name == "n_waveforms" else c > limit if name == "negative_thickness" else c >= limit
                worst.append(F.when(hit, level).otherwise(0))
    level = F.greatest(*worst) if len(worst) > 1 else worst[0]
    return F.when(thickness.isNull(), F.lit(3)).otherwise(level).cast("tinyint")


def neighbourhood(df: DataFrame, column: str, out: str, reach: int = 1, how: str = "max", cell: Sequence[str] = CELL) -> DataFrame:
    """Maximum or mean over the cells within `reach` rows and columns: each cell is sent to its neighbours, which
    costs a fixed factor and no self join."""
    yj, xi = cell
    offsets = F.sequence(F.lit(-reach), F.lit(reach))
    sent = df.filter(F.col(column).isNotNull()).select(
        F.explode(F.transform(offsets, lambda d: d)).alias("__dy"), *cell, F.col(column).alias("__v")
    )
    sent = sent.select(F.explode(offsets).alias("__dx"), "__dy", *cell, "__v")
    sent = sent.select((F.col(yj) + F.col("__dy")).alias(yj), (F.col(xi) + F.col("__dx")).alias(xi), "__v")
    agg = F.max("__v") if how == "max" else F.avg("__v")
    return df.join(sent.groupBy(*cell).agg(agg.alias(out)), list(cell), "left")


def densify(cells: DataFrame, grid: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """All cells of the grid dimension, with the values of those that have any."""
    return grid.join(cells, list(cell), "left")


#: The columns that gridded uncertainties are made of and write, by the names that names= may replace.
UNCERTAINTY_COLUMNS = (
    "radar_freeboard_l3_uncertainty", "sea_ice_freeboard", "sea_ice_freeboard_l3_uncertainty", "snow_depth", "snow_depth_uncertainty", "snow_density", "snow_density_uncertainty",
    "sea_ice_density", "sea_ice_density_uncertainty", "sea_ice_thickness", "sea_ice_thickness_l3_uncertainty", "sea_ice_draft_l3_uncertainty",
)
_UNCERTAINTY_OPTIONS = {
    "radar_freeboard": set(), "sea_ice_freeboard": {"snow_factor"}, "sea_ice_thickness": {"water_density"}, "sea_ice_draft": set(),
}


def chosen_uncertainties(cells: DataFrame, kinds: Mapping[str, Mapping], names: Mapping[str, str] | None = None) -> DataFrame:
    """The uncertainties named in kinds, each with its options: valid_range (both ends kept), snow_factor of the freeboard's,
    water_density of the thickness's. names: other columns for those of UNCERTAINTY_COLUMNS, so that several solutions can
    stand side by side. The radar freeboard's is made by inverse_variance and only clipped here."""
    from firnline.functions.physics import thickness_uncertainty

    if unknown := set(kinds) - set(_UNCERTAINTY_OPTIONS):
        raise ValueError(f"unknown uncertainties {sorted(unknown)}")
    for kind, options in kinds.items():
        if unknown := set(options) - _UNCERTAINTY_OPTIONS[kind] - {"valid_range"}:
            raise ValueError(f"{kind}: unknown options {sorted(unknown)}")
    if unknown := set(names or {}) - set(UNCERTAINTY_COLUMNS):
        raise ValueError(f"unknown columns {sorted(unknown)}")
    name = {c: c for c in UNCERTAINTY_COLUMNS} | dict(names or {})
    col = lambda c: F.col(name[c])

    def clipped(value: Column, kind: str) -> Column:
        if "valid_range" not in kinds[kind]:
            return value
        low, high = kinds[kind]["valid_range"]
        return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))

    radar, frb, sit = "radar_freeboard_l3_uncertainty", "sea_ice_freeboard_l3_uncertainty", "sea_ice_thickness_l3_uncertainty"
    if "radar_freeboard" in kinds:
        cells = cells.withColumn(name[radar], clipped(col(radar), "radar_freeboard"))
    if "sea_ice_freeboard" in kinds:
        value = F.sqrt(F.pow(F.lit(float(kinds["sea_ice_freeboard"].get("snow_factor", 0.22))) * col("snow_depth_uncertainty"), 2) + F.pow(col(radar), 2))
        known = col("sea_ice_freeboard").isNotNull() & col("snow_depth").isNotNull()
        cells = cells.withColumn(name[frb], clipped(F.when(known, value), "sea_ice_freeboard"))
    if "sea_ice_thickness" in kinds:
        value = thickness_uncertainty(
            col("sea_ice_freeboard"), col("snow_depth"), F.lit(float(kinds["sea_ice_thickness"].get("water_density", 1024.0))), col("sea_ice_density"), col("snow_density"), col(frb),
            col("snow_depth_uncertainty"), col("sea_ice_density_uncertainty"), col("snow_density_uncertainty"),
        )
        cells = cells.withColumn(name[sit], clipped(F.when(col("sea_ice_thickness").isNotNull(), value), "sea_ice_thickness"))
    if "sea_ice_draft" in kinds:
        cells = cells.withColumn(name["sea_ice_draft_l3_uncertainty"], clipped(F.sqrt(F.pow(col(sit), 2) + F.pow(col(frb), 2)), "sea_ice_draft"))
    return cells


def stack_metadata(df: DataFrame, mission: str, time: str) -> DataFrame:
    return df.agg(
        F.array_join(F.array_sort(F.collect_set(mission)), ",").alias("missions"), F.min(time).alias("start_time"), F.max(time).alias("stop_time")
    )


def load_masks(cells: DataFrame, masks: Mapping[str, DataFrame], cell: Sequence[str] = CELL) -> DataFrame:
    """A column for each mask table (yj, xi, value); cells that a mask lacks are NULL."""
    for name, mask in masks.items():
        cells = cells.join(mask.select(*cell, F.col("value").alias(name)), list(cell), "left")
    return cells


def land_mask(cells: DataFrame, ocean: DataFrame, limit: float = 1e-5, out: str = "is_land", cell: Sequence[str] = CELL) -> DataFrame:
    """Land is where the density of ocean (yj, xi, density_of_ocean) is under a limit."""
    found = cells.join(ocean.select(*cell, "density_of_ocean"), list(cell), "left")
    return found.withColumn(out, F.col("density_of_ocean") < limit).drop("density_of_ocean")


def resample_mask(source: DataFrame, grid, how: str = "nearest", value: str = "value") -> DataFrame:
    """A mask of (longitude, latitude, value) points on the grid's cells: the value nearest to the cell's centre, or (mean)
    the share of the cell's points."""
    from firnline.functions.geodesy import laea_polar, with_cell

    x, y = laea_polar(F.col("longitude"), F.col("latitude"), grid.hemisphere, grid.lon_0)
    base = with_cell(source, grid).filter(F.col("xi").isNotNull() & F.col("yj").isNotNull())
    if how == "mean":
        return base.groupBy(*CELL).agg(F.avg(value).alias("value"))
    dx = x - ((F.col("xi") + 0.5) * grid.dx - grid.xsize / 2)
    dy = y - ((F.col("yj") + 0.5) * grid.dy - grid.ysize / 2)
    return base.withColumn("__away", dx * dx + dy * dy).groupBy(*CELL).agg(F.min(F.struct("__away", value))[value].alias("value"))
