"""Auxiliary data providers: named, declared lookups that add columns to along-track records."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.functions import physics as P
from firnline.functions.geodesy import Grid, ellipsoid_delta, laea_polar, stereographic_polar
from firnline.operators import lookups as L
from firnline.operators.windows import Track


@dataclass(frozen=True)
class Provider:
    """add(records, tables, options) -> records with the columns in `writes`."""

    category: str
    name: str
    add: Callable[[DataFrame, Mapping[str, DataFrame], Mapping], DataFrame]
    writes: Sequence[str]
    tables: Sequence[str] = ()
    required: Sequence[str] = ()


PROVIDERS: dict[tuple[str, str], Provider] = {}


def provider(category: str, name: str, writes: Sequence[str], tables: Sequence[str] = (), required: Sequence[str] = ()):
    def register(add):
        PROVIDERS[category, name] = Provider(category, name, add, writes, tables, required)
        return add

    return register


@dataclass(frozen=True)
class Auxiliary:
    """An ordered list of (category, name, options); later options override a provider's defaults."""

    steps: Sequence[tuple[str, str, Mapping]]
    defaults: Mapping[tuple[str, str], Mapping] = field(default_factory=dict)

    def validate(self, tables: Sequence[str]) -> None:
        for category, name, options in self.steps:
            p = PROVIDERS.get((category, name))
            if p is None:
                raise KeyError(f"no provider {category}/{name}")
            merged = {**self.defaults.get((category, name), {}), **options}
            if lost := [t for t in p.tables if merged.get(t, t) not in tables]:
                raise KeyError(f"{category}/{name}: tables {lost} are missing")
            if lost := [o for o in p.required if o not in merged]:
                raise KeyError(f"{category}/{name}: options {lost} are missing")

    def apply(self, records: DataFrame, tables: Mapping[str, DataFrame], track: Track | None = None) -> DataFrame:
        """Side tables are keyed by the day of the segment's first record. A day without a file leaves NULL."""
        self.validate(list(tables))
        out = L.segment_day(records, (track or Track()).segment, "time", "day") if "day" not in records.columns else records
        for category, name, options in self.steps:
            p = PROVIDERS[category, name]
            merged = {**self.defaults.get((category, name), {}), **options}
            out = p.add(out, {t: tables[merged.get(t, t)] for t in p.tables}, merged)
        return out


def grid_index(grid: Grid, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Fractional cell indices (0 at the first cell's centre)."""
    x, y = laea_polar(lon, lat, grid.hemisphere, grid.lon_0)
    return (x + F.lit(grid.xsize / 2)) / F.lit(grid.dx) - 0.5, (y + F.lit(grid.ysize / 2)) / F.lit(grid.dy) - 0.5


def _nearest(df: DataFrame, raster: DataFrame, grid: Grid, values: Sequence[str], outside=None) -> DataFrame:
    ix, iy = grid_index(grid, F.col("longitude"), F.col("latitude"))
    keys = ["day"] if "day" in raster.columns else []
    return L.nearest_cell(df, raster, ix, iy, values, keys, outside)


def record_version(day: Column, cut_over, before: str = "cdr", after: str = "icdr") -> Column:
    """The data record that holds a day: the climate record before a date, the interim one from it on."""
    return F.when(day < F.lit(cut_over).cast("date"), F.lit(before)).otherwise(F.lit(after))


@provider("sic", "nearest", ["sea_ice_concentration"], ["sic"], ["grid"])
def _sic(df, tables, o):
    """Concentration of the nearest cell; values beyond 0 to 100 count as 0. cut_over: the table has a column `version`, and
    days from this date on take `icdr`, earlier ones `cdr`. pole_hole: {"latitude", "value"} for gaps near the pole."""
    raster = tables["sic"]
    if "cut_over" in o:
        raster = raster.filter(F.col("version") == record_version(F.col("day"), o["cut_over"])).drop("version")
    out = _nearest(df, raster, o["grid"], ["sea_ice_concentration"])
    c = F.col("sea_ice_concentration")
    value = F.when(c.between(0, 100), c).when(c.isNotNull(), F.lit(0.0))
    if "pole_hole" in o:
        value = F.when(value.isNull() & (F.col("latitude") >= o["pole_hole"]["latitude"]), F.lit(float(o["pole_hole"]["value"]))).otherwise(value)
    return out.withColumn("sea_ice_concentration", value)


@provider("sic", "distances", ["distance_to_ocean", "distance_to_low_ice_concentration"], ["sic"], ["grid"])
def _sic_distances(df, tables, o):
    """Metres, by bilinear lookup, to the next cell under 15 and under 70 per cent; no distance to the ocean where the record's
    concentration is under 15. The raster's negative concentrations are missing."""
    cells, grid = tables["sic"], o["grid"]
    keys = ["day"] if "day" in cells.columns else []
    cells = cells.select(*keys, F.col("iy").alias("yj"), F.col("ix").alias("xi"), F.when(F.col("sea_ice_concentration") >= 0, F.col("sea_ice_concentration")).alias("sic"))
    ix, iy = grid_index(grid, F.col("longitude"), F.col("latitude"))
    out = df
    for name, bound in (("distance_to_ocean", 15.0), ("distance_to_low_ice_concentration", 70.0)):
        raster = L.edge_proximity(cells, "sic", bound, grid.dx, int(o.get("reach", 16)), keys)
        raster = raster.select(*keys, F.col("yj").alias("iy"), F.col("xi").alias("ix"), F.col("distance").alias(name))
        out = L.bilinear(out, raster, ix, iy, name, ["segment_id", "record_idx"], keys)
    far = F.col("sea_ice_concentration") < 15
    return out.withColumn("distance_to_ocean", F.when(~F.coalesce(far, F.lit(False)), F.col("distance_to_ocean")))


@provider("sitype", "codes", ["sea_ice_type", "sea_ice_type_uncertainty"], ["sitype"], ["grid"])
def _sitype(df, tables, o):
    """Multi-year fraction and uncertainty from type codes and confidence levels."""
    out = _nearest(df, tables["sitype"], o["grid"], ["ice_type", "confidence_level"])
    types = o.get("types", [None, None, 0.0, 1.0, 0.5])
    sure = o.get("confidence", [1.0, 1.0, 0.5, 0.2, 0.1, 0.0])
    return out.withColumns({"sea_ice_type": L.code_value(F.col("ice_type"), types), "sea_ice_type_uncertainty": L.code_value(F.col("confidence_level"), sure)}).drop("ice_type", "confidence_level")


@provider("sitype", "fraction", ["sea_ice_type"], ["sitype"], ["grid"])
def _sitype_fraction(df, tables, o):
    out = _nearest(df, tables["sitype"], o["grid"], ["myi_percent"])
    return out.withColumn("sea_ice_type", F.greatest(F.col("myi_percent") / 100.0, F.lit(0.0))).drop("myi_percent")


@provider("sitype", "all_multi_year", ["sea_ice_type", "sea_ice_type_uncertainty"])
def _all_myi(df, tables, o):
    return df.withColumns({"sea_ice_type": F.when(F.col("sea_ice_concentration") > 0, 1.0).otherwise(0.0), "sea_ice_type_uncertainty": F.lit(0.0)})


@provider("sitype", "all_first_year", ["sea_ice_type", "sea_ice_type_uncertainty"])
def _all_fyi(df, tables, o):
    return df.withColumns({"sea_ice_type": F.lit(0.0), "sea_ice_type_uncertainty": F.lit(0.0)})


@provider("region", "nearest", ["region_code"], ["region"], ["grid"])
def _region(df, tables, o):
    return _nearest(df, tables["region"], o["grid"], ["region_code"], o.get("outside", -1))


def _global_index(step: float) -> tuple[Column, Column]:
    """Fractional indices of a global raster from longitude 0 and latitude -90."""
    return F.pmod(F.col("longitude"), F.lit(360.0)) / step, (F.col("latitude") + 90.0) / step


@provider("mss", "raster", ["mean_sea_surface"], ["mss"], ["step"])
def _mss(df, tables, o):
    """A global raster by its cubic spline, moved to the target ellipsoid."""
    ix, iy = _global_index(o["step"])
    base = df.withColumns({"__ix": ix, "__iy": iy})
    out = L.spline_lookup(base, tables["mss"], "__ix", "__iy", "mss", ["segment_id", "record_idx"], "mean_sea_surface").drop("__ix", "__iy")
    if "ellipsoid" in o:
        out = out.withColumn("mean_sea_surface", F.col("mean_sea_surface") + ellipsoid_delta(F.col("latitude"), *o["ellipsoid"]))
    return out


@provider("mdt", "raster", ["mean_dynamic_topography", "mean_dynamic_topography_uncertainty"], ["mdt"], ["step"])
def _mdt(df, tables, o):
    """Topography and its error by cubic splines; 0 where the raster has none."""
    ix, iy = _global_index(o["step"])
    out = df.withColumns({"__ix": ix, "__iy": iy})
    for value, name in (("mdt", "mean_dynamic_topography"), ("err", "mean_dynamic_topography_uncertainty")):
        raster = tables["mdt"].withColumn(value, F.coalesce(F.col(value), F.lit(0.0)))
        out = L.spline_lookup(out, raster, "__ix", "__iy", value, ["segment_id", "record_idx"], name).fillna(0.0, [name])
    return out.drop("__ix", "__iy")


_SNOW = ["snow_depth", "snow_depth_uncertainty", "snow_density", "snow_density_uncertainty"]


@provider("snow", "climatology", _SNOW)
def _snow_climatology(df, tables, o):
    """Monthly fits in degrees of arc, depth bounds, first-year scaling."""
    x, y = stereographic_polar(F.col("longitude"), F.col("latitude"))
    arc = 6371000.8 * 3.141592653589793 / 180.0
    w = P.snow_climatology(x / arc, y / arc, F.month("day"))
    out = df.withColumns(w)
    low, high = o.get("valid_range", (0.0, 0.6))
    ok = F.col("snow_depth").between(low, high)
    out = out.withColumns({c: F.when(ok, F.col(c)) for c in _SNOW if c != "snow_depth"} | {"snow_depth": F.when(ok, F.col("snow_depth"))})
    depth, unc = P.scale_first_year_snow(F.col("snow_depth"), F.col("snow_depth_uncertainty"), F.col("sea_ice_type"), F.coalesce(F.col("sea_ice_type_uncertainty"), F.lit(0.0)), o.get("first_year_factor", 0.5))
    return out.withColumns({"snow_depth": depth, "snow_depth_uncertainty": unc})


@provider("snow", "merged_monthly", ["snow_depth", "snow_depth_uncertainty"], ["snow"], ["grid"])
def _snow_monthly(df, tables, o):
    """Daily values between monthly fields: nearest cells of the two reference months, weighted by date."""
    low, high, weight = L.between_months(F.col("day"), o.get("reference_day", 15))
    ix, iy = grid_index(o["grid"], F.col("longitude"), F.col("latitude"))
    out = df.withColumns({"__low": F.month(low), "__high": F.month(high), "__w": weight})
    for tag in ("low", "high"):
        raster = tables["snow"].select(F.col("month").alias(f"__{tag}"), "ix", "iy", *[F.col(c).alias(f"__{tag}_{c}") for c in ("snow_depth", "snow_depth_uncertainty")])
        out = L.nearest_cell(out, raster, ix, iy, [f"__{tag}_snow_depth", f"__{tag}_snow_depth_uncertainty"], [f"__{tag}"])
    mixed = {c: F.col(f"__low_{c}") * (1 - F.col("__w")) + F.col(f"__high_{c}") * F.col("__w") for c in ("snow_depth", "snow_depth_uncertainty")}
    return out.withColumns(mixed).select(*df.columns, *mixed)


@provider("snow", "seasonal_density", ["snow_density", "snow_density_uncertainty"])
def _seasonal_density(df, tables, o):
    value = P.seasonal_snow_density(F.col("day"), P.winter_start(F.col("day")))
    ice = F.col("sea_ice_concentration").isNotNull()
    return df.withColumns({"snow_density": F.when(ice, value), "snow_density_uncertainty": F.when(ice, F.lit(float(o.get("uncertainty", 50.0))))})


@provider("snow", "fixed", _SNOW, (), ["snow_depth", "snow_density"])
def _snow_fixed(df, tables, o):
    return df.withColumns({
        "snow_depth": F.lit(float(o["snow_depth"])), "snow_density": F.lit(float(o["snow_density"])),
        "snow_depth_uncertainty": F.lit(float(o.get("snow_depth_uncertainty", 0.0))), "snow_density_uncertainty": F.lit(float(o.get("snow_density_uncertainty", 0.0))),
    })


@provider("snow", "day_of_year", ["snow_depth"], ["snow"], ["grid"])
def _snow_day_of_year(df, tables, o):
    """A climatology by month and day; 29 February takes the 28th, negative depths are missing."""
    ix, iy = grid_index(o["grid"], F.col("longitude"), F.col("latitude"))
    key = F.date_format(F.when((F.month("day") == 2) & (F.dayofmonth("day") == 29), F.date_sub("day", 1)).otherwise(F.col("day")), "MMdd")
    out = L.nearest_cell(df.withColumn("month_day", key), tables["snow"], ix, iy, ["snow_depth"], ["month_day"])
    return out.withColumn("snow_depth", F.when(F.col("snow_depth") >= 0, F.col("snow_depth"))).drop("month_day")


_CHART = [f"{c}{k}" for c in ("sic", "sod", "floe") for k in "abc"]


@provider("icechart", "grid", ["ice_chart_total", "ice_chart_concentrations", "ice_chart_stages"], ["icechart"], ["grid"])
def _icechart(df, tables, o):
    """Total concentration and three-class arrays of the nearest cell of the closest chart within some days; without partial
    concentrations the first class takes the total."""
    days = tables["icechart"].select(F.col("day").alias("chart_day")).distinct()
    near = L.closest_date(df, "day", days, "chart_day", int(o.get("max_days", 7)), o.get("prefer", "before"))
    ix, iy = grid_index(o["grid"], F.col("longitude"), F.col("latitude"))
    raster = tables["icechart"].withColumnRenamed("day", "chart_day")
    out = L.nearest_cell(near, raster, ix, iy, ["sict", *_CHART], ["chart_day"])
    empty = F.coalesce(F.col("sica"), F.lit(-9)) == -9
    for k in "bc":
        empty = empty & (F.coalesce(F.col(f"sic{k}"), F.lit(-9)) == -9)
    first = F.when(empty & F.col("sict").isNotNull(), F.col("sict")).otherwise(F.col("sica"))
    return out.withColumns({
        "ice_chart_total": F.col("sict"), "ice_chart_concentrations": F.array(first, F.col("sicb"), F.col("sicc")),
        "ice_chart_stages": F.array("soda", "sodb", "sodc"),
    }).drop("chart_day", "sict", *_CHART)


def decode_chart_codes(df: DataFrame, codes: Mapping[str, Mapping[int, int]], groups: Mapping[str, Sequence[str]], total: str = "CT", first: str = "CA", missing: int = -9) -> DataFrame:
    """Chart code columns replaced by classes. codes: group -> code -> class; groups: group -> its columns. Where the first
    partial concentration is not filled and the total is above 0 it takes the total."""
    out = df
    for group, columns in groups.items():
        table = F.map_from_arrays(F.array(*[F.lit(int(k)) for k in codes[group]]), F.array(*[F.lit(int(v)) for v in codes[group].values()]))
        out = out.withColumns({c: F.coalesce(F.element_at(table, F.coalesce(F.col(c).cast("int"), F.lit(missing))), F.col(c).cast("int"), F.lit(missing)) for c in columns})
    return out.withColumn(first, F.when((F.col(first) == missing) & (F.col(total) > 0), F.col(total)).otherwise(F.col(first)))


@provider("risk", "index", ["risk_index"], (), ["table"])
def _risk(df, tables, o):
    return df.withColumn("risk_index", L.risk_index(F.col("ice_chart_stages"), F.col("ice_chart_concentrations"), o["table"], o.get("open_water", 3)))


@provider("mask", "land", ["surface_flag", "distance_to_coast"], ["landmask"], ["grid"])
def _land(df, tables, o):
    """Overwrites the surface flag by a land mask where it has a value: 1 land, 0 ocean."""
    out = _nearest(df.withColumnRenamed("surface_flag", "__flag"), tables["landmask"], o["grid"], ["land", "distance_to_coast"])
    flag = F.when(F.col("land") == 1, 7).when(F.col("land") == 0, 1).otherwise(F.col("__flag"))
    return out.withColumn("surface_flag", flag).drop("__flag", "land")


def snow_validity_mask(value: Column, latitude: Column) -> Column:
    """Where the monthly snow fits hold: never up to 65 degrees, always from 89 on, else as the mask says."""
    return F.when(latitude <= 65, 0).when(latitude >= 89, 1).otherwise(F.coalesce(value, F.lit(0))).cast("tinyint")
