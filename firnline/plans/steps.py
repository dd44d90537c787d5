"""Declarative record pipelines: a validated list of steps that each turn a DataFrame into a DataFrame.

A step declares the columns it reads and writes, its options and its error bit. A pipeline checks all of this before
Spark runs anything, and yields one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.functions import physics as P
from firnline.functions.predicates import classify
from firnline.functions.vocab import ERROR_BITS, SURFACE_TYPES, is_surface, raise_bit
from firnline.operators import filters, retrack, sealevel
from firnline.operators.windows import Track, extrapolate_gaps, fill_nearest, rolling, rolling_by_spacing


class PipelineError(ValueError):
    pass


@dataclass(frozen=True)
class Step:
    """run(df, track, options) -> (df, error predicate or None)."""

    name: str
    run: Callable[[DataFrame, Track, Mapping], tuple[DataFrame, Column | None]]
    reads: Callable[[Mapping], Sequence[str]]
    writes: Callable[[Mapping], Sequence[str]]
    required: Sequence[str] = ()
    bit: str = "other"


STEPS: dict[str, Step] = {}


def step(name: str, reads=lambda o: (), writes=lambda o: (), required: Sequence[str] = (), bit: str = "other"):
    def register(run):
        as_list = lambda x: x if callable(x) else (lambda o: x)  # noqa: E731  constants or functions of the options
        STEPS[name] = Step(name, run, as_list(reads), as_list(writes), required, bit)
        return run

    return register


@step("transfer", lambda o: [], lambda o: list(o["columns"]), ("columns",), "l1")
def _transfer(df, track, o):
    """columns: target -> source. A missing source is a NULL column and flags all rows."""
    missing = [s for s in o["columns"].values() if s not in df.columns]
    new = {t: (F.col(s) if s in df.columns else F.lit(None).cast("double")) for t, s in o["columns"].items()}
    return df.withColumns(new), F.lit(bool(missing))


@step("instrument_mode", ["radar_mode"], ["instrument_mode"])
def _instrument_mode(df, track, o):
    return df.withColumn("instrument_mode", F.col("radar_mode") + 1), None


@step("rolling_statistics", lambda o: o["columns"], lambda o: [f"{c}_rolling_{s}" for c in o["columns"] for s in ("mean", "sdev")], ("columns",))
def _rolling(df, track, o):
    """window: records (constant frame), or window_m and a spacing column (width per segment)."""
    if "window" in o:
        half = (int(o["window"]) - 1) // 2
        return df.withColumns({f"{c}_rolling_{s}": x for c in o["columns"] for s, x in rolling(track, F.col(c), half).items()}), None
    from firnline.operators.windows import odd_window

    base = df.withColumn("__window", odd_window(F.lit(float(o["window_m"])), F.col(o.get("spacing", "spacing"))))
    for c in o["columns"]:
        extra = [f"{c}_rolling_mean", f"{c}_rolling_sdev"]
        base = rolling_by_spacing(base.drop(*extra), track, c, "__window")
    return base.drop("__window"), None


@step("surface_type", ["radar_mode", "month"], ["surface_type"], ("rules",), "surface_type")
def _surface(df, track, o):
    land = is_surface(F.col("surface_flag"), "land", "land_ice") if "surface_flag" in df.columns else None
    out = df.withColumn("surface_type", classify(o["rules"], F.col("radar_mode"), F.col("month"), land=land))
    return out, F.col("surface_type") == SURFACE_TYPES["unknown"]


@step("retrack", ["waveform_power", "waveform_range", "radar_mode", "is_valid", "altitude", "surface_type"], ["elevation", "elevation_uncertainty", "retracked_range"], ("surface_types",), "retracker")
def _retrack(df, track, o):
    retrackers = {}
    for name, options in o["surface_types"].items():
        options = dict(options)
        threshold = options.pop("threshold", 0.5)
        udf = retrack.first_maximum_retracker(retrack.FirstMaximum(**options))
        retrackers[SURFACE_TYPES[name]] = udf("waveform_power", "waveform_range", "radar_mode", "is_valid", retrack.threshold_column(threshold))
    out = retrack.retrack_by_surface(df, retrackers)
    return out.drop("retracker_failed").withColumn("__failed", out["retracked_range"].isNull() & F.col("surface_type").eqNullSafe(SURFACE_TYPES["invalid"])), F.col("__failed")


@step("range_corrections", lambda o: ["elevation"], lambda o: ["total_range_correction"], ("corrections",), "range_correction")
def _corrections(df, track, o):
    """Each correction, gaps filled along the track (with extrapolation) unless preserve_nan, is taken off the target."""
    target, total, flagged, base = o.get("target", "elevation"), F.lit(0.0), F.lit(False), df
    base = base.withColumn("__pos", track.position())
    for c in o["corrections"]:
        if c not in df.columns:
            flagged = flagged | F.lit(True)
            continue
        if o.get("preserve_nan"):
            value = F.col(c)
            flagged = flagged | value.isNull()
        else:
            base = extrapolate_gaps(base, track, c, "__pos", f"__f_{c}")
            base = base.withColumn(f"__k_{c}", F.count(c).over(track.whole))
            flagged = flagged | (F.col(f"__k_{c}") == 0)
            value = F.col(f"__f_{c}")
        total = total + value
    out = base.withColumns({"__flag": flagged, "total_range_correction": total, target: F.col(target) - total})
    return out.drop("__pos", *[x for c in o["corrections"] for x in (f"__f_{c}", f"__k_{c}")]), F.col("__flag")


@step("sea_level", ["elevation", "mean_sea_surface", "surface_type"], ["sea_level_anomaly", "sea_level_anomaly_uncertainty"], (), "sea_level")
def _sea_level(df, track, o):
    out = sealevel.smoothed_linear(df, track, sealevel.SeaLevel(**o))
    return out, F.col("sea_level_anomaly").isNull()


@step("radar_freeboard", ["elevation", "elevation_uncertainty", "mean_sea_surface", "sea_level_anomaly", "sea_level_anomaly_uncertainty", "surface_type"], ["radar_freeboard", "radar_freeboard_uncertainty"], (), "freeboard")
def _radar_freeboard(df, track, o):
    ice = is_surface(F.col("surface_type"), "sea_ice")
    value = P.radar_freeboard(F.col("elevation"), F.col("mean_sea_surface"), F.col("sea_level_anomaly"))
    unc = P.hypot(F.col("elevation_uncertainty"), F.col("sea_level_anomaly_uncertainty"))
    return df.withColumns({"radar_freeboard": F.when(ice, value), "radar_freeboard_uncertainty": F.when(ice, unc)}), None


@step("snow_correction", ["radar_freeboard", "radar_freeboard_uncertainty", "snow_depth", "snow_depth_uncertainty", "snow_density", "surface_type"], ["sea_ice_freeboard", "sea_ice_freeboard_uncertainty", "snow_geometric_correction"], (), "freeboard")
def _snow_correction(df, track, o):
    """factor: a number, or by snow density."""
    factor = F.lit(float(o["factor"])) if "factor" in o else P.snow_speed_factor(F.col("snow_density"))
    ice = is_surface(F.col("surface_type"), "sea_ice")
    extra = factor * F.col("snow_depth")
    return df.withColumns({
        "snow_geometric_correction": F.when(ice, extra), "sea_ice_freeboard": F.when(ice, F.col("radar_freeboard") + extra),
        "sea_ice_freeboard_uncertainty": F.when(ice, P.hypot(factor * F.col("snow_depth_uncertainty"), F.col("radar_freeboard_uncertainty"))),
    }), None


@step("snow_freeboard_assumption", ["radar_freeboard"], ["sea_ice_freeboard"], (), "freeboard")
def _assumption(df, track, o):
    return df.withColumns({"sea_ice_freeboard": F.col("radar_freeboard"), "sea_ice_freeboard_uncertainty": F.col("radar_freeboard_uncertainty")}), None


@step("valid_range", lambda o: [o["source"]], lambda o: [], ("source", "targets"), "filter")
def _valid_range(df, track, o):
    out = filters.valid_range(df, o["source"], o.get("min"), o.get("max"), o["targets"], "__out")
    return out, F.col("__out")


@step("ice_density", ["sea_ice_type"], ["sea_ice_density", "sea_ice_density_uncertainty"])
def _density(df, track, o):
    fyi, myi = o.get("fyi", 916.7), o.get("myi", 882.0)
    u_fyi, u_myi = o.get("fyi_uncertainty", 35.7), o.get("myi_uncertainty", 23.0)
    unc = F.lit(u_fyi) - F.col("sea_ice_type") * F.lit(u_fyi - u_myi)
    return df.withColumns({"sea_ice_density": P.ice_density(F.col("sea_ice_type"), fyi, myi), "sea_ice_density_uncertainty": unc}), None


_SIT = ["sea_ice_freeboard", "sea_ice_freeboard_uncertainty", "snow_depth", "snow_depth_uncertainty", "snow_density", "snow_density_uncertainty", "sea_ice_density", "sea_ice_density_uncertainty", "surface_type"]


@step("thickness", _SIT, ["sea_ice_thickness", "sea_ice_thickness_uncertainty"], (), "thickness")
def _thickness(df, track, o):
    """From ice freeboard, or (from_snow_freeboard) from snow freeboard."""
    ice, c, rho_w = is_surface(F.col("surface_type"), "sea_ice"), F.col, F.lit(float(o.get("water_density", 1024.0)))
    convert = P.snow_freeboard_to_thickness if o.get("from_snow_freeboard") else P.ice_freeboard_to_thickness
    value = convert(c("sea_ice_freeboard"), c("snow_depth"), rho_w, c("sea_ice_density"), c("snow_density"))
    unc = P.thickness_uncertainty(
        c("sea_ice_freeboard"), c("snow_depth"), rho_w, c("sea_ice_density"), c("snow_density"), c("sea_ice_freeboard_uncertainty"),
        c("snow_depth_uncertainty"), c("sea_ice_density_uncertainty"), c("snow_density_uncertainty"),
    )
    out = df.withColumns({"sea_ice_thickness": F.when(ice, value), "sea_ice_thickness_uncertainty": F.when(ice, unc)})
    return out, F.col("sea_ice_thickness").isNull()


@step("draft", ["sea_ice_thickness", "sea_ice_freeboard"], ["sea_ice_draft", "sea_ice_draft_uncertainty"], (), "thickness")
def _draft(df, track, o):
    c = F.col
    return df.withColumns({
        "sea_ice_draft": P.draft(c("sea_ice_thickness"), c("sea_ice_freeboard")),
        "sea_ice_draft_uncertainty": P.hypot(c("sea_ice_thickness_uncertainty"), c("sea_ice_freeboard_uncertainty")),
    }), None


@step("dynamic_topography", ["sea_level_anomaly", "sea_level_anomaly_uncertainty", "mean_dynamic_topography", "mean_dynamic_topography_uncertainty"], ["dynamic_ocean_topography"], ())
def _dot(df, track, o):
    value, unc = P.dynamic_topography(*[F.col(x) for x in ("sea_level_anomaly", "mean_dynamic_topography", "sea_level_anomaly_uncertainty", "mean_dynamic_topography_uncertainty")])
    return df.withColumns({"dynamic_ocean_topography": value, "dynamic_ocean_topography_uncertainty": unc}), None


@step("smooth", lambda o: [o["source"]], lambda o: [o["target"]], ("source", "target", "method", "window"))
def _smooth(df, track, o):
    from firnline.operators.windows import box_smooth

    if o["method"] == "box_filter":
        return box_smooth(df, track, o["source"], int(o["window"]), o["target"]), None
    if o["method"] == "lowess":
        return sealevel.lowess_smooth(df, track, o["source"], int(o["window"]), o["target"]), None
    raise PipelineError(f"unknown smoothing method {o['method']!r}")


@step("ice_type_gaps", ["sea_ice_type", "sea_ice_concentration"], ["sea_ice_type"], (), "auxdata")
def _ice_type_gaps(df, track, o):
    """Where there is ice but no type: the nearest type within `reach` records, else ambiguous."""
    pos, reach = track.position(), int(o.get("reach", 150))
    gap = (F.col("sea_ice_concentration") >= 70) & F.col("sea_ice_type").isNull()
    base = df.withColumns({"__pos": pos, "__gap": F.coalesce(gap, F.lit(False))})
    base = base.withColumn("__near", fill_nearest(track, F.col("sea_ice_type"), F.col("__pos"), reach))
    value = F.when(F.col("__gap"), F.coalesce("__near", F.lit(0.5))).otherwise(F.col("sea_ice_type"))
    return base.withColumn("sea_ice_type", value).drop("__pos", "__near"), F.col("__gap")


@step("elevations", lambda o: ["altitude", *[f"range_{n}" for n in o["names"]]], lambda o: [f"elevation_{n}" for n in o["names"]] + (["elevation", "elevation_uncertainty"] if o.get("use") else []), ("names",), "retracker")
def _elevations(df, track, o):
    """Elevations of several given ranges; `use` names the one that becomes the elevation."""
    out = df.withColumns({f"elevation_{n}": F.col("altitude") - F.col(f"range_{n}") for n in o["names"]})
    if o.get("use"):
        out = out.withColumns({"elevation": F.col(f"elevation_{o['use']}"), "elevation_uncertainty": F.lit(float(o.get("uncertainty", 0.0)))})
    return out, None


@step("peakiness_correction", ["elevation", "peakiness"], ["peakiness_range_correction"], (), "retracker")
def _peakiness_correction(df, track, o):
    value = P.peakiness_range_correction(F.col("peakiness"))
    return df.withColumns({"peakiness_range_correction": value, "elevation": F.col("elevation") - value}), None


@step("pulse_deblurring", lambda o: [o.get("source", "epss"), o.get("target", "elevation")], ["pulse_deblurring_correction"], (), "retracker")
def _deblurring(df, track, o):
    value, target = P.pulse_deblurring(F.col(o.get("source", "epss")), float(o.get("slope", 5.0))), o.get("target", "elevation")
    return df.withColumns({"pulse_deblurring_correction": value, target: F.col(target) + value}), None


@step("drift_correction", lambda o: [o["target"], "time"], (), ("target", "base_year", "base_month", "factor"), "l1")
def _drift(df, track, o):
    start = F.min("time").over(track.whole)
    base = df.withColumn("__start", start)
    return base.withColumn(o["target"], P.drift_correction(F.col(o["target"]), F.col("__start"), o["base_year"], o["base_month"], o["factor"])).drop("__start"), None


@step("sea_state_bias", ["elevation", "wave_height", "wind_speed", "surface_type"], ["sea_state_bias"], ("table", "wave_step", "wind_step"), "range_correction")
def _sea_state_bias(df, track, o):
    """Bilinear in a table of (wave height, wind speed) rows, on leads and ocean only; 0 where the table has no value."""
    table = [list(map(float, row)) for row in o["table"]]
    cells = F.array(*[F.array(*[F.lit(v) for v in row]) for row in table])
    x, y = F.col("wave_height") / float(o["wave_step"]), F.col("wind_speed") / float(o["wind_step"])
    i, j = F.floor(x).cast("int"), F.floor(y).cast("int")
    part_x, part_y = x - i, y - j
    at = lambda a, b: F.get(F.get(cells, a), b)
    low = at(i, j) * (1 - part_y) + F.coalesce(at(i, j + 1), at(i, j)) * part_y
    high = F.coalesce(at(i + 1, j), at(i, j)) * (1 - part_y) + F.coalesce(at(i + 1, j + 1), at(i, j + 1), at(i + 1, j), at(i, j)) * part_y
    value = F.coalesce(low * (1 - part_x) + high * part_x, F.lit(0.0))
    bias = F.when(is_surface(F.col("surface_type"), "lead", "ocean"), value).otherwise(F.lit(0.0))
    return df.withColumns({"sea_state_bias": bias, "elevation": F.col("elevation") - bias}), F.col("sea_state_bias").isNull()


@step("sea_surface_height", ["mean_sea_surface", "sea_level_anomaly", "sea_level_anomaly_uncertainty"], ["sea_surface_height"], (), "sea_level")
def _ssh(df, track, o):
    return df.withColumns({"sea_surface_height": F.col("mean_sea_surface") + F.col("sea_level_anomaly"), "sea_surface_height_uncertainty": F.col("sea_level_anomaly_uncertainty")}), None


@step("raw_sea_level", ["elevation", "mean_sea_surface", "surface_type"], ["sea_level_anomaly", "sea_level_anomaly_uncertainty"], (), "sea_level")
def _raw_sea_level(df, track, o):
    value = sealevel.raw_anomaly(F.col("surface_type"), F.col("elevation"), F.col("mean_sea_surface"), o.get("surface_types", ["lead"]))
    return df.withColumns({"sea_level_anomaly": value, "sea_level_anomaly_uncertainty": F.when(value.isNotNull(), F.lit(0.0))}), F.col("sea_level_anomaly").isNull()


@step("remove_non_ocean", ["surface_type"], (), ("targets",), "filter")
def _remove_non_ocean(df, track, o):
    out = filters.remove_non_ocean(df, "surface_type", o["targets"])
    return out, is_surface(F.col("surface_type"), "land", "land_ice")


@step("wave_zone_flag", lambda o: [o["distance"], o["wave_height"], "sea_ice_concentration"], ["flag_miz"], ("distance", "wave_height", "max_distance", "min_wave_height"), "filter")
def _wave_zone(df, track, o):
    flag = filters.wave_zone_flag(F.col(o["distance"]), F.col(o["wave_height"]), F.col("sea_ice_concentration"), o["max_distance"], o["min_wave_height"])
    return df.withColumn("flag_miz", flag), None


@step(
    "marginal_zone_flag", ["sea_ice_concentration", "leading_edge_width_rolling_mean", "peakiness_rolling_sdev", "radar_freeboard", "distance_to_low_ice_concentration", "distance_to_ocean"], ["flag_miz"],
    ("proximity", "transition"), "filter",
)
def _marginal_zone(df, track, o):
    """The larger of the transition and the proximity flag; with boolean just whether it is above 1."""
    p, t = o["proximity"], o["transition"]
    near = filters.proximity_flag(
        F.col("distance_to_low_ice_concentration"), F.col("sea_ice_concentration"), F.col("leading_edge_width_rolling_mean"), F.col("peakiness_rolling_sdev"),
        p["max_distance"], p["sic_max"], p["width_min"], p["sdev_max"],
    )
    edge = sealevel.IceEdge(t["ice_width"], t["ocean_width"], t["smoother_width"], t["gradient_min"], t["width_min"])
    base = df if "spacing" in df.columns else sealevel.footprint_spacing(df, track)
    base = sealevel.transition_zone(
        base, track, "sea_ice_concentration", "leading_edge_width_rolling_mean", "radar_freeboard", "distance_to_ocean", "spacing", edge, "__transition"
    )
    flag = F.greatest(near, F.col("__transition"))
    return base.withColumn("flag_miz", F.when(flag > 1, 1).otherwise(0).cast("tinyint") if o.get("boolean") else flag).drop("__transition"), None


@dataclass
class Pipeline:
    """steps: (name, options). The error bits of all steps meet in the column `flag`."""

    steps: Sequence[tuple[str, Mapping]]
    track: Track = field(default_factory=Track)

    @classmethod
    def from_config(cls, config: Mapping, track: Track | None = None) -> Pipeline:
        """config: {"procsteps": [{"step": name, "options": {...}}, ...]}."""
        if "procsteps" not in config:
            raise PipelineError("a pipeline needs the tag procsteps")
        steps = []
        for item in config["procsteps"]:
            unknown = set(item) - {"step", "options"}
            if unknown:
                raise PipelineError(f"unknown tags {sorted(unknown)}")
            steps.append((item["step"], item.get("options") or {}))
        return cls(steps, track or Track())

    @classmethod
    def from_yaml(cls, path: str, track: Track | None = None) -> Pipeline:
        import yaml

        with open(path) as f:
            return cls.from_config(yaml.safe_load(f), track)

    def validate(self, columns: Sequence[str]) -> list[str]:
        """The columns that the pipeline ends with; raises on unknown steps, missing options and missing inputs."""
        have = set(columns)
        for name, options in self.steps:
            if name not in STEPS:
                raise PipelineError(f"unknown step {name!r}")
            s = STEPS[name]
            if lost := [k for k in s.required if k not in options]:
                raise PipelineError(f"step {name}: options {lost} are missing")
            if lost := [c for c in s.reads(options) if c not in have]:
                raise PipelineError(f"step {name}: inputs {lost} are missing")
            have |= set(s.writes(options))
        return sorted(have)

    def apply(self, df: DataFrame) -> DataFrame:
        self.validate(df.columns)
        if "flag" not in df.columns:
            df = df.withColumn("flag", F.lit(0))
        for name, options in self.steps:
            df, error = STEPS[name].run(df, self.track, options)
            if error is not None:
                df = df.withColumn("flag", raise_bit(F.col("flag"), ERROR_BITS[STEPS[name].bit], error))
            df = df.drop("__flag", "__out", "__gap", "__failed")
        return df
