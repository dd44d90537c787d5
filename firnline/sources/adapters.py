"""Source adapters: products with a row per file and arrays per record, as records with one row each.

A file's high-rate arrays (20 Hz) become rows; its low-rate arrays (1 Hz) are interpolated to their times, or repeated by
blocks. An adapter says where a product keeps what; the four below describe the products of the supported altimeters by the
names of their variables, so that tables converted from them (a column per variable, arrays in record order) can be read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.functions import waveform as V
from firnline.functions.geodesy import wrap_longitude
from firnline.functions.vocab import RADAR_MODES, SURFACE_TYPES
from firnline.sources.records import tai_to_utc

# The surface codes of the products.
PRODUCT_SURFACES = {0: "ocean", 1: "closed_sea", 2: "land_ice", 3: "land"}


@dataclass(frozen=True)
class Adapter:
    """fields, corrections, classifiers: target -> source, high rate; *_low: low rate, interpolated over time_low, or (without
    time_low) repeated in blocks. time: seconds since epoch; leap: whether these are TAI. power: array of arrays; scale:
    columns of a factor and an exponent of 2. ranges: ("delay", seconds) or ("tracker", metres, nominal bin, bin width).
    valid: ("between", column, low, high), ("not", column) or ("in", column, values). mode: a name, or a column and its
    codes' names. wrap: positions that are impossible become NULL and longitudes are wrapped."""

    mission: str
    sensor: str
    time: str
    fields: Mapping[str, str]
    power: str
    ranges: tuple
    mode: str | tuple[str, Mapping[int, str]]
    epoch: str = "2000-01-01"
    leap: bool = False
    scale: tuple[str, ...] = ()
    valid: tuple | None = None
    time_low: str | None = None
    fields_low: Mapping[str, str] = field(default_factory=dict)
    corrections: Mapping[str, str] = field(default_factory=dict)
    corrections_low: Mapping[str, str] = field(default_factory=dict)
    surface: str | None = None
    surface_low: str | None = None
    classifiers: Mapping[str, str] = field(default_factory=dict)
    wrap: bool = False


def low_rate_place(time: Column, low: Column) -> Column:
    """(i, w): the low-rate value before a time and the weight of the next one; NULL outside the low-rate times."""
    i = F.size(F.filter(low, lambda t: t <= time)) - 1
    inside = (i >= 0) & (time <= F.element_at(low, -1))
    w = F.coalesce(F.try_divide(time - F.get(low, i), F.get(low, i + 1) - F.get(low, i)), F.lit(0.0))
    return F.when(inside, F.struct(i.alias("i"), w.alias("w")))


def _linear(values: Column, at: Column) -> Column:
    here, after = F.get(values, at["i"]), F.get(values, at["i"] + 1)
    return F.when(at["w"] == 0, here).otherwise(here + at["w"] * (after - here))


def _nearest(values: Column, at: Column) -> Column:
    return F.get(values, F.when(at["w"] > 0.5, at["i"] + 1).otherwise(at["i"]))


def records(files: DataFrame, a: Adapter, key: str = "file_id", more: Mapping[str, str] | None = None) -> DataFrame:
    """The records of all files: key, record_idx, time, mission, sensor, the adapter's fields, waveform_power, waveform_range,
    radar_mode, is_valid, surface_type, corrections and classifiers. more: further high-rate columns. Variables that a
    file table lacks are NULL."""
    have = set(files.columns)
    high = {f"__{t}": s for t, s in {**a.fields, **a.corrections, **a.classifiers, **(more or {})}.items() if s in have}
    special = [a.time, a.power, *a.scale, a.ranges[1], *([a.valid[1]] if a.valid else []), *([a.surface] if a.surface else []), *([a.mode[0]] if isinstance(a.mode, tuple) else [])]
    arrays = {**high, **{f"__s_{s}": s for s in dict.fromkeys(special) if s in have}}
    zipped = F.arrays_zip(*[F.col(s).alias(t) for t, s in arrays.items()])
    low = [c for c in dict.fromkeys([*a.fields_low.values(), *a.corrections_low.values(), *([a.surface_low] if a.surface_low else []), *([a.time_low] if a.time_low else [])]) if c in have]
    n = F.size(F.col(a.time)).alias("__n")
    df = files.select(key, *low, n, F.posexplode(zipped).alias("record_idx", "__r")).select(key, *low, "__n", "record_idx", *[F.col(f"__r.{t}").alias(t) for t in arrays])
    of = lambda s: F.col(f"__s_{s}") if s in have else F.lit(None).cast("double")
    blocks = a.time_low is None
    if a.time_low:
        df = df.withColumn("__at", low_rate_place(of(a.time).cast("double"), F.transform(F.col(a.time_low), lambda t: t.cast("double"))))

    def from_low(s: str, how=_linear) -> Column:
        if s not in have:
            return F.lit(None).cast("double")
        if blocks:
            return F.get(F.col(s), F.floor(F.col("record_idx") * F.size(s) / F.col("__n")).cast("int"))
        return how(F.col(s), F.col("__at"))

    stamp = F.timestamp_micros(F.round((of(a.time).cast("double") + F.unix_seconds(F.lit(a.epoch).cast("timestamp"))) * 1e6).cast("long")).cast("timestamp_ntz")
    out = {"time": tai_to_utc(stamp) if a.leap else stamp, "mission": F.lit(a.mission), "sensor": F.lit(a.sensor)}
    for t, s in {**a.fields, **a.corrections, **a.classifiers, **(more or {})}.items():
        out[t] = F.col(f"__{t}") if s in have else F.lit(None).cast("double")
    out |= {t: from_low(s) for t, s in {**a.fields_low, **a.corrections_low}.items()}
    power = of(a.power)
    if a.scale:
        factor = of(a.scale[0]).cast("double") * (F.pow(F.lit(2.0), of(a.scale[1]).cast("double")) if len(a.scale) > 1 else F.lit(1.0))
        power = V.let(factor, lambda f: F.transform(of(a.power), lambda x: x * f))
    out["waveform_power"] = power
    bins = F.greatest(F.size(of(a.power)), F.lit(1))
    at = F.sequence(F.lit(0), bins - 1)
    if a.ranges[0] == "delay":
        step = V.SPEED_OF_LIGHT / (4.0 * 3.2e8)
        out["waveform_range"] = F.transform(at, lambda i: of(a.ranges[1]) * (V.SPEED_OF_LIGHT / 2.0) + (i - bins / 2.0) * step)
    else:
        _, tracker, nominal, width = a.ranges
        out["waveform_range"] = F.transform(at, lambda i: of(tracker) + (i - F.lit(float(nominal))) * width)
    if isinstance(a.mode, tuple):
        codes = F.map_from_arrays(F.array(*[F.lit(int(k)) for k in a.mode[1]]), F.array(*[F.lit(RADAR_MODES[v]) for v in a.mode[1].values()]))
        out["radar_mode"] = F.element_at(codes, of(a.mode[0]).cast("int")).cast("int")
    else:
        out["radar_mode"] = F.lit(RADAR_MODES[a.mode])
    kind, rest = (a.valid[0], a.valid[1:]) if a.valid else ("all", ())
    valid = {"all": lambda: F.lit(True), "between": lambda: of(rest[0]).between(rest[1], rest[2]), "not": lambda: of(rest[0]) == 0, "in": lambda: of(rest[0]).isin(*rest[1])}[kind]()
    out["is_valid"] = F.coalesce(valid, F.lit(False))
    code = of(a.surface) if a.surface else from_low(a.surface_low, _nearest) if a.surface_low else F.lit(None)
    types = F.map_from_arrays(F.array(*[F.lit(k) for k in PRODUCT_SURFACES]), F.array(*[F.lit(SURFACE_TYPES[v]) for v in PRODUCT_SURFACES.values()]))
    out["surface_type"] = F.coalesce(F.element_at(types, code.cast("int")), F.lit(SURFACE_TYPES["unknown"])).cast("int")
    if a.wrap:
        ok = F.coalesce((F.abs(out["latitude"]) <= 90) & (F.abs(out["longitude"]) <= 180), F.lit(False))
        out |= {c: F.when(ok, wrap_longitude(out[c]) if c == "longitude" else out[c]) for c in ("longitude", "latitude", "altitude") if c in out}
    return df.select(key, "record_idx", *[c.alias(t) for t, c in out.items()])


_TIDES = {
    "ocean_loading_tide": "load_tide", "solid_earth_tide": "solid_earth_tide", "geocentric_polar_tide": "pole_tide", "ocean_tide_long_period": "ocean_tide_eq",
    "ionosphere": "iono_cor_gim", "dry_troposphere": "mod_dry_tropo_cor", "wet_troposphere": "mod_wet_tropo_cor", "inverse_barometric": "inv_bar_cor", "dynamic_atmosphere": "hf_fluct_total_cor",
}
_POSITION = {"longitude": "lon_20_ku", "latitude": "lat_20_ku", "altitude": "alt_20_ku", "altitude_rate": "orb_alt_rate_20_ku"}

ADAPTERS: dict[str, Adapter] = {
    "cryosat2": Adapter(
        "cryosat2", "siral", "time_20_ku",
        {**_POSITION, "antenna_pitch": "off_nadir_pitch_angle_str_20_ku", "antenna_roll": "off_nadir_roll_angle_str_20_ku", "antenna_yaw": "off_nadir_yaw_angle_str_20_ku"},
        "pwr_waveform_20_ku", ("delay", "window_del_20_ku"), ("op_mode", {0: "lrm", 1: "sar", 2: "sin"}), leap=True, scale=("echo_scale_factor_20_ku", "echo_scale_pwr_20_ku"),
        valid=("between", "flag_mcd_20_ku", 0, 4096), time_low="time_cor_01", corrections_low={t: f"{s}_01" for t, s in _TIDES.items()}, surface_low="surf_type_01",
    ),
    "envisat": Adapter(
        "envisat", "ra2", "time_20", {"longitude": "lon_20", "latitude": "lat_20", "altitude": "alt_20"}, "waveform_fft_20_ku", ("tracker", "tracker_range_20_ku", 63, 0.4684), "lrm",
        valid=("not", "waveform_fault_id_20"), time_low="time_01", corrections_low={t: f"{s}_01" for t, s in _TIDES.items()}, surface="surf_class_20",
    ),
    "ers": Adapter(
        "ers2", "ra", "time_20hz", {"longitude": "lon_20hz", "latitude": "lat_20hz", "altitude": "alt_20hz", "antenna_mispointing": "off_nadir_angle_wf_20hz"}, "ku_wf",
        ("tracker", "tracker_range_20hz", 32.5, 0.4545), "lrm", epoch="1990-01-01", valid=("in", "alt_state_flag_20hz", (2, 3)), corrections_low=dict(_TIDES), surface_low="surface_type", wrap=True,
    ),
    "sentinel3": Adapter(
        "sentinel3", "sral", "time_20_ku", _POSITION, "waveform_20_ku", ("tracker", "tracker_range_20_ku", 43, 0.234212857813), ("instr_op_mode_20_ku", {0: "lrm", 1: "sar", 2: "sar"}),
        scale=("scale_factor_20_ku",), time_low="time_01", fields_low={f"antenna_{x}": f"off_nadir_{x}_angle_pf_01" for x in ("pitch", "roll", "yaw")},
        corrections_low={t: f"{s}_01" for t, s in _TIDES.items()}, surface_low="surf_type_01",
    ),
}
