"""Backscatter and window geometry of the supported altimeters, dispatched by radar mode."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline.functions import physics as P
from firnline.functions import waveform as V
from firnline.functions.vocab import RADAR_MODES

# Antenna and pulse constants of the low-resolution backscatter formula.
LRM = {
    "semi_major_m": 6378137.0, "pulse_s": 4.183e-9, "gain": 18197.008586099826, "wavelength_m": 2.2084e-2, "nominal_range_m": 720000.0,
    "beam_azimuth_deg": 1.06, "beam_elevation_deg": 1.1992, "sent_watt": 22.4,
}


def sigma0_lrm(rng: Column, received: Column, roll: Column, pitch: Column, bias: float = 0.0, c: Mapping[str, float] = LRM) -> Column:
    """Low-resolution backscatter in dB with the loss by mispointing. Non-positive power gives NULL."""
    beam = 1.0 / (1.0 / math.radians(c["beam_azimuth_deg"]) + 1.0 / math.radians(c["beam_elevation_deg"]))
    gamma = 2.0 / math.log(2.0) * math.sin(beam) ** 2
    curvature = (c["nominal_range_m"] + c["semi_major_m"]) / c["semi_major_m"]
    antenna = P.SPEED_OF_LIGHT * math.pi * c["wavelength_m"] ** 2 * c["gain"] ** 2 * c["pulse_s"]
    constant = 10.0 * math.log10(antenna / ((4.0 * math.pi * c["nominal_range_m"]) ** 3 * curvature))
    off_nadir = P.hypot(F.radians(roll), F.radians(pitch))
    lost = F.lit(-40.0 / (gamma * math.log(10.0))) * P.square(F.sin(off_nadir))
    ratio = received / F.lit(c["sent_watt"])
    level = F.lit(10.0) * F.log10(ratio) - constant + F.lit(30.0) * F.log10(rng / c["nominal_range_m"]) - lost + F.lit(bias)
    return F.when((received > 0) & (rng > 0), level)


def sigma0_by_mode(mode: Column, power: Column, sent: Column, r: Column, velocity: Column, o: Mapping) -> Column:
    """SAR modes take the peak and the SAR footprint, low resolution the OCOG amplitude and the pulse-limited one.
    o: wavelength, gain, bandwidth, ptr_width, burst, and optionally bias per mode."""
    bias = o.get("bias", {})
    radar = {"wavelength": o["wavelength"], "gain": o["gain"]}
    sar_area = P.footprint_sar(r, velocity, o["ptr_width"], o["burst"], o["wavelength"])
    lrm_power = V.ocog(power)[0]
    lrm = P.sigma0(lrm_power, sent, r, P.footprint_pulse_limited(r, o["bandwidth"]), bias=bias.get("lrm", 0.0), **radar)
    sar = P.sigma0(V.peak(power), sent, r, sar_area, bias=bias.get("sar", 0.0), **radar)
    sin = P.sigma0(V.peak(power), sent, r, sar_area, bias=bias.get("sin", 0.0), **radar)
    return F.when(mode == RADAR_MODES["lrm"], lrm).when(mode == RADAR_MODES["sar"], sar).when(mode == RADAR_MODES["sin"], sin)


def first_bin_delay(tracker: Column, corrections: Sequence[Column], nominal_bin: float, width: float) -> Column:
    """Range of the first bin: tracker range, less the nominal tracking bins, plus Doppler terms."""
    out = tracker - F.lit(nominal_bin * width)
    for c in corrections:
        out = out + c
    return out


def resample_by_mode(mode: Column, power: Column, sin_bins: int = 256, lrm_bins: int = 256) -> Column:
    """Interferometric waveforms are cut to, low-resolution ones padded to a number of bins."""
    return F.when(mode == RADAR_MODES["sin"], V.reduce_bins(power, sin_bins)).when(mode == RADAR_MODES["lrm"], V.pad_power(power, lrm_bins)).otherwise(power)


def by_mode(mode: Column, values: Mapping[str, Column]) -> Column:
    """The Column of the record's radar mode, NULL for modes without one."""
    out = F.lit(None)
    for name, column in values.items():
        out = F.when(mode == RADAR_MODES[name], column).otherwise(out)
    return out


def threshold_rules(options: Mapping[str, Mapping[str, Mapping]]) -> list[dict]:
    """Classification rules (ocean, lead, sea ice per radar mode) from threshold options; numbers or monthly lists.
    The lead rule's peakiness bound has an option of its own."""
    text = lambda v: "[" + ", ".join(map(str, v)) + "]" if isinstance(v, (list, tuple)) else str(float(v))
    named = {
        "ocean": (("peakiness", "<=", "peakiness_max"), ("sic", "<", "ice_concentration_min")),
        "lead": (("sigma0", ">=", "sea_ice_backscatter_min"), ("leading_edge_width", "<=", "leading_edge_width_max"), ("peakiness", ">=", "peakiness_min"), ("sic", ">", "ice_concentration_min")),
        "sea_ice": (
            ("sigma0", ">=", "sea_ice_backscatter_min"), ("sigma0", "<=", "sea_ice_backscatter_max"), ("leading_edge_width", ">=", "leading_edge_width_min"),
            ("peakiness", "<=", "peakiness_max"), ("sic", ">", "ice_concentration_min"),
        ),
    }
    out = []
    for mode, classes in options.items():
        for name, tests in named.items():
            conditions = [f"{{{p}}} {op} {text(classes[name][key])}" for p, op, key in tests]
            out.append({"surface_type": name, "radar_mode": RADAR_MODES[mode], "conditions": conditions})
    return out


def external_classes(code: Column, sic: Column, options: Mapping[str, Mapping]) -> Column:
    """Classes from an external classifier's codes and the ice concentration (below the bound for ocean, from it on for
    leads and ice); a later class overwrites."""
    from firnline.functions.vocab import SURFACE_TYPES

    out = F.lit(SURFACE_TYPES["unknown"])
    for name, test in (("ocean", "below"), ("lead", "from"), ("sea_ice", "from")):
        if name in options:
            o = options[name]
            bound = sic < o["sic"] if test == "below" else sic >= o["sic"]
            out = F.when(code.isin(*o["nn"]) & bound, F.lit(SURFACE_TYPES[name])).otherwise(out)
    return out
