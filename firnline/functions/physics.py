"""Scalar physics with error propagation, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SPEED_OF_LIGHT = 299792458.0


def square(x: Column) -> Column:
    return x * x


def hypot(*parts: Column) -> Column:
    total = square(parts[0])
    for p in parts[1:]:
        total = total + square(p)
    return F.sqrt(total)


def polynomial(x: Column, coefficients) -> Column:
    """c0 + c1 x + c2 x^2 + ..., by Horner's rule."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def radar_freeboard(elevation: Column, mss: Column, sla: Column) -> Column:
    return elevation - mss - sla


def snow_speed_factor(density: Column) -> Column:
    """Range delay per metre of snow of a density in kg/m3."""
    return F.pow(F.lit(1.0) + F.lit(0.51) * density / 1000.0, F.lit(1.5)) - 1.0


def ice_freeboard_to_thickness(frb: Column, snow: Column, rho_w: Column, rho_i: Column, rho_s: Column) -> Column:
    return (rho_w * frb + rho_s * snow) / (rho_w - rho_i)


def snow_freeboard_to_thickness(frb: Column, snow: Column, rho_w: Column, rho_i: Column, rho_s: Column) -> Column:
    return (rho_w * frb + (rho_s - rho_w) * snow) / (rho_w - rho_i)


def thickness_uncertainty(frb, snow, rho_w, rho_i, rho_s, u_frb, u_snow, u_rho_i, u_rho_s) -> Column:
    """First-order propagation of freeboard, ice density, snow depth and snow density errors."""
    d = rho_w - rho_i
    return hypot(rho_w / d * u_frb, (frb * rho_w + snow * rho_s) / square(d) * u_rho_i, rho_s / d * u_snow, snow / d * u_rho_s)


def draft(thickness: Column, freeboard: Column) -> Column:
    return thickness - freeboard


def ice_density(myi_fraction: Column, fyi: float = 916.7, myi: float = 882.0) -> Column:
    return F.lit(fyi) - myi_fraction * F.lit(fyi - myi)


def dynamic_topography(sla: Column, mdt: Column, u_sla: Column, u_mdt: Column) -> tuple[Column, Column]:
    return sla + mdt, hypot(u_mdt / math.sqrt(3.0), u_sla)


def seasonal_snow_density(day: Column, winter_start: Column) -> Column:
    """Linear growth over the season from 15 October; t in months of a 182-day season."""
    t = F.datediff(day, winter_start) / F.lit(182.0) * 6.0
    return F.lit(6.5) * t + F.lit(274.51)


def winter_start(day: Column) -> Column:
    """15 October of the winter that the day belongs to."""
    year = F.year(day) - F.when(F.month(day) >= 10, F.lit(0)).otherwise(F.lit(1))
    return F.make_date(year, F.lit(10), F.lit(15))


def peakiness_range_correction(pp: Column) -> Column:
    """Cubic up to 0.1, linear to 0.25 m at 0.33, constant beyond."""
    at = lambda x: ((-1390.0 * x + 339.0) * x - 28.4) * x + 0.994
    knee = at(0.1)
    cubic = ((F.lit(-1390.0) * pp + 339.0) * pp - 28.4) * pp + 0.994
    slope = (0.25 - knee) / 0.23
    return F.when(pp > 0.33, F.lit(0.25)).when(pp > 0.1, (pp - 0.1) * slope + knee).otherwise(cubic)


def pulse_deblurring(epss: Column, slope: float = 5.0) -> Column:
    """Elevation change for negative peakiness-dependent delays."""
    eps = epss * 0.5 * SPEED_OF_LIGHT
    return F.when(eps < 0, eps / slope).otherwise(F.lit(0.0))


def drift_correction(value: Column, start: Column, base_year: int, base_month: int, factor: float) -> Column:
    """Monthly instrument drift relative to a base month."""
    months = (F.lit(base_year) - F.year(start)) * 12 + (F.lit(base_month) - F.month(start))
    return value + F.lit(factor) * months


def sea_level_uncertainty(distance: Column, u_min: float, u_max: float, d_max: float) -> Column:
    """Grows with the square of the distance to the next tie point up to d_max."""
    return F.lit(u_min) + F.lit(u_max - u_min) * square(F.least(distance / F.lit(float(d_max)), F.lit(1.0)))


def sub_cycle(track: Column, tracks: int = 840) -> tuple[Column, Column]:
    """(sub-cycle, relative track) of an absolute track number."""
    return F.floor(track / tracks).cast("long"), F.pmod(track, F.lit(tracks))


def velocity(x: Column, y: Column, z: Column) -> Column:
    return hypot(x, y, z)


def footprint_pulse_limited(r: Column, bandwidth: float) -> Column:
    """Area of the pulse-limited footprint, square kilometres."""
    return F.lit(math.pi) * (r * SPEED_OF_LIGHT / bandwidth) / 1e6


def footprint_sar(r: Column, v: Column, ptr_width: float, burst: float, wavelength: float, widening: float = 1.0, radius: float = 6371000.0) -> Column:
    across = F.sqrt(F.lit(SPEED_OF_LIGHT * ptr_width) * r / (1.0 + r / radius))
    along = F.lit(wavelength) * r / (2.0 * v * burst)
    return 2.0 * across * F.lit(widening) * along


def _decibel(x: Column) -> Column:
    return F.lit(10.0) * F.log10(x)


def sigma0(received: Column, sent: Column, r: Column, area: Column, wavelength: float, gain: float, loss: float = 1.0, bias: float = 0.0) -> Column:
    """Radar equation in dB. Non-positive power gives NULL."""
    k = F.lit((4 * math.pi) ** 3 * loss / (wavelength**2 * gain**2)) * F.pow(r, F.lit(4.0)) / area
    ratio = F.try_divide(received, sent)
    return F.when(ratio > 0, _decibel(ratio) + _decibel(k) + F.lit(bias))


def sigma0_pulse_limited(peak: Column, sent: Column, r: Column, noise: Column | float = 0.0, bandwidth: float = 3.2e8, **radar) -> Column:
    noise = noise if isinstance(noise, Column) else F.lit(float(noise))
    return sigma0(peak + noise, sent, r, footprint_pulse_limited(r, bandwidth), **radar)


# Monthly snow climatology fits of Warren et al. (1999): c0, x, y, xy, x2, y2, rms, trend, trend error,
# interannual variability; snow depth (cm), then snow water equivalent (cm); January to December.
W99_SNOW_DEPTH = (
    (28.01, 0.1270, -1.1833, -0.1164, -0.0051, 0.0243, 7.6, -0.06, 0.07, 4.6),
    (30.28, 0.1056, -0.5908, -0.0263, -0.0049, 0.0044, 7.9, -0.06, 0.08, 5.5),
    (33.89, 0.5486, -0.1996, 0.0280, 0.0216, -0.0176, 9.4, -0.04, 0.10, 6.2),
    (36.80, 0.4046, -0.4005, 0.0256, 0.0024, -0.0641, 9.4, -0.09, 0.09, 6.1),
    (36.93, 0.0214, -1.1795, -0.1076, -0.0244, -0.0142, 10.6, -0.21, 0.09, 6.3),
    (36.59, 0.7021, -1.4819, -0.1195, -0.0009, -0.0603, 14.1, -0.16, 0.12, 8.1),
    (11.02, 0.3008, -1.2591, -0.0811, -0.0043, -0.0959, 9.5, 0.02, 0.10, 6.7),
    (4.64, 0.3100, -0.6350, -0.0655, 0.0059, -0.0005, 4.6, -0.01, 0.05, 3.3),
    (15.81, 0.2119, -1.0292, -0.0868, -0.0177, -0.0723, 7.8, -0.03, 0.06, 3.8),
    (22.66, 0.3594, -1.3483, -0.1063, 0.0051, -0.0577, 8.0, -0.08, 0.06, 4.0),
    (25.57, 0.1496, -1.4643, -0.1409, -0.0079, -0.0258, 7.9, -0.05, 0.07, 4.3),
    (26.67, -0.1876, -1.4229, -0.1413, -0.0316, -0.0029, 8.2, -0.06, 0.07, 4.8),
)
W99_WATER_EQUIVALENT = (
    (8.37, -0.0270, -0.3400, -0.0319, -0.0056, -0.0005, 2.5, -0.005, 0.024, 1.6),
    (9.43, 0.0058, -0.1309, 0.0017, -0.0021, -0.0072, 2.6, -0.007, 0.028, 1.8),
    (10.74, 0.1618, 0.0276, 0.0213, 0.0076, -0.0125, 3.1, 0.007, 0.032, 2.1),
    (11.67, 0.0841, -0.1328, 0.0081, -0.0003, -0.0301, 3.2, -0.013, 0.032, 2.1),
    (11.80, -0.0043, -0.4284, -0.0380, -0.0071, -0.0063, 3.5, -0.047, 0.033, 2.2),
    (12.48, 0.2084, -0.5739, -0.0468, -0.0023, -0.0253, 4.9, -0.030, 0.044, 2.9),
    (4.01, 0.0970, -0.4930, -0.0333, -0.0026, -0.0343, 3.5, 0.008, 0.037, 2.4),
    (1.08, 0.0712, -0.1450, -0.0155, 0.0014, -0.0000, 1.1, -0.001, 0.012, 0.8),
    (3.84, 0.0393, -0.2107, -0.0182, -0.0053, -0.0190, 2.0, -0.003, 0.016, 1.0),
    (6.24, 0.1158, -0.2803, -0.0215, 0.0015, -0.0176, 2.3, -0.005, 0.021, 1.4),
    (7.54, 0.0567, -0.3201, -0.0284, -0.0032, -0.0129, 2.4, -0.000, 0.023, 1.5),
    (8.00, -0.0540, -0.3650, -0.0362, -0.0112, -0.0035, 2.5, -0.003, 0.024, 1.5),
)
WATER_DENSITY = 1024.0


def _monthly(table, place: int, month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(row[place])) for row in table]), month.cast("int"))


def snow_climatology(x: Column, y: Column, month: Column) -> dict[str, Column]:
    """Depth (m), density (kg/m3) and uncertainties of the quadratic monthly fits; x, y in degrees of arc from the pole."""

    def surface(table) -> Column:
        c = [_monthly(table, k, month) for k in range(6)]
        return (c[0] + c[1] * x + c[2] * y + c[3] * x * y + c[4] * x * x + c[5] * y * y) * 0.01

    depth, swe = surface(W99_SNOW_DEPTH), surface(W99_WATER_EQUIVALENT)
    spread = (_monthly(W99_SNOW_DEPTH, 6, month) + _monthly(W99_SNOW_DEPTH, 9, month)) * 0.01
    fit = (_monthly(W99_WATER_EQUIVALENT, 6, month) + _monthly(W99_WATER_EQUIVALENT, 9, month)) * 0.01
    return {
        "snow_depth": depth,
        "snow_density": F.try_divide(swe, depth) * WATER_DENSITY,
        "snow_depth_uncertainty": spread,
        "snow_density_uncertainty": F.try_divide(fit, depth) * WATER_DENSITY,
    }


def scale_first_year_snow(depth: Column, u_depth: Column, myi: Column, u_myi: Column, factor: float) -> tuple[Column, Column]:
    """Less snow on first-year ice; the ice type's uncertainty adds a term."""
    f = (F.lit(1.0) - myi) * F.lit(factor)
    scaled = depth - f * depth
    return scaled, u_depth - f * u_depth + scaled * f * u_myi
