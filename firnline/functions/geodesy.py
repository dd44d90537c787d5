"""Map projection, grid cells, distances and angles as Column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
EARTH_RADIUS_M = 6371000.0


@dataclass(frozen=True)
class Grid:
    """A regular grid in the plane of a polar azimuthal equal-area projection. Sizes in metres; cell (0, 0) has its
    corner at (-xsize/2, -ysize/2) of the projection centre."""

    grid_id: str
    hemisphere: str = "north"
    lon_0: float = 0.0
    xsize: float = 10_800_000.0
    ysize: float = 10_800_000.0
    dx: float = 12_500.0
    dy: float = 12_500.0
    xoff: float = 0.0
    yoff: float = 0.0

    @property
    def numx(self) -> int:
        return int(self.xsize / self.dx)

    @property
    def numy(self) -> int:
        return int(self.ysize / self.dy)


def _authalic(sin_phi: Column, e: float) -> Column:
    es = F.lit(e) * sin_phi
    return F.lit(1 - e * e) * (sin_phi / (1 - es * es) - F.lit(1 / (2 * e)) * F.log((1 - es) / (1 + es)))


def laea_polar(lon: Column, lat: Column, hemisphere: str = "north", lon_0: float = 0.0) -> tuple[Column, Column]:
    """Ellipsoidal polar Lambert azimuthal equal-area, metres (Snyder 1987, eqs. 3-12 and 24-23 to 24-26)."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    q_pole = 1 - (1 - e * e) / (2 * e) * math.log((1 - e) / (1 + e))
    sign = 1.0 if hemisphere == "north" else -1.0
    q = _authalic(F.sin(F.radians(lat)), e)
    rho = F.lit(WGS84_A) * F.sqrt(F.greatest(F.lit(q_pole) - F.lit(sign) * q, F.lit(0.0)))
    angle = F.radians(lon - F.lit(lon_0))
    return rho * F.sin(angle), F.lit(-sign) * rho * F.cos(angle)


def stereographic_polar(lon: Column, lat: Column, lat_ts: float = 70.0, lon_0: float = -90.0) -> tuple[Column, Column]:
    """Ellipsoidal north polar stereographic with true scale at lat_ts, metres (Snyder 1987, 21-33 and 15-9)."""
    e = math.sqrt(WGS84_F * (2 - WGS84_F))

    def t_of(phi: float) -> float:
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    ts = math.radians(lat_ts)
    scale = WGS84_A * math.cos(ts) / math.sqrt(1 - (e * math.sin(ts)) ** 2) / t_of(ts)
    phi = F.radians(lat)
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(e / 2))
    angle = F.radians(lon - F.lit(lon_0))
    return F.lit(scale) * t * F.sin(angle), F.lit(-scale) * t * F.cos(angle)


def cell_index(x: Column, y: Column, grid: Grid) -> tuple[Column, Column]:
    """(xi, yj) by floor; NULL outside the grid (negative indices do not wrap)."""
    xi = F.floor((x - F.lit(grid.xoff) + F.lit(grid.xsize / 2)) / F.lit(grid.dx)).cast("int")
    yj = F.floor((y - F.lit(grid.yoff) + F.lit(grid.ysize / 2)) / F.lit(grid.dy)).cast("int")
    inside = (xi >= 0) & (xi < grid.numx) & (yj >= 0) & (yj < grid.numy)
    return F.when(inside, xi), F.when(inside, yj)


def with_cell(df: DataFrame, grid: Grid, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    x, y = laea_polar(F.col(lon), F.col(lat), grid.hemisphere, grid.lon_0)
    xi, yj = cell_index(x, y, grid)
    return df.withColumns({"xi": xi, "yj": yj})


def grid_cells(spark: SparkSession, grid: Grid) -> DataFrame:
    """The grid as a dimension table: yj, xi, xc, yc (cell centres)."""
    cells = spark.range(grid.numx * grid.numy)
    yj, xi = F.floor(F.col("id") / grid.numx).cast("int"), (F.col("id") % grid.numx).cast("int")
    xc = (xi + 0.5) * grid.dx - grid.xsize / 2 + grid.xoff
    yc = (yj + 0.5) * grid.dy - grid.ysize / 2 + grid.yoff
    return cells.select(yj.alias("yj"), xi.alias("xi"), xc.alias("xc"), yc.alias("yc"))


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = EARTH_RADIUS_M) -> Column:
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def wrap_longitude(lon: Column) -> Column:
    """To [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def angular_distance(a: Column, b: Column) -> Column:
    """Circular difference in degrees, at most 180."""
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, F.lit(360.0) - d)


def ellipsoid_delta(lat: Column, a1: float, f1: float, a2: float, f2: float) -> Column:
    """Height change between two ellipsoids: -(da cos^2 + db sin^2)."""
    da, db = a2 - a1, a2 * (1 - f2) - a1 * (1 - f1)
    phi = F.radians(lat)
    return -(F.lit(da) * F.pow(F.cos(phi), 2) + F.lit(db) * F.pow(F.sin(phi), 2))


def mispointing(pitch: Column, roll: Column, yaw: Column) -> Column:
    """Degrees between nadir and the antenna axis after rotations by pitch, roll and yaw (yaw turns about nadir)."""
    del yaw
    return F.degrees(F.acos(F.least(F.cos(F.radians(pitch)) * F.cos(F.radians(roll)), F.lit(1.0))))


# Longitude limits (degrees, wrapping) and the latitude limit of the Southern Ocean sectors.
ANTARCTIC_SEAS = (
    ("indian_ocean", 20.0, 90.0), ("west_pacific", 90.0, 160.0), ("ross_sea", 160.0, 230.0),
    ("amundsen_bellingshausen", 230.0, 300.0), ("weddell_sea", 300.0, 20.0),
)


def longitude_arc(lon: Column, low: float, high: float) -> Column:
    """Whether lon lies in the eastward arc from low to high, both ends included."""
    return F.pmod(lon - F.lit(low), F.lit(360.0)) <= F.lit((high - low) % 360.0)


def antarctic_sea(lon: Column, lat: Column, first_code: int = 2, lat_limit: float = -50.0, seas=ANTARCTIC_SEAS) -> Column:
    """Region code by longitude sector; a later sector wins on shared limits."""
    out = F.lit(0)
    for k, (_, low, high) in enumerate(seas):
        out = F.when(longitude_arc(lon, low, high) & (lat < lat_limit), F.lit(first_code + k)).otherwise(out)
    return out
