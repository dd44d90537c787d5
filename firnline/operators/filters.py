"""Filters that null values (value and uncertainty together) and report the rows they touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.functions.vocab import is_surface
from firnline.operators.windows import Track


def _clear(df: DataFrame, targets: Sequence[str], hit: Column) -> DataFrame:
    hit = F.coalesce(hit, F.lit(False))
    names = [c for t in targets for c in (t, f"{t}_uncertainty") if c in df.columns]
    return df.withColumns({c: F.when(~hit, F.col(c)) for c in names})


def valid_range(df: DataFrame, source: str, low: float | None, high: float | None, targets: Sequence[str], flag: str | None = None) -> DataFrame:
    """Targets outside strict bounds of the source become NULL; a NULL source is never outside."""
    c = F.col(source)
    out = F.lit(False)
    if low is not None:
        out = out | (c < low)
    if high is not None:
        out = out | (c > high)
    hit = F.coalesce(out, F.lit(False))
    base = df.withColumn("__hit", hit)
    base = _clear(base, targets, F.col("__hit"))
    return base.withColumn(flag, F.col("__hit")).drop("__hit") if flag else base.drop("__hit")


def remove_non_ocean(df: DataFrame, surface: str, targets: Sequence[str]) -> DataFrame:
    return _clear(df, targets, is_surface(F.col(surface), "land", "land_ice"))


def remove_surface_types(df: DataFrame, surface: str, names: Sequence[str], targets: Sequence[str]) -> DataFrame:
    return _clear(df, targets, is_surface(F.col(surface), *names))


def orbit_direction(df: DataFrame, track: Track, latitude: str, keep: str, targets: Sequence[str]) -> DataFrame:
    """Targets of the other direction become NULL; the direction of a record is that of the step to the next."""
    step = F.lead(latitude).over(track.along) - F.col(latitude)
    base = df.withColumn("__step", step)
    return _clear(base, targets, F.col("__step") < 0 if keep == "ascending" else F.col("__step") > 0).drop("__step")


def marginal_ice_zone(df: DataFrame, least: int, targets: Sequence[str], flag: str = "flag_miz") -> DataFrame:
    return _clear(df, targets, F.col(flag) >= least) if flag in df.columns else df


def transfer_nulls(df: DataFrame, source: str, targets: Sequence[str]) -> DataFrame:
    return _clear(df, targets, F.col(source).isNull())


def wave_zone_flag(distance: Column, wave_height: Column, sic: Column, far: float, high: float, sic_least: float = 15.0) -> Column:
    """1 where the record is near the ice edge, in high waves and in ice."""
    return F.when((distance <= far) & (wave_height >= high) & (sic >= sic_least), 1).otherwise(0).cast("tinyint")


def proximity_flag(distance: Column, sic: Column, width_mean: Column, peakiness_sdev: Column, far: float, sic_most: float, width_least: float, sdev_most: float) -> Column:
    """1 near low ice concentration; 2 where concentration, edge width and peakiness variability agree."""
    near = (distance <= far) & sic.isNotNull()
    sure = near & (sic <= sic_most) & (width_mean >= width_least) & (peakiness_sdev <= sdev_most)
    return F.when(sure, 2).when(near, 1).otherwise(0).cast("tinyint")


def edge_transitions(df: DataFrame, track: Track, sic: str, threshold: float = 15.0, out: str = "is_ice_edge") -> DataFrame:
    """Rows where the ice test changes, with finite concentrations before, at and after."""
    c = F.col(sic)
    before, after = F.lag(c).over(track.along), F.lead(c).over(track.along)
    edge = ((c > threshold) != (before > threshold)) & after.isNotNull()
    return df.withColumn(out, F.coalesce(edge, F.lit(False)))


def tie_point_distance_filter(df: DataFrame, track: Track, distance: str, most: float, targets: Sequence[str], tie: str, edges_only: bool = False) -> DataFrame:
    """Targets farther than `most` from a tie point; with edges_only just before the first and after the last one."""
    hit = F.col(distance) > most
    base = df
    if edges_only:
        seen = F.max(F.col(tie).cast("int"))
        base = base.withColumn("__inner", (seen.over(track.before) == 1) & (seen.over(track.after) == 1))
        hit = hit & ~F.col("__inner")
    out = _clear(base.withColumn("__hit", hit), targets, F.col("__hit"))
    return out.drop("__hit", "__inner")


def sparse_sections(df: DataFrame, track: Track, surface: str, tie: str, least: int, targets: Sequence[str]) -> DataFrame:
    """Ocean sections between land runs with fewer than `least` tie points are cleared."""
    from firnline.operators.windows import islands
    from pyspark.sql import Window as W

    land = is_surface(F.col(surface), "land", "land_ice")
    base = islands(df.withColumn("__land", land), track, F.col("__land"), "__part")
    count = F.sum(F.col(tie).cast("int")).over(W.partitionBy(*track.segment, "__part"))
    base = base.withColumn("__ties", count)
    return _clear(base, targets, ~F.col("__land") & (F.col("__ties") < least)).drop("__land", "__part", "__ties")
