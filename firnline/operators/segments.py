"""Splitting, trimming and merging trajectories: every cut is a change flag, its running sum the new segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.operators.windows import Track, islands


def split_where(df: DataFrame, track: Track, cut: Column, out: str = "part") -> DataFrame:
    """A new part starts at every row where cut holds (NULL: no cut); parts count from 0."""
    return df.withColumn(out, F.sum(F.when(F.coalesce(cut, F.lit(False)), 1).otherwise(0)).over(track.before).cast("long"))


def split_at_time_gaps(df: DataFrame, track: Track, time: str, seconds: float, out: str = "part") -> DataFrame:
    gap = seconds_of(F.col(time)) - F.lag(seconds_of(F.col(time))).over(track.along)
    return split_where(df.withColumn("__gap", gap), track, F.col("__gap") > seconds, out).drop("__gap")


def seconds_of(time: Column) -> Column:
    """Seconds since the epoch with fractions, for timestamps with or without zone."""
    return F.unix_micros(time.cast("timestamp")).cast("double") / 1e6


def split_by_change(df: DataFrame, track: Track, column: str, out: str = "part") -> DataFrame:
    """A new part at every change of the column (radar mode, hemisphere); all records stay."""
    return islands(df, track, F.col(column), out)


def split_hemispheres(df: DataFrame, latitude: str, min_latitude: float, out: str = "hemisphere") -> DataFrame:
    """Polar records with the hemisphere they belong to."""
    lat = F.col(latitude)
    return df.filter(F.abs(lat) >= min_latitude).withColumn(out, F.when(lat >= 0, "north").otherwise("south"))


def polar_parts(df: DataFrame, track: Track, latitude: str, min_latitude: float, out: str = "part") -> DataFrame:
    """Contiguous polar stretches, each its own part."""
    polar = F.abs(F.col(latitude)) >= min_latitude
    return islands(df.withColumn("__polar", polar), track, F.col("__polar"), out).filter("__polar").drop("__polar")


def with_run_length(df: DataFrame, track: Track, condition: Column, out: str = "run_length") -> DataFrame:
    base = islands(df.withColumn("__runs_of", condition), track, F.col("__runs_of"), "__run")
    return base.withColumn(out, F.count(F.lit(1)).over(W.partitionBy(*track.segment, "__run"))).drop("__run", "__runs_of")


def small_runs_to_land(df: DataFrame, track: Track, is_ocean: Column, least: int, land: Column, surface: str) -> DataFrame:
    """Ocean runs of fewer than `least` records become land."""
    base = df.withColumn("__ocean", is_ocean)
    base = with_run_length(base, track, F.col("__ocean"), "__len")
    value = F.when(F.col("__ocean") & (F.col("__len") < least), land).otherwise(F.col(surface))
    return base.withColumn(surface, value).drop("__ocean", "__len")


def trim_to(df: DataFrame, track: Track, condition: Column) -> DataFrame:
    """From the first to the last row that satisfies the condition; segments without one vanish."""
    any_before = F.max(F.col("__hit")).over(track.before)
    any_after = F.max(F.col("__hit")).over(track.after)
    base = df.withColumn("__hit", F.when(condition, 1).otherwise(0))
    return base.withColumns({"__b": any_before, "__a": any_after}).filter("__b = 1 and __a = 1").drop("__hit", "__b", "__a")


def split_at_long_runs(df: DataFrame, track: Track, condition: Column, most: int, out: str = "part") -> DataFrame:
    """Runs of more than `most` records with the condition are dropped, and the trajectory is cut there."""
    base = df.withColumn("__cond", F.coalesce(condition, F.lit(False)))
    base = with_run_length(base, track, F.col("__cond"), "__len")
    base = base.withColumn("__gone", F.col("__cond") & (F.col("__len") > most))
    start = F.col("__gone") & ~F.coalesce(F.lag("__gone").over(track.along), F.lit(False))
    base = base.withColumn("__start", start)
    return split_where(base, track, F.col("__start"), out).filter("not __gone").drop("__cond", "__len", "__gone", "__start")


def segment_summary(df: DataFrame, track: Track, time: str, latitude: str = "latitude", longitude: str = "longitude", mode: str | None = None, surface: str | None = None) -> DataFrame:
    """One row per segment: count, time and position range, mode and open-ocean percentages, region name."""
    n = F.count(F.lit(1))
    share = lambda c: F.round(F.lit(100.0) * F.count_if(c) / n, 6)
    out = [
        n.alias("n_records"), F.min(time).alias("start_time"), F.max(time).alias("stop_time"), F.min(latitude).alias("lat_min"),
        F.max(latitude).alias("lat_max"), F.min(longitude).alias("lon_min"), F.max(longitude).alias("lon_max"),
    ]
    if mode:
        out += [share(F.col(mode) == k).alias(f"{name}_mode_percent") for k, name in enumerate(("lrm", "sar", "sin"))]
    if surface:
        out.append(share(F.col(surface) == 1).alias("open_ocean_percent"))
    base = df.groupBy(*track.segment).agg(*out)
    region = F.when(F.col("lat_min") > 0, "north").when(F.col("lat_max") < 0, "south").otherwise("global")
    return base.withColumn("region_name", region)


def connect_segments(summary: DataFrame, platform: str, seconds: float, out: str = "chain", start: str = "start_time", stop: str = "stop_time") -> DataFrame:
    """Segments of a platform whose next one starts within `seconds` of the latest stop so far share a chain."""
    w = W.partitionBy(platform).orderBy(start, stop)
    latest = F.max(seconds_of(F.col(stop))).over(w.rowsBetween(W.unboundedPreceding, -1))
    base = summary.withColumn("__cut", F.when(seconds_of(F.col(start)) - latest <= seconds, 0).otherwise(1))
    return base.withColumn(out, F.sum("__cut").over(w.rowsBetween(W.unboundedPreceding, 0)) - 1).drop("__cut")


def append_without_overlap(parts: DataFrame, chain: str, part: str, time: str) -> DataFrame:
    """Records of consecutive parts of a chain; a part's records up to the stop of all parts before are dropped."""
    stops = parts.groupBy(chain, part).agg(F.max(time).alias("__stop"))
    w = W.partitionBy(chain).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    stops = stops.withColumn("__seen", F.max("__stop").over(w)).drop("__stop")
    return parts.join(stops, [chain, part]).filter(F.col("__seen").isNull() | (F.col(time) > F.col("__seen"))).drop("__seen")


def enough_records(df: DataFrame, track: Track, least: int) -> DataFrame:
    return df.withColumn("__n", F.count(F.lit(1)).over(track.whole)).filter(F.col("__n") >= least).drop("__n")


def fill_time_gaps(df: DataFrame, track: Track, time: str, interpolate: list[str], step_tolerance: float = 0.02) -> DataFrame:
    """Records inserted where the step exceeds the segment's median step by the tolerance: time and the interpolated
    columns are linear between the neighbours, all other columns NULL; `is_inserted` marks them."""
    t = seconds_of(F.col(time))
    lead = {c: F.lead(c).over(track.along) for c in interpolate}
    base = df.withColumns({"__t": t, "__dt": F.lead(t).over(track.along) - t} | {f"__next_{c}": x for c, x in lead.items()})
    steps = base.filter("__dt is not null").groupBy(*track.segment).agg(F.median("__dt").alias("__median"))
    base = base.join(steps, track.segment, "left")
    gap = F.col("__dt") > F.col("__median") * (1 + step_tolerance)
    missing = F.when(gap, F.greatest(F.round(F.col("__dt") / F.col("__median")) - 1, F.lit(0))).otherwise(0).cast("int")
    new = base.filter(missing > 0).withColumn("__m", missing).withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__m"))))
    part = F.col("__k") / (F.col("__m") + 1)
    moved = F.timestamp_micros(F.round((F.col("__t") + part * F.col("__dt")) * 1e6).cast("long"))
    values = {c: F.col(c) + part * (F.col(f"__next_{c}") - F.col(c)) for c in interpolate}
    kinds = dict(df.dtypes)
    inserted = new.select(
        *[
            (F.col(c) if c in track.segment else moved.cast(kinds[c]) if c == time else values[c] if c in values else F.lit(None).cast(kinds[c])).alias(c)
            for c in df.columns
        ],
        F.lit(True).alias("is_inserted"),
    )
    return df.withColumn("is_inserted", F.lit(False)).unionByName(inserted)
