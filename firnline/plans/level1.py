"""Level-1 preprocessing as one plan: polar ocean segments are cut out of source files, connected ones are merged.

The processors of the three kinds of sources differ in how a file is cut to polar regions: `custom` and `half` orbits by
hemisphere, `full` orbits into every contiguous polar stretch. Processing items (functions of a DataFrame) run at three
stages: post_source_file, post_ocean_segment_extraction and post_merge.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firnline.functions.vocab import SURFACE_TYPES, is_surface
from firnline.operators import segments as S
from firnline.operators.windows import Track

STAGES = ("post_source_file", "post_ocean_segment_extraction", "post_merge")
KINDS = ("custom", "half", "full")


@dataclass(frozen=True)
class Level1:
    """Options; counts are records. hemisphere None keeps both (of a custom orbit there is but one)."""

    kind: str = "custom"
    min_latitude: float = 50.0
    hemisphere: str | None = None
    least_ocean: int | None = None
    gap_seconds: float | None = None
    most_land: int = 1000
    split_modes: bool = False
    connect_seconds: float = 10.0
    least_records: int = 1

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}")


PROCESSORS = {"custom_orbit": "custom", "half_orbit": "half", "full_orbit": "full"}


def processor(name: str, **options) -> Level1:
    """A processor by its name."""
    if name not in PROCESSORS:
        raise ValueError(f"unknown processor {name!r}, known are {sorted(PROCESSORS)}")
    return Level1(PROCESSORS[name], **options)


def polar_ocean_segments(df: DataFrame, track: Track, o: Level1, time: str = "time", latitude: str = "latitude", surface: str = "surface_type", mode: str = "radar_mode") -> tuple[DataFrame, Track]:
    """The polar ocean records of all files, each segment by the track returned."""
    ocean = F.coalesce(is_surface(F.col(surface), "ocean"), F.lit(False))
    if o.least_ocean:
        df = S.small_runs_to_land(df, track, ocean, o.least_ocean, F.lit(SURFACE_TYPES["land"]), surface)
    if o.kind == "full":
        df = S.polar_parts(df, track, latitude, o.min_latitude, "region_part")
    else:
        df = S.split_hemispheres(df, latitude, o.min_latitude, "region_part")
        if o.hemisphere:
            df = df.filter(F.col("region_part") == o.hemisphere)
    track = Track([*track.segment, "region_part"], track.order)
    if o.gap_seconds is not None:
        df, track = S.split_at_time_gaps(df, track, time, o.gap_seconds, "time_part"), Track([*track.segment, "time_part"], track.order)
    df = S.trim_to(df, track, ocean)
    df, track = S.split_at_long_runs(df, track, ~ocean, o.most_land, "land_part"), Track([*track.segment, "land_part"], track.order)
    if o.split_modes:
        df, track = S.split_by_change(df, track, mode, "mode_part"), Track([*track.segment, "mode_part"], track.order)
    return df, track


def preprocess(
    df: DataFrame, track: Track, o: Level1, items: Mapping[str, Sequence[Callable[[DataFrame], DataFrame]]] | None = None, platform: str = "mission", time: str = "time",
    latitude: str = "latitude", surface: str = "surface_type", mode: str = "radar_mode",
) -> DataFrame:
    """Merged polar ocean segments of a platform's files: all columns of df and segment_id, platform/number by start time.
    Segments that start within connect_seconds after those before belong together; records that these cover already go."""
    items = dict(items or {})
    if unknown := set(items) - set(STAGES):
        raise ValueError(f"unknown stages {sorted(unknown)}")

    def run(stage: str, rows: DataFrame) -> DataFrame:
        for item in items.get(stage, ()):
            rows = item(rows)
        return rows

    df = run("post_source_file", df)
    parts, by = polar_ocean_segments(df, track, o, time, latitude, surface, mode)
    parts = run("post_ocean_segment_extraction", parts)
    spans = parts.groupBy(platform, *by.segment).agg(F.min(time).alias("start_time"), F.max(time).alias("stop_time"))
    chains = S.connect_segments(spans, platform, o.connect_seconds, "chain")
    nth = F.row_number().over(W.partitionBy(platform, "chain").orderBy("start_time", "stop_time", *by.segment))
    name = F.concat_ws("/", F.col(platform).cast("string"), F.col("chain").cast("string"))
    chains = chains.select(F.col(platform), *by.segment, name.alias("segment_id"), nth.alias("part_number"))
    merged = S.append_without_overlap(parts.join(chains, [platform, *by.segment]), "segment_id", "part_number", time)
    gone = [c for c in by.segment if c not in track.segment]
    merged = run("post_merge", merged.drop(*gone, "part_number"))
    return S.enough_records(merged, Track("segment_id", [time]), o.least_records)
