"""Gridded products from along-track records: prefilters, gridding, statistics, uncertainties and flags in one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions.geodesy import Grid, with_cell
from firnline.operators import filters, grid as G
from firnline.operators.windows import Track


@dataclass(frozen=True)
class GriddedProduct:
    """A period's grid. methods: column -> grid method. prefilter: the column whose NULLs clear the others."""

    grid: Grid
    methods: Mapping[str, str]
    least: int = 1
    prefilter: str | None = None
    miz_least: int | None = None
    orbit: str | None = None
    period_days: int = 30
    classifier_parameters: Sequence[str] = ()
    quality_rules: Mapping[str, Mapping] = field(default_factory=dict)
    sic_least: float = 70.0
    orbit_latitude: float = 88.0

    def records(self, df: DataFrame, track: Track) -> DataFrame:
        targets = [c for c in self.methods if c in df.columns and c not in ("longitude", "latitude", "time", "surface_type")]
        if self.orbit:
            df = filters.orbit_direction(df, track, "latitude", self.orbit, targets)
        if self.miz_least is not None:
            df = filters.marginal_ice_zone(df, self.miz_least, targets)
        if self.prefilter:
            df = filters.transfer_nulls(df, self.prefilter, [t for t in targets if t != self.prefilter])
        return with_cell(df, self.grid).filter(F.col("xi").isNotNull() & F.col("yj").isNotNull())

    def cells(self, df: DataFrame, track: Track | None = None, first_day=None) -> DataFrame:
        """One row per non-empty cell. All partial aggregates share one shuffle by cell."""
        rows = self.records(df, track or Track())
        wanted = {c: m for c, m in self.methods.items() if m != "none" and c in rows.columns}
        out = [F.when(F.count(c) >= self.least, G._method(m, F.col(c))).alias(c) for c, m in wanted.items()]
        out += [F.lit(None).cast("double").alias(c) for c, m in self.methods.items() if m != "none" and c not in rows.columns]
        surface, sit = F.col("surface_type"), F.col("sea_ice_thickness") if "sea_ice_thickness" in rows.columns else None
        out += [x.alias(k) for k, x in G.surface_statistics(surface, sit).items()]
        if "radar_freeboard_uncertainty" in rows.columns:
            out.append(G.inverse_variance(F.col("radar_freeboard_uncertainty")).alias("radar_freeboard_l3_uncertainty"))
        if self.classifier_parameters:
            stats = G.classifier_statistics(self.classifier_parameters, ("mean", "sdev"), surface, ("all", "lead", "sea_ice", "ocean"))
            out += [x.alias(k) for k, x in stats.items()]
        cells = rows.groupBy(*G.CELL).agg(*out)
        if first_day is not None and sit is not None:
            day = F.datediff(F.to_date("time"), F.lit(first_day).cast("date"))
            cells = cells.join(G.temporal_coverage(rows, day, sit.isNotNull(), self.period_days), list(G.CELL), "left")
        if {"sea_ice_density", "snow_depth", "radar_freeboard_l3_uncertainty", "sea_ice_thickness"} <= set(cells.columns):
            cells = cells.withColumns(G.grid_uncertainties())
        if "sea_ice_concentration" in cells.columns and "latitude" in cells.columns and sit is not None:
            flag = G.status_flag(F.col("sea_ice_concentration"), F.col("latitude"), F.col("is_land"), F.col("n_valid_waveforms"), F.col("sea_ice_thickness"), self.sic_least, self.orbit_latitude)
            cells = cells.withColumn("status_flag", flag)
        if self.quality_rules and sit is not None:
            cells = cells.withColumn("quality_flag", G.quality_flag(F.col("sea_ice_thickness"), self.quality_rules))
        return cells


def daily_product(parts: Sequence[DataFrame], required: str = "sea_ice_freeboard") -> DataFrame:
    """Records of many files merged, without those that lack the required parameter."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).filter(F.col(required).isNotNull())


def periods(first, last, kind: str, spark: SparkSession) -> DataFrame:
    """Day, ISO-week or month segments of a period: start and stop dates."""
    unit = {"day": "day", "isoweek": "week", "month": "month"}[kind]
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.groupBy(F.date_trunc(unit, "day").alias("k")).agg(F.min("day").alias("start"), F.max("day").alias("stop")).drop("k").orderBy("start")
