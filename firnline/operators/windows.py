"""Ordered window operators. A trajectory is a segment key and a total order within it; each operator uses one
window over (segment, order), so Catalyst shares a single sort.

Windows whose width depends on the data use prefix sums looked up by position, so a frame need not be constant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Track:
    """The segment and order columns of a trajectory."""

    def __init__(self, segment: str | Sequence[str] = "segment_id", order: str | Sequence[str] = "record_idx"):
        self.segment = [segment] if isinstance(segment, str) else list(segment)
        self.order = [order] if isinstance(order, str) else list(order)

    # windows need a running session, so they are made when they are used

    @property
    def whole(self):
        return W.partitionBy(*self.segment)

    @property
    def along(self):
        return self.whole.orderBy(*self.order)

    @property
    def before(self):
        return self.along.rowsBetween(W.unboundedPreceding, 0)

    @property
    def after(self):
        return self.along.rowsBetween(0, W.unboundedFollowing)

    def rows(self, low: int, high: int):
        return self.along.rowsBetween(low, high)

    def position(self) -> Column:
        """0, 1, 2, ... along the segment."""
        return F.row_number().over(self.along) - 1


def odd_window(width: Column, spacing: Column) -> Column:
    """Records in a filter of a width in metres: floor(width / spacing), made odd."""
    return (F.floor(F.floor(width / spacing) / 2) * 2 + 1).cast("int")


def rolling(track: Track, column: Column, half: int) -> dict[str, Column]:
    """Centred mean and sample deviation of the values present in 2 half + 1 records."""
    w = track.rows(-half, half)
    return {"mean": F.avg(column).over(w), "sdev": F.stddev_samp(column).over(w)}


def rolling_by_spacing(df: DataFrame, track: Track, column: str, window: str, prefix: str | None = None) -> DataFrame:
    """Centred mean and sample deviation with an odd window width per row (or segment) given by a column; NULL
    width gives NULL. Prefix sums of count, value and square, joined at the window's ends by position."""
    prefix = prefix or column
    c = F.col(column).cast("double")
    shift = F.avg(c).over(track.whole)  # near the mean, so that squares keep their digits
    d = c - shift
    base = df.withColumns({
        "__pos": track.position(), "__n": F.count(F.lit(1)).over(track.whole), "__shift": shift,
        "__k": F.count(c).over(track.before), "__s": F.coalesce(F.sum(d).over(track.before), F.lit(0.0)),
        "__q": F.coalesce(F.sum(d * d).over(track.before), F.lit(0.0)),
    })
    half = F.floor((F.col(window) - 1) / 2).cast("int")
    base = base.withColumns({
        "__hi": F.least(F.col("__pos") + half, F.col("__n") - 1), "__lo": F.greatest(F.col("__pos") - half, F.lit(0)) - 1,
    })
    sums = base.select(*track.segment, "__pos", "__k", "__s", "__q")

    def at(end: str, tag: str) -> DataFrame:
        return sums.select(*track.segment, F.col("__pos").alias(end), *[F.col(x).alias(f"{x}_{tag}") for x in ("__k", "__s", "__q")])

    out = base.join(at("__hi", "hi"), [*track.segment, "__hi"], "left").join(at("__lo", "lo"), [*track.segment, "__lo"], "left")
    zero = lambda x: F.coalesce(F.col(f"{x}_hi"), F.lit(0)) - F.coalesce(F.col(f"{x}_lo"), F.lit(0))
    n, s, q = zero("__k"), zero("__s"), zero("__q")
    known = F.col(window).isNotNull()
    mean = F.when(known & (n > 0), F.col("__shift") + F.try_divide(s, n))
    sdev = F.when(known & (n > 1), F.sqrt(F.greatest(F.try_divide(q - F.try_divide(s * s, n), n - 1), F.lit(0.0))))
    kept = [F.col(x) for x in df.columns]
    return out.select(*kept, mean.alias(f"{prefix}_rolling_mean"), sdev.alias(f"{prefix}_rolling_sdev"))


def box_smooth(df: DataFrame, track: Track, column: str, window: int | str, out: str | None = None) -> DataFrame:
    """Box mean whose half width shrinks towards the segment's ends (min(i, n - 1 - i, half)), of the values
    present. Prefix sums: inside, those `half` records on and back; at the ends, where the frame shrinks, the first and last
    2 half + 1 of the segment, which every row gets as arrays. Wider windows, and widths in a column (NULL gives NULL), look
    the sums up by position."""
    out = out or f"{column}_smooth"
    half = (window - 1) // 2 if isinstance(window, int) else F.floor((F.col(window) - 1) / 2).cast("int")
    c = F.col(column).cast("double")
    base = df.withColumns({"__i": track.position(), "__n": F.count(F.lit(1)).over(track.whole)})
    if not isinstance(half, int) or half > 64:
        reach = F.least(F.col("__i"), F.col("__n") - 1 - F.col("__i"), F.lit(half))
        width = base.withColumn("__w", 2 * (reach if isinstance(half, int) else F.when(half.isNotNull(), reach)) + 1)
        smooth = rolling_by_spacing(width, track, column, "__w", "__r")
        return smooth.withColumn(out, F.col("__r_rolling_mean")).drop("__i", "__n", "__w", "__r_rolling_mean", "__r_rolling_sdev")
    shift = F.avg(c).over(track.whole)  # near the mean, so that sums keep their digits
    base = base.withColumns({"__shift": shift, "__k": F.count(c).over(track.before), "__s": F.coalesce(F.sum(c - shift).over(track.before), F.lit(0.0))})
    base = base.withColumn("__p", F.struct(F.col("__k").alias("k"), F.col("__s").alias("s")))
    i, n = F.col("__i"), F.col("__n")
    everything = track.along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    base = base.withColumns({
        "__lead": F.lead("__p", half).over(track.along), "__lag": F.lag("__p", half + 1).over(track.along),
        "__first": F.collect_list(F.when(i <= 2 * half, F.col("__p"))).over(everything), "__last": F.collect_list(F.when(i >= n - 1 - 2 * half, F.col("__p"))).over(everything),
    })
    none = F.struct(F.lit(0).cast("long").alias("k"), F.lit(0.0).alias("s"))
    from_start = (i <= n - 1 - i) & (i < half)  # the frame is 0 .. 2 i
    to_end = ~from_start & (n - 1 - i < half)  # the frame is 2 i - n + 1 .. n - 1
    offset = F.greatest(n - 1 - 2 * half, F.lit(0))  # the position of the first of __last
    high = F.when(from_start, F.get("__first", (2 * i).cast("int"))).when(to_end, F.element_at("__last", -1)).otherwise(F.col("__lead"))
    before = 2 * i - n  # the last record that the frame leaves out
    low = F.when(from_start, none).when(to_end, F.when(before >= 0, F.get("__last", (before - offset).cast("int"))).otherwise(none)).otherwise(F.coalesce("__lag", none))
    base = base.withColumns({"__high": high, "__low": low})
    count = F.col("__high.k") - F.col("__low.k")
    value = F.when(count > 0, F.col("__shift") + (F.col("__high.s") - F.col("__low.s")) / count)
    return base.withColumn(out, value).drop("__i", "__n", "__shift", "__k", "__s", "__p", "__lead", "__lag", "__first", "__last", "__high", "__low")


def neighbours(track: Track, column: Column, x: Column) -> dict[str, Column]:
    """The nearest present values on both sides (the row's own included), with their coordinates."""
    point = F.when(column.isNotNull(), F.struct(x.alias("x"), column.alias("y")))
    return {"left": F.last(point, ignorenulls=True).over(track.before), "right": F.first(point, ignorenulls=True).over(track.after)}


def _between(left: Column, right: Column, x: Column) -> Column:
    part = F.try_divide(x - left["x"], right["x"] - left["x"])
    return left["y"] + part * (right["y"] - left["y"])


def fill_gaps(track: Track, column: Column, x: Column, edges: str = "null") -> Column:
    """Linear interpolation over x. edges: "null" leaves the ends open (and everything with fewer than two values),
    "hold" extends the first and last values."""
    n = neighbours(track, column, x)
    left, right = n["left"], n["right"]
    inside = F.when(column.isNotNull(), column).when(left.isNotNull() & right.isNotNull(), _between(left, right, x))
    if edges == "null":
        enough = F.count(column).over(track.whole) >= 2
        return F.when(enough, inside).otherwise(column)
    if edges == "hold":
        return F.coalesce(inside, left["y"], right["y"])
    raise ValueError(f"unknown edge rule {edges!r}")


def extrapolate_gaps(df: DataFrame, track: Track, column: str, x: str, out: str) -> DataFrame:
    """Linear interpolation that goes on beyond the ends along the outer two values; one value is held, none is 0."""
    c, at = F.col(column), F.col(x).cast("double")
    point = F.when(c.isNotNull(), F.struct(at.alias("x"), c.alias("y")))
    base = df.withColumns({"__p": point, "__a": F.count(c).over(track.before), "__z": F.count(c).over(track.after)})
    pick = lambda k, at: F.max(F.when(F.col(k) == at, F.col("__p"))).over(track.whole)
    base = base.withColumns({"__a1": pick("__a", 1), "__a2": pick("__a", 2), "__z1": pick("__z", 1), "__z2": pick("__z", 2)})
    n = neighbours(track, c, at)
    left, right = n["left"], n["right"]
    line = lambda p, q: F.coalesce(_between(F.col(p), F.col(q), at), F.col(p)["y"])
    value = (
        F.when(c.isNotNull(), c)
        .when(left.isNotNull() & right.isNotNull(), _between(left, right, at))
        .when(right.isNotNull(), line("__a1", "__a2"))
        .when(left.isNotNull(), line("__z1", "__z2"))
        .otherwise(F.lit(0.0))
    )
    return base.withColumn(out, value).drop("__p", "__a", "__z", "__a1", "__a2", "__z1", "__z2")


def box_sum(track: Track, column: Column, window: int) -> Column:
    """Moving sum over the window's width: a zero-padded convolution with a box."""
    half = window // 2
    return F.coalesce(F.sum(column).over(track.rows(-half, window - 1 - half)), F.lit(0.0)) / float(window)


def uniform_reflect(df: DataFrame, track: Track, column: str, window: int, out: str) -> DataFrame:
    """Moving mean that reflects the series at its ends (d c b a | a b c d | d c b a)."""
    half = window // 2
    back = window - 1 - half
    c = F.col(column)
    pos, n = track.position(), F.count(F.lit(1)).over(track.whole)
    value = F.coalesce(F.sum(c).over(track.rows(-half, back)), F.lit(0.0))
    for k in range(half):  # the k + 1 bins beyond the start are the first ones again
        lead = F.coalesce(F.sum(F.when(F.col("__pos") <= k, c)).over(track.whole), F.lit(0.0))
        value = value + F.when(F.col("__pos") == half - 1 - k, lead).otherwise(0.0)
    for k in range(back):
        tail = F.coalesce(F.sum(F.when(F.col("__n") - 1 - F.col("__pos") <= k, c)).over(track.whole), F.lit(0.0))
        value = value + F.when(F.col("__n") - 1 - F.col("__pos") == back - 1 - k, tail).otherwise(0.0)
    return df.withColumns({"__pos": pos, "__n": n}).withColumn(out, value / float(window)).drop("__pos", "__n")


def islands(df: DataFrame, track: Track, condition: Column, out: str = "island") -> DataFrame:
    """A number for each run of equal condition values (NULL equals NULL), from 0 along the segment."""
    changed = F.when(F.lag(condition).over(track.along).eqNullSafe(condition), 0).otherwise(1)
    first = F.row_number().over(track.along) == 1
    return df.withColumn("__c", F.when(first, 0).otherwise(changed)).withColumn(out, F.sum("__c").over(track.before).cast("long")).drop("__c")


def run_lengths(df: DataFrame, track: Track, column: str) -> DataFrame:
    """Runs of equal values: segment, island, value, start position and length."""
    base = islands(df.withColumn("__pos", track.position()), track, F.col(column))
    return base.groupBy(*track.segment, "island").agg(
        F.first(column).alias("value"), F.min("__pos").cast("long").alias("start"), F.count(F.lit(1)).alias("length")
    )


def flag_distance(track: Track, flag: Column, position: Column) -> Column:
    """Records to the nearest flagged row in either direction; the segment's length where there is none."""
    at = F.when(flag, position)
    n = F.count(F.lit(1)).over(track.whole)
    ahead = F.coalesce(position - F.max(at).over(track.before), n)
    behind = F.coalesce(F.min(at).over(track.after) - position, n)
    return F.least(ahead, behind)


def first_last_index(track: Track, flag: Column, position: Column) -> tuple[Column, Column]:
    """Positions of the first and last flagged rows of the segment, NULL if there is none."""
    at = F.when(flag, position)
    return F.min(at).over(track.whole), F.max(at).over(track.whole)


def orbit_flag(track: Track, latitude: Column) -> Column:
    """1 where latitude falls, 0 where it rises; the first row has the second one's."""
    step = F.coalesce(latitude - F.lag(latitude).over(track.along), F.lead(latitude).over(track.along) - latitude)
    return F.when(step < 0, 1).otherwise(0)


def fill_nearest(track: Track, column: Column, position: Column, reach: int) -> Column:
    """The nearest present value within `reach` records; the earlier one of two equally near."""
    n = neighbours(track, column, position)
    dl, dr = position - n["left"]["x"], n["right"]["x"] - position
    left_first = n["right"].isNull() | (dl <= dr)
    near = F.when(n["left"].isNotNull() & left_first, F.when(dl <= reach, n["left"]["y"])).otherwise(F.when(dr <= reach, n["right"]["y"]))
    return F.coalesce(column, near)
