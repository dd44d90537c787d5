"""Features of array-valued waveforms by higher-order array functions. Bins that are NULL are skipped; indices in
arguments and results count from 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline.functions.physics import SPEED_OF_LIGHT


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body (or a lambda in it) refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalised(w: Column) -> Column:
    """Power over its peak."""
    return let(F.array_max(w), lambda top: F.transform(w, lambda x: F.try_divide(x, top)))


def present(w: Column) -> Column:
    return F.filter(w, lambda x: x.isNotNull())


def total(w: Column, f=lambda x: x) -> Column:
    return F.aggregate(w, F.lit(0.0), lambda a, x: a + F.coalesce(f(x), F.lit(0.0)))


def mean(w: Column) -> Column:
    """NULL for an empty (or all-NULL) array."""
    return F.try_divide(total(w), F.size(present(w)).cast("double"))


def window(w: Column, first: Column | int, count: Column | int) -> Column:
    """Bins first .. first + count - 1, as far as the array has them."""
    first = first if isinstance(first, Column) else F.lit(first)
    count = count if isinstance(count, Column) else F.lit(count)
    return F.slice(w, (F.greatest(first, F.lit(0)) + 1).cast("int"), F.greatest(count, F.lit(0)).cast("int"))


def peak(w: Column) -> Column:
    return F.array_max(w)


def peak_index(w: Column) -> Column:
    return (F.array_position(w, F.array_max(w)) - 1).cast("int")


def peak_power_db(w: Column) -> Column:
    return F.when(peak(w) > 0, F.lit(10.0) * F.log10(peak(w)))


def scaled_power(counts: Column, linear: Column, power: Column) -> Column:
    """Instrument counts to watts: counts * linear * 1e-9 * 2**power."""
    scale = linear * 1e-9 * F.pow(F.lit(2.0), power)
    return F.transform(counts, lambda x: x * scale)


def window_ranges(delay: Column, n_bins: int, bandwidth: float = 3.2e8) -> Column:
    """Range of each bin from the two-way delay to the window's centre (the user handbook's formula)."""
    step = SPEED_OF_LIGHT / (4.0 * bandwidth)
    first = delay * (SPEED_OF_LIGHT / 2.0) - n_bins * step / 2.0
    return F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)), lambda i: first + i * step)


def tracker_ranges(tracker: Column, nominal_bin: float, width: float, n_bins: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n_bins - 1)), lambda i: tracker + (i - F.lit(nominal_bin)) * width)


def correct_ranges(ranges: Column, correction: Column) -> Column:
    c = F.coalesce(correction, F.lit(0.0))
    return F.transform(ranges, lambda x: x + c)


def peakiness(w: Column, skip: int = 0, norm_bins: Column | int | None = None) -> Column:
    """Peak over sum, times the number of bins (or a given number), after the first `skip` bins."""
    part = F.slice(w, skip + 1, F.greatest(F.size(w) - skip, F.lit(0))) if skip else w
    n = F.size(part) if norm_bins is None else (norm_bins if isinstance(norm_bins, Column) else F.lit(norm_bins))
    return F.try_divide(F.array_max(part), total(part)) * n.cast("double")


def without_noise(w: Column, bins: int = 11) -> Column:
    """The mean of the first bins taken off, negatives set to zero."""
    return let(mean(F.slice(w, 1, bins)), lambda noise: F.transform(w, lambda x: F.greatest(x - noise, F.lit(0.0))))


def side_peakiness(w: Column, pad: int = 1, side: str = "left") -> Column:
    """Peak over the mean of the three bins that end (or start) `pad` bins beside it, times 3."""
    at = peak_index(w)
    first = at - 3 * pad if side == "left" else at + pad
    part = window(w, first, 2 * pad + 1)
    enough = (at - 3 * pad >= 0) if side == "left" else (at + 3 * pad < F.size(w))
    return F.when(enough, F.try_divide(peak(w), mean(part)) * 3.0)


def ocog(w: Column, noise_bins: int = 11) -> tuple[Column, Column]:
    """(amplitude, width) by the offset centre of gravity."""
    y = without_noise(w, noise_bins) if noise_bins else w
    y2 = total(y, lambda x: x * x)
    y4 = total(y, lambda x: x * x * x * x)
    return F.sqrt(F.try_divide(y4, y2)), F.try_divide(y2 * y2, y4)


def ocog_properties(w: Column) -> tuple[Column, Column, Column]:
    """(centre of gravity, amplitude, width) of the raw power; the first bin counts as 1."""
    p, pp = total(w), total(w, lambda x: x * x)
    moment = total(F.zip_with(w, F.sequence(F.lit(1), F.size(w)), lambda x, i: x * i))
    return F.try_divide(moment, p), F.sqrt(F.try_divide(pp, p)), F.try_divide(p * p, pp)


def late_tail_ratio(w: Column, first: int = 100, last: int = 140, noise_bins: int = 11) -> Column:
    """Late tail over peak after the noise is taken off."""
    return let(without_noise(w, noise_bins), lambda y: late_tail_to_peak(y, first, last))


def late_tail_to_peak(w: Column, first: int, last: int) -> Column:
    """Mean of the bins peak + first .. peak + last over the peak; NULL if the window leaves the array."""
    at = peak_index(w)
    part = window(w, at + first, last - first + 1)
    return F.when(at + last < F.size(w), F.try_divide(mean(part), peak(w)))


def first_maximum_index(w: Column, threshold: Column | float, ignore: int = 0) -> Column:
    """The first local maximum at or before the absolute one that reaches the threshold; else the absolute maximum;
    -1 without values."""
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    low = F.lit(-1e-6)

    def search(at: Column) -> Column:
        y, top = at["y"], at["top"]
        candidates = F.filter(
            F.sequence(F.lit(ignore), F.greatest(top, F.lit(ignore))),
            lambda i: (F.get(y, i) >= at["need"])
            & (F.get(y, i) > F.when(i > ignore, F.get(y, i - 1)).otherwise(low))
            & (F.get(y, i) > F.when(i < top, F.get(y, i + 1)).otherwise(low)),
        )
        return F.when(top >= 0, F.when(top < ignore, top).otherwise(F.coalesce(F.get(candidates, F.lit(0)), top))).otherwise(F.lit(-1))

    return let(w, lambda y: let(F.struct(y.alias("y"), peak_index(y).alias("top"), threshold.alias("need")), search)).cast("int")


def leading_edge(w: Column, threshold: float, look_back: int, first_valid: int = 0) -> dict[str, Column]:
    """Index and normalised power of the first maximum, and the edge's quality: power gained in the look-back window
    (rises only, plus the power it starts from) over the power at the first maximum."""

    def edge(at: Column) -> Column:
        y, fmi = at["y"], at["fmi"]
        ok = fmi >= first_valid
        power = F.get(y, F.greatest(fmi, F.lit(0)))
        start = F.greatest(fmi - look_back, F.lit(1))
        bins = F.when(start <= fmi, F.sequence(start, F.greatest(fmi, start))).otherwise(F.array().cast("array<int>"))
        rises = F.aggregate(bins, F.lit(0.0), lambda a, i: a + F.greatest(F.get(y, i) - F.get(y, i - 1), F.lit(0.0)))
        return F.struct(
            F.when(ok, fmi).otherwise(F.lit(-1)).alias("index"), F.when(ok, power).alias("power"),
            F.when(ok, F.try_divide(rises + F.get(y, start), power)).alias("quality"),
        )

    found = let(normalised(w), lambda y: let(F.struct(y.alias("y"), first_maximum_index(y, threshold, first_valid).alias("fmi")), edge))
    return {"first_maximum_index": found["index"], "first_maximum_power": found["power"], "leading_edge_quality": found["quality"]}


def leading_edge_peakiness(w: Column, fmi: Column, size: int) -> Column:
    start = F.greatest(fmi - size, F.lit(0))
    n = fmi - start
    return F.when(fmi > 0, F.try_divide(F.get(w, fmi), mean(window(w, start, n))) * n.cast("double"))


def trailing_edge_slope(w: Column, start: Column, floor: float = 0.15) -> dict[str, Column]:
    """Least-squares slope and correlation of the normalised power over the bins from start until it first falls under
    the floor. NULL with fewer than two bins."""

    def bins_of(at: Column) -> Column:
        y, n = at["y"], F.size(at["y"])
        after = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i > at["s"]) & (F.coalesce(F.get(y, i), F.lit(-1.0)) < floor))
        stop = F.coalesce(F.array_min(after), n)
        first = F.when(F.get(y, F.greatest(at["s"], F.lit(0))) >= floor, at["s"]).otherwise(at["s"] + 1)
        return F.when(stop > first, F.sequence(first, F.greatest(stop - 1, first))).otherwise(F.array().cast("array<int>"))

    def fit(at: Column) -> Column:
        zero = F.struct(*[F.lit(0.0).alias(k) for k in ("n", "x", "xx", "y", "xy", "yy")])

        def add(a: Column, i: Column) -> Column:
            x, y = i.cast("double"), F.get(at["y"], i)
            terms = {"n": F.lit(1.0), "x": x, "xx": x * x, "y": y, "xy": x * y, "yy": y * y}
            return F.struct(*[(a[k] + t).alias(k) for k, t in terms.items()])

        def solve(s: Column) -> Column:
            vx, vy = s["n"] * s["xx"] - s["x"] * s["x"], s["n"] * s["yy"] - s["y"] * s["y"]
            cxy, enough = s["n"] * s["xy"] - s["x"] * s["y"], s["n"] >= 2
            return F.struct(
                F.when(enough, F.try_divide(cxy, vx)).alias("slope"), F.when(enough & (vy > 0), F.try_divide(cxy, F.sqrt(vx * vy))).alias("r")
            )

        return let(F.aggregate(at["bins"], zero, add), solve)

    base = lambda y: F.struct(y.alias("y"), start.alias("s"))
    whole = let(normalised(w), lambda y: let(base(y), lambda at: let(F.struct(at["y"].alias("y"), bins_of(at).alias("bins")), fit)))
    return {"trailing_edge_slope": whole["slope"], "trailing_edge_correlation": whole["r"]}


def determination(observed: Column, modelled: Column) -> Column:
    """1 - SSres / SStot over the bins where both are present."""
    both = F.filter(F.arrays_zip(observed.alias("o"), modelled.alias("m")), lambda p: p["o"].isNotNull() & p["m"].isNotNull())
    n = F.size(both).cast("double")
    mean_o = F.try_divide(F.aggregate(both, F.lit(0.0), lambda a, p: a + p["o"]), n)
    res = F.aggregate(both, F.lit(0.0), lambda a, p: a + (p["o"] - p["m"]) * (p["o"] - p["m"]))
    tot = F.aggregate(F.transform(both, lambda p: (p["o"] - mean_o) * (p["o"] - mean_o)), F.lit(0.0), lambda a, x: a + x)
    return F.lit(1.0) - F.try_divide(res, tot)


def inverse_power(x: Column, scale: Column, decay: Column, offset: Column) -> Column:
    return scale * F.pow(x, -decay) + offset


def reduce_bins(w: Column, count: int, lead: float = 0.4, around: Column | None = None) -> Column:
    """`count` bins around the maximum, `lead` of them before it, clamped to the array."""
    at = peak_index(w) if around is None else around
    first = F.greatest(F.least(at - int(count * lead), F.size(w) - count), F.lit(0))
    return F.when(F.size(w) <= count, w).otherwise(F.slice(w, (first + 1).cast("int"), count))


def pad_power(w: Column, count: int) -> Column:
    return F.concat(w, F.array_repeat(F.lit(0.0), F.greatest(F.lit(count) - F.size(w), F.lit(0))))


def pad_range(r: Column, count: int) -> Column:
    """Extended by the first bin's width."""
    step = F.get(r, F.lit(1)) - F.get(r, F.lit(0))
    missing = F.greatest(F.lit(count) - F.size(r), F.lit(0))
    more = F.transform(F.sequence(F.lit(1), F.greatest(missing, F.lit(1))), lambda i: F.element_at(r, -1) + step * i)
    return F.concat(r, F.slice(more, F.lit(1), missing))


def thermal_noise(w: Column, first: int = 4, last: int = 12) -> Column:
    """Median of the bins first .. last of the sorted first half of the waveform."""
    half = F.array_sort(F.slice(w, F.lit(1), (F.size(w) / 2).cast("int")))
    part = F.slice(half, first + 1, last - first + 1)
    n = F.size(part)
    return F.when(n > 0, (F.element_at(part, F.floor((n + 1) / 2).cast("int")) + F.element_at(part, F.floor((n + 2) / 2).cast("int"))) / 2.0)


def look_angles(start_deg: Column, stop_deg: Column, n: int) -> Column:
    step = (stop_deg - start_deg) / float(n - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(90.0) - (start_deg + i * step))


def epoch_to_range(epoch: Column, ranges: Column, centre_bin: int) -> Column:
    return epoch * (SPEED_OF_LIGHT / 2.0) + F.get(ranges, F.lit(centre_bin))


def misfit(observed: Column, modelled: Column, scale: Column) -> Column:
    """100 RMS(residual) / scale."""
    d2 = F.zip_with(observed, modelled, lambda o, m: (o - m) * (o - m))
    return F.lit(100.0) * F.sqrt(mean(d2)) / scale


def ocog_retrack(w: Column, ranges: Column, share: float) -> tuple[Column, Column]:
    """(bin, range) where power first exceeds a share of the OCOG amplitude, interpolated between bins."""
    y2, y4 = total(w, lambda x: x * x), total(w, lambda x: x * x * x * x)

    def search(level: Column) -> Column:
        above = F.filter(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))), lambda i: F.get(w, i) > level)
        return F.struct(level.alias("level"), F.get(above, F.lit(0)).alias("i"))

    def between(at: Column) -> Column:
        i1, i0 = at["i"], at["i"] - 1
        part = F.try_divide(at["level"] - F.get(w, i0), F.get(w, i1) - F.get(w, i0))
        return F.struct((i0 + part).alias("bin"), (F.get(ranges, i0) + part * (F.get(ranges, i1) - F.get(ranges, i0))).alias("range"))

    found = let(let(F.lit(share) * F.sqrt(F.try_divide(y4, y2)), search), between)
    return found["bin"], found["range"]


def tail_shape(w: Column, at: Column, pad: int = 3) -> Column:
    """Root mean square deviation of the tail, from `pad` bins behind a bin on and over its mean, from a straight line.
    NULL with fewer than two bins."""

    def fit(tail: Column) -> Column:
        n = F.size(tail).cast("double")
        x = F.transform(tail, lambda _, i: i - (n - 1) / 2)
        dot = lambda a, b: total(F.zip_with(a, b, lambda u, v: u * v))
        spread = lambda y: F.greatest(dot(y, y) - dot(x, y) * dot(x, y) / dot(x, x), F.lit(0.0))
        scaled = let(mean(tail), lambda level: F.transform(tail, lambda v: v / level - 1))
        return F.when(n >= 2, F.sqrt(let(scaled, spread) / n))

    start = F.floor(at).cast("int") + pad
    return F.when((at >= 0) & (start < F.size(w)), let(window(w, start, F.size(w) - start), fit))


def ocog_ice_retrack(w: Column, ranges: Column, share: float, early: float, skip: int = 0, pad: int = 3) -> dict[str, Column]:
    """bin, range, leading-edge width (bins between the shares `early` and `share` of the OCOG amplitude) and tail shape.
    The first `skip` bins take no part in the amplitude and the search. A bin outside the window gives NULL throughout."""
    part = F.slice(w, skip + 1, F.greatest(F.size(w) - skip, F.lit(0)))
    ends = F.struct((ocog_retrack(part, part, share)[0] + skip).alias("at"), (ocog_retrack(part, part, early)[0] + skip).alias("first"))

    def properties(e: Column) -> Column:
        at = F.when(e["at"].between(0, F.size(w) - 1), e["at"])
        i0 = F.floor(at).cast("int")
        rng = F.get(ranges, i0) + (at - i0) * (F.coalesce(F.get(ranges, i0 + 1), F.get(ranges, i0)) - F.get(ranges, i0))
        return F.struct(at.alias("bin"), rng.alias("range"), (at - e["first"]).alias("leading_edge_width"), tail_shape(w, at, pad).alias("tail_shape"))

    found = let(ends, properties)
    return {k: found[k] for k in ("bin", "range", "leading_edge_width", "tail_shape")}


def ocog_ice_valid(found: dict[str, Column], widest: float, roughest: float, first_bin: float, last_bin: float) -> Column:
    """Whether a retracked waveform passes the filter; a property that is missing does not."""
    ok = (found["leading_edge_width"] < widest) & (found["tail_shape"] < roughest) & (found["bin"] > first_bin) & (found["bin"] < last_bin)
    return F.coalesce(ok, F.lit(False))


def width_to_nu(width: Column, a: float, b: float, low: float, high: float, widest: float = 50.0) -> Column:
    nu = F.least(F.greatest(F.lit(a) + F.pow(width, F.lit(-b)), F.lit(low)), F.lit(high))
    return F.when(width > widest, F.lit(0.0)).otherwise(nu)
