"""One-dimensional signals on a ring: ``n`` samples a key, numbered ``i`` from 0."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import labels
from ringlake.session import written


def neighbour(name: str, key: list[str], by: int, n: Column | None = None) -> Column:
    """Value ``by`` places on, around the ring."""
    o = W.partitionBy(*key).orderBy("i")
    whole = o.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return F.coalesce(F.lead(name).over(o), F.first(name).over(whole)) if by == 1 else F.coalesce(F.lag(name).over(o), F.last(name).over(whole))


def curvature(samples: DataFrame, key: list[str], ds: str) -> DataFrame:
    """Adds ``kappa``, signed (left positive), from central differences of ``x, y`` spaced ``ds`` apart."""
    s = samples
    for c in ("x", "y"):
        s = s.withColumn(f"_{c}p", neighbour(c, key, -1)).withColumn(f"_{c}n", neighbour(c, key, 1))
    d = F.col(ds)
    x1, y1 = (F.col("_xn") - F.col("_xp")) / (2 * d), (F.col("_yn") - F.col("_yp")) / (2 * d)
    x2, y2 = (F.col("_xn") - 2 * F.col("x") + F.col("_xp")) / (d * d), (F.col("_yn") - 2 * F.col("y") + F.col("_yp")) / (d * d)
    size = F.pow(x1 * x1 + y1 * y1, F.lit(1.5))
    return s.withColumn("kappa", F.when(size < 1e-12, 0.0).otherwise((x1 * y2 - y1 * x2) / size)).drop("_xp", "_xn", "_yp", "_yn")


def odd(window: Column) -> Column:
    return F.when(window % 2 == 0, window + 1).otherwise(window)


def smoothed(samples: DataFrame, key: list[str], value: str, window: int, out: str | None = None) -> DataFrame:
    """Moving mean over an odd window around the ring: the ring is unrolled by half a window on both sides."""
    half = (window + 1 - window % 2) // 2
    n = F.count("*").over(W.partitionBy(*key))
    s = samples.withColumn("_n", n)
    laps = F.ceil(F.lit(float(half)) / F.col("_n")).cast("int")
    roll = s.withColumn("_t", F.explode(F.sequence(-laps, laps))).withColumn("_j", F.col("i") + F.col("_t") * F.col("_n")).where((F.col("_j") >= -half) & (F.col("_j") < F.col("_n") + half))
    o = W.partitionBy(*key).orderBy("_j").rowsBetween(-half, half)
    return roll.withColumn("_v", F.avg(value).over(o)).where("_t = 0").withColumn(out or value, F.col("_v")).drop("_n", "_t", "_j", "_v")


def nearest_rank(values: Column, q: float) -> Column:
    """The sorted array's entry at ``(n - 1) * q``, rounded half to even; 0 for an empty array."""
    at = F.bround((F.size(values) - 1) * F.lit(q)).cast("int") + 1
    return F.coalesce(F.try_element_at(F.array_sort(values), at), F.lit(0.0))


def apart(rows: DataFrame, key: list[str], at: str, lap: str, strength: Column, by: float, rounds: int = 6) -> DataFrame:
    """The rows that a greedy choice keeps: strongest first (least ``strength``, which is never equal within a key), each ``by`` or more from all
    kept before it on a lap of length ``lap``.

    Rounds of local dominance give the same rows: who is strongest of all undecided rows nearer than ``by`` stays, and who is near
    one that stays goes. Several rounds share one shuffle and one sort by key and place; a lap's ends see each other through
    copies of what lies within ``by`` of them. Rows are decided in few rounds unless strengths fall steadily along a lap.
    Distances within a billionth of ``by`` count as apart.
    """
    unit = 1 << 40  # of the frames, whose bounds are whole numbers: ``by`` has so many
    reach = int(unit * (1 - 1e-9))
    if by <= 0:
        return rows
    todo = written(rows.withColumn("_w", strength).withColumn("_id", F.monotonically_increasing_id()).withColumn("_at", F.pmod(F.col(at).cast("double"), F.col(lap))).withColumn("_state", F.lit(0)), "undecided")
    names, done = rows.columns, []
    near = W.partitionBy(*key).orderBy(F.col("_p") * (unit / by)).rangeBetween(-reach, reach)
    same = W.partitionBy(*key, "_id")
    while True:
        copies = F.array_compact(F.array(F.col("_at"), F.when(F.col("_at") < by, F.col("_at") + F.col(lap)), F.when(F.col("_at") >= F.col(lap) - by, F.col("_at") - F.col(lap))))
        x = todo.withColumn("_p", F.explode(copies))
        for _ in range(rounds):
            best = F.min(F.when(F.col("_state") == 0, F.struct("_w", "_id"))).over(near)
            x = x.withColumn("_keep", (F.col("_state") == 1) | ((F.col("_state") == 0) & (best["_id"] == F.col("_id"))))
            x = x.withColumn("_keep", F.bool_or(F.when(F.col("_p") == F.col("_at"), F.col("_keep"))).over(same))  # copies see less around them
            gone = F.max(F.col("_keep").cast("int")).over(near)
            x = x.withColumn("_gone", gone).withColumn("_gone", F.max(F.when(F.col("_p") == F.col("_at"), F.col("_gone"))).over(same))
            x = x.withColumn("_state", F.when(F.col("_keep"), 1).when((F.col("_state") == 0) & (F.col("_gone") == 1), 2).otherwise(F.col("_state"))).drop("_keep", "_gone")
        todo = written(x.where("_p = _at").drop("_p"), "undecided")
        if todo.where("_state = 0").isEmpty():
            return todo.where("_state = 1").select(*names)


def peaks(samples: DataFrame, key: list[str], value: str, lap: str, least: str, by: float, most: int | None = None) -> DataFrame:
    """``number, i, s`` of the kept maxima of ``value``: local maxima at or above ``least``, strongest first, ``by`` apart on the lap, at most
    ``most`` of them; numbered along the lap. Equal values go by ``i``; ``s`` places samples."""
    m = samples.withColumn("_p", neighbour(value, key, -1)).withColumn("_q", neighbour(value, key, 1))
    top = m.where((F.col(value) >= F.col(least)) & (F.col(value) >= F.col("_p")) & (F.col(value) > F.col("_q"))).select(*key, "i", "s", F.col(value).alias("_v"), F.col(lap).alias("_lap"))
    return _strongest(top, key, by, most).select(*key, "number", "i", "s")


def _strongest(top: DataFrame, key: list[str], by: float, most: int | None) -> DataFrame:
    """The maxima ``(key, i, s, _v, _lap, ...)`` that the greedy choice keeps, with their ``number``."""
    kept = apart(top, key, "s", "_lap", F.struct((-F.col("_v")).alias("v"), "i"), by)
    if most:  # the greedy choice's first ones are the strongest of all that it keeps
        kept = kept.withColumn("_r", F.row_number().over(W.partitionBy(*key).orderBy(F.col("_v").desc(), "i"))).where(F.col("_r") <= most).drop("_r")
    return kept.withColumn("number", F.row_number().over(W.partitionBy(*key).orderBy("s", "i")))


def _grown(i: Column, n: Column, total_m: Column, reach: Column, a: Column, b: Column, pre_m: float, post_m: float) -> tuple[Column, Column]:
    """``start, end`` of a range about sample ``i`` whose first samples below the threshold lie ``a`` places on and ``b`` back (null: none in reach)."""
    right = F.pmod(i + F.least(F.coalesce(a - 1, reach), reach), n)
    left = F.pmod(i - F.least(F.coalesce(b - 1, reach), reach), n)
    step = total_m / n
    return F.greatest(F.lit(0.0), (left * step - pre_m) / total_m), F.least(F.lit(1.0), (right * step + post_m) / total_m)


def grown_ranges(samples: DataFrame, tops: DataFrame, key: list[str], value: str, floor: float = 0.00012, ratio: float = 0.32, most_m: float = 650.0, pre_m: float = 75.0, post_m: float = 55.0) -> DataFrame:
    """``start, end`` (fractions) about each peak: out to the last sample on each side at or above the threshold, at most
    ``most_m`` away, padded, held to 0..1. The nearest sample below the threshold on each side bounds the walk; each peak
    meets only the samples within its reach."""
    s = samples.select(*key, F.col("i").alias("j"), F.col(value).alias("vj"))
    sizes = samples.groupBy(*key).agg(F.first("n").alias("n"), F.first("total_m").alias("total_m"))
    step = F.col("total_m") / F.col("n")
    t = tops.join(sizes, key).withColumn("_r", F.ceil(F.lit(most_m) / step).cast("int"))
    near = F.least(F.col("_r"), F.col("n").cast("int") - 1)
    t = t.withColumn("_by", F.explode(F.sequence(-near, near))).where("_by <> 0").withColumn("j", F.pmod(F.col("i") + F.col("_by"), F.col("n")).cast("int"))
    low = F.col("vj") < F.greatest(F.lit(floor), F.col("peak") * ratio)
    g = t.join(s.withColumn("j", F.col("j").cast("int")), [*key, "j"]).groupBy(*key, "number", "i", "n", "total_m", "_r").agg(F.min(F.when(low & (F.col("_by") > 0), F.col("_by"))).alias("_a"), F.min(F.when(low & (F.col("_by") < 0), -F.col("_by"))).alias("_b"))
    start, end = _grown(*map(F.col, ["i", "n", "total_m", "_r", "_a", "_b"]), pre_m, post_m)
    return g.select(*key, "number", "i", start.alias("start"), end.alias("end"))


def corner_layers(vertices: DataFrame, ring=None, step_m: float = 4.0, smooth_m: float = 90.0, percentile: float = 0.82, least: float = 0.0, apart_m: float = 90.0, most: int | None = None) -> DataFrame:
    """Apexes of a ring's curvature, with direction, severity and range: resample, curvature, two smoothings, peaks, ranges.

    Vertices are dealt by ring once, and all up to the maxima with their ranges, a few for each ring, is done where a ring's samples are
    made: no sample is shuffled or written. Rings without a key or a length have none."""
    from ringlake.operators.ring import R, resampled

    r = ring or R
    key = list(r.key)
    s = resampled(vertices.dropna(subset=key), r, step_m).where("total_m > 0").withColumn("ds", F.col("total_m") / F.col("n"))
    g = curvature(s, key, "ds").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("i", "kappa", "lon", "lat"))).alias("_s"), *[F.first(c).alias(c) for c in ("n", "ds", "total_m")])
    wide = F.greatest(F.lit(1), F.round(F.lit(smooth_m) / F.col("ds")).cast("int"))
    mean = F.arrow_udf(_smoothed_lines, "array<double>")
    g = g.withColumn("_k", mean(F.col("_s.kappa"), odd(wide), odd(F.greatest(F.lit(1), F.floor(wide / 2).cast("int")))))
    tops = g.select(*key, F.col("total_m").alias("_lap"), "total_m", F.inline(_tops(percentile, least)))
    kept = _strongest(tops, key, apart_m, most)
    return kept.select(*key, "number", (F.col("s") / F.col("total_m")).alias("marker"), F.when(F.col("kappa") > 0, "left").otherwise("right").alias("direction"), labels.scale_of_radius(F.col("_v")).alias("scale"), "lon", "lat", "start", "end", F.col("_v").alias("peak"), "min_k", "total_m")


def _smoothed_lines(lines: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """Two moving means of each closed line, over odd windows that may differ from line to line: by differences of a running sum. Nulls add
    nothing, and sums before a line's first value are null."""
    values, ends = lines.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(lines.value_lengths().to_numpy()))
    out = np.empty(len(values))
    for a, b, *windows in zip(ends[:-1], ends[1:], first.to_numpy(), second.to_numpy(), strict=True):
        v, i = values[a:b], np.arange(b - a)
        for w in windows:
            none = np.isnan(v)
            upto = np.cumsum(np.where(none, 0.0, v))
            upto[np.logical_and.accumulate(none)] = np.nan
            high, low = i + w // 2, i - w // 2 - 1
            v = ((high // len(v)) * upto[-1] + upto[high % len(v)] - ((low // len(v)) * upto[-1] + upto[low % len(v)])) / w
        out[a:b] = v
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, from_pandas=True))


def _tops(percentile: float, least: float, floor: float = 0.00012, ratio: float = 0.32, most_m: float = 650.0, pre_m: float = 75.0, post_m: float = 55.0) -> Column:
    """Structs ``s, i, _v, kappa, lon, lat, start, end, min_k`` of the maxima of a line ``_k``: at or above the percentile of its absolute
    values, and grown as ``grown_ranges`` does."""
    n, total = F.col("n"), F.col("total_m")
    of = lambda name, i: F.element_at(name, i + 1)
    high = lambda i: F.abs(of("_k", F.pmod(i, n)))
    if least <= 0:
        ranked = F.sort_array(F.array_compact(F.transform("_k", F.abs)))
        at = F.bround((F.size(ranked) - 1) * F.lit(percentile)).cast("int") + 1
        min_k = F.greatest(F.lit(0.00018), F.coalesce(F.try_element_at(ranked, at), F.lit(0.0)))
    else:
        min_k = F.lit(least)
    reach = F.ceil(F.lit(most_m) / (total / n)).cast("int")
    near = F.sequence(F.lit(1), F.least(reach, n - 1))

    def top(i: Column, bar: Column) -> Column:
        low = F.greatest(F.lit(floor), high(i) * ratio)
        a, b = (F.try_element_at(F.filter(near, lambda d: high(i + d if on else i - d) < low), F.lit(1)) for on in (True, False))
        start, end = _grown(i, n, total, reach, a, b, pre_m, post_m)
        return F.struct((i * total / n).alias("s"), i.alias("i"), high(i).alias("_v"), of("_k", i).alias("kappa"), of("_s.lon", i).alias("lon"), of("_s.lat", i).alias("lat"), start.alias("start"), end.alias("end"), bar.alias("min_k"))

    def found(bar: Column) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda i: (high(i) >= bar) & (high(i) >= high(i - 1)) & (high(i) > high(i + 1))), lambda i: top(i, bar))

    return F.transform(F.array(min_k), found)[0]  # the threshold is found once a line, not for each sample
