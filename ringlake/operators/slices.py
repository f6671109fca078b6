"""Keys too large for one task, cut by position: slices, sweeps over them, ranks and the exact selection of a rank.

Most keys are small, and then a count is all that these helpers add. A key over ``SLICE`` rows is cut at approximate
quantiles of its positions; where the cuts fall never changes a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ringlake.session import written

#: Rows of a key in one slice, about, and slices of a key at most.
SLICE, MOST = 50_000, 4096


def cuts(events: DataFrame, key: list[str], at: str) -> DataFrame | None:
    """``key, _cuts``: ascending positions at which the keys over ``SLICE`` rows are cut; None where no key is that large."""
    large = events.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > SLICE)
    top = large.agg(F.max("_n")).first()[0]
    if top is None:
        return None
    n = min(MOST, math.ceil(top / SLICE))
    some = F.percentile_approx(at, F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]), F.lit(max(10_000, 4 * n)))
    return written(events.join(large.select(*key), key, "left_semi").groupBy(*key).agg(F.array_sort(F.array_distinct(some)).alias("_cuts")), "cuts")


def slice_of(at: Column) -> Column:
    """Number of cuts up to a position; 0 for keys without cuts and null positions."""
    return F.when(F.col("_cuts").isNull() | at.isNull(), F.lit(0)).otherwise(F.size(F.filter("_cuts", lambda c: c <= at)))


def sliced(rows: DataFrame, key: list[str], bounds: DataFrame | None) -> DataFrame:
    return rows.withColumn("_cuts", F.lit(None).cast("array<double>")) if bounds is None else rows.join(bounds, key, "left")


def ranked(rows: DataFrame, key: list[str], at: str, out: str) -> DataFrame:
    """Adds ``out``: how many rows of the key stand at smaller positions. A large key's slices are ranked apart and shifted by the rows before them."""
    bounds = cuts(rows.select(*key, F.col(at).cast("double").alias("_x")), key, "_x")
    if bounds is None:
        return rows.withColumn(out, (F.rank().over(W.partitionBy(*key).orderBy(at)) - 1).cast("long"))
    s = sliced(rows, key, bounds).withColumn("_s", slice_of(F.col(at).cast("double"))).drop("_cuts")
    size = s.groupBy(*key, "_s").agg(F.count("*").alias("_m"))
    before = size.withColumn("_before", F.sum("_m").over(W.partitionBy(*key).orderBy("_s").rowsBetween(W.unboundedPreceding, 0)) - F.col("_m")).drop("_m")
    return s.withColumn(out, F.rank().over(W.partitionBy(*key, "_s").orderBy(at)) - 1).join(before, [*key, "_s"]).withColumn(out, F.col(out) + F.col("_before")).drop("_s", "_before")


def whole_groups(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.Table]:
    """Sorted batches as tables that end where a group ``(_h, _g)`` ends; several small groups share a table."""
    held, n, last = [], 0, None
    for b in batches:
        if not b.num_rows:
            continue
        h, g = b.column(0).to_numpy(), b.column(1).to_numpy()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        new[0] = (h[0], g[0]) != last
        last = (h[-1], g[-1])
        at = np.flatnonzero(new)
        if len(at) and n + at[-1] >= least:
            yield pa.Table.from_batches([*held, b.slice(0, at[-1])])
            held, n = [b.slice(at[-1])], b.num_rows - at[-1]
        else:
            held, n = [*held, b], n + b.num_rows
    if held:
        yield pa.Table.from_batches(held)


def spans(t: pa.Table, closed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A sweep over starts, ends and points of whole groups: the rows of points and of ranges, the points' order by group and position, and for
    each range the places ``lo`` up to ``hi`` in that order which it holds."""
    h, g, kind = (t[c].to_numpy() for c in ("_h", "_g", "_kind"))
    a, b = (t[c].cast(pa.float64()).to_numpy() for c in ("_lo", "_hi"))
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    group = np.cumsum(new)
    points = np.flatnonzero((kind == 1) & ~np.isnan(a))
    ranges = np.flatnonzero((kind == 0) & ~np.isnan(a) & ~np.isnan(b))
    values, place = np.unique(np.concatenate([a[points], a[ranges], b[ranges]]), return_inverse=True)
    wide = len(values) + 1
    at, start, end = np.split(place, [len(points), len(points) + len(ranges)])
    at = group[points] * wide + at
    order = np.argsort(at, kind="stable")
    lo = np.searchsorted(at[order], group[ranges] * wide + start, "left")
    hi = np.searchsorted(at[order], group[ranges] * wide + end, "right" if closed else "left")
    return points, ranges, order, lo, np.maximum(lo, hi)


def first_over(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` places the first of the spans that hold it, ``len(lo)`` where none does. Every span counts at two overlapping runs of a
    power of two, and runs pass on to their halves: ``n log n`` in all."""
    none = len(lo)
    size = hi - lo
    level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
    best = np.full(n, none)
    for k in range(int(level.max(initial=0)), -1, -1):
        at = np.flatnonzero((level == k) & (size > 0))
        np.minimum.at(best, lo[at], at)
        np.minimum.at(best, hi[at] - (1 << k), at)
        if k:
            half = 1 << (k - 1)
            best[half:] = np.minimum(best[half:], best[:-half].copy()) if half < n else best[half:]
    return best


def met(points: DataFrame, ranges: DataFrame, key: list[str], at: str, start: str, end: str, closed: bool, order: str | None = None, value: str | None = None) -> DataFrame:
    """Points and the ranges that hold them, as structs ``_p, _r``; with ``order`` each point once, with the ``value`` of its first range as ``_v``.

    Both sides are dealt by key and slice and sorted there, and one sweep over a slice's starts, ends and points finds what
    each range holds. A range counts in every slice that it touches; for ``order``, of those that cover a slice wholly
    only the first goes along, so what a slice carries stays small. Null positions are in no range, null keys meet none.
    """
    first = order is not None
    named = [F.col(c).alias(f"_k{i}") for i, c in enumerate(key)]
    keys = [f"_k{i}" for i in range(len(key))]
    p = points.select(*named, F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_p"), F.col(at).cast("double").alias("_lo"))
    held = F.struct(F.col(value).alias("v")) if first else F.struct(*[F.col(f"`{c}`") for c in ranges.columns])
    r = ranges.select(*named, held.alias("_r"), F.col(start).cast("double").alias("_lo"), F.col(end).cast("double").alias("_hi"), *([F.col(order).alias("_o")] if first else []))
    r = r.where(F.col("_lo") <= F.col("_hi") if closed else F.col("_lo") < F.col("_hi")).where(" and ".join(f"{k} is not null" for k in keys) or "true")
    r = r.where("_o is not null") if first else r
    bounds = cuts(p.select(*keys, "_lo").unionByName(r.select(*keys, "_lo")), keys, "_lo")
    p = sliced(p, keys, bounds).withColumn("_s", slice_of(F.col("_lo"))).drop("_cuts")
    if bounds is None:
        r = r.withColumn("_s", F.lit(0))
    else:
        r = sliced(r, keys, bounds).withColumn("_a", slice_of(F.col("_lo"))).withColumn("_b", slice_of(F.col("_hi"))).withColumn("_s", F.explode(F.sequence("_a", "_b")))
        if first:
            across = (F.col("_s") > F.col("_a")) & (F.col("_s") < F.col("_b"))
            fields = ["_lo", "_hi", "_r", "_o"]
            top = r.where(across).groupBy(*keys, "_s").agg(F.min_by(F.struct(*fields), "_o").alias("_t")).select(*keys, "_s", *[F.col(f"_t.{c}").alias(c) for c in fields])
            r = r.where(~across).select(*keys, "_s", *fields).unionByName(top)
        else:
            r = r.drop("_cuts", "_a", "_b")
    both = r.withColumn("_kind", F.lit(0)).unionByName(p.withColumn("_kind", F.lit(1)), allowMissingColumns=True).withColumn("_h", F.xxhash64(*keys, "_s"))
    dealt = both.repartition("_h").sortWithinPartitions("_h", *keys, "_s", "_kind", *(["_o"] if first else []))
    group = F.dense_rank().over(W.partitionBy("_h").orderBy(*keys, "_s"))  # keys of one hash stay apart
    rows = dealt.withColumn("_g", group).select("_h", "_g", "_kind", "_lo", "_hi", "_p", "_r")
    types = {f.name: f.dataType for f in rows.schema}
    out = StructType([StructField("_p", types["_p"]), StructField("_v", types["_r"]["v"].dataType) if first else StructField("_r", types["_r"])])

    def sweep(batches):
        for t in whole_groups(batches):
            pts, rng, order_, lo, hi = spans(t, closed)
            mine, theirs = t["_p"].combine_chunks(), t["_r"].combine_chunks()
            if first:
                best = np.full(len(t), -1)
                hit = first_over(lo, hi, len(order_))
                at_ = hit < len(rng)
                best[pts[order_[at_]]] = rng[hit[at_]]
                every = np.flatnonzero(t["_kind"].to_numpy() == 1)
                for a in range(0, len(every), 1 << 16):
                    own = every[a : a + (1 << 16)]
                    found = best[own]
                    yield pa.RecordBatch.from_arrays([mine.take(pa.array(own)), theirs.field("v").take(pa.array(found, mask=found < 0))], ["_p", "_v"])
                continue
            n = hi - lo
            for a, b in _runs(n, 1 << 16):
                which = np.repeat(np.arange(a, b), n[a:b])
                inner = np.arange(len(which)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b]) + lo[which]
                for c in range(0, len(which), 1 << 16):
                    cut = slice(c, c + (1 << 16))
                    yield pa.RecordBatch.from_arrays([mine.take(pa.array(pts[order_[inner[cut]]])), theirs.take(pa.array(rng[which[cut]]))], ["_p", "_r"])

    return rows.mapInArrow(sweep, out)


def _runs(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of ranges that hold about ``most`` points together."""
    total = np.cumsum(n)
    a = 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def selected(rows: DataFrame, key: list[str], value: str, q: float, out: str, few: int = 10_000, bars: int = 256) -> DataFrame:
    """``key, out``: of each key's values (nulls left out) the one of rank ``(n - 1) * q``, rounded half to even, in ascending order; 0 for keys
    of nulls only.

    Exact and without an array of a key's values: a histogram of ``bars`` parts of about equal depth brackets the rank, a count of
    what stands below and within the bracket makes that exact, and so on until a key has ``few`` values left, at once for
    most, which a window ranks. Passes shuffle sketches and counts only, each leaves about a hundredth of a key's values, and
    equal values end a search.
    """
    x = rows.select(*key, F.col(value).cast("double").alias("_x"))
    n = x.groupBy(*key).agg(F.count("_x").alias("_m"))
    left = n.select(*key, "_m", F.bround((F.col("_m") - 1) * F.lit(q)).cast("long").alias("_k"), F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"))
    x, parts = x.where("_x is not null"), []
    within = (F.col("_lo").isNull() | (F.col("_x") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_x") < F.col("_hi")))

    def closed(which: DataFrame) -> DataFrame:
        held = x.join(which, key).where(within)
        return held.withColumn("_i", F.row_number().over(W.partitionBy(*key).orderBy("_x"))).where(F.col("_i") == F.col("_k") + 1).select(*key, F.col("_x").alias(out))

    while (left.agg(F.max("_m")).first()[0] or 0) > few:
        left = written(left, "ranks")
        parts.append(closed(left.where(F.col("_m") <= few)))
        held = x.join(left.where(F.col("_m") > few), key).where(within)
        bar = F.percentile_approx("_x", F.array(*[F.lit(i / bars) for i in range(bars + 1)]), F.lit(10_000))
        one = [F.first(c).alias(c) for c in ("_m", "_k", "_lo", "_hi")]
        i = F.floor(F.col("_k") * bars / F.col("_m")).cast("int")
        bracket = written(held.groupBy(*key).agg(bar.alias("_h"), *one).select(*key, "_k", "_lo", "_hi", F.element_at("_h", F.greatest(i, F.lit(1))).alias("_a"), F.element_at("_h", F.least(i + 3, F.lit(bars + 1))).alias("_b")), "brackets")
        a, b, v = F.col("_a"), F.col("_b"), F.col("_x")
        counts = [F.count_if(v < a).alias("_n1"), F.count_if(v == a).alias("_n2"), F.count_if((v > a) & (v < b)).alias("_n3"), F.count_if((v == b) & (b > a)).alias("_n4"), F.count_if(v > b).alias("_n5")]
        seen = x.join(bracket, key).where(within).groupBy(*key).agg(*[F.first(c).alias(c) for c in ("_k", "_lo", "_hi", "_a", "_b")], *counts)
        # where the rank falls: below, on or between the bracket's ends, or above; ends that it is not on are left out for good
        upto = [F.lit(0), *[sum((F.col(f"_n{j}") for j in range(2, c + 1)), F.col("_n1")) for c in range(1, 5)]]
        k = F.col("_k")
        case = lambda low, at, mid, top, over: F.when(k < upto[1], low).when(k < upto[2], at).when(k < upto[3], mid).when(k < upto[4], top).otherwise(over)
        none = F.lit(None).cast("double")
        exact = written(seen.select(*key, case(F.col("_n1"), F.lit(0), F.col("_n3"), F.lit(0), F.col("_n5")).alias("_m"), case(k, F.lit(0), k - upto[2], F.lit(0), k - upto[4]).alias("_k"), case(F.col("_lo"), none, a, none, b).alias("_lo"), case(a, none, b, none, F.col("_hi")).alias("_hi"), case(none, a, none, b, none).alias("_x")), "ranks")
        parts.append(exact.where("_x is not null").select(*key, F.col("_x").alias(out)))
        left = exact.where("_x is null").drop("_x")
    parts.append(closed(left))
    found = reduce(DataFrame.unionByName, parts)
    return n.select(*key).join(found, key, "left").withColumn(out, F.coalesce(out, F.lit(0.0)))
