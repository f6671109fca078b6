"""Joins of points and ranges on the lap, always with an equality key so that no plan becomes a Cartesian product."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import cyclic, geo
from ringlake.operators import slices


def ranges_at(points: DataFrame, ranges: DataFrame, key: list[str], at: str, start: str = "start", end: str = "end", closed: bool = False) -> DataFrame:
    """Points with the ranges of their key that hold them: ``start <= at < end``, or both ends with ``closed``.

    A sweep by key and slice: work is that of a sort and of the pairs that come out, for one hot key too. Null keys and positions
    meet nothing, empty and inverted ranges hold nothing, repeated rows each count.
    """
    pairs = slices.met(points, ranges, key, at, start, end, closed)
    return pairs.select(*[F.col(f"_p.`{c}`").alias(c) for c in [*key, *(c for c in points.columns if c not in key)]], *[F.col(f"_r.`{c}`").alias(c) for c in ranges.columns if c not in key])


def first_range_at(points: DataFrame, ranges: DataFrame, key: list[str], at: str, order: str, value: str, start: str = "start", end: str = "end") -> DataFrame:
    """The points with the ``value`` of the first range, by ``order``, of their key that holds each (``start <= at < end``); null where none does.

    A sweep by key and slice finds one range a point, whatever the number that holds it: work is that of a sort. Points of null
    keys or positions stay, ranges of a null order count nowhere, equal orders may give either's value.
    """
    out = slices.met(points, ranges, key, at, start, end, False, order, value)
    return out.select(*[F.col(f"_p.`{c}`").alias(c) for c in points.columns if c != value], F.col("_v").alias(value))


def bucketed_ranges_at(points: DataFrame, ranges: DataFrame, at: str, buckets: int, start: str = "start", end: str = "end") -> DataFrame:
    """Range join without another key: both sides meet in the buckets of the lap that a range touches."""
    p = points.withColumn("_k", F.least(F.floor(F.col(at) * buckets), F.lit(buckets - 1)).cast("int"))
    r = ranges.withColumn("_k", F.explode(F.sequence(F.floor(F.col(start) * buckets).cast("int"), F.least(F.floor(F.col(end) * buckets), F.lit(buckets - 1)).cast("int"))))
    return p.join(r, "_k").where((F.col(start) <= F.col(at)) & (F.col(at) < F.col(end))).drop("_k")


def near_points(a: DataFrame, b: DataFrame, key: list[str], most: float = 0.0035, most_m: float = 85.0) -> DataFrame:
    """Pairs within a lap distance (``marker``, ``marker2``) or within metres (``lon, lat``, ``lon2, lat2``).

    Rows meet only in neighbouring cells of the lap or of space, so a large key does not pair all its rows. Cells of space
    are cubes about the globe, which have no seams: a chord is never longer than its arc. Cubes are four times as wide as the
    reach, so most rows of ``b`` stand in few; they are merged, since the copies that a broadcast would hold are not in its estimate.
    """
    lap = cyclic.distance(F.col("marker"), F.col("marker2"))
    m = geo.haversine(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2"))
    close = F.coalesce(F.col("lap_distance") < most, F.lit(False))
    cells = max(1, int(1 / most) - 1)

    def measured(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("lap_distance", lap).withColumn("dist_m", m)

    def slot(at: str):
        return F.floor(cyclic.frac(F.col(at)) * cells).cast("int")

    def cube(x: str, y: str) -> list[Column]:
        lon, lat, unit = F.radians(x), F.radians(y), geo.RADIUS_M / (4 * most_m * (1 + 1e-6))
        return [v * unit for v in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]

    around = F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(slot("marker2") + d, F.lit(cells)))))
    by_lap = measured(a.withColumn("_c", slot("marker")).join(b.withColumn("_c", around), [*key, "_c"]).drop("_c")).where(close)
    p, q, names = a, b, ["_x", "_y", "_z"]
    for n, v, w in zip(names, cube("lon", "lat"), cube("lon2", "lat2"), strict=True):
        p, q = p.withColumn(n, F.floor(v).cast("long")), q.withColumn(n, F.explode(F.array_distinct(F.array(F.floor(w - 0.25).cast("long"), F.floor(w + 0.25).cast("long")))))
    by_place = measured(p.join(q.hint("merge"), [*key, *names]).drop(*names)).where(~close & (F.col("dist_m") < most_m))
    return by_lap.unionByName(by_place)


def nearest_cyclic(points: DataFrame, point_id: list[str], targets: DataFrame, key: list[str], at: str, target_at: str, target_id: str) -> DataFrame:
    """Each point's nearest target on the lap, the least target id among equals (to nine digits, so that rounding decides nothing), with its
    ``lap_distance``, and the ``least_distance`` of all targets, which may be another's among equals.

    Points and the targets of three laps are merged by their place, so each point looks only at its neighbours.
    """
    t = targets.select(*key, F.struct(F.col(target_id).alias("id"), F.col(target_at).alias("at")).alias("_t"), cyclic.frac(F.col(target_at)).alias("_p"))
    t = t.withColumn("_p", F.explode(F.array(F.col("_p") - 1.0, F.col("_p"), F.col("_p") + 1.0)))
    p = points.select(*key, F.struct(*point_id, F.col(at).alias("_at")).alias("_row"), cyclic.frac(F.col(at)).alias("_p"))
    both = t.unionByName(p, allowMissingColumns=True)
    last = lambda o: F.last("_t", ignorenulls=True).over(o.rowsBetween(W.unboundedPreceding, 0))
    by = W.partitionBy(*key)
    both = both.withColumn("_a", last(by.orderBy("_p", F.col("_t").isNull(), F.col("_t.id").desc()))).withColumn("_b", last(by.orderBy(F.col("_p").desc(), F.col("_t").isNull(), F.col("_t.id").desc())))
    apart = lambda c: cyclic.distance(F.col("_row._at"), F.col(f"{c}.at"))
    far = lambda c: F.struct(F.round(apart(c), 9).alias("near"), F.col(f"{c}.id").alias("id"), apart(c).alias("d"))
    near = both.where(F.col("_row").isNotNull() & F.col("_a").isNotNull()).withColumn("n", F.least(far("_a"), far("_b")))
    return near.select(*key, *[F.col(f"_row.{c}").alias(c) for c in point_id], F.col("n.id").alias(target_id), F.col("n.d").alias("lap_distance"), F.least(apart("_a"), apart("_b")).alias("least_distance"))


def close_pairs(rows: DataFrame, key: list[str], number: str, at: str, most: float = 0.003) -> DataFrame:
    """Pairs of one key closer than ``most`` on the lap: ``a`` before ``b`` by number.

    Rows meet only in neighbouring cells of the lap, so a large key does not pair all its rows.
    """
    cells = max(1, int(1 / most) - 1)
    k = F.floor(cyclic.frac(F.col(at)) * cells).cast("int")
    x = rows.select(*key, F.col(number).alias("a"), F.col(at).alias("at_a"), k.alias("_c"))
    y = rows.select(*key, F.col(number).alias("b"), F.col(at).alias("at_b"), F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(k + d, F.lit(cells))))).alias("_c"))
    return x.join(y, [*key, "_c"]).where((F.col("a") < F.col("b")) & (cyclic.distance(F.col("at_a"), F.col("at_b")) < most)).select(*key, "a", "b")


def by_anchor(ranges: DataFrame, points: DataFrame, key: list[str], anchor: str, own: str, point_id: str) -> DataFrame:
    """Ranges with the point that their anchor names, or else the one that shares their id."""
    p1 = points.select(*key, F.col(point_id).alias(anchor), F.struct(*points.columns).alias("_a"))
    p2 = points.select(*key, F.col(point_id).alias(own), F.struct(*points.columns).alias("_o"))
    return ranges.join(p1, [*key, anchor], "left").join(p2, [*key, own], "left").withColumn("point", F.coalesce("_a", "_o")).drop("_a", "_o")


def unresolved(refs: DataFrame, targets: DataFrame, key: list[str], ref: str, target: str) -> DataFrame:
    """References whose target does not exist under the same key."""
    return refs.where(F.col(ref).isNotNull()).join(targets.select(*key, F.col(target).alias(ref)).distinct(), [*key, ref], "left_anti")


def by_name(left: DataFrame, names: list[Column], index: DataFrame, index_key: str, order: str, payload: list[str]) -> DataFrame:
    """The first of the candidate names that the index knows; of equal index keys the first by order counts."""
    first = index.groupBy(index_key).agg(F.min_by(F.struct(*payload), order).alias("_hit"))
    out, hits = left, []
    for i, n in enumerate(names):
        out = out.withColumn(f"_k{i}", n).join(first.select(F.col(index_key).alias(f"_k{i}"), F.col("_hit").alias(f"_h{i}")), f"_k{i}", "left").drop(f"_k{i}")
        hits.append(f"_h{i}")
    return out.withColumn("hit", F.coalesce(*hits)).drop(*hits)


def _ratios(cutoff: float):
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str, y: str) -> float:
            m = difflib.SequenceMatcher(None, y, x)
            return m.ratio() if m.quick_ratio() >= cutoff else 0.0

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return score


def _matched(la: Column, lb: Column, cutoff: float) -> Column:
    """Characters that must match for the ratio to reach the cutoff."""
    return F.ceil((la + lb) * cutoff / 2 - 1e-9)


def fuzzy_candidates(left: DataFrame, name: str, index: DataFrame, index_name: str, cutoff: float = 0.82) -> DataFrame:
    """Distinct pairs ``a, b`` of names among which are all whose Ratcliff-Obershelp ratio reaches the cutoff.

    Of ``la + lb`` characters at least ``M = cutoff * (la + lb) / 2`` match on each side, in at most ``la + lb - 2 * M + 1`` blocks, so
    the names share that many character pairs less than ``M``. Hence they share one among each name's rarest pairs, as many
    as leave no room for the rest: only those are joined, and common pairs meet nobody. Pairs that stand once in both names
    must also stand about as far from the start. Needs a cutoff over two thirds.
    """
    if cutoff <= 2 / 3:
        raise ValueError("the bound on shared pairs needs a cutoff over two thirds")

    def grams(df: DataFrame, col: str) -> DataFrame:
        c = F.col("_n")
        pairs = F.when(F.length(c) < 2, F.array(c)).otherwise(F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.substring(c, i, F.lit(2))))
        g = df.select(F.col(col).alias("_n")).where(F.length("_n") > 0).distinct().select("_n", F.posexplode(pairs).alias("_at", "_g"))
        same = W.partitionBy("_n", "_g")
        return g.withColumn("_k", F.row_number().over(same.orderBy("_at"))).withColumn("_of", F.count("*").over(same))

    a, b = grams(left, name), grams(index, index_name)
    often = a.select("_g", "_k").unionByName(b.select("_g", "_k")).groupBy("_g", "_k").agg(F.count("*").alias("_f"))

    def rarest(g: DataFrame, out: str) -> DataFrame:
        n = F.length("_n")
        other = F.ceil(n * cutoff / (2 - cutoff) - 1e-9)  # the shortest partner's length
        shared = F.greatest(F.lit(1), 3 * _matched(n, other, cutoff) - n - other - 1)
        first = F.row_number().over(W.partitionBy("_n").orderBy("_f", "_g", "_k"))
        kept = g.join(often, ["_g", "_k"]).withColumn("_i", first).where(F.col("_i") <= F.greatest(F.lit(1), n - 1) - shared + 1)
        return kept.select("_g", "_k", F.col("_n").alias(out), F.col("_at").alias(f"_at_{out}"), F.col("_of").alias(f"_of_{out}"))

    la, lb = F.length("a"), F.length("b")
    far = F.abs(F.col("_at_a") - F.col("_at_b")) > la + lb - 2 * _matched(la, lb, cutoff)
    j = rarest(a, "a").join(rarest(b, "b"), ["_g", "_k"])
    return j.where(2.0 * F.least(la, lb) / (la + lb) >= cutoff - 1e-9).where(~(far & (F.col("_of_a") == 1) & (F.col("_of_b") == 1))).select("a", "b").distinct()


def fuzzy_names(left: DataFrame, name: str, index: DataFrame, index_name: str, cutoff: float = 0.82) -> DataFrame:
    """Adds ``match, ratio``: the index name of the highest Ratcliff-Obershelp ratio at or above the cutoff, the greatest
    name among equals. The ratio itself, which no built-in gives, runs in batches over the candidates. Null and empty names match nothing."""
    ratio = F.pandas_udf(_ratios(cutoff), "double")
    scored = fuzzy_candidates(left, name, index, index_name, cutoff).withColumn("ratio", ratio("a", "b")).where(F.col("ratio") >= cutoff)
    best = scored.groupBy("a").agg(F.max(F.struct("ratio", "b")).alias("m")).select(F.col("a").alias(name), F.col("m.b").alias("match"), F.col("m.ratio").alias("ratio"))
    return left.join(best, name, "left")
