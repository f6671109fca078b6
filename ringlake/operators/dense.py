"""Densified closed rings that are not made: their legs are kept with the number of equal pieces of each, and vertices between are made only where
one is looked for. Vertex ``_before + i + 1`` is where piece ``i`` of a leg begins; lengths are those of the pieces, plain and between vertices rounded
to six places (names that end in ``r``)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import geo
from ringlake.operators import near, ring
from ringlake.session import written

#: Room for rounding in metres.
SLACK_M = 1e-6


def _rounded(c: Column) -> Column:
    """``F.round(c, 6)``, which takes longer than all else on a piece, only where a tie may be near: elsewhere the nearest whole number of millionths is the same."""
    n = F.rint(c * 1e6)
    return F.when(F.abs(c * 1e6 - n) < 0.4999, n / 1e6).otherwise(F.round(c, 6))


def _piece(i: Column, r: ring.Ring, rounded: bool = False) -> Column:
    """Metres of a piece of a leg; none where a place is not known."""
    ends = [*ring.spot(i, r), *ring.spot(i + 1, r)]
    return F.coalesce(geo.haversine(*[_rounded(c) if rounded else c for c in ends]), F.lit(0.0))


def _until(i: Column, r: ring.Ring, rounded: bool = False) -> Column:
    """Metres of a leg before its piece ``i``."""
    return F.when(i > 0, F.aggregate(F.sequence(F.lit(0), i - 1), F.lit(0.0), lambda a, j: a + _piece(j, r, rounded))).otherwise(0.0)


def cut(v: DataFrame, r: ring.Ring = ring.R, most_m: float = 30.0) -> DataFrame:
    """Cut legs of closed rings, with their metres ``_len, _lenr`` and those before them ``_cum, _cumr``, the ring's ``_total, _totalr`` and ``_vertices``.
    The ring's last leg alone has ``_fin``, the metres up to the last vertex. Pieces are summed where they are made, by parts of about 500,000."""
    m = written(ring.cut_legs(v, r, most_m), "cut")
    parts = max(1, math.ceil((m.agg(F.sum("_n")).first()[0] or 0) / 500_000))
    i, ends = F.col("_i"), ["_x", "_y", "_x2", "_y2"]
    p = m.repartition(parts, *r.key).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    p = p.select("*", *[c.alias(n) for n, c in zip(ends, [*ring.spot(i, r), *ring.spot(i + 1, r)], strict=True)])
    p = p.select("*", *[_rounded(F.col(n)).alias(f"{n}r") for n in ends])
    metres = lambda c: F.coalesce(F.sum(geo.haversine(*[F.col(f"{n}{c}") for n in ends])), F.lit(0.0)).alias(f"_len{c}")
    m = p.groupBy(*r.key, "_before").agg(*[F.first(c).alias(c) for c in (r.lon, r.lat, "lon2", "lat2", "_n")], metres(""), metres("r"))
    o = r.by.orderBy("_before")
    for c in ("", "r"):
        m = m.withColumn(f"_cum{c}", F.coalesce(F.sum(f"_len{c}").over(o.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))).withColumn(f"_total{c}", F.sum(f"_len{c}").over(r.by))
    m = m.withColumn("_vertices", F.sum("_n").over(r.by))
    last = F.col("_before") + F.col("_n") == F.col("_vertices")
    return written(m.withColumn("_fin", F.when(last, F.col("_cum") + F.col("_len") - _piece(F.col("_n") - 1, r))), "legs")


def vertices(legs: DataFrame, r: ring.Ring, *more: str) -> DataFrame:
    """The vertices of cut legs by their number ``_k``, with ``more`` columns of the leg."""
    p = legs.select(*r.key, r.lon, r.lat, "lon2", "lat2", "_n", "_before", *more, F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i"))
    x, y = ring.spot(F.col("_i"), r)
    return p.select(*r.key, (F.col("_before") + F.col("_i") + 1).alias("_k"), x.alias(r.lon), y.alias(r.lat), *more)


def nearest(legs: DataFrame, points: DataFrame, point_key: list[str], r: ring.Ring = ring.R) -> DataFrame:
    """For each point ``(key, point_key, plon, plat, _back)`` its ring's nearest vertex ``_k``, the first among equals or with ``_back`` the last: the metres
    up to it ``_at, _atr``, and ``_total, _totalr, _vertices``.

    Only legs are looked at whose middle is no farther than half of the leg and the nearest vertex known; rings with many points
    and vertices are searched by groups of points (``near``).
    """
    key, by = list(r.key), [*r.key, *point_key]
    d = geo.haversine(F.col("plon"), F.col("plat"), F.col(r.lon), F.col(r.lat))
    order = F.when(F.col("_back"), -F.col("_k")).otherwise(F.col("_k"))
    many = points.groupBy(*key).agg(F.count("*").alias("_p")).where(F.col("_p") > near.FAN)
    many = many.join(legs.groupBy(*key).agg(F.sum("_n").alias("_m")).where(F.col("_m") > near.DIRECT), key).select(*key)
    hot = written(many, "hot")
    some = hot.first() is not None
    few, own = (points.join(hot, key, "left_anti"), legs.join(hot, key, "left_anti")) if some else (points, legs)
    x, y = geo.lerp(F.col(r.lon), F.col("lon2"), F.lit(0.5)), geo.lerp(F.col(r.lat), F.col("lat2"), F.lit(0.5))
    dx, dy = F.col("lon2") - F.col(r.lon), F.col("lat2") - F.col(r.lat)
    half = F.sqrt(dx * dx + dy * dy) * (geo.RADIUS_M * math.pi / 360.0)  # as on the equator
    reach = geo.haversine(F.col("plon"), F.col("plat"), x, y) - half

    def around(p: DataFrame, bound: str) -> DataFrame:
        return vertices(p.join(own, key).where(F.coalesce(reach <= F.col(bound) * near.SLACK + SLACK_M, F.lit(True))), r, *point_key, "plon", "plat", "_back", bound)

    def joined(p: DataFrame, more: DataFrame) -> DataFrame:
        same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in by]
        return p.alias("a").join(more.alias("b"), same).select("a.*", *[f"b.`{c}`" for c in more.columns if c not in by])

    known = joined(few, few.join(own, key).groupBy(*by).agg(F.min(d).alias("_known")))
    least = written(joined(few, around(known, "_known").groupBy(*by).agg(F.min(d).alias("_d"))), "least")
    found = around(least, "_d").groupBy(*by).agg(F.min(F.when(d.eqNullSafe(F.col("_d")), order)).alias("_o"))
    if some:
        v = vertices(legs.join(hot, key, "left_semi"), r)
        far = near.nearest(points.join(hot, key, "left_semi"), v, key, point_key, d, near.on_sphere("plon", "plat"), near.chord(near.on_sphere(r.lon, r.lat)))
        found = found.unionByName(far.groupBy(*by).agg(F.min(order).alias("_o")))
    at = found.withColumn("_k", F.abs("_o")).join(legs, key).where((F.col("_k") > F.col("_before")) & (F.col("_k") <= F.col("_before") + F.col("_n")))
    i = (F.col("_k") - F.col("_before") - 1).cast("int")
    return at.select(*by, "_k", (F.col("_cum") + _until(i, r)).alias("_at"), (F.col("_cumr") + _until(i, r, True)).alias("_atr"), "_total", "_totalr", "_vertices")


def places(legs: DataFrame, at: DataFrame, r: ring.Ring = ring.R, rounded: bool = False) -> DataFrame:
    """Rows of ``at(ring key, _u, ...)`` with the ``lon, lat`` that lie ``_u`` metres from the first vertex, on the plain ring or the rounded one.

    Metres wrap at the ring's total. Legs and places are merged by their metres, so the work is that of a sort, and then that of the one leg's pieces.
    """
    key, c = list(r.key), "r" if rounded else ""
    leg = F.struct(r.lon, r.lat, "lon2", "lat2", "_n", F.col(f"_cum{c}").alias("_cum"))
    both = legs.select(*key, leg.alias("_leg"), F.col(f"_cum{c}").alias("_pos"), F.col(f"_total{c}").alias("_total"), "_before")
    both = both.unionByName(at.select(*key, F.struct(*at.columns).alias("_row")), allowMissingColumns=True).withColumn("_total", F.max("_total").over(r.by))
    both = both.withColumn("_pos", F.coalesce("_pos", F.pmod(F.col("_row._u"), F.nullif("_total", F.lit(0.0))), F.lit(0.0)))
    o = r.by.orderBy("_pos", F.col("_leg").isNull(), "_before").rowsBetween(W.unboundedPreceding, 0)
    hit = both.withColumn("_hit", F.last("_leg", ignorenulls=True).over(o)).where(F.col("_row").isNotNull() & F.col("_hit").isNotNull())
    rest = hit.select("_row", (F.col("_pos") - F.col("_hit._cum")).alias("_rest"), "_hit.*")

    # vertices and metres of the leg's pieces stand in arrays, so that each is counted once
    spots = lambda i: F.struct(*[(_rounded(c) if rounded else c).alias(n) for n, c in zip("xy", ring.spot(i, r), strict=True)])
    p = lambda i: (F.get("_p", i)["x"], F.get("_p", i)["y"])
    rest = rest.withColumn("_p", F.transform(F.sequence(F.lit(0), F.col("_n")), spots))
    rest = rest.withColumn("_m", F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.coalesce(geo.haversine(*p(i), *p(i + 1)), F.lit(0.0))))

    def further(a: Column, m: Column) -> Column:
        """The piece that the place is on, or the last one, and the metres before it."""
        return F.when((a["i"] == F.col("_n") - 1) | (a["run"] + m >= F.col("_rest")), F.struct(a["run"].alias("run"), a["i"].alias("i"), F.lit(True).alias("on"))).otherwise(F.struct((a["run"] + m).alias("run"), (a["i"] + 1).alias("i"), F.lit(False).alias("on")))

    none = F.struct(F.lit(0.0).alias("run"), F.lit(0).alias("i"), F.lit(False).alias("on"))
    on = rest.withColumn("_on", F.aggregate("_m", none, lambda a, m: F.when(a["on"], a).otherwise(further(a, m))))
    i, m = F.col("_on.i"), F.get("_m", F.col("_on.i"))
    share = F.when(m > 0, F.least(F.lit(1.0), (F.col("_rest") - F.col("_on.run")) / m)).otherwise(0.0)
    (x, y), (x2, y2) = p(i), p(i + 1)
    return on.select(*[F.col(f"_row.`{n}`").alias(n) for n in at.columns], geo.lerp(x, x2, share).alias("lon"), geo.lerp(y, y2, share).alias("lat"))
