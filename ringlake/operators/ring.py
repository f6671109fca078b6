"""Closed polylines in long form: one row a vertex, keyed by ring columns and ordered by one column.

Every operator needs one shuffle on the ring key; windows over the same key share it. Rings of any number spread over
the cluster; one ring is ordered in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import geo
from ringlake.operators import near
from ringlake.session import dealt


@dataclass(frozen=True)
class Ring:
    """Names of the ring columns."""

    key: tuple[str, ...] = ("ring",)
    seq: str = "seq"
    lon: str = "lon"
    lat: str = "lat"

    @property
    def by(self):
        return W.partitionBy(*self.key)

    @property
    def inorder(self):
        return self.by.orderBy(self.seq)


R = Ring()


def _wrapped_next(name: str, r: Ring) -> Column:
    """Value of the next vertex, the first after the last."""
    whole = r.inorder.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return F.coalesce(F.lead(name).over(r.inorder), F.first(name).over(whole))


def legs(v: DataFrame, r: Ring = R, closed: bool = True, radius: float = geo.RADIUS_M) -> DataFrame:
    """Adds the next vertex ``lon2, lat2`` and the leg's metres ``seg_m``; an open line's last leg is null."""
    nxt = (lambda c: _wrapped_next(c, r)) if closed else (lambda c: F.lead(c).over(r.inorder))
    out = v.withColumn("lon2", nxt(r.lon)).withColumn("lat2", nxt(r.lat))
    return out.withColumn("seg_m", geo.haversine(F.col(r.lon), F.col(r.lat), F.col("lon2"), F.col("lat2"), radius))


def measured(v: DataFrame, r: Ring = R, closed: bool = True, radius: float = geo.RADIUS_M) -> DataFrame:
    """Legs with ``cum_m`` (metres from the start to this vertex) and ``total_m``."""
    before = r.inorder.rowsBetween(W.unboundedPreceding, -1)
    return legs(v, r, closed, radius).withColumn("cum_m", F.coalesce(F.sum("seg_m").over(before), F.lit(0.0))).withColumn("total_m", F.coalesce(F.sum("seg_m").over(r.by), F.lit(0.0)))


def summary(v: DataFrame, r: Ring = R, closed: bool = True) -> DataFrame:
    """Length, vertex mean, bounding box and signed area (east of the first vertex; negative runs clockwise) of each ring."""
    first = r.inorder.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    m = legs(v, r, closed).withColumn("lon0", F.first(r.lon).over(first)).withColumn("lat0", F.first(r.lat).over(first))
    x, y = (lambda c: geo.east(F.col(c), F.col("lon0"), F.col("lat0"))), (lambda c: geo.north(F.col(c), F.col("lat0")))
    wrap = m.withColumn("cross", x(r.lon) * y("lat2") - x("lon2") * y(r.lat))
    return wrap.groupBy(*r.key).agg(
        F.count("*").alias("vertices"), F.coalesce(F.sum("seg_m"), F.lit(0.0)).alias("length_m"), F.avg(r.lon).alias("centre_lon"), F.avg(r.lat).alias("centre_lat"),
        F.min(r.lon).alias("min_lon"), F.max(r.lon).alias("max_lon"), F.min(r.lat).alias("min_lat"), F.max(r.lat).alias("max_lat"), (F.sum("cross") / 2.0).alias("area_m2"),
    )


def points_at(v: DataFrame, at: DataFrame, fraction: str = "fraction", r: Ring = R, clamp: bool = False) -> DataFrame:
    """Rows of ``at(ring key, fraction, ...)`` with the interpolated ``lon, lat`` on their ring.

    Fractions wrap (1.0 is the start); with ``clamp`` they are held to 0..1 instead. A target belongs to the first leg
    whose end reaches it, the last one beyond all. Rings without length answer their first vertex. Legs and targets are
    merged by their place on the ring, so the work is that of a sort, not of their product.
    """
    return points_on_measured(measured(v, r), at, fraction, r, clamp)


def points_on_measured(m: DataFrame, at: DataFrame, fraction: str = "fraction", r: Ring = R, clamp: bool = False) -> DataFrame:
    """``points_at`` on rings that are measured already."""
    key = list(r.key)
    leg = F.struct(F.col(r.lon).alias("x"), F.col(r.lat).alias("y"), F.col("lon2").alias("x2"), F.col("lat2").alias("y2"), "cum_m", "seg_m", F.col(r.seq).cast("long").alias("seq"))
    legs_ = m.select(*key, leg.alias("_leg"), (F.col("cum_m") + F.col("seg_m")).alias("_pos"), F.col("total_m").alias("_total"))
    f = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(fraction))) if clamp else F.pmod(F.col(fraction), F.lit(1.0))
    both = legs_.unionByName(at.select(*key, F.struct(*at.columns).alias("_row"), f.alias("_f")), allowMissingColumns=True)
    both = both.withColumn("_total", F.max("_total").over(r.by)).withColumn("_last", F.max(F.struct(F.col("_leg.seq").alias("s"), F.col("_leg").alias("leg"))).over(r.by)["leg"])
    both = both.withColumn("_pos", F.coalesce("_pos", F.col("_f") * F.col("_total")))
    down = r.by.orderBy(F.col("_pos").desc(), F.col("_leg").isNull(), F.col("_leg.seq").desc()).rowsBetween(W.unboundedPreceding, 0)
    hit = both.withColumn("_hit", F.coalesce(F.last("_leg", ignorenulls=True).over(down), F.col("_last"))).where(F.col("_row").isNotNull() & F.col("_hit").isNotNull())
    share = F.when(F.col("_hit.seg_m") > 0, F.least(F.lit(1.0), (F.col("_pos") - F.col("_hit.cum_m")) / F.col("_hit.seg_m"))).otherwise(0.0)
    return hit.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in at.columns], geo.lerp(F.col("_hit.x"), F.col("_hit.x2"), share).alias("lon"), geo.lerp(F.col("_hit.y"), F.col("_hit.y2"), share).alias("lat"))


def nearest_vertex(v: DataFrame, points: DataFrame, point_key: list[str], r: Ring = R) -> DataFrame:
    """For each point (``plon, plat``) its ring's nearest vertex (the first among equals): ``seq, cum_m, fraction, dist_m``.

    Long rings are searched by groups of points (``near``); points of rings without vertices give no row."""
    return nearest_measured(measured(v, r), points, point_key, r)


def nearest_measured(m: DataFrame, points: DataFrame, point_key: list[str], r: Ring = R) -> DataFrame:
    """``nearest_vertex`` of rings that are measured already."""
    d = geo.haversine(F.col("plon"), F.col("plat"), F.col(r.lon), F.col(r.lat))
    j = near.nearest(points, m, list(r.key), point_key, d, near.on_sphere("plon", "plat"), near.chord(near.on_sphere(r.lon, r.lat)))
    best = j.groupBy(*r.key, *point_key).agg(F.min_by(F.struct(r.seq, "cum_m", "total_m", F.col("_d").alias("dist_m")), F.struct("_d", r.seq)).alias("n"))
    return best.select(*r.key, *point_key, F.col(f"n.{r.seq}").alias(r.seq), "n.cum_m", F.coalesce(F.col("n.cum_m") / F.nullif("n.total_m", F.lit(0.0)), F.lit(0.0)).alias("fraction"), "n.dist_m")


def nearest_on_line(v: DataFrame, points: DataFrame, point_key: list[str], r: Ring = R) -> DataFrame:
    """The nearest place on any leg, on the plane tangent at the point: ``fraction, dist_m``. Long rings are searched by groups of points."""
    points = points.withColumn("_k", F.cos(F.radians("plat")))  # once a point, not for each leg
    x = lambda c: (F.col(c) - F.col("plon")) * F.col("_k") * geo.DEGREE_M
    y = lambda c: geo.north(F.col(c), F.col("plat"))
    qx, qy = x("lon2") - x(r.lon), y("lat2") - y(r.lat)
    t = geo.along(-x(r.lon), -y(r.lat), qx, qy)
    dx, dy = x(r.lon) + qx * t, y(r.lat) + qy * t

    def gap(at: list[Column], scale: Column) -> Column:
        """Degrees from a leg, as counted at the latitude of the scale."""
        ax, ay, bx, by = (F.col(r.lon) - at[0]) * scale, F.col(r.lat) - at[1], (F.col("lon2") - F.col(r.lon)) * scale, F.col("lat2") - F.col(r.lat)
        s = geo.along(-ax, -ay, bx, by)
        return F.sqrt((ax + bx * s) * (ax + bx * s) + (ay + by * s) * (ay + by * s))

    j = near.nearest(points, measured(v, r), list(r.key), point_key, F.sqrt(dx * dx + dy * dy), [F.col("plon"), F.col("plat")], gap, F.abs("_k"), r.seq)
    j = j.withColumn("fraction", F.coalesce((F.col("cum_m") + t * F.col("seg_m")) / F.nullif("total_m", F.lit(0.0)), F.lit(0.0)))
    return j.groupBy(*r.key, *point_key).agg(F.min_by(F.struct("fraction", F.col("_d").alias("dist_m")), F.struct("_d", r.seq)).alias("n")).select(*r.key, *point_key, "n.fraction", "n.dist_m")


def off_line(v: DataFrame, points: DataFrame, point_key: list[str], r: Ring = R) -> DataFrame:
    """``dist_m`` from each point (``plon, plat``) to its open line, by the nearest vertex and the two legs beside it.

    Every vertex carries its neighbours, so only the nearest one's legs are measured; long lines are searched by groups of points."""
    before = [F.lag(c).over(r.inorder).alias(f"_{c}") for c in (r.lon, r.lat)]
    m = legs(v, r, closed=False).select(*r.key, r.seq, r.lon, r.lat, "lon2", "lat2", *before)
    d = geo.haversine(F.col("plon"), F.col("plat"), F.col(r.lon), F.col(r.lat))
    j = near.nearest(points, m, list(r.key), point_key, d, near.on_sphere("plon", "plat"), near.chord(near.on_sphere(r.lon, r.lat)))
    own = F.struct(F.col(r.lon).alias("x"), F.col(r.lat).alias("y"), F.col("lon2").alias("x2"), F.col("lat2").alias("y2"), F.col(f"_{r.lon}").alias("x0"), F.col(f"_{r.lat}").alias("y0"), F.col("_d").alias("d"), "plon", "plat")
    best = j.groupBy(*r.key, *point_key).agg(F.min_by(own, F.struct("_d", r.seq)).alias("n"))

    def foot(leg: Column) -> Column:
        px, py = F.col("n.plon"), F.col("n.plat")
        k = F.cos(F.radians(py))
        qx, qy = (leg["x2"] - leg["x"]) * k, leg["y2"] - leg["y"]
        t = F.when((qx == 0) & (qy == 0), 0.0).otherwise(geo.along((px - leg["x"]) * k, py - leg["y"], qx, qy))
        return F.when(leg["x"].isNotNull() & leg["x2"].isNotNull(), geo.haversine(px, py, geo.lerp(leg["x"], leg["x2"], t), geo.lerp(leg["y"], leg["y2"], t)))

    c = lambda n: F.col(f"n.{n}")
    leg = lambda *n: F.struct(*[c(x).alias(a) for x, a in zip(n, ("x", "y", "x2", "y2"), strict=True)])
    beside = F.array_min(F.transform(F.array(leg("x", "y", "x2", "y2"), leg("x0", "y0", "x", "y")), foot))
    return best.select(*r.key, *point_key, F.least(c("d"), beside).alias("dist_m"))


def rounded_curve(v: DataFrame, r: Ring = R, x: str = "lon", y: str = "lat") -> DataFrame:
    """A closed Catmull-Rom spline through the vertices as cubic legs: from (``x, y``) by the control points ``c1x, c1y, c2x, c2y`` to
    ``x2, y2``. Rings under three vertices give none."""
    whole = r.inorder.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    o, n = r.inorder, F.count("*").over(r.by)

    def at(c: str, by: int):
        if by < 0:
            return F.coalesce(F.lag(c).over(o), F.last(c).over(whole))
        return F.coalesce(F.lead(c, by).over(o), F.nth_value(c, by).over(whole) if by == 1 else F.when(F.lead(c, 1).over(o).isNull(), F.nth_value(c, 2).over(whole)).otherwise(F.first(c).over(whole)))

    s = v.withColumn("_n", n)
    for c in (x, y):
        s = s.withColumn(f"_{c}0", at(c, -1)).withColumn(f"_{c}2", at(c, 1)).withColumn(f"_{c}3", at(c, 2))
    control = [((F.col(c) + (F.col(f"_{c}2") - F.col(f"_{c}0")) / 6).alias(f"c1{d}"), (F.col(f"_{c}2") - (F.col(f"_{c}3") - F.col(c)) / 6).alias(f"c2{d}"), F.col(f"_{c}2").alias(f"{d}2")) for c, d in ((x, "x"), (y, "y"))]
    return s.where("_n >= 3").select(*r.key, r.seq, x, y, *control[0], *control[1])


def _pieces(seg_m: Column, most_m: float) -> Column:
    """How many equal pieces of at most ``most_m`` a leg makes."""
    return F.coalesce(F.when(seg_m > most_m, F.floor(seg_m / most_m).cast("int") + 1).otherwise(1), F.lit(1))


def cut_legs(v: DataFrame, r: Ring = R, most_m: float = 30.0, closed: bool = True) -> DataFrame:
    """Legs with the number ``_n`` of equal pieces of at most ``most_m`` that each makes, and of the pieces ``_before`` it."""
    m = legs(v, r, closed).withColumn("_n", _pieces(F.col("seg_m"), most_m))
    m = m.withColumn("_before", F.coalesce(F.sum("_n").over(r.inorder.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return m.select(*r.key, r.lon, r.lat, "lon2", "lat2", "_n", "_before")


def spot(i: Column, r: Ring = R) -> tuple[Column, Column]:
    """Where piece ``i`` of a cut leg begins; the last one ends at the next vertex."""
    t = i / F.col("_n").cast("double")
    one = lambda a, b: F.when(i == 0, F.col(a)).when(i == F.col("_n"), F.col(b)).otherwise(geo.lerp(F.col(a), F.col(b), t))
    return one(r.lon, "lon2"), one(r.lat, "lat2")


def densified(v: DataFrame, r: Ring = R, most_m: float = 30.0, closed: bool = True) -> DataFrame:
    """Legs over ``most_m`` are cut into equal pieces: ``seq2`` orders the new vertices. They are numbered by the pieces before each leg, so
    they are not sorted, and legs are dealt out by the pieces that they make."""
    m = cut_legs(v, r, most_m, closed)
    many = m.agg(F.avg("_n")).first()[0] or 1.0
    cut = dealt(m, list(r.key), 500_000, many).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    x, y = spot(F.col("_i"), r)
    return cut.select(*r.key, (F.col("_before") + F.col("_i") + 1).cast("int").alias(r.seq), x.alias(r.lon), y.alias(r.lat))


def rotated(v: DataFrame, starts: DataFrame, r: Ring = R) -> DataFrame:
    """Each ring starts at the ``start_seq`` that ``starts(ring key, start_seq)`` names; others stay."""
    j = v.join(starts, list(r.key), "left").withColumn("_i", F.row_number().over(r.inorder) - 1).withColumn("_n", F.count("*").over(r.by))
    k = F.max(F.when(F.col(r.seq) == F.col("start_seq"), F.col("_i"))).over(r.by)
    return j.withColumn("_k", F.coalesce(k, F.lit(0))).withColumn(r.seq, F.pmod(F.col("_i") - F.col("_k"), F.col("_n")) + 1).drop("_i", "_n", "_k", "start_seq")


def oriented(v: DataFrame, want: DataFrame, r: Ring = R) -> DataFrame:
    """Rings whose winding disagrees with ``want(ring key, direction)`` are reversed: ``clockwise`` asks for a negative area, any
    other word for the opposite; null and '' ask for nothing."""
    area = summary(v, r).select(*r.key, "area_m2")
    asked = F.col("direction").isNotNull() & (F.col("direction") != "")
    turn = area.join(want, list(r.key), "left").select(*r.key, (asked & ((F.col("area_m2") < 0) != (F.col("direction") == "clockwise"))).alias("_turn"))
    j = v.join(turn, list(r.key), "left").withColumn("_i", F.row_number().over(r.inorder)).withColumn("_n", F.count("*").over(r.by))
    return j.withColumn(r.seq, F.when(F.coalesce("_turn", F.lit(False)), F.col("_n") - F.col("_i") + 1).otherwise(F.col("_i"))).drop("_i", "_n", "_turn")


def closing(v: DataFrame, r: Ring = R) -> DataFrame:
    """The rows that close rings: the first vertex once more at the end, unless the last equals it."""
    ends = v.groupBy(*r.key).agg(F.min_by(F.struct(r.lon, r.lat), r.seq).alias("a"), F.max_by(F.struct(r.lon, r.lat), r.seq).alias("b"), F.max(r.seq).alias("n"))
    return ends.where(F.col("a") != F.col("b")).select(*r.key, (F.col("n") + 1).cast(v.schema[r.seq].dataType).alias(r.seq), F.col(f"a.{r.lon}").alias(r.lon), F.col(f"a.{r.lat}").alias(r.lat))


def closed_ring(v: DataFrame, r: Ring = R) -> DataFrame:
    """The first vertex once more at the end, unless the last equals it."""
    return v.select(*r.key, r.seq, r.lon, r.lat).unionByName(closing(v, r))


def opened_ring(v: DataFrame, r: Ring = R) -> DataFrame:
    """Rings of three vertices or more without a last vertex that equals the first."""
    whole = r.inorder.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    again = (F.lead(r.seq).over(r.inorder).isNull()) & (F.count("*").over(r.by) > 2) & (F.col(r.lon) == F.first(r.lon).over(whole)) & (F.col(r.lat) == F.first(r.lat).over(whole))
    return v.select(*r.key, r.seq, r.lon, r.lat, F.coalesce(again, F.lit(False)).alias("_again")).where("not _again").drop("_again")


def sliced(v: DataFrame, cuts: DataFrame, r: Ring = R) -> DataFrame:
    """The part of each ring between ``from_f`` and ``to_f``: cut ends interpolated, vertices strictly between kept."""
    m = measured(v, r).withColumn("_f", F.coalesce(F.col("cum_m") / F.nullif("total_m", F.lit(0.0)), F.lit(0.0)))
    inner = cuts.join(m, list(r.key)).where("_f > from_f and _f < to_f").select(*cuts.columns, F.col("_f").alias("at"), F.col(r.lon).alias("lon"), F.col(r.lat).alias("lat"))
    ends = cuts.withColumn("at", F.explode(F.array("from_f", "to_f")))
    return inner.unionByName(points_at(v, ends, "at", r, clamp=True).select(*inner.columns))


def resampled(v: DataFrame, r: Ring = R, step_m: float = 4.0, least: int = 80) -> DataFrame:
    """``max(least, round(total / step))`` evenly spaced points with local metres ``x, y``: the ring as a signal."""
    def sized(v: DataFrame) -> DataFrame:
        return measured(v, r, radius=geo.SIGNAL_RADIUS_M).groupBy(*r.key).agg(F.max("total_m").alias("total_m"), F.avg(r.lat).alias("_lat0"), F.min_by(r.lon, r.seq).alias("_lon0"))

    n = F.greatest(F.lit(least), F.round(F.col("total_m") / step_m).cast("int"))
    v = v.repartition(math.ceil((sized(v).agg(F.sum(n)).first()[0] or 1) / 200_000), *r.key)  # a sort holds the points of a part
    total = sized(v)
    at = total.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).withColumn("s", F.col("i") * F.col("total_m") / F.col("n")).withColumn("fraction", F.col("i") / F.col("n").cast("double"))
    p = points_at(v, at, "fraction", r)
    k = geo.SIGNAL_RADIUS_M * 3.141592653589793 / 180.0
    return p.withColumn("x", geo.east(F.col("lon"), F.col("_lon0"), F.col("_lat0"), k)).withColumn("y", geo.north(F.col("lat"), F.col("_lat0"), k)).drop("_lat0", "_lon0", "fraction")


def anomalies(v: DataFrame, r: Ring = R, long_m: float = 60.0, back_degrees: float = 145.0, least_leg_m: float = 10.0) -> DataFrame:
    """Vertices whose leg is long, or where the line turns back: ``seg_m, turn``, null where in order."""
    m = legs(v, r)
    px, py = F.lag(r.lon).over(r.inorder), F.lag(r.lat).over(r.inorder)
    k = F.cos(F.radians(F.col(r.lat))) * geo.DEGREE_M
    m = m.withColumn("_ax", (F.col(r.lon) - px) * k).withColumn("_ay", (F.col(r.lat) - py) * geo.DEGREE_M).withColumn("_bx", (F.col("lon2") - F.col(r.lon)) * k).withColumn("_by", (F.col("lat2") - F.col(r.lat)) * geo.DEGREE_M)
    size = lambda a, b: F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))
    turn = F.when((size("_ax", "_ay") >= least_leg_m) & (size("_bx", "_by") >= least_leg_m), geo.turn_degrees(F.col("_ax"), F.col("_ay"), F.col("_bx"), F.col("_by")))
    m = m.withColumn("turn", turn).withColumn("long_m", F.when(F.col("seg_m") > long_m, F.col("seg_m"))).withColumn("back", F.when(F.col("turn") > back_degrees, F.col("turn")))
    return m.select(*r.key, r.seq, "seg_m", "long_m", "back")


def quality(v: DataFrame, expected: DataFrame, r: Ring = R) -> DataFrame:
    """``score`` of each ring, lower is better: length error + 8 a metre over 60 + 25 a degree over 145, on the densified
    ring; rings under eight vertices score infinity. ``expected(ring key, expected_m)`` may lack rings.

    The densified ring is not made: its line turns at the given vertices only, and its pieces are measured one by one only where degrees
    of longitude may make one longer than 60 m."""
    m = legs(v, r).withColumn("_n", _pieces(F.col("seg_m"), 30.0))
    x, y, x2, y2 = F.col(r.lon), F.col(r.lat), F.col("lon2"), F.col("lat2")
    over = lambda i: F.greatest(F.lit(0.0), F.coalesce(geo.haversine(*spot(i, r), *spot(i + 1, r)) - 60.0, F.lit(0.0))) * 8.0
    most = F.sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y)) * (geo.RADIUS_M * 3.141592653589793 / 180.0) / F.col("_n")  # of a piece, as on the equator
    m = m.withColumn("_over", F.when(most > 59.0, F.aggregate(F.sequence(F.lit(0), F.col("_n") - 1), F.lit(0.0), lambda a, i: a + over(i))).otherwise(0.0))
    o = r.inorder
    m = m.withColumn("_x0", F.lag(r.lon).over(o)).withColumn("_y0", F.lag(r.lat).over(o)).withColumn("_n0", F.lag("_n").over(o))
    k = F.cos(F.radians(F.col(r.lat))) * geo.DEGREE_M
    ax, ay, bx, by = (x - F.col("_x0")) * k / F.col("_n0"), (y - F.col("_y0")) * geo.DEGREE_M / F.col("_n0"), (x2 - x) * k / F.col("_n"), (y2 - y) * geo.DEGREE_M / F.col("_n")
    turn = F.when((F.sqrt(ax * ax + ay * ay) >= 10.0) & (F.sqrt(bx * bx + by * by) >= 10.0), geo.turn_degrees(ax, ay, bx, by))
    dense = m.withColumn("_turn", turn).groupBy(*r.key).agg(F.sum("_over").alias("_long"), F.coalesce(F.sum(F.when(F.col("_turn") > 145.0, (F.col("_turn") - 145.0) * 25.0)), F.lit(0.0)).alias("_back"))
    base = summary(v, r).select(*r.key, "vertices", "length_m").join(dense, list(r.key)).join(expected, list(r.key), "left")
    score = F.coalesce(F.abs(F.col("length_m") - F.col("expected_m")), F.lit(0.0)) + F.col("_long") + F.col("_back")
    return base.select(*r.key, "vertices", "length_m", F.when(F.col("vertices") < 8, F.lit(float("inf"))).otherwise(score).alias("score"))
