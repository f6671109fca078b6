"""The nearest items of many places on rings of any length, by an exact search from groups of places down to single ones.

Places are packed along a space-filling curve into groups of ``FAN``, groups of groups above them. From the top, a group keeps the
items that may be nearest to any of its places: by the triangle inequality those no farther from its middle than the nearest one
and twice its radius. Items are measured themselves, not by boxes about them, so long legs are left out as well as short ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlake.operators import slices
from ringlake.session import written

#: Places of a group and groups of a group; keys of up to ``FAN`` places or ``DIRECT`` items meet at once.
FAN, DIRECT = 16, 512
#: Room for rounding in distances.
SLACK = 1 + 1e-9


def curve(places: list[Column], bits: int) -> Column:
    """Place on a Z curve of coordinates in 0..1."""
    cells = [F.least(F.floor(F.coalesce(p, F.lit(0.0)) * float(1 << bits)), F.lit((1 << bits) - 1)).cast("long") for p in places]
    out = F.lit(0).cast("long")
    for b in range(bits):
        for d, c in enumerate(cells):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1)), b * len(cells) + d))
    return out


def nearest(points: DataFrame, items: DataFrame, key: list[str], point_key: list[str], dist: Column, at: list[Column], gap: Callable[[list[Column], Column], Column], scale: Column | None = None, order: str | None = None) -> DataFrame:
    """Each point ``(key, point_key, ...)`` with the items of its key at its least ``dist``, all of them where several are or that of the least ``order``: columns of both, and ``_d``.

    ``at`` are a point's coordinates and ``gap`` is the distance of an item from such coordinates, in whose order ``dist`` puts the items. The first
    coordinate counts ``scale`` (of the point, 1 if None) times in it, and ``gap`` must not shrink as that grows. In keys over ``DIRECT`` items
    and ``FAN`` points, points and items without a distance are left out.

    Pairs are never sorted or shuffled: one pass over them finds each point's least distance, a second one the items at it.
    """
    hot = points.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > FAN)
    hot = hot.join(items.groupBy(*key).agg(F.count("*").alias("_m")).where(F.col("_m") > DIRECT), key)
    top = hot.agg(F.max("_n")).first()[0]
    if top is None:
        return _least(points, items, key, point_key, dist, order)
    hot = written(hot.select(*key), "hot")
    direct = _least(points.join(hot, key, "left_anti"), items.join(hot, key, "left_anti"), key, point_key, dist, order)
    p, close = _grouped(points.join(hot, key, "left_semi"), key, at, F.lit(1.0) if scale is None else scale, top), items.join(hot, key, "left_semi")
    close = written(close.repartition(*close.columns), "items")  # a key's items by no means stay in one task
    levels = 1
    while top > FAN**levels:
        levels += 1
    dims = range(len(at))
    for n in range(levels, -1, -1):  # down to single places
        cell = F.floor(F.col("_i") / FAN**n).cast("long")
        box = p.groupBy(*key, cell.alias("_g")).agg(*[F.min(f"_p{d}").alias(f"_l{d}") for d in dims], *[F.max(f"_p{d}").alias(f"_h{d}") for d in dims], F.min("_s").alias("_s0"), F.max("_s").alias("_s1"))
        half = [(F.col(f"_h{d}") - F.col(f"_l{d}")) / 2 * (F.col("_s1") if d == 0 else F.lit(1.0)) for d in dims]
        radius = F.sqrt(sum((h * h for h in half), F.lit(0.0)))
        group = written(box.select(*key, "_g", F.floor(F.col("_g") / FAN).cast("long").alias("_up"), *[((F.col(f"_l{d}") + F.col(f"_h{d}")) / 2).alias(f"_p{d}") for d in dims], "_s0", "_s1", radius.alias("_r")), "groups")
        j = close.join(group.drop("_up"), key) if n == levels else close.withColumnRenamed("_g", "_up").join(group, [*key, "_up"])
        middle = [F.col(f"_p{d}") for d in dims]
        bound = j.groupBy(*key, "_g").agg(F.min(gap(middle, F.col("_s1"))).alias("_best"))
        reach = group.select(*key, "_g", "_s0", "_r", *middle, "_up").join(written(bound, "bounds"), [*key, "_g"])
        j = close.join(reach.drop("_up"), key) if n == levels else close.withColumnRenamed("_g", "_up").join(reach, [*key, "_up"])
        close = written(j.where(gap(middle, F.col("_s0")) <= (F.col("_best") + 2 * F.col("_r")) * SLACK + 1e-12).select(*items.columns, "_g"), "close")
    p = p.withColumn("_g", F.col("_i").cast("long")).drop("_i", "_s", *[f"_p{d}" for d in dims])
    return direct.unionByName(_least(p, close, [*key, "_g"], ["_pid"], dist, order).drop("_g", "_pid"))


def _grouped(points: DataFrame, key: list[str], at: list[Column], scale: Column, top: int) -> DataFrame:
    """The points with a number ``_pid``, coordinates ``_p0, ...``, scale ``_s`` and rank ``_i`` along a curve through their key's places."""
    dims = range(len(at))
    p = points.withColumn("_pid", F.monotonically_increasing_id())
    for d in dims:
        p = p.withColumn(f"_p{d}", at[d])
    p = written(p.withColumn("_s", scale).where(" and ".join(f"_p{d} is not null" for d in dims)), "points")
    ends = p.groupBy(*key).agg(*[F.min(f"_p{d}").alias(f"_l{d}") for d in dims], *[F.max(f"_p{d}").alias(f"_h{d}") for d in dims])
    place = [(F.col(f"_p{d}") - F.col(f"_l{d}")) / F.nullif(F.col(f"_h{d}") - F.col(f"_l{d}"), F.lit(0.0)) for d in dims]
    z = p.join(ends, key).withColumn("_z", curve(place, 30 // len(at))).drop(*[f"_{e}{d}" for e in "lh" for d in dims])
    return written(slices.ranked(z, key, "_z", "_i").drop("_z"), "ranked")


def _least(points: DataFrame, items: DataFrame, key: list[str], point_key: list[str], dist: Column, order: str | None = None) -> DataFrame:
    """The pairs of a key at the point's least distance, with ``order`` only that of the least one; equal point keys are one point.

    With ``order`` the distance stands in aggregates of numbers alone: there its parts are counted once a pair, and a filter's again and again."""
    by = [*key, *point_key]
    best = points.join(items, key).groupBy(*by).agg(F.min(dist).alias("_d"))
    same = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in by]
    held = points.alias("a").join(best.alias("b"), same).select("a.*", "b._d")
    if order is None:
        return held.join(items, key).where(dist.eqNullSafe(F.col("_d")))
    held = written(held, "least")
    first = held.join(items, key).groupBy(*by).agg(F.min(F.when(dist.eqNullSafe(F.col("_d")), F.col(order))).alias(order))
    return held.alias("a").join(first.alias("b"), same).select("a.*", f"b.`{order}`").join(items, [*key, order])


def on_sphere(lon: str | Column, lat: str | Column) -> list[Column]:
    """Place on the unit sphere, where the chord grows with the great circle."""
    x, y = F.radians(lon), F.radians(lat)
    return [F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y)]


def chord(place: list[Column]) -> Callable[[list[Column], Column], Column]:
    """Distance of an item's place on the sphere from another."""
    return lambda at, scale: F.sqrt(sum(((a - b) * (a - b) for a, b in zip(at, place, strict=True)), F.lit(0.0)))
