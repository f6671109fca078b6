"""Lap-speed profiles: a curvature limit, then braking and traction as closed-form windows over the unrolled ring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Top speed, lateral grip, braking and acceleration by car class.
CARS = {"lmph": (90.0, 34.0, 46.0, 17.0), "gt3": (78.0, 27.0, 36.0, 12.0), "bmw328": (42.0, 12.0, 11.0, 4.5)}


def corner_speed(kappa, vmax: float, lateral: float):
    return F.when(kappa <= 1e-4, vmax).otherwise(F.least(F.lit(vmax), F.sqrt(lateral / kappa)))


def profile(samples: DataFrame, key: list[str], limit: str, step: str, braking: float, traction: float) -> DataFrame:
    """Adds ``speed``: the greatest profile under ``limit`` that brakes and accelerates within bounds around the ring.

    ``step`` is the distance to the next sample. Braking: ``u_i^2 = min over the lap ahead of limit_j^2 + 2 b (S_j - S_i)``;
    traction likewise over the lap behind: a minimum over a window of the unrolled ring instead of sweeps.
    """
    o = W.partitionBy(*key).orderBy("i")
    s = samples.withColumn("_n", F.count("*").over(W.partitionBy(*key))).withColumn("_lap", F.sum(step).over(W.partitionBy(*key))).withColumn("_s", F.coalesce(F.sum(step).over(o.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    roll = s.withColumn("_t", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn("_S", F.col("_s") + F.col("_t") * F.col("_lap")).withColumn("_j", F.col("i") + F.col("_t") * F.col("_n"))
    u = W.partitionBy(*key).orderBy("_j")
    # a whole lap or more ahead adds only greater values, so the window may run to the unrolled end
    ahead = F.min(F.col(limit) * F.col(limit) + 2 * braking * F.col("_S")).over(u.rowsBetween(0, W.unboundedFollowing)) - 2 * braking * F.col("_S")
    roll = roll.withColumn("_u", ahead)
    behind = F.min(F.col("_u") - 2 * traction * F.col("_S")).over(u.rowsBetween(W.unboundedPreceding, 0)) + 2 * traction * F.col("_S")
    return roll.withColumn("speed", F.sqrt(F.greatest(F.lit(0.0), behind))).where("_t = 0").drop("_n", "_lap", "_s", "_t", "_S", "_j", "_u")


def states(profiled: DataFrame, key: list[str], band: float = 0.4) -> DataFrame:
    """Adds ``state``: brake, throttle or corner, by the change to the next sample."""
    from ringlake.operators.signal import neighbour

    d = neighbour("speed", key, 1) - F.col("speed")
    return profiled.withColumn("state", F.when(d < -band, "brake").when(d > band, "throttle").otherwise("corner"))


def sampled(profiled: DataFrame, at: DataFrame, key: list[str], metres: str) -> DataFrame:
    """Rows of ``at(key, metres, ...)`` with the sample ``i`` they follow, the ``share`` of the way to the next one and the interpolated ``speed``, on
    profiles ``(key, i, s, step, speed)``; metres wrap at the lap. Samples and places are merged, so each place looks at one sample only."""
    from ringlake.operators.signal import neighbour

    by = W.partitionBy(*key)
    p = profiled.withColumn("_next", neighbour("speed", key, 1)).select(*key, F.struct("i", "s", "step", "speed", "_next").alias("_p"), F.col("s").alias("_pos"), "step")
    both = p.unionByName(at.select(*key, F.struct(*at.columns).alias("_row"), F.col(metres).alias("_m")), allowMissingColumns=True).withColumn("_lap", F.sum("step").over(by))
    both = both.withColumn("_pos", F.coalesce("_pos", F.pmod("_m", "_lap")))
    hit = both.withColumn("_p", F.last("_p", ignorenulls=True).over(by.orderBy("_pos", F.col("_p").isNull(), "_p.i").rowsBetween(W.unboundedPreceding, 0))).where("_row is not null and _p is not null")
    share = F.coalesce((F.col("_pos") - F.col("_p.s")) / F.nullif("_p.step", F.lit(0.0)), F.lit(0.0))
    return hit.select(*[F.col(f"_row.{c}").alias(c) for c in at.columns], F.col("_p.i").alias("i"), share.alias("share"), (F.col("_p.speed") + (F.col("_p._next") - F.col("_p.speed")) * share).alias("speed"))
