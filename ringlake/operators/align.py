"""Fit of lap markers to arc fractions from sparse anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import cyclic


def fits(anchors: DataFrame, key: list[str]) -> DataFrame:
    """``offset, residual`` forward, ``offset_r, residual_r`` reversed, and ``reversed`` where that is strictly better.

    ``anchors(key, marker, fraction)``; the offset is the circular mean of fraction less marker, the residual the sum of
    absolute differences from it. One anchor keeps its direction.
    """
    two = anchors.select(*key, "marker", F.explode(F.array(F.struct(F.lit("f").alias("way"), F.col("fraction").alias("f")), F.struct(F.lit("r").alias("way"), (1.0 - F.col("fraction")).alias("f")))).alias("w")).select(*key, "marker", "w.*")
    c = two.groupBy(*key, "way").agg(cyclic.mean(cyclic.frac(F.col("f") - F.col("marker"))).alias("offset"), F.count("*").alias("n"))
    res = two.join(c, [*key, "way"]).groupBy(*key, "way").agg(F.sum(F.abs(cyclic.signed(F.col("f") - F.col("marker") - F.col("offset")))).alias("residual"), F.max("offset").alias("offset"), F.max("n").alias("n"))
    pick = lambda c, w: F.max(F.when(F.col("way") == w, F.col(c)))
    g = res.groupBy(*key).agg(F.max("n").alias("n"), pick("offset", "f").alias("offset"), pick("residual", "f").alias("residual"), pick("offset", "r").alias("offset_r"), pick("residual", "r").alias("residual_r"))
    return g.withColumn("reversed", (F.col("n") > 1) & (F.col("residual_r") < F.col("residual")))


def placed(targets: DataFrame, anchors: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``targets(key, marker, ...)`` with ``fraction`` on the (possibly reversed) ring and ``reversed``.

    Without anchors the marker itself; with one a constant offset; with more, linear between neighbours, the last one
    carried a lap back and the first a lap on.
    """
    f = fits(anchors, key).select(*key, "n", "reversed")
    a = anchors.join(f, key).withColumn("f", F.when(F.col("reversed"), 1.0 - F.col("fraction")).otherwise(F.col("fraction")))
    o = W.partitionBy(*key).orderBy("marker", "f")
    step = F.col("f") - F.lag("f").over(o)
    a = a.withColumn("_u", F.sum(F.coalesce(F.when(step < 0, step + 1.0).otherwise(step), F.col("f"))).over(o.rowsBetween(W.unboundedPreceding, 0)))
    knots = a.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("marker", F.col("_u").alias("u")))).alias("_k"), F.max("n").alias("n"), F.bool_or("reversed").alias("reversed"))
    last, first = F.element_at("_k", -1), F.element_at("_k", 1)
    shift = lambda x, d: F.array(F.struct((x["marker"] + d).alias("marker"), (x["u"] + d).alias("u")))
    knots = knots.withColumn("_k", F.concat(shift(last, -1.0), F.col("_k"), shift(first, 1.0)))
    t = targets.join(knots, key, "left")
    lo, hi = F.element_at("_k", 1)["marker"], F.element_at("_k", -1)["marker"]
    m = F.when(F.col("marker") < lo, F.col("marker") + 1.0).when(F.col("marker") > hi, F.col("marker") - 1.0).otherwise(F.col("marker"))
    t = t.withColumn("_m", m).withColumn("_i", F.size(F.filter(F.slice("_k", 1, F.greatest(F.size("_k") - 1, F.lit(0))), lambda x: x["marker"] <= F.col("_m"))))
    p, q = F.try_element_at("_k", F.greatest(F.col("_i"), F.lit(1))), F.try_element_at("_k", F.greatest(F.col("_i"), F.lit(1)) + 1)
    width = q["marker"] - p["marker"]
    share = (F.col("_m") - p["marker"]) / F.when(width == 0, 1e-9).otherwise(width)
    out = F.when(F.col("_k").isNull(), cyclic.frac(F.col("marker"))).otherwise(cyclic.frac(p["u"] + share * (q["u"] - p["u"])))
    return t.withColumn("fraction", out).withColumn("reversed", F.coalesce("reversed", F.lit(False))).select(*targets.columns, "fraction", "reversed")
