"""Small numpy trainers and crc32 splits shared by the learned operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(doc_id, modulus: int):
    """``crc32(doc_id as text) mod modulus``; null ids count as remainder of the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def bounded_sample(texts: DataFrame, cls: str, per_class: int, most_chars: int, labels: DataFrame | None = None, on: str | None = None, seed: int = 11):
    """At most ``per_class`` rows of each class with at most ``most_chars`` characters in all, as pandas ``(text, cls)``.

    A text over a quarter of ``most_chars`` counts, and comes, as its first quarter, so that no single text ends the sample.

    ``texts(text, ...)`` has the class itself, or ``labels(on, cls)`` joins it by ``on``. Rows come in order of a hash of
    their text, so reruns pick the same ones. Only hashes and lengths are counted, joined and ranked, over all rows;
    the few rows of the sample then fetch their texts through a broadcast of their keys, which the bounds limit.
    """
    from pyspark.sql import Window as W

    own, share = [on] if on else [], max(1, most_chars // 4)
    hashed = texts.where("text is not null").withColumn("_k", F.xxhash64(F.col("text"), F.lit(seed)))
    light = hashed.select(*own, *([cls] if labels is None else []), "_k", F.least(F.length("text"), F.lit(share)).alias("_len"))
    if labels is not None:
        light = light.join(labels.select(on, cls), on)
    light = light.where(F.col(cls).isNotNull())
    known = {r[0]: (r[1], r[2] or 1) for r in light.groupBy(cls).agg(F.count("*"), F.sum("_len")).collect()}
    part = F.pmod("_k", F.lit(1 << 30)) / float(1 << 30)
    pick = F.lit(False)
    for c, (n, chars) in sorted(known.items()):
        pick = pick | ((F.col(cls) == F.lit(c)) & (part < min(1.0, 1.3 * per_class / n + 30 / n, 1.3 * most_chars / chars + 30 / n)))
    by = W.partitionBy(cls).orderBy(part, "_k", *own)
    head = light.where(pick).dropDuplicates([cls, "_k", *own]).withColumn("_r", F.row_number().over(by)).withColumn("_n", F.sum("_len").over(by.rowsBetween(W.unboundedPreceding, 0)))
    keys = head.where((F.col("_r") <= per_class) & (F.col("_n") <= most_chars)).select(*own, cls, "_k", "_r")
    rows = [tuple(r) for r in keys.collect()]
    found = hashed.drop(cls).join(F.broadcast(texts.sparkSession.createDataFrame(rows, keys.schema)), ["_k", *own]).dropDuplicates([cls, "_k", *own])
    return found.select(F.substring("text", 1, share).alias("text"), cls, "_r").toPandas().sort_values([cls, "_r"], ignore_index=True)[["text", cls]]


class Adam:
    def __init__(self, params: list[np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)
