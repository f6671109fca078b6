"""Hard negatives by Fagin's threshold algorithm over integer inner products.

Rows come in shards, as many as a batch holds, each with its rows sorted along every dimension. An anchor reads these lists
from the end that its own sign makes the better one, scores each row it meets first there by random access, and stops
once the sum of what the lists still offer falls strictly below what its windows hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.llm.spaces import staged, table
from ringlake.llm.vectors import extent, matrix, pieces, usable

#: Components of a block of anchors that is sent to every executor, and rows of a shard.
BLOCK, SHARD = 1 << 22, 4096
LEAST, LAST = -(1 << 62), (1 << 63) - 1


class Lists:
    """A shard's rows sorted along each dimension, worst and best first."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        up = np.argsort(x, axis=0, kind="stable").T
        self.order = np.stack([up, up[:, ::-1]]).astype(np.int32)
        self.value = np.stack([np.take_along_axis(x.T, up, 1), np.take_along_axis(x.T, up, 1)[:, ::-1]])


class Windows:
    """The best rows of one anchor in each of its score windows: higher scores first, then smaller ids."""

    __slots__ = ("low", "high", "scores", "ids", "kth", "k")

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.kth = low.copy()  # below it nothing can enter
        self.scores, self.ids = [np.empty(0, np.int64)] * len(low), [np.empty(0, np.int64)] * len(low)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.kth[:, None]) & (scores <= self.high[:, None])
        for p in np.flatnonzero(fits.any(1)):
            s, i = np.concatenate([self.scores[p], scores[fits[p]]]), np.concatenate([self.ids[p], ids[fits[p]]])
            top = np.lexsort((i, -s))[: self.k]
            self.scores[p], self.ids[p] = s[top], i[top]
            if len(top) == self.k:
                self.kth[p] = max(self.low[p], s[top[-1]])

    def closed(self, offer: int | None) -> bool:
        """Whether no row that the lists still hold can enter: each window is empty, or what they offer is strictly below its kth score
        (below its lower end, while it is not full)."""
        return bool(((self.low > self.high) | ((offer < self.kth) if offer is not None else False)).all())


def search(lists: Lists, w: np.ndarray, skip: np.ndarray, found: Windows) -> None:
    """The threshold algorithm for one anchor ``w`` over one shard; rows marked in ``skip`` never score."""
    n, dims = len(lists.x), np.flatnonzero(w)
    side = (w[dims] > 0).astype(np.int64)
    weight, seen, at, depth = w[dims], skip.copy(), 0, 32
    if not len(dims):  # the zero vector: every row scores 0
        new = np.flatnonzero(~seen)
        return found.add(np.zeros(len(new), np.int64), lists.ids[new])
    if found.closed(int((weight * lists.value[side, dims, 0]).sum())):
        return
    while at < n:
        upto = min(n, depth)
        before = seen.copy()
        seen[lists.order[side, dims, at:upto]] = True
        new = np.flatnonzero(seen & ~before)
        if len(new):
            found.add(lists.x[new] @ w, lists.ids[new])
        if found.closed(int((weight * lists.value[side, dims, upto - 1]).sum())) or seen.all():
            return
        at, depth = upto, 2 * depth


class Anchors:
    """One block of anchors: numbers, ids, labels and vectors, and each one's windows."""

    def __init__(self, number, ids, label, x):
        self.number, self.ids, self.label, self.x = number, ids, label, x
        self.low = self.high = None


def best(batches, block: Anchors, dim: int, scale: int, k: int, same: bool):
    """A task's best rows for each anchor and window, over all its shards."""
    found: dict[int, Windows] = {}
    wide = lambda: (np.array([LEAST]), np.array([-LEAST]))
    for b in pieces(batches, dim, SHARD * max(1, dim)):
        ids = b.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
        label, x = b.column(1).to_numpy(zero_copy_only=False), matrix(b.column(2), dim, scale)
        if same:  # each label's rows are a shard of their own
            parts = [(Lists(x[at], ids[at]), np.flatnonzero(block.label == v)) for v in np.intersect1d(label, block.label) if len(at := np.flatnonzero(label == v))]
        else:
            parts = [(Lists(x, ids), np.arange(len(block.number)))]
        for lists, who in parts:
            for a in who.tolist():
                if a not in found:
                    found[a] = Windows(*(wide() if same else (block.low[a], block.high[a])), k)
                skip = (lists.ids == block.ids[a]) if same else (label == block.label[a])
                search(lists, block.x[a], skip, found[a])
    out = [(block.number[a], p, s, i) for a, f in found.items() for p in range(len(f.low)) for s, i in zip(f.scores[p].tolist(), f.ids[p].tolist(), strict=True)]
    for at in range(0, len(out), 1 << 16):
        number, window, score, row = map(list, zip(*out[at : at + (1 << 16)], strict=True))
        yield pa.record_batch({"number": pa.array(number, pa.int64()), "window": pa.array(window, pa.int32()), "score": pa.array(score, pa.int64()), "id": pa.array([None if i == LAST else i for i in row], pa.int64())})


def mined(df: DataFrame, id_col: str, vec_col: str, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its best other rows of its label; for each, the negatives are the best rows of other labels that
    score ``low`` to ``high`` percent of the positive's score. Scores are integer inner products of ``floor(scale * x)``; ties go
    to the smaller id.

    Anchors are a stated set of queries against all rows. They are staged, and go to the executors in blocks of bounded size; for
    each block every task reads its rows once for the positives and once for the negatives, without a shuffle of rows, and
    emits its own best, whose merge is a limited ranking by anchor.

    Rows with a null label, a null vector or a null, NaN or infinite component take no part. Shorter vectors end in zeros. A
    row of an anchor's own id is not its positive; repeated rows each count, as anchors too. Null ids come last among ties and
    are never anchors by id (2**63 - 1 stands for them). Fewer rows than asked give all there are; an empty table, or one
    without anchors, gives none. Only the named columns are read, so other names never clash. Raises ValueError where scores
    do not fit 64 bits.
    """
    spark = df.sparkSession
    rows = df.where(label.isNotNull() & usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vec_col).alias("vec"), is_anchor.alias("_anchor"))
    dim, top = extent(rows, "vec", scale)
    if dim * top * top * 100 >= 1 << 62:
        raise ValueError("components are too large for exact 64-bit scores")
    plain = rows.select("id", "label", "vec")
    anchors = staged(rows.where("_anchor").select("id", "label", "vec", F.monotonically_increasing_id().alias("number")), "anchors")
    blocks = -(-anchors.count() * max(1, dim) // BLOCK)
    schema, out = "number long, window int, score long, id long", None

    def ranked(found: DataFrame, keep: int, *by: str) -> DataFrame:
        o = W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(o)).where(F.col("rank") <= keep)

    for n in range(blocks):
        t = anchors.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == n).toArrow().combine_chunks()
        if not t.num_rows:
            continue
        whole = lambda c: t[c].combine_chunks()
        block = Anchors(whole("number").to_numpy(), whole("id").fill_null(LAST).to_numpy(zero_copy_only=False), whole("label").to_numpy(), matrix(whole("vec"), dim, scale))
        sent = spark.sparkContext.broadcast(block)
        near = staged(ranked(plain.mapInArrow(lambda b, s=sent: best(b, s.value, dim, scale, positives, True), schema), positives, "number"), "positives")
        held = near.select("number", "rank", "score").toArrow()  # at most ``positives`` rows an anchor of the block
        place = {v: i for i, v in enumerate(block.number.tolist())}
        block.low, block.high = np.ones((len(place), positives), np.int64), np.zeros((len(place), positives), np.int64)
        a, p = np.array([place[v] for v in held["number"].to_pylist()], np.int64), held["rank"].to_numpy().astype(np.int64) - 1
        score = held["score"].to_numpy()
        block.low[a, p], block.high[a, p] = -(-low * score // 100), high * score // 100
        sent = spark.sparkContext.broadcast(block)
        hard = ranked(plain.mapInArrow(lambda b, s=sent: best(b, s.value, dim, scale, negatives, False), schema), negatives, "number", "window")
        pairs = near.select("number", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        names = anchors.select("number", F.col("id").alias("anchor_id"))
        hit = hard.join(pairs, ["number", "window"]).join(names, "number")
        one = staged(hit.select("anchor_id", "positive_id", (F.col("window") + 1).alias("positive_rank"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long")


def op13_threshold_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 50; null labels and broken vectors take no part, an empty table gives no rows."""
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    found = mined(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
