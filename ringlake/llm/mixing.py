"""Mixing overlapping sources to target weights by min-cost flow (operator 6).

Documents are aggregated by membership pattern, the set of sources they belong to. Tokens flow from patterns, whose
capacity may be used up to ``repeats`` times at convex cost (each further use costs more), to the sources' quotas.
As the cost of a unit depends only on which use of its pattern it is, successive shortest paths become maximum flows
over one use, two uses, and so on, each kept and extended. Seeded document selection then realises each flow.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import staged, table


def word_counts(docs: DataFrame, text_col: str, out: str = "size") -> DataFrame:
    """Every row with its number of words; null has none. The other columns pass through Arrow unchanged."""
    names = [f.name for f in docs.schema]
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names if n != text_col]).alias("rest"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rest = packed.schema["rest"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, off in B.cut(batches):
            _, _, first = B.words(buf, off)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(first[1:] - first[:-1], pa.int64())], names=["rest", "size"])

    return packed.mapInArrow(scan, f"rest {rest}, size bigint").select("rest.*", F.col("size").alias(out))


def targets(sizes: dict, weights: dict, repeats: float) -> dict:
    """Shares of all sizes by weight; a target stops at ``repeats`` times its source's size and the excess is shared anew by weight."""
    left, open_, out = float(sum(sizes.values())), dict(weights), {}
    while open_:
        total = sum(open_.values())
        over = [s for s, w in open_.items() if left * w / total > repeats * sizes[s]]
        if not over:
            out |= {s: left * w / total for s, w in open_.items()}
            break
        for s in over:
            out[s] = float(repeats * sizes[s])
            del open_[s]
        left -= sum(out[s] for s in over)
    return out


class _Flow:
    """Integer maximum flow (Dinic) whose capacities may be raised between runs."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[int] = []

    def arc(self, a: int, b: int, cap: int) -> int:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.cap += [cap, 0]
        return len(self.to) - 2

    def run(self, s: int, t: int) -> None:
        while True:
            level = {s: 0}
            queue = deque([s])
            while queue:
                a = queue.popleft()
                for e in self.out[a]:
                    if self.cap[e] and self.to[e] not in level:
                        level[self.to[e]] = level[a] + 1
                        queue.append(self.to[e])
            if t not in level:
                return
            turn = [0] * len(self.out)
            while True:
                path, a = [], s
                while a != t:
                    while turn[a] < len(self.out[a]):
                        e = self.out[a][turn[a]]
                        if self.cap[e] and level.get(self.to[e]) == level[a] + 1:
                            break
                        turn[a] += 1
                    else:
                        if not path:
                            break
                        a = self.to[path.pop() ^ 1]
                        turn[a] += 1
                        continue
                    path.append(e)
                    a = self.to[e]
                if a != t or not path:
                    break
                most = min(self.cap[e] for e in path)
                for e in path:
                    self.cap[e] -= most
                    self.cap[e ^ 1] += most


def route(patterns: list[tuple[tuple, int]], quota: dict, repeats: int) -> dict:
    """``{(pattern number, source): tokens}`` of least repetition cost among those that fill the quotas best."""
    sources = list(quota)
    n = len(patterns)
    flow = _Flow(n + len(sources) + 2)
    s, t = n + len(sources), n + len(sources) + 1
    number = {x: n + i for i, x in enumerate(sources)}
    feed = [flow.arc(s, i, 0) for i in range(n)]
    legs = {(i, x): flow.arc(i, number[x], 1 << 62) for i, (members, _) in enumerate(patterns) for x in members}
    for x in sources:
        flow.arc(number[x], t, round(quota[x]))
    for _ in range(repeats):
        for e, (_, size) in zip(feed, patterns, strict=True):
            flow.cap[e] += size
        flow.run(s, t)
    return {k: flow.cap[e ^ 1] for k, e in legs.items() if flow.cap[e ^ 1]}


def mix(rows: DataFrame, members_col: str, size_col: str, key: list[str], weights, repeats: int = 3, seed: int = 17, max_patterns: int = 100_000) -> DataFrame:
    """``rows`` with ``_copies array<source>`` (one entry per time the row is taken), the sources' sizes and their targets.

    ``members_col`` is a sorted array of sources, null standing for itself. ``weights(sources)`` gives their weights.
    A pattern's documents stand in seeded order, those large against the flow's remainder first, larger ones earlier;
    their copies are laid end to end, once for each use, and a copy goes to the source in whose interval its middle
    falls. Cumulative sums run over hash slices first, so no task orders a whole source. What a source's taken tokens then
    lack or exceed is closed by single documents, whichever is nearest to it in size. Rows of size 0 are never taken.
    Raises beyond ``max_patterns`` membership patterns, which are collected.
    """
    spark = rows.sparkSession
    total = rows.groupBy(members_col).agg(F.sum(size_col).alias("tokens"), F.count("*").alias("n")).limit(max_patterns + 1).collect()
    if len(total) > max_patterns:
        raise ValueError(f"over {max_patterns} membership patterns")
    patterns = sorted(((tuple(r[0] or ()), int(r[1] or 0)) for r in total), key=lambda p: [(x is None, x or "") for x in p[0]])
    count = max((r[2] for r in total), default=0)
    sizes: dict = {}
    for members, size in patterns:
        for x in members:
            sizes[x] = sizes.get(x, 0) + size
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    goal = targets({x: sizes[x] for x in order}, weights(order), repeats) if order else {}
    sent = route(patterns, goal, repeats) if order else {}
    plan = []
    for i, (members, size) in enumerate(patterns):
        ends, at = [], 0
        for x in members:
            if f := sent.get((i, x), 0):
                at += f
                ends.append((x, at))
        plan.append((list(members), size, at % size if size and at < repeats * size else 0, ends))
    schema = "_members array<string>, _tokens bigint, _rest bigint, _ends array<struct<source string, upto bigint>>"
    plans = F.broadcast(spark.createDataFrame(plan, schema))  # one row a pattern, bounded above
    slices = max(64, min(1 << 20, count // 1000))
    h = F.xxhash64(*key, F.lit(seed))
    known = rows.join(plans, F.col(members_col).eqNullSafe(F.col("_members"))).where(F.col(size_col) > 0)
    big = F.when(F.col(size_col) > F.col("_rest"), F.lit(100)).when(F.col(size_col) * 100 > F.col("_rest"), 40 - F.floor(F.log2(F.col(size_col).cast("double"))).cast("int")).otherwise(F.lit(50))
    known = known.withColumn("_h", h).withColumn("_class", big).withColumn("_slice", F.pmod(F.shiftright("_h", 7), F.lit(slices)).cast("int"))
    group = ["_members", "_class", "_slice"]
    sums = known.groupBy(*group).agg(F.sum(size_col).alias("_sum"))
    before = sums.withColumn("_before", F.sum("_sum").over(W.partitionBy("_members").orderBy("_class", "_slice").rowsBetween(W.unboundedPreceding, 0)) - F.col("_sum")).drop("_sum")
    placed = known.join(before, group).withColumn("_at", F.col("_before") + F.sum(size_col).over(W.partitionBy(*group).orderBy("_h", *key).rowsBetween(W.unboundedPreceding, 0)) - F.col(size_col))
    middle = [(F.lit(u) * F.col("_tokens") + F.col("_at")) + F.col(size_col) / 2 for u in range(repeats)]

    def owner(at):
        return F.slice(F.transform(F.filter("_ends", lambda e: at < e["upto"]), lambda e: e["source"]), 1, 1)

    copies = F.flatten(F.array(*map(owner, middle)))
    taken = closer(placed.select(*rows.columns, copies.alias("_copies")), members_col, size_col, key, goal, repeats, seed)
    none = rows.where(F.coalesce(F.col(size_col), F.lit(0)) <= 0).withColumn("_copies", F.array().cast("array<string>"))
    return taken.unionByName(none), sizes, goal


def closer(taken: DataFrame, members_col: str, size_col: str, key: list[str], goal: dict, repeats: int, seed: int) -> DataFrame:
    """``taken`` with one copy more or less of a few rows, so that each source's taken tokens come as near to its goal as single documents bring them.

    One pass gathers for each source a row of every size class (a sixteenth of a power of two) that may take a copy more, and one that may
    lose its copy; the driver then takes whichever one, or two where one leaves over a thousandth, brings a source nearest to
    its goal, again and again as long as that helps. It holds up to some 700 rows a source, however many documents there are.
    """
    spark = taken.sparkSession
    rows = staged(taken.withColumn("_u", F.monotonically_increasing_id()), "taken")
    sums = {r[0]: int(r[1]) for r in rows.select(F.explode("_copies").alias("x"), size_col).groupBy("x").agg(F.sum(size_col)).collect()}
    gap = {x: g - sums.get(x, 0) for x, g in goal.items()}
    if all(abs(g) < 1 for g in gap.values()):
        return rows.drop("_u")
    h = F.xxhash64(*key, F.lit(seed))
    one = rows.select("_u", F.col(size_col).alias("_s"), "_copies", h.alias("_h"), F.explode(members_col).alias("_x"))
    way = F.array_compact(F.array(F.when(F.size("_copies") < repeats, 1), F.when(F.exists("_copies", lambda c: c.eqNullSafe(F.col("_x"))), -1)))
    ranks = F.floor(F.log2(F.col("_s").cast("double")) * 16).cast("int")
    least = one.withColumn("_by", F.explode(way)).groupBy("_x", "_by", ranks.alias("_class")).agg(F.min(F.struct("_h", "_u", "_s")).alias("b")).select("_x", "_by", "b._u", "b._s").collect()
    may: dict = {}
    for x, by, u, size in sorted(least, key=lambda r: (r[0] is None, r[0] or "", r[3], r[1], r[2])):
        may.setdefault(x, []).append((by, u, int(size)))
    done, used = [], set()
    for x, g in gap.items():
        while free := [m for m in may.get(x, []) if m[1] not in used]:
            step = np.array([by * size for by, _, size in free], float)
            one_off = np.abs(g - step)
            took, off = [int(one_off.argmin())], float(one_off.min())
            if off > max(1.0, goal[x] / 1000):
                row = np.array([u for _, u, _ in free])
                pair = np.abs(g - step[:, None] - step[None, :])
                pair[row[:, None] == row[None, :]] = np.inf
                if pair.min() < off:
                    took, off = list(map(int, np.unravel_index(pair.argmin(), pair.shape))), float(pair.min())
            if off >= abs(g):
                break
            for k in took:
                by, u, size = free[k]
                g -= by * size
                used.add(u)
                done.append((u, x, by))
    if not done:
        return rows.drop("_u")
    moves = F.broadcast(spark.createDataFrame(done, "_u long, _to string, _by int"))
    at = F.array_position(F.transform("_copies", lambda c: F.coalesce(c, F.lit("\x00"))), F.coalesce("_to", F.lit("\x00"))).cast("int")
    less = F.filter("_copies", lambda c, i: i + 1 != at)
    return rows.join(moves, "_u", "left").withColumn("_copies", F.when(F.col("_by") == 1, F.array_append("_copies", F.col("_to"))).when(F.col("_by") == -1, less).otherwise(F.col("_copies"))).drop("_u", "_to", "_by")


def cycle_weights(order: list) -> dict:
    return {x: (5, 2, 1)[i % 3] for i, x in enumerate(order)}


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", repeats: int = 3, seed: int = 17, keep: str | None = None) -> DataFrame:
    """``(id, size, source, source_size, target, copies)`` for every row, and its column ``keep``.

    Sources by code point, null last, weigh 5, 2, 1 in turn. Null and wordless texts have size 0 and are never taken.
    Repeated rows each count; ties in the seeded order are between equal rows; an empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"), *([F.col(keep).alias("kept")] if keep else []))
    sized = staged(word_counts(rows.withColumn("mark", F.xxhash64("text")), "text").withColumn("members", F.array("source")), "sizes")
    out, sizes, goal = mix(sized, "members", "size", ["id", "mark"], cycle_weights, repeats, seed)
    facts = docs.sparkSession.createDataFrame([(x, int(sizes[x]), float(goal[x])) for x in sizes], "_s string, source_size bigint, target double")
    return out.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("_s"))).select("id", "size", "source", "source_size", "target", F.size("_copies").alias("copies"), *([F.col("kept").alias(keep)] if keep else []))


def op6_min_cost_flow_mixing(spark, sf_dir: str) -> DataFrame:
    found = mixed_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
