"""Assembly of unordered line segments into one closed lap. Searches are inherently sequential, so each group, one small
graph, is one Arrow-batched Python call; groups spread over the cluster."""

from __future__ import annotations

from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.functions import geo
from ringlake.functions.geo import RADIUS_M
from ringlake.session import dealt

Line = np.ndarray  # (points, 2) of lon, lat


def metres(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = np.radians(a), np.radians(b)
    d = (b - a) / 2
    h = np.sin(d[..., 1]) ** 2 + np.cos(a[..., 1]) * np.cos(b[..., 1]) * np.sin(d[..., 0]) ** 2
    return 2 * RADIUS_M * np.arcsin(np.minimum(1.0, np.sqrt(h)))


def length(line: Line) -> float:
    return float(metres(line[:-1], line[1:]).sum())


def measured(lines: list[Line]) -> tuple[np.ndarray, list[float]]:
    """Both ends of each line, and its metres: all lines at once."""
    n = [len(s) for s in lines]
    points, stop = np.concatenate(lines), np.cumsum(n)
    start, leg = stop - n, metres(points[:-1], points[1:])
    return np.stack([points[start], points[stop - 1]], 1), [float(leg[a] if b - a == 2 else leg[a : b - 1].sum()) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]


def joined(lines: list[Line], same_m: float) -> Line:
    """Lines laid end to end: each is flipped where its tail is nearer, and a shared end point counts once."""
    ends = np.stack([[s[0] for s in lines], [s[-1] for s in lines]], 1)
    apart = metres(ends[:-1, :, None], ends[1:, None]).tolist()  # from either end of a line to either end of the next
    out, tail = [lines[0]], 1
    for s, gaps in zip(lines[1:], apart, strict=True):
        head = int(gaps[tail][1] < gaps[tail][0])
        s = s[::-1] if head else s
        out.append(s[1:] if gaps[tail][head] < same_m else s)
        tail = 1 - head
    return np.concatenate(out)


def in_order(lines: list[Line]) -> Line:
    """Chain in the given order; the first line is turned towards the second."""
    ends = lines[1][[0, -1]]
    if metres(lines[0][0], ends).min() < metres(lines[0][-1], ends).min():
        lines = [lines[0][::-1], *lines[1:]]
    return joined(lines, 1.0)


def walked(link: tuple | None) -> list:
    """The values of a chain of links (value, link before), first one first."""
    out = []
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def lap_cycle(lines: list[Line], expected: float | None, most_steps: int = 200_000) -> Line | None:
    """The simple cycle through the longest line whose length is nearest the expected one (or greatest).

    Nodes are end points snapped to 1/20000 degree; paths over 1.6 times the expected length plus 2 km are dropped. The search
    ends once no cycle can be better: at the expected length, or with all lines.
    """
    ends, size = measured(lines)
    ends = [(tuple(a), tuple(b)) for a, b in np.rint(ends * 20_000).astype(int).tolist()]
    at: dict = {}
    for i, (a, b) in enumerate(ends):
        at.setdefault(a, []).append((i, b))
        at.setdefault(b, []).append((i, a))
    seed = max(range(len(lines)), key=size.__getitem__)
    goal, limit = ends[seed][0], expected * 1.6 + 2000 if expected else float("inf")
    best: tuple[float, tuple] | None = None
    ideal = 0.0 if expected else -sum(size) * (1 - 1e-12)
    # a state: node, last link (line, link before), lines used as bits, length
    todo = [(ends[seed][1], (seed, None), 1 << seed, size[seed])]
    for _ in range(most_steps):
        if not todo:
            break
        node, path, used, run = todo.pop()
        if run > limit:
            continue
        if node == goal and path[1]:
            off = abs(run - expected) if expected else -run
            if best is None or off < best[0]:
                best = off, path
                if off <= ideal:
                    break
            continue
        todo += [(to, (i, path), used | 1 << i, run + size[i]) for i, to in at.get(node, ()) if not used >> i & 1]
    return joined([lines[i] for i in walked(best[1])], 10.0) if best else None


def relation_lap(lines: list[Line], expected: float | None) -> Line | None:
    """Best of both strategies by closing gap (to 500 m) and relative length error; a single line must nearly close."""
    if len(lines) == 1:
        return lines[0] if metres(lines[0][0], lines[0][-1]) < 50 else None
    laps = [x for x in (in_order(lines), lap_cycle(lines, expected)) if x is not None]
    return min(laps, key=lambda x: min(float(metres(x[0], x[-1])), 500.0) + (abs(length(x) - expected) / expected * 1000 if expected else 0))


def stitched_lap(lines: list[Line], expected: float | None, reach: float = 120.0, gap: float = 300.0, seeds: int = 8, budget: int = 20_000) -> tuple[float, Line] | None:
    """Closed chain of the best score (gap plus length error) from the longest seeds: at most three of the tightest joins
    are followed from each of the first seven links, one from there on. A score of 0 ends the search, since only a
    lower one would count."""
    ends, size = measured(lines)
    order = sorted(range(len(lines)), key=lambda i: -size[i])
    lines, ends, size = [lines[i] for i in order], ends[order], [size[i] for i in order]
    every = ends.reshape(-1, 2)
    lat, band = np.radians(every[:, 1]), reach / RADIUS_M * (1 + 1e-9)  # no nearer than their latitudes are
    block = max(1, 20_000 // len(every))
    near: dict = {}
    held = 0

    def joins(i: int, e: int) -> list:
        """Joins within reach of an end, the tightest first; for a block of ends at once."""
        nonlocal held
        if (i, e) not in near:
            if held > 1_000_000:  # bounds the memory of a large group
                near.clear()
                held = 0
            first = (2 * i + e) // block * block
            tails = np.arange(first, min(first + block, len(every)))
            t, h = np.nonzero(np.abs(lat[tails, None] - lat) <= band)
            d = metres(every[h], every[tails[t]])
            in_reach = np.flatnonzero(d < reach)
            in_reach = in_reach[np.lexsort((h[in_reach], d[in_reach], t[in_reach]))]
            near.update(((int(x) // 2, int(x) % 2), []) for x in tails)
            for x, m, y in zip(tails[t[in_reach]].tolist(), d[in_reach].tolist(), h[in_reach].tolist(), strict=True):
                near[x // 2, x % 2].append((m, y // 2, y % 2 == 1))
            held += len(in_reach)
        return near[i, e]

    best = None
    for seed in range(min(seeds, len(lines))):
        left = budget
        # a state: last link ((line, flipped), link before), links, lines used as bits, length
        todo = [(((seed, False), None), 1, 1 << seed, size[seed])]
        home = metres(ends[seed][0], ends).tolist()
        while todo and left and (best is None or best[0] > 0.0):
            left -= 1
            chain, links, used, run = todo.pop()
            tail = chain[0][0], 0 if chain[0][1] else 1
            open_m = home[tail[0]][tail[1]]
            if open_m <= gap:
                whole = run + open_m
                if not expected or 0.6 * expected <= whole <= 1.5 * expected:
                    off = open_m + (abs(whole - expected) if expected else 0.0)
                    if best is None or off < best[0]:
                        best = off, chain
            if expected and run > 1.6 * expected:
                continue
            free = list(islice((x for x in joins(*tail) if not used >> x[1] & 1), 3 if links <= 7 else 1))
            todo += [(((i, flip), chain), links + 1, used | 1 << i, run + join * (join >= 1) + size[i]) for join, i, flip in reversed(free)]
    if best is None:
        return None
    parts = [lines[i][::-1] if flip else lines[i] for i, flip in walked(best[1])]
    again = metres(np.array([s[-1] for s in parts[:-1]]).reshape(-1, 2), np.array([s[0] for s in parts[1:]]).reshape(-1, 2)) < 1
    out = np.concatenate([parts[0], *[s[1:] if same else s for s, same in zip(parts[1:], again.tolist(), strict=True)]])
    return best[0], out


def assembled(segments: DataFrame, key: list[str], how: str = "relation") -> DataFrame:
    """Laps from ``segments(key, ord, name, expected_m, points array<struct<lon, lat>>)`` as ``(key, seq, lon, lat)``.

    ``relation`` takes the segments as an ordered relation; ``stitch`` as loose ways, first those of a name that three or
    more share, then all. Groups without a lap give no rows; lines of under two points are left out.
    """
    def one(group: pa.Table) -> pa.Table:
        group = group.filter(pc.greater(pc.list_value_length(group["points"]), 1)).sort_by("ord").combine_chunks()
        lines = []
        if len(group):
            points = group["points"].combine_chunks()
            at = np.stack([points.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("lon", "lat")], 1).astype(float)
            lines = np.split(at, np.cumsum(points.value_lengths().to_numpy())[:-1])
        known = group["expected_m"].drop_null().to_numpy().astype(float)
        known = known[~np.isnan(known)]
        expected = float(known.max()) if len(known) else None
        lap = None
        if lines and how == "relation":
            lap = relation_lap(lines, expected)
        elif lines:
            names = group["name"].to_pylist()
            often = Counter(n for n in names if n)
            top = max(often, key=often.__getitem__, default=None)
            top = top if often[top] >= 3 else None
            pools = ([[x for x, n in zip(lines, names, strict=True) if n == top]] if top else []) + [lines]
            lap = next((x[1] for x in (stitched_lap(pool, expected) for pool in pools) if x), None)
        n = 0 if lap is None else len(lap)
        at = np.empty((0, 2)) if lap is None else lap
        keys = [group[k].combine_chunks().take(pa.array(np.zeros(n, int))) for k in key]
        return pa.Table.from_arrays([*keys, pa.array(np.arange(1, n + 1)), pa.array(np.ascontiguousarray(at[:, 0])), pa.array(np.ascontiguousarray(at[:, 1]))], [*key, "seq", "lon", "lat"])

    kinds = ", ".join(f"{k} {segments.schema[k].dataType.simpleString()}" for k in key)
    # a search takes far longer than its rows tell, so parts are small and their number is kept
    return dealt(segments, key, 20_000).groupBy(*key).applyInArrow(one, f"{kinds}, seq bigint, lon double, lat double")


def member_segments(relations: DataFrame, key: list[str]) -> DataFrame:
    """Lap members of relation documents (``elements``): ways of a lap role with two points or more, first use of each way."""
    from pyspark.sql import Window as W

    rel = relations.select(*key, "expected_m", F.inline(F.filter("elements", lambda e: e["type"] == "relation"))).select(*key, "expected_m", F.posexplode("members").alias("ord", "m"))
    role = F.coalesce(F.col("m.role"), F.lit(""))
    ways = rel.where((F.col("m.type") == "way") & role.isin("", "forward", "backward", "main_track"))
    ways = ways.withColumn("_r", F.row_number().over(W.partitionBy(*key, "m.ref").orderBy("ord"))).where("_r = 1 or m.ref is null")
    return ways.where(F.size("m.geometry") >= 2).select(*key, "ord", F.lit("").alias("name"), "expected_m", F.transform("m.geometry", lambda g: F.struct(g["lon"].alias("lon"), g["lat"].alias("lat"))).alias("points"))


#: Names of ways that are no part of a lap, and of those that are no corner.
OFF_LAP = r"(?i)pit|penalty|long lap|safety|kart|karting|moto\b|motorcycle|drift|short|club course|school|oval|ドリフト|ショート|カート|スクール|paddock|service|access"
NO_CORNER = r"(?i)pit|circuit|ligne droite|straight|long lap|penalty|safety car|porsche center|maison blanche|s du garage|moto"


def corner_ways(ways: DataFrame, key: list[str]) -> DataFrame:
    """``(key, ord, name, points, lon, lat)``: named ways (``elements``) of two points or more whose name may be a corner's, with their mean point."""
    w = ways.select(*key, F.posexplode("elements").alias("ord", "e")).where((F.col("e.type") == "way") & (F.size("e.geometry") >= 2))
    w = w.withColumn("name", F.try_element_at("e.tags", F.lit("name"))).where((F.coalesce("name", F.lit("")) != "") & ~F.col("name").rlike(NO_CORNER))
    mean = lambda c: F.aggregate(F.transform("e.geometry", lambda g: g[c]), F.lit(0.0), lambda a, x: a + x) / F.size("e.geometry")
    return w.select(*key, "ord", "name", F.transform("e.geometry", lambda g: F.struct(g["lon"].alias("lon"), g["lat"].alias("lat"))).alias("points"), mean("lon").alias("lon"), mean("lat").alias("lat"))


def way_segments(ways: DataFrame, key: list[str], drop: str = OFF_LAP) -> DataFrame:
    """Segments of loose ways (``elements``) whose name is not dropped."""
    w = ways.select(*key, "expected_m", F.posexplode("elements").alias("ord", "e")).where((F.col("e.type") == "way") & (F.size("e.geometry") >= 2))
    name = F.coalesce(F.try_element_at("e.tags", F.lit("name")), F.lit(""))
    return w.where(~name.rlike(drop)).select(*key, "ord", name.alias("name"), "expected_m", F.transform("e.geometry", lambda g: F.struct(g["lon"].alias("lon"), g["lat"].alias("lat"))).alias("points"))


def pit_lane_centres(ways: DataFrame, key: list[str]) -> DataFrame:
    """Mean of all vertices of the loose ways (``elements``) that are named like a pit lane: ``lon, lat``; no row without one."""
    e = ways.select(*key, F.explode("elements").alias("e")).where((F.col("e.type") == "way") & F.coalesce(F.try_element_at("e.tags", F.lit("name")), F.lit("")).rlike("(?i)pit ?lane"))
    return e.select(*key, F.explode("e.geometry").alias("g")).groupBy(*key).agg(F.avg("g.lon").alias("lon"), F.avg("g.lat").alias("lat"))


#: Names of ways that no trace of the racing surface takes.
OFF_TRACE = r"(?i)pit|bugatti|prost|c\.?i\.?k|amateur|\bkart\b|karting|\bmoto\b|penalty|safety|maison blanche|garage bleu|chapelle|mus[eé]e|garage vert|b[oœ]ufs|porsche cent"


def traced_loop(ways: DataFrame, corners: DataFrame, key: list[str], least: int = 4) -> DataFrame:
    """``(key, seq, lon, lat)``: ways ``(key, name, ord, points)`` laid end to end in the order of the corners ``(key, norm, marker)`` that bear
    their name, the one of most points for each marker, each turned so that its nearer end follows. Under ``least`` ways: none."""
    from ringlake.functions import labels

    w = ways.where(~F.col("name").rlike(OFF_TRACE) & (F.size("points") >= 2)).withColumn("norm", labels.normalized(F.col("name")))
    first = corners.where("marker is not null and norm <> ''").groupBy(*key, "norm").agg(F.min("marker").alias("marker"))
    one = w.join(first, [*key, "norm"]).groupBy(*key, "marker").agg(F.max_by("points", F.struct(F.size("points"), -F.col("ord"))).alias("points"))
    segments = one.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("marker", "points"))), lambda x: x["points"]).alias("_s")).where(F.size("_s") >= least)

    def laid(acc, s):
        near = lambda p: geo.haversine(F.element_at(acc, -1)["lon"], F.element_at(acc, -1)["lat"], p["lon"], p["lat"])
        return F.concat(acc, F.when(near(F.element_at(s, -1)) < near(s[0]), F.reverse(s)).otherwise(s))

    loop = F.aggregate(F.slice("_s", 2, F.size("_s")), F.col("_s")[0], laid)
    return segments.select(*key, F.posexplode(loop).alias("seq", "p")).select(*key, (F.col("seq") + 1).alias("seq"), "p.lon", "p.lat")


def name_mode(ways: DataFrame, key: list[str], name: str = "name", order: str = "ord", least: int = 3) -> DataFrame:
    """Each key's most frequent non-empty name, the first seen among equals, if at least ``least`` ways bear it."""
    n = ways.where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(*key, name).agg(F.count("*").alias("n"), F.min(order).alias("_o"))
    return n.groupBy(*key).agg(F.max_by(F.struct(name, "n"), F.struct("n", -F.col("_o"))).alias("m")).select(*key, f"m.{name}", "m.n").where(F.col("n") >= least)
