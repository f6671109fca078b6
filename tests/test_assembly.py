"""Assembly of laps and layouts, ids, sources and tools on small made-up circuits, against plain Python."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringlake.functions import labels
from ringlake.operators import graph, intervals, locate, merge, ring, signal
from ringlake.plans import generate, layer_tools
from ringlake.sources import documents


def circle(n, metres=700.0, lon0=10.0, lat0=50.0, clockwise=False):
    k = metres / 111320.0
    turn = -1 if clockwise else 1
    return [(lon0 + k * math.cos(turn * 2 * math.pi * i / n) / math.cos(math.radians(lat0)), lat0 + k * math.sin(turn * 2 * math.pi * i / n)) for i in range(n)]


def pieces(rng, points, parts):
    """The closed line cut into parts, shuffled, some flipped."""
    closed = points + points[:1]
    cuts = sorted({0, len(points), *rng.sample(range(1, len(points)), parts - 1)})
    out = [np.array(closed[a : b + 1]) for a, b in itertools.pairwise(cuts)]
    out = [s[::-1] if rng.random() < 0.5 else s for s in out]
    rng.shuffle(out)
    return out


def stitched_by_hand(lines, expected, reach=120.0, gap=300.0):
    """The rule written out: depth-first over whole lines, three joins for seven links, then one."""
    lines = sorted(lines, key=lambda s: -graph.length(s))
    best = [None, float("inf")]

    def visit(line, used, depth, branch, left):
        left[0] -= 1
        if left[0] < 0:
            return
        open_m = float(graph.metres(line[0], line[-1]))
        whole = graph.length(line) + open_m
        if open_m <= gap and (not expected or 0.6 * expected <= whole <= 1.5 * expected):
            off = open_m + (abs(whole - expected) if expected else 0)
            if off < best[1] - 1e-9:
                best[:] = [line, off]
        if expected and graph.length(line) > 1.6 * expected:
            return
        found = sorted((float(graph.metres(line[-1], c[::-1][0] if f else c[0])), i, f) for i, c in enumerate(lines) if i not in used for f in (False, True) if graph.metres(line[-1], c[::-1][0] if f else c[0]) < reach)
        for d, i, f in found[:branch]:
            c = lines[i][::-1] if f else lines[i]
            visit(np.concatenate([line, c[1:] if d < 1 else c]), used | {i}, depth + 1, branch if depth < 6 else 1, left)

    for seed in range(min(8, len(lines))):
        visit(lines[seed], {seed}, 0, 3, [20_000])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_stitching_follows_the_rule(seed):
    rng = random.Random(seed)
    ring_ = circle(30, rng.uniform(300, 900))
    lines = pieces(rng, ring_, rng.randint(3, 7))
    for _ in range(rng.randint(0, 2)):  # dead ends
        x, y = rng.choice(ring_)
        lines.append(np.array([(x, y), (x + 0.002, y + 0.001)]))
    lines = [s + np.array([rng.uniform(-1e-5, 1e-5), 0]) for s in lines]
    expected = rng.choice([None, 2 * math.pi * 600])
    want, off = stitched_by_hand(lines, expected)
    got = graph.stitched_lap(lines, expected)
    assert (got is None) == (want is None)
    if got:
        assert got[0] == pytest.approx(off, abs=1.0 * len(lines)) and graph.length(got[1]) == pytest.approx(graph.length(want), abs=1.0 * len(lines))  # joins under a metre


def test_cycle_through_a_branched_graph():
    rng = random.Random(2)
    lines = pieces(rng, circle(24), 6) + [np.array([circle(24)[0], (10.0, 50.0)]), np.array([(10.0, 50.0), circle(24)[12]])]
    whole = graph.length(np.array(circle(24) + circle(24)[:1]))
    lap = graph.lap_cycle(lines, whole)
    assert graph.length(lap) == pytest.approx(whole, rel=1e-6) and graph.metres(lap[0], lap[-1]) < 1


def test_ids_avoid_all_that_are_taken(spark):
    bases = {1: ["a", "a", "a-2", "a"], 2: ["a-2", "a", "a"], 3: ["b", "b", "c", "b"], 4: ["x-2", "x-2", "x", "x", "x-2-2"]}
    want = set()
    for k, names in bases.items():
        used = []
        for i, b in enumerate(names):
            name, n = b, 2
            while name in used:
                name, n = f"{b}-{n}", n + 1
            used.append(name)
            want.add((k, i, name))
    d = spark.createDataFrame([(k, i, b) for k, names in bases.items() for i, b in enumerate(names)], "k int, i int, base string")
    assert {(r.k, r.i, r.id) for r in intervals.suffixed_ids(d, ["k"], "base", ["i"]).collect()} == want


def test_folding_equals_decomposition(spark):
    import unicodedata

    rng = random.Random(5)
    texts = ["".join(rng.choice([chr(rng.randint(0x20, 0x24F)), chr(rng.randint(0x1E00, 0x1EFF)), chr(rng.randint(0x2100, 0x2190)), chr(rng.randint(0xFB00, 0xFB06)), chr(rng.randint(0x1D400, 0x1D7FF)), "́"]) for _ in range(30)) for _ in range(60)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", labels.folded(F.col("t")).alias("f")).collect()
    assert [r.f for r in got] == [unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode() for r in got]


def vertices(spark, **rings_):
    return spark.createDataFrame([(k, i, x, y) for k, ps in rings_.items() for i, (x, y) in enumerate(ps, 1)], "ring string, seq int, lon double, lat double")


def test_points_at_equal_a_plain_walk(spark):
    rng = random.Random(8)
    rings_ = {f"r{k}": [(rng.random(), rng.random()) for _ in range(rng.randint(1, 12))] for k in range(8)} | {"same": [(0.5, 0.5)] * 4, "twice": [(0.0, 0.0), (0.0, 0.0), (0.1, 0.0), (0.1, 0.0)]}
    at = [(k, f) for k in rings_ for f in [0.0, 1.0, 0.999999, *[rng.uniform(-1, 2) for _ in range(6)]]]
    for clamp in (False, True):
        got = {(r.ring, r.fraction): (r.lon, r.lat) for r in ring.points_at(vertices(spark, **rings_), spark.createDataFrame(at, "ring string, fraction double"), clamp=clamp).collect()}
        assert len(got) == len(at)
        for k, f in at:
            p = np.array(rings_[k] + rings_[k][:1])
            cum = np.concatenate([[0], np.cumsum(graph.metres(p[:-1], p[1:]))])
            goal = (min(1.0, max(0.0, f)) if clamp else f % 1.0) * cum[-1]
            i = next((i for i in range(1, len(cum)) if cum[i] >= goal), len(cum) - 1)
            t = min(1.0, (goal - cum[i - 1]) / (cum[i] - cum[i - 1])) if cum[i] > cum[i - 1] else 0.0
            assert got[k, f] == pytest.approx(tuple(p[i - 1] + (p[i] - p[i - 1]) * t), abs=1e-9), (k, f)


def test_nearest_on_the_lap_equals_all_pairs(spark):
    rng = random.Random(3)
    t = [(k, n, rng.choice([rng.random(), 0.25, 0.999])) for k in range(3) for n in range(7)]
    p = [(k, i, rng.choice([rng.random(), 0.25, 1.0, 0.0])) for k in range(4) for i in range(30)]
    got = {(r.k, r.i): (r.n, r.lap_distance) for r in locate.nearest_cyclic(spark.createDataFrame(p, "k int, i int, at double"), ["i"], spark.createDataFrame(t, "k int, n int, to double"), ["k"], "at", "to", "n").collect()}
    far = lambda a, b: min(abs(a - b) % 1.0, 1.0 - abs(a - b) % 1.0)
    for k, i, a in p:
        own = [(far(a, b), n) for q, n, b in t if q == k]
        assert ((k, i) in got) == bool(own)
        if own:
            assert got[k, i][1] == pytest.approx(min(own)[0]) and far(a, next(b for q, n, b in t if q == k and n == got[k, i][0])) == pytest.approx(min(own)[0])


def test_grown_ranges_equal_a_walk(spark):
    rng = random.Random(6)
    n, total = 60, 1500.0
    v = [abs(rng.gauss(0, 0.0006)) for _ in range(n)]
    d = spark.createDataFrame([(1, i, i * total / n, x, n, total) for i, x in enumerate(v)], "k int, i int, s double, v double, n int, total_m double")
    tops = [(1, j, i, v[i]) for j, i in enumerate(sorted(rng.sample(range(n), 5)), 1)]
    got = {r.number: (r.start, r.end) for r in signal.grown_ranges(d, spark.createDataFrame(tops, "k int, number int, i int, peak double"), ["k"], "v").collect()}
    step = total / n
    for _, j, i, peak in tops:
        ends = []
        for way in (-1, 1):
            at, walked = i, 0
            while walked < math.ceil(650 / step) and v[(at + way) % n] >= max(0.00012, peak * 0.32):
                at, walked = (at + way) % n, walked + 1
            ends.append(at)
        assert got[j] == pytest.approx((max(0.0, (ends[0] * step - 75) / total), min(1.0, (ends[1] * step + 55) / total)))


def test_a_layout_is_emitted_from_its_start(spark):
    """The clean candidate wins, the ring runs the way the markers do, starts at the pinned start and closes; markers lie on it."""
    good, torn = circle(40), [(x + 0.01 * (i % 5 == 0), y) for i, (x, y) in enumerate(circle(40))]
    c = vertices(spark, a=good).withColumn("source", F.lit("relation")).withColumn("rank", F.lit(0)).unionByName(vertices(spark, a=torn).withColumn("source", F.lit("stitched")).withColumn("rank", F.lit(1)))
    line = generate.chosen(c, spark.createDataFrame([("a", 4398.0)], "ring string, expected_m double"))
    assert {r.source for r in line.collect()} == {"relation"} and line.count() == 40
    start = good[10]
    anchors = spark.createDataFrame([("a", 0.0, *start), ("a", 0.25, *good[0]), ("a", 0.5, *good[30])], "ring string, marker double, plon double, plat double")
    out = generate.outline(line, anchors, spark.createDataFrame([("a", *start)], "ring string, plon double, plat double"))
    p = [(r.lon, r.lat) for r in out.orderBy("seq").collect()]
    assert p[0] == p[-1] == (round(start[0], 6), round(start[1], 6)) and len(p) > 120
    quarter = generate.placed(out, spark.createDataFrame([("a", 0.25), ("a", None)], "ring string, marker double")).collect()
    assert len(quarter) == 1 and graph.metres(np.array([quarter[0].lon, quarter[0].lat]), np.array(good[0])) < 3


def test_traced_loops(spark):
    pts = circle(12)
    w = [("a", f"Virage {i}", i, [pts[i], pts[(i + 1) % 12]][:: 1 if i % 2 else -1]) for i in range(12)] + [("a", "Pit 3", 40, pts[:5]), ("a", "Virage 5", 41, [pts[5]])]
    ways = spark.createDataFrame([(k, n, i, [{"lon": x, "lat": y} for x, y in p]) for k, n, i, p in w], "ring string, name string, ord int, points array<struct<lon:double,lat:double>>")
    corners = spark.createDataFrame([("a", str(i), i / 12) for i in range(1, 11)], "ring string, norm string, marker double")
    got = [(r.lon, r.lat) for r in graph.traced_loop(ways, corners, ["ring"]).orderBy("seq").collect()]
    assert got[2:] == [p for i in range(2, 11) for p in (pts[i], pts[(i + 1) % 12])] and set(got[:2]) == {pts[1], pts[2]}
    assert graph.traced_loop(ways, corners.where("marker < 0.2"), ["ring"]).count() == 0


def test_sources_round_trip(spark, tmp_path):
    track = {"slug": "b", "name": "B", "country": "x", "series": ["f1"], "layouts": [{"id": "gp", "name": "GP", "length_m": 5.0, "point_layers": [{"id": "corners", "items": [{"id": "t1", "number": 1}, {"id": "t2", "number": 2}]}]}]}
    d = spark.createDataFrame([json.dumps(track), json.dumps(track | {"slug": "a"})], "string").select(F.from_json("value", documents.TRACK).alias("t")).select("t.*")
    documents.write_json_lines(d, f"{tmp_path}/out")
    again = documents.json_lines(spark, f"{tmp_path}/out")
    assert sorted(r.slug for r in again.collect()) == ["a", "b"] and again.schema.simpleString() == d.schema.simpleString()
    row = documents.index_rows(again).where("slug = 'a'").first()
    assert row.layouts[0].corners == 2 and row.layouts[0].poster == "posters/a_gp.png"
    assert json.loads(again.select(documents.compact_json(F.struct("slug", "name")).alias("j")).orderBy("j").first().j) == {"slug": "a", "name": "B"}
    documents.write_json_schema(again.schema, f"{tmp_path}/schema.json")
    assert json.load(open(f"{tmp_path}/schema.json"))["properties"]["layouts"]["items"]["properties"]["length_m"] == {"type": "number"}
    for s in ("a", "b"):
        (tmp_path / "tracks" / s).mkdir(parents=True)
        (tmp_path / "tracks" / s / "source.json").write_text("{}")
    (tmp_path / "tracks" / "none").mkdir()
    assert {r.slug for r in documents.slugs(spark, f"{tmp_path}/tracks").collect()} == {"a", "b"}


def test_segments_of_map_elements(spark):
    node = lambda *p: [{"lat": float(y), "lon": float(x)} for x, y in p]
    member = lambda ref, role, n: {"type": "way", "ref": ref, "role": role, "geometry": node(*[(i, ref) for i in range(n)])}
    rel = spark.createDataFrame([json.dumps({"elements": [{"type": "relation", "id": 1, "members": [member(1, "", 2), member(2, "pit", 2), member(1, "forward", 3), member(3, None, 1), member(4, "main_track", 2)]}]})], "string")
    r = rel.select(F.lit("a").alias("k"), F.lit(1.0).alias("expected_m"), F.from_json("value", documents.RELATION)["elements"].alias("elements"))
    assert [(x.ord, len(x.points)) for x in graph.member_segments(r, ["k"]).orderBy("ord").collect()] == [(0, 2), (4, 2)]
    way = lambda name, n: {"type": "way", "tags": {"name": name} if name else {}, "geometry": node(*[(i, 0) for i in range(n)])}
    w = spark.createDataFrame([json.dumps({"elements": [way("Main", 2), way("Pit lane", 2), way(None, 3), way("Main", 1), {"type": "node"}]})], "string")
    w = w.select(F.lit("a").alias("k"), F.lit(1.0).alias("expected_m"), F.from_json("value", documents.WAYS)["elements"].alias("elements"))
    assert [(x.ord, x.name) for x in graph.way_segments(w, ["k"]).orderBy("ord").collect()] == [(0, "Main"), (2, "")]
    assert graph.pit_lane_centres(w, ["k"]).first().lon == 0.5


def test_corner_ways_and_times(spark):
    node = lambda n: [{"lat": 1.0 * i, "lon": 2.0 * i} for i in range(n)]
    way = lambda name, n: {"type": "way", "tags": {"name": name} if name else {}, "geometry": node(n)}
    w = spark.createDataFrame([json.dumps({"elements": [way("Big Bend", 3), way("Pit exit", 2), way("Circuit", 2), way(None, 2), way("One", 1)]})], "string")
    w = w.select(F.lit("a").alias("k"), F.from_json("value", documents.WAYS)["elements"].alias("elements"))
    assert [(r.name, r.ord, r.lon, r.lat) for r in graph.corner_ways(w, ["k"]).collect()] == [("Big Bend", 0, 2.0, 1.0)]
    from datetime import UTC, datetime

    made = datetime.fromisoformat(spark.range(1).select(documents.generated_at().alias("t")).first().t)
    assert abs((datetime.now(UTC) - made).total_seconds()) < 60


def test_phases_are_rounded(spark):
    d = spark.createDataFrame([(1, 1, 0.123456789, 3, 3000.0, ""), (1, 2, 0.6, 6, 3000.0, "")], "k int, number int, marker double, scale int, lap_m double, grp string")
    got = intervals.phases(d, ["k"], "marker", "number", "scale", "lap_m", "grp").orderBy("number").collect()
    assert [(r.start, r.apex, r.end) for r in got] == [(0.08346, 0.12346, 0.15679), (0.6, 0.6, 0.6)]


def test_tools_and_their_layers(spark, tmp_path):
    parts = spark.createDataFrame([("x", 1, 30.0), ("x", 2, 10.0)], "k string, n int, m double")
    layers = spark.createDataFrame([("s", "gp", "old", 1, "[]"), ("s", "gp", "micro", 2, "[1]"), ("t", "gp", "micro", 1, "[2]")], "slug string, layout_id string, layer_id string, i int, items string")
    cfg = {"slug": "s", "layout": "gp", "layer_id": "micro", "tool": "length_partition", "params": {"key": ["k"], "order": ["n"], "length": "m"}}
    got = {(r.slug, r.layer_id): (r.i, json.loads(r["items"])) for r in layer_tools.run_config(layers, cfg, {"rows": parts}, str(tmp_path)).collect()}
    assert got["t", "micro"] == (1, [2]) and got["s", "old"] == (1, []) and got["s", "micro"][0] == 2
    assert [(x["start"], x["end"]) for x in got["s", "micro"][1]] == [(0.0, 0.75), (0.75, 1.0)]
    new = layer_tools.run_config(layers, cfg | {"layer_id": "fresh", "id": "a b"}, {"rows": parts}, str(tmp_path))
    assert {r.layer_id: r.i for r in new.where("slug = 's'").collect()} == {"old": 1, "micro": 2, "fresh": 3} and (tmp_path / "generated-layers" / "a-b").exists()
    lost = spark.createDataFrame([("x", 1, "s1", "S1", None, None), ("x", 2, "s2", "S2", None, None)], "k string, i int, id string, label string, start double, end double")
    meta = spark.createDataFrame([("x", "S1", "One", "Off", "", 0.1, 0.4)], "k string, id string, label string, official string, driver string, start double, end double")
    with pytest.raises(Exception, match="no bounds"):
        layer_tools.with_meta(lost, meta, ["k"]).collect()
    assert merge.upsert(layers, layers.limit(0), ["slug", "layout_id"], "layer_id", "i", ["items"]).count() == 3


def test_missing_imports(spark):
    s = spark.createDataFrame([json.dumps({"slug": "a", "osm": {"bbox": [1, 2, 3, 4], "relation": 7}, "layouts": [{"id": "gp", "lovely": "gp"}, {"id": "x"}]}), json.dumps({"slug": "b", "layouts": []})], "string").select(F.from_json("value", documents.SOURCE).alias("s")).select("s.*")
    have = spark.createDataFrame([("a", "ways", "bbox")], "slug string, kind string, key string")
    assert {(r.slug, r.kind, r.key) for r in documents.imported(s, have).collect()} == {("a", "lap", "gp"), ("a", "relation", "7")}
    assert "relation(7)" in documents.relation_query(7) and "(1,2,3,4)" in documents.bbox_query(1, 2, 3, 4)
