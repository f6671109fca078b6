"""Faults that a review found."""

import json
import math
import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from pyspark.sql import functions as F

from ringlake.operators import dense, graph, intervals, locate, near, ring, signal
from ringlake.plans import audit, catalog, catalog_layouts, catalog_scale, generate, layouts, quality  # noqa: F401  (they register their queries)


def many_zones(spark, path, parts=20_000, places=4_000):
    spark.range(parts).select(F.col("id").alias("p_partkey"), (F.floor(F.col("id") / 2) % 2 + 20).cast("int").alias("p_size")).write.parquet(f"{path}/part.parquet")
    at = F.timestamp_seconds(F.lit(1_704_067_200 + 8 * 3600) + F.col("id") % 2 * 60)
    spark.range(places).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), at.alias("ts")).write.parquet(f"{path}/events.parquet")
    return str(path)


def rows_met(spark, monkeypatch, name, query, path):
    """The query's rows, and how many pairs the range join gave."""
    met, plain = [], getattr(locate, name)
    monkeypatch.setattr(locate, name, lambda *a, **k: met.append(plain(*a, **k)) or met[-1])
    return query(spark, path).collect(), met[0].count()


def test_equal_zones_meet_equal_times_once(spark, tmp_path, monkeypatch):
    got, pairs = rows_met(spark, monkeypatch, "bucketed_ranges_at", catalog.bucketed_range_join, many_zones(spark, tmp_path))
    assert len(got) == 4000 and {(r.zones, r.first_zone) for r in got} == {(10_000, 0)} and pairs < 10


def test_equal_zones_of_a_half_meet_equal_places_once(spark, tmp_path, monkeypatch):
    path = many_zones(spark, tmp_path)
    got, pairs = rows_met(spark, monkeypatch, "ranges_at", catalog_scale.zones_of_half, path)
    assert pairs < 100
    z, p = spark.read.parquet(f"{path}/part.parquet"), spark.read.parquet(f"{path}/events.parquet").where("event_id < 2")
    z = z.select("p_partkey", (F.col("p_size") / 60.0).alias("a"), (F.col("p_size") / 60.0 + (F.col("p_partkey") % 13) / 400.0).alias("b"))
    at = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("double") / 86400.0
    j = p.select("event_id", at.alias("at")).join(z, (F.col("event_id") % 2 == F.col("p_partkey") % 2) & F.col("at").between(F.col("a"), F.col("b")))
    want = {r.event_id: (r.n, r.s) for r in j.groupBy("event_id").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("s")).collect()}
    assert want and {r.event_id: (r.zones, r.sum_key) for r in got if r.event_id < 2} == want


def test_nearest_of_two_as_far_is_the_lesser(spark):
    t = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.3)], "k int, id int, marker double")
    got = locate.nearest_cyclic(spark.createDataFrame([(1, 0.2)], "k int, at double"), [], t, ["k"], "at", "marker", "id").first()
    assert abs(0.3 - 0.2) < abs(0.2 - 0.1) and got.id == 1 and got.lap_distance == 0.1


def test_fractions_that_differ_by_rounding_are_no_inversion(spark):
    rows = [(1, 1, 0.1, 0.0 + 1e-17), (1, 2, 0.2, 1e-17 + 3e-17), (1, 3, 0.3, 2e-17)]
    got = intervals.inversions(spark.createDataFrame(rows, "k int, n int, m double, f double"), ["k"], "m", "f", first=["n"]).first()
    assert got.n == 3 and got.inversions == 0


def test_the_closing_vertex_stands_once(spark):
    at = [(7 + 0.001 * math.cos(i * math.pi / 4), 50 + 0.001 * math.sin(i * math.pi / 4)) for i in range(8)]
    line = spark.createDataFrame([(1, i, *p) for i, p in enumerate([*at, at[0]])], "ring int, seq int, lon double, lat double")
    anchors = spark.createDataFrame([(1, i / 8, *at[(i + 3) % 8]) for i in range(8)], "ring int, marker double, plon double, plat double")
    got = generate.outline(line, anchors, spark.createDataFrame([(1, *at[3])], "ring int, plon double, plat double")).orderBy("seq").collect()
    p = [(r.lon, r.lat) for r in got]
    assert p[0] == p[-1] and len(p) - 1 == len(set(p))


def test_long_legs_leave_few_pairs(spark, monkeypatch):
    rng, kept, plain = random.Random(5), [], near.written
    v = spark.createDataFrame([(1, i, rng.random(), rng.random()) for i in range(2000)], "ring int, seq int, lon double, lat double")
    p = spark.createDataFrame([(1, i, rng.gauss(0.05, 0.006), 0.05) for i in range(300)], "ring int, id int, plon double, plat double")
    monkeypatch.setattr(near, "written", lambda df, tag: (kept.append((tag, df.count())) or plain(df, tag)))
    got = {r.id: r.dist_m for r in ring.nearest_on_line(v, p, ["id"]).collect()}
    assert [n for tag, n in kept if tag == "close"][-1] < 2000 * 300 / 100
    monkeypatch.setattr(near, "DIRECT", 10**9)
    assert got == {r.id: r.dist_m for r in ring.nearest_on_line(v, p, ["id"]).collect()} and len(got) == 300


def test_copies_of_cells_are_not_broadcast(spark):
    a = spark.createDataFrame([(1, i, 0.5, 0.01 * i, 0.0) for i in range(9)], "k int, seq int, marker double, lon double, lat double")
    b = a.selectExpr("k", "marker as marker2", "lon as lon2", "lat as lat2")
    by_place = locate.near_points(a, b, ["k"], most_m=900.0)._jdf.queryExecution().executedPlan().toString().split("_z")[0]
    assert "SortMergeJoin" in by_place


def test_a_score_makes_no_dense_ring(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, i, lon + rng.uniform(-1, 1) * size, lat + rng.uniform(-1, 1) * size) for k, (lon, lat, size) in enumerate([(7, 50, 0.002), (7, 50, 0.0003), (179.9, 10, 0.01), (20, 89.5, 0.4), (-180, 0, 0.05)]) for i in range(1, 30)]
    rows += [(9, i, 180.0 if i % 2 else -179.99, 0.0) for i in range(1, 11)]  # a leg over the seam is short, its pieces are not
    v = spark.createDataFrame(rows, "ring int, seq int, lon double, lat double")
    goal = v.select("ring").distinct().withColumn("expected_m", F.lit(500.0))
    dense = ring.anomalies(ring.densified(v)).groupBy("ring").agg(F.coalesce(F.sum((F.col("long_m") - 60.0) * 8.0), F.lit(0.0)).alias("a"), F.coalesce(F.sum((F.col("back") - 145.0) * 25.0), F.lit(0.0)).alias("b"))
    want = {r.ring: abs(r.length_m - 500.0) + r.a + r.b for r in ring.summary(v).join(dense, "ring").collect()}
    monkeypatch.setattr(ring, "densified", None)
    got = {r.ring: r.score for r in ring.quality(v, goal).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in want), (got, want)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_hold_a_bounded_part_in_a_task(spark):
    n = F.col("id") % 9
    rows = spark.range(450_000).select(F.floor(F.col("id") / 9).cast("string").alias("slug"), F.lit("main").alias("layout_id"), F.lit("corners").alias("layer_id"), n.cast("string").alias("id"), n.alias("number"), n.cast("string").alias("code"), F.create_map(F.lit("numbered"), F.lit("x")).alias("labels"), F.lit("partition").alias("coverage"), n.alias("start"), n.alias("end"))
    for rules in (quality.point_rules, quality.range_rules):
        plan = plan_of(rules(rows))
        assert plan.count("Exchange") == 1 and "hashpartitioning(slug" in plan and ", 3), REPARTITION_BY_NUM" in plan


def test_corners_are_dealt_to_bounded_parts(spark, tmp_path):
    i = F.col("id")
    spark.range(450_000).select((i / 9).cast("long").alias("l_orderkey"), (i % 9).cast("int").alias("l_linenumber"), i.alias("l_partkey"), i.alias("l_suppkey"), i.cast("double").alias("l_extendedprice"), (i % 7 + 1.0).alias("l_quantity"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("usable_bounds", "order_inversions"):
        assert ", 3), REPARTITION_BY_NUM" in plan_of(catalog.QUERIES[name](spark, str(tmp_path))), name


def test_a_roll_up_joins_nothing(spark):
    checks = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "other"), (None, "x"), ("c", "x"), ("c", "y"), ("c", "y"), ("d", None)], "slug string, rule string")
    bad = spark.createDataFrame([("a", "y", "warn"), ("b", "x", "error"), ("b", "x", "error"), ("c", "other", "error"), ("e", "x", "error"), (None, "y", "error"), ("d", "y", "error")], "slug string, rule string, level string")
    df = quality.roll_up(bad, checks, ["x", "y"])
    assert "Join" not in plan_of(df)
    assert {r.slug: (r.meets, r.failed, r.unknown) for r in df.collect()} == {"a": (True, [], []), "b": (False, ["x"], ["y"]), None: (False, [], ["x", "y"]), "c": (True, [], []), "d": (False, ["y"], ["x"])}


def test_bits_of_large_keys_are_dealt_to_parts_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(intervals.slices, "SLICE", 40)
    rng = random.Random(6)
    rows = [(1, rng.randint(0, 60), rng.randint(0, 60)) for _ in range(200)]
    df = intervals.inversions(spark.createDataFrame(rows, "k int, a int, b int"), ["k"], "a", "b")
    assert "REPARTITION_BY_NUM" in plan_of(df)
    assert df.first().inversions == sum(x[1] < y[1] and x[2] > y[2] for x in rows for y in rows)


def test_samples_are_dealt_to_bounded_parts(spark):
    v = spark.createDataFrame([(k, i, 7 + 0.01 * (i % 2), 50 + 0.01 * (i // 2)) for k in range(3) for i in range(4)], "ring int, seq int, lon double, lat double")
    df = ring.resampled(v, step_m=0.02)
    n = df.groupBy("ring").agg(F.count("*").alias("n"), F.max("n").alias("m")).collect()
    assert len(n) == 3 and all(r.n == r.m for r in n)
    assert plan_of(df).count("REPARTITION_BY_NUM") >= 1, plan_of(df)


def test_layers_of_curvature_write_no_samples(spark, monkeypatch):
    turn = lambda i, n: 2 * math.pi * i / n
    rows = [(k, i, 7 + 0.01 * math.cos(turn(i, n)) * (1 + 0.3 * math.sin(k * turn(i, n))), 50 + 0.006 * math.sin(turn(i, n))) for k, n in ((2, 50), (5, 90)) for i in range(n)]
    rows += [(3, i, 7.0, 50.0) for i in range(3)] + [(None, i, 7.0 + i, 50.0) for i in range(3)]  # no length, no key
    v = spark.createDataFrame(rows, "ring int, seq int, lon double, lat double")
    kept, plain = [], signal.written
    monkeypatch.setattr(signal, "written", lambda df, tag: (kept.append(df.count()) or plain(df, tag)))
    got = {}
    for r in signal.corner_layers(v, step_m=20.0).collect():
        got.setdefault(r.ring, []).append(r)
    assert got.keys() == {2, 5} and sum(kept) < 200
    for ring_, of in got.items():
        s = ring.resampled(v.where(F.col("ring") == ring_), step_m=20.0).orderBy("i").collect()
        n, total, ds = len(s), s[0].total_m, s[0].total_m / len(s)
        k = []
        for i in range(n):
            p, x, q = s[i - 1], s[i], s[(i + 1) % n]
            x1, y1, x2, y2 = (q.x - p.x) / (2 * ds), (q.y - p.y) / (2 * ds), (q.x - 2 * x.x + p.x) / ds**2, (q.y - 2 * x.y + p.y) / ds**2
            k.append((x1 * y2 - y1 * x2) / (x1 * x1 + y1 * y1) ** 1.5)
        wide = round(90 / ds)
        for w in (wide | 1, (wide // 2) | 1):
            k = [sum(k[(i + d) % n] for d in range(-(w // 2), w // 2 + 1)) / w for i in range(n)]
        a = [abs(x) for x in k]
        bar = max(0.00018, sorted(a)[round((n - 1) * 0.82)])
        chosen = []
        for i in sorted((i for i in range(n) if a[i] >= bar and a[i] >= a[i - 1] and a[i] > a[(i + 1) % n]), key=lambda i: (-a[i], i)):
            if all(min((i - j) % n, (j - i) % n) * ds >= 90 for j in chosen):
                chosen.append(i)
        reach, of = math.ceil(650 / ds), sorted(of, key=lambda r: r.number)
        assert [round(r.marker * n) for r in of] == sorted(chosen) and chosen
        for r, i in zip(of, sorted(chosen), strict=True):
            low = max(0.00012, a[i] * 0.32)
            on, back = (next((d - 1 for d in range(1, min(reach, n - 1) + 1) if a[(i + way * d) % n] < low), reach) for way in (1, -1))
            want = (k[i], bar, max(0.0, ((i - back) % n * ds - 75) / total), min(1.0, ((i + on) % n * ds + 55) / total), s[i].lon)
            assert all(math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-12) for x, y in zip((r.peak if r.direction == "left" else -r.peak, r.min_k, r.start, r.end, r.lon), want, strict=True)), (r, want)


def test_a_lap_is_measured_in_few_calls(spark, monkeypatch):
    calls, plain = [], graph.metres
    monkeypatch.setattr(graph, "metres", lambda a, b: (calls.append(1) or plain(a, b)))
    p = [np.array([7 + 0.01 * math.cos(i * math.pi / 40), 50 + 0.006 * math.sin(i * math.pi / 40)]) for i in range(80)]
    lines = [np.array([p[i], p[(i + 1) % 80]][:: 1 if i % 3 else -1]) for i in range(80)]
    random.Random(8).shuffle(lines)
    around = {tuple(x) for x in p}
    score, lap = graph.stitched_lap(lines, None)
    assert score == 0.0 and len(lap) == 81 and {tuple(x) for x in lap} == around and len(calls) < 40
    lap = graph.lap_cycle(lines, None)
    assert len(lap) == 81 and {tuple(x) for x in lap} == around and len(calls) < 40


def test_laps_of_odd_groups_in_parts_of_their_own(spark):
    square = [((0, 0), (1, 0)), ((1, 1), (1, 0)), ((1, 1), (0, 1)), ((0, 1), (0, 0))]
    at = lambda x, y: (7 + 0.002 * x, 50 + 0.002 * y)
    rows = [(k, o, name, float("nan") if k == "b" else None, [at(*q) for q in s]) for k in ("a", "b", None) for o, (s, name) in enumerate(zip(square, ("x", None, "", "x"), strict=True))]
    rows += [("a", 9, "x", None, None), ("a", 10, "x", None, [at(5, 5)]), ("c", 1, "x", 10.0, None), ("d", 1, None, None, [at(0, 0), at(9, 9)])]
    s = spark.createDataFrame(rows, "k string, ord int, name string, expected_m double, points array<struct<lon:double,lat:double>>")
    for how in ("relation", "stitch"):
        df = graph.assembled(s, ["k"], how)
        assert "REPARTITION_BY_NUM" in plan_of(df)
        got = {}
        for r in df.orderBy("seq").collect():
            got.setdefault(r.k, []).append((r.lon, r.lat))
        assert got.keys() == {"a", "b", None}
        for lap in got.values():
            assert len(lap) == 5 and lap[0] == lap[-1] and set(lap) == {at(x, y) for x in (0, 1) for y in (0, 1)}


def test_wide_corners_join_nothing(spark):
    rng = random.Random(9)
    at = [(k, f"t{i}", i, None if i == 5 else rng.randint(0, 20) / 20) for k in (1, 2) for i in range(1, 9)] + [(1, None, 9, 0.5), (None, "t1", 1, 0.5), (2, "t8", 10, 0.1)]
    sectors = [(k, n, a / 20, b / 20) for k in (1, 2) for n in "abcdef" for a, b in [(rng.randint(0, 19), rng.randint(0, 20))]] + [(1, "z", None, 1.0), (None, "y", 0.0, 1.0)]
    ranges = [(1, "t1", None, 0.1, 0.2), (1, "t1", "t2", 0.2, 0.3), (1, "t3", "no", 0.3, 0.4), (1, "no", "no", 0.3, 0.4), (1, None, "t4", 0.4, 0.5), (1, None, None, 0.6, 0.7), (2, "t1", "t1", 0.1, 0.2), (2, "t1", None, 0.8, 0.9), (None, "t1", None, 0.1, 0.2)]
    groups = [(1, "B", ["t1", "t2"]), (1, "A", ["t2", "t3", None]), (1, "C", ["t6"]), (None, "D", ["t1", "t2"])]
    c = spark.createDataFrame(at, "k int, id string, number int, marker double").selectExpr("*", "cast(null as string) code", "map('numbered', concat('Turn ', number)) labels", "cast(null as string) direction", "number % 6 + 1 as scale")
    df = layouts.wide_corners(c, ["k"], ["numbered"], spark.createDataFrame(groups, "k int, label string, members array<string>"), spark.createDataFrame(sectors, "k int, label string, start double, end double"), spark.createDataFrame(ranges, "k int, id string, anchor string, start double, end double"))
    assert "Join" not in plan_of(df) and "MapInArrow" not in plan_of(df)
    ids, want = {(k, i) for k, i, *_ in at if k and i}, []
    for k, i, n, m in at:
        held = [(a, s) for q, s, a, b in sectors if m is not None and q == k and k and a is not None and a <= m < b]
        first = {s for a, s in held if a == min(held)[0]} or {""}
        names = [label for q, label, of in groups if k and q == k and i in of and len(of) > 1 and i]
        mine = [f"{a * 100:.1f}% → {b * 100:.1f}%" for q, own, anchor, a, b in ranges if k and i and q == k and (anchor if (k, anchor) in ids else own) == i]
        want += [(k, n, min(names, default=""), first, r) for r in mine or ["—"]]
    got = [(r.k, r.number, r.complex, r.sector, r.range) for r in df.collect()]
    order = lambda x: (x[0] or 0, x[1], x[4])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert (*g[:3], g[4]) == (*w[:3], w[4]) and g[3] in w[3], (g, w)


def ring_events(spark, path, rings=4, n=12):
    """Rings of about 600 m between vertices, as the outlines read them."""
    at = lambda i: (300 + 30 * math.cos(i * 2 * math.pi / n), 100 + 30 * math.sin(i * 2 * math.pi / n))
    rows = [(n * k + i, k, datetime(2024, 1, 1) + timedelta(minutes=i), at(i)[0], json.dumps({"k": at(i)[1]})) for k in range(rings) for i in range(n)]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double, props string").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_outlines_are_emitted_without_a_table_of_their_vertices(spark, tmp_path, monkeypatch):
    sizes, plain = {}, generate.written
    spy = lambda df, tag: sizes.__setitem__(tag, df.count()) or plain(df, tag)
    for m in (generate, dense, near):
        monkeypatch.setattr(m, "written", spy)
    got = catalog_layouts.emitted_outlines(spark, ring_events(spark, tmp_path)).collect()
    assert len(got) == 4 * 5 and sizes and max(sizes.values()) <= 2 * 4 * 12, sizes  # two candidates of each ring, and no more


def test_markers_lie_where_the_outline_has_them(spark, monkeypatch):
    rng = random.Random(3)
    spots = {k: [(7 + k + rng.random() / 200, 50 + rng.random() / 200) for _ in range((1, 2, 5, 12)[k % 4])] for k in range(12)}
    line = spark.createDataFrame([(k, i, *p) for k, v in spots.items() for i, p in enumerate(v)], "ring int, seq int, lon double, lat double")
    ways = {k: v if k % 2 else v[::-1] for k, v in spots.items()}  # half of them run backwards
    anchors = spark.createDataFrame([(k, (j + 0.3 * rng.random()) / len(v), *p) for k, v in ways.items() if k != 7 for j, p in enumerate(v)], "ring int, marker double, plon double, plat double")
    starts = spark.createDataFrame([(k, *v[0]) for k, v in spots.items() if k % 3], "ring int, plon double, plat double")
    marked = line.select("ring").distinct().withColumn("marker", F.explode(F.array(*map(F.lit, [0.0, 0.13, 0.5, 0.999, 1.0, 1.25, -0.1]))))
    rows = lambda df: {(r.ring, r.marker): (r.lon, r.lat) for r in df.collect()}
    rim = generate.outline(line, anchors, starts)
    want = rows(generate.placed(rim, marked))
    got = rows(generate.emitted(line, anchors, starts, marked))
    assert got == want and len(want) == 12 * 7
    first = {r.ring: (r.lon, r.lat) for r in rim.where("seq = 1").collect()}
    assert all(got[k, m] == first[k] for k in first for m in (0.0, 1.0))
    for k, v in spots.items():  # a start is a vertex of the line, so it is the ring's first
        assert k % 3 == 0 or first[k] == (round(v[0][0], 6), round(v[0][1], 6))
    monkeypatch.setattr(near, "FAN", 2)  # rings of many points and vertices are searched by groups
    monkeypatch.setattr(near, "DIRECT", 1)
    assert rows(generate.emitted(line, anchors, starts, marked)) == want


def test_an_apex_is_as_far_as_the_least_of_two_equals(spark):
    c = spark.createDataFrame([("a", "main", "t1", 0.2)], "slug string, layout_id string, id string, marker double")
    apexes = spark.createDataFrame([("a", "main", 1, 0.1), ("a", "main", 2, 0.3)], "slug string, layout_id string, number int, marker double")
    totals = spark.createDataFrame([("a", "main", 2600.0)], "slug string, layout_id string, total_m double")
    far = math.nextafter(260.0, 0.0)  # 0.2 - 0.1 is a little more than 0.3 - 0.2
    got = audit.apex_report(c, apexes, totals, far).first()
    assert got.apex == 1 and got.metres == (0.3 - 0.2) * 2600.0 and not got.far


def test_rounding_between_two_equals_makes_no_apex_far(spark):
    c = spark.createDataFrame([("a", "main", "t1", 0.2), ("a", "main", "t2", 0.9)], "slug string, layout_id string, id string, marker double")
    apexes = spark.createDataFrame([("a", "main", 1, 0.1), ("a", "main", 2, 0.3)], "slug string, layout_id string, number int, marker double")
    totals = spark.createDataFrame([("a", "main", 1800.0)], "slug string, layout_id string, total_m double")
    far = math.nextafter(180.0, 0.0)  # t1 is as far from either, by a little less from the second
    assert [r.detail for r in audit.apex_rules(c, apexes, totals, far).collect()] == ["t2 360 m"]


def test_places_of_the_bar_are_looked_for_once(spark, tmp_path, monkeypatch):
    looked, plain = [], ring.nearest_on_line

    def spied(v, points, by, *more):
        seen = spark.sparkContext.accumulator(0)
        looked.append(seen)
        count = F.udf(lambda x: (seen.add(1), x)[1], "double").asNondeterministic()
        return plain(v, points.withColumn("plat", count("plat")), by, *more)

    from tests.test_generate import sources

    monkeypatch.setattr(ring, "nearest_on_line", spied)
    given = sources(spark)
    generate.generated(generate.Steps(spark, str(tmp_path / "plan")), *given)
    once = 2 + 1  # the two passes over the pairs and a count of a ring's points read each of 18 points
    assert len(looked) == 1 and 0 < looked[0].value <= 18 * once, looked[0].value


def probed(spark, path, rings=4000, n=8):
    """The rings' means as the nearest queries take them, of events whose rows lie in any order in several files; and as added in the ring's order."""
    rng, rows, want = random.Random(8), [], {}
    for k in range(rings):
        values = [round(rng.expovariate(1 / 50), 2) for _ in range(n)]
        rows += [(n * k + i, k, datetime(2024, 1, 1) + timedelta(minutes=i), v, '{"k": 7}') for i, v in enumerate(values)]
        total = 0.0
        for v in values:
            total += v * 1e-3
        want[k] = float(Decimal(repr(total / n)).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    rng.shuffle(rows)
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp, value double, props string").repartition(6).write.parquet(f"{path}/events.parquet")
    return want


def test_means_of_nearest_on_line_are_added_in_the_order_of_the_ring(spark, tmp_path):
    want = probed(spark, tmp_path)
    assert {r.ring: r.plon for r in catalog.probes(spark, str(tmp_path)).collect()} == want


def test_nearest_vertices_do_not_depend_on_the_order_of_files(spark, tmp_path):
    probed(spark, tmp_path / "a")
    spark.read.parquet(str(tmp_path / "a" / "events.parquet")).orderBy("event_id").coalesce(1).write.parquet(str(tmp_path / "b" / "events.parquet"))
    one, other = [sorted(map(tuple, catalog.nearest_vertex(spark, str(tmp_path / x)).collect())) for x in "ab"]
    assert one == other and len(one) == 4000
