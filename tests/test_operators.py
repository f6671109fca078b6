"""Operators against plain Python on synthetic rings."""

import difflib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from ringlake.functions import cyclic, labels
from ringlake.operators import align, graph, intervals, locate, merge, ring, signal, solver
from ringlake.plans import layer_tools
from ringlake.sources import documents


def circle(spark, n=72, r=0.005, ring_id=1):
    return spark.createDataFrame([(ring_id, i + 1, r * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n)) for i in range(n)], "ring int, seq int, lon double, lat double")


def test_circle_length_area_and_direction(spark):
    s = ring.summary(circle(spark)).first()
    r = math.radians(0.005) * 6371000
    assert abs(s.length_m - 2 * math.pi * r) / r < 0.01
    assert s.area_m2 > 0
    want = spark.createDataFrame([(1, "clockwise")], "ring int, direction string")
    assert ring.summary(ring.oriented(circle(spark), want)).first().area_m2 < 0


def test_point_wraps_and_clamps(spark):
    at = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 0.25), (1, -0.25)], "ring int, fraction double")
    got = {r.fraction: (r.lon, r.lat) for r in ring.points_at(circle(spark), at).collect()}
    assert got[0.0] == got[1.0]
    assert abs(got[0.25][1] - 0.005) < 1e-6 and abs(got[-0.25][1] + 0.005) < 1e-6


def test_curvature_of_a_circle_is_its_inverse_radius(spark):
    s = ring.resampled(circle(spark), step_m=10.0).withColumn("ds", F.col("total_m") / F.col("n"))
    k = [r.kappa for r in signal.curvature(s, ["ring"], "ds").collect()]
    assert abs(np.mean(k) * math.radians(0.005) * 6371008.8 - 1) < 0.02


def test_corner_layers_find_the_ends_of_a_stadium(spark):
    pts = [(x / 2000, -0.001) for x in range(-20, 21)] + [(0.01 + 0.001 * math.sin(a), -0.001 * math.cos(a)) for a in np.linspace(0.2, math.pi - 0.2, 8)]
    pts += [(-x / 2000, 0.001) for x in range(-20, 21)] + [(-0.01 - 0.001 * math.sin(a), 0.001 * math.cos(a)) for a in np.linspace(0.2, math.pi - 0.2, 8)]
    v = spark.createDataFrame([(1, i, x, y) for i, (x, y) in enumerate(pts)], "ring int, seq int, lon double, lat double")
    got = layer_tools.run("curvature_apexes", v, smooth_m=60.0, apart_m=300.0).orderBy("marker").collect()
    assert len(got) == 2 and {r.direction for r in got} == {"left"}
    assert abs(got[1].marker - got[0].marker - 0.5) < 0.02


def test_peaks_equal_greedy_choice(spark):
    rng = random.Random(3)
    v = [rng.random() for _ in range(60)]
    s = spark.createDataFrame([(1, i, x, float(i), 60.0, 0.2) for i, x in enumerate(v)], "k int, i int, v double, s double, lap double, least double")
    top = sorted((i for i in range(60) if v[i] >= 0.2 and v[i] >= v[i - 1] and v[i] > v[(i + 1) % 60]), key=lambda i: -v[i])
    kept = []
    for i in top:
        if all(min(abs(i - j), 60 - abs(i - j)) >= 6 for j in kept):
            kept.append(i)
    assert [r.i for r in signal.peaks(s, ["k"], "v", "lap", "least", 6.0).orderBy("number").collect()] == sorted(kept)


def test_speed_equals_sweeps(spark):
    rng = random.Random(1)
    n, b, a = 40, 20.0, 8.0
    lim = [rng.uniform(5, 60) for _ in range(n)]
    v = lim[:]
    for _ in range(3):
        for i in range(n - 1, -1, -1):
            v[i] = min(v[i], math.sqrt(v[(i + 1) % n] ** 2 + 2 * b * 15))
    for _ in range(3):
        for i in range(n):
            v[i] = min(v[i], math.sqrt(v[i - 1] ** 2 + 2 * a * 15))
    s = spark.createDataFrame([(1, i, x, 15.0) for i, x in enumerate(lim)], "k int, i int, lim double, step double")
    got = [r.speed for r in solver.profile(s, ["k"], "lim", "step", b, a).orderBy("i").collect()]
    assert np.allclose(got, v, atol=1e-9)


def test_alignment_recovers_reversed_offset(spark):
    a = spark.createDataFrame([(1, m, (1 - m + 0.3) % 1.0) for m in (0.05, 0.3, 0.55, 0.8)], "k int, marker double, fraction double")
    t = spark.createDataFrame([(1, m) for m in (0.0, 0.1, 0.5, 0.95)], "k int, marker double")
    for r in align.placed(t, a, ["k"]).collect():
        assert r.reversed and abs(((r.fraction - (r.marker - 0.3)) + 0.5) % 1.0 - 0.5) < 1e-9
    none = align.placed(t, a.where("k = 9"), ["k"]).collect()
    assert all(r.fraction == r.marker and not r.reversed for r in none)


def test_graph_assembly(spark):
    n = 24
    p = [(0.005 * math.cos(2 * math.pi * i / n), 0.005 * math.sin(2 * math.pi * i / n)) for i in range(n)]
    segs = [[p[(i * 4 + j) % n] for j in range(5)] for i in range(6)]
    segs = [s[::-1] if i % 2 else s for i, s in enumerate(segs)]
    branch = [p[4], (p[4][0] + 0.003, p[4][1] + 0.003)]
    order = [3, 0, 5, 1, 4, 2]
    rows = [(1, k, "", 3500.0, segs[i]) for k, i in enumerate(order)] + [(1, 9, "", 3500.0, branch)]
    df = spark.createDataFrame(rows, "ring int, ord int, name string, expected_m double, points array<struct<lon:double,lat:double>>")
    for how in ("relation", "stitch"):
        lap = graph.assembled(df, ["ring"], how).orderBy("seq").collect()
        line = np.array([(r.lon, r.lat) for r in lap])
        assert graph.metres(line[0], line[-1]) < 5 and abs(graph.length(line) - 3490) < 40


def test_fuzzy_equals_close_matches(spark):
    names = ["parabolica", "ascari", "lesmo", "curvagrande", "variantedellaroggia", "tamburello"]
    asks = ["parabolicca", "askari", "lesmo1", "tamburelo", "nothing"]
    a, b = spark.createDataFrame([(x,) for x in asks], "name string"), spark.createDataFrame([(x,) for x in names], "k string")
    got = {r.name: r.match for r in locate.fuzzy_names(a, "name", b, "k").collect()}
    for x in asks:
        want = difflib.get_close_matches(x, names, n=1, cutoff=0.82)
        assert got[x] == (want[0] if want else None)


def test_override_presence(spark):
    d = spark.createDataFrame([({"numbered": "Turn 1", "driver": "Old", "local": "Turn 9"}, {"driver": None, "official": "Off"}), ({"numbered": "Turn 1"}, {"official": "Off"}), ({"numbered": "Turn 1", "driver": "D"}, {})], "n map<string,string>, f map<string,string>")
    got = [dict(r[0]) for r in d.select(merge.named_layers(F.col("n"), F.col("f"), F.lit("9"))).collect()]
    assert got == [{"numbered": "Turn 9", "official": "Off"}, {"numbered": "Turn 9", "official": "Off", "driver": "Off"}, {"numbered": "Turn 9", "driver": "D"}]


def test_wrapping_phase_becomes_a_short_range(spark):
    c = spark.createDataFrame([(1, 1, 0.01, 1, 4000.0, ""), (1, 2, 0.5, 1, 4000.0, "")], "k int, number int, marker double, scale int, lap_m double, grp string")
    p = intervals.phases(c, ["k"], "marker", "number", "scale", "lap_m", "grp")
    one = p.where("number = 1").first()
    assert one.start > one.end
    b = intervals.usable_bounds(p, ["k", "number"], "lap_m").where("number = 1").first()
    assert abs(b.start - (0.01 - 15 / 4000)) < 1e-12 and abs(b.end - (0.01 + 15 / 4000)) < 1e-12


def test_names_and_fractions(spark):
    r = spark.range(1).select(labels.normalized(F.lit("Virage de l'Élan Straße")).alias("a"), cyclic.gap(F.lit(0.9), F.lit(0.1)).alias("g")).first()
    assert r.a == "elanstrae" and abs(r.g - 0.2) < 1e-12


def test_files(spark, tmp_path):
    (tmp_path / "tracks" / "ring-one" / "raw").mkdir(parents=True)
    f = tmp_path / "tracks" / "ring-one" / "raw" / "lap.json"
    f.write_text('{"name": "Ring", "turn": [{"name": "A", "direction": 1, "scale": 2, "start": 0.9, "end": 0.1}, {"number": 7, "marker": 0.5}], "sector": [{"marker": 1}]}')
    got = documents.turns(documents.documents(spark, str(f), documents.LAP)).orderBy("number").collect()
    assert [(r.slug, r.number, r.marker, r.direction) for r in got] == [("ring-one", 1, 0.0, "right"), ("ring-one", 7, 0.5, None)]
    g = tmp_path / "x.geojson"
    g.write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"role":"corner"},"geometry":{"type":"Point","coordinates":[1,2]}},{"type":"Feature","properties":{"role":"outline"},"geometry":{"type":"LineString","coordinates":[[0,0],[1,0],[1,1],[0,1],[0,0]]}}]}')
    assert documents.outline(spark, str(g)).count() == 4


def test_stream_equals_batch(spark, tmp_path):
    from ringlake.streaming.laps import windowed_counts

    e = spark.createDataFrame([(1, "2024-01-01 10:00:00", "a", 1.0), (2, "2024-01-01 11:00:00", "a", 2.0), (3, "2024-01-02 01:00:00", "b", 3.0)], "event_id int, t string, event_type string, value double").selectExpr("event_id", "cast(t as timestamp_ntz) ts", "event_type", "value")
    e.write.parquet(str(tmp_path / "in"))
    q = windowed_counts(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("laps").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("laps").collect())) == sorted(map(tuple, windowed_counts(e).collect()))
