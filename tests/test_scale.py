"""Operators on hot keys, long rings and many names against plain versions."""

import difflib
import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ringlake.operators import intervals, locate, near, ring, signal, slices


@pytest.fixture
def small_slices(monkeypatch):
    """Slices of some rows, so that small tables are cut."""
    monkeypatch.setattr(slices, "SLICE", 40)


def interval_rows(seed):
    rng = random.Random(seed)
    spot = lambda: rng.choice([rng.random(), rng.randint(0, 8) / 8, None, 0.5])
    key = lambda: rng.choice(["hot", "hot", "hot", "b", None])
    points = [(i, key(), spot()) for i in range(300)] + [(7, "hot", 0.5)] * 3
    ranges = [(i, key(), a, b if rng.random() < 0.9 or a is None or b is None else a, rng.choice([i, None, i % 5])) for i, (a, b) in enumerate((spot(), spot()) for _ in range(300))] + [(900 + i, "hot", 0.0, 1.0, 500 + i) for i in range(40)]
    return points, ranges


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cut", [True, False])
def test_ranges_against_all_pairs(spark, seed, cut, monkeypatch):
    if cut:
        monkeypatch.setattr(slices, "SLICE", 40)
    points, ranges = interval_rows(seed)
    p = spark.createDataFrame(points, "pid int, k string, at double").repartition(3)
    r = spark.createDataFrame(ranges, "rid int, k string, start double, end double, o int").repartition(3)
    for closed in (True, False):
        want = Counter((pid, rid) for pid, k, x in points for rid, k2, a, b, _ in ranges if k is not None and k == k2 and None not in (x, a, b) and a <= x and (x <= b if closed else x < b))
        got = locate.ranges_at(p, r, ["k"], "at", closed=closed)
        assert got.columns == ["k", "pid", "at", "rid", "start", "end", "o"] and Counter((t.pid, t.rid) for t in got.collect()) == want
    first = locate.first_range_at(p, r.withColumn("v", F.col("o")), ["k"], "at", "o", "v").collect()
    want = Counter()
    for pid, k, x in points:
        held = [o for _, k2, a, b, o in ranges if k is not None and k == k2 and None not in (x, a, b, o) and a <= x < b]
        want[pid, k, x, min(held) if held else None] += 1
    assert Counter((t.pid, t.k, t.at, t.v) for t in first) == want


def test_ranges_of_nothing(spark):
    p = spark.createDataFrame([], "pid int, k string, at double")
    r = spark.createDataFrame([("a", 0.0, 1.0, 1)], "k string, start double, end double, o int")
    one = spark.createDataFrame([(1, "a", 0.5)], p.schema)
    assert locate.ranges_at(p, r, ["k"], "at").count() == 0 and locate.ranges_at(one, r.limit(0), ["k"], "at").count() == 0
    assert [tuple(x) for x in locate.first_range_at(one, r.limit(0), ["k"], "at", "o", "o").collect()] == [(1, "a", 0.5, None)]


def test_first_range_of_a_hot_key_is_no_product(spark):
    """200,000 places in 200,000 ranges of one key that all overlap: all pairs would be 4e10."""
    n = 200_000
    p = spark.range(n).select(F.lit("k").alias("k"), "id", (F.col("id") / n).alias("at"))
    r = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") / (2 * n)).alias("start"), (F.col("id") / (2 * n) + 0.5).alias("end"), F.col("id").alias("o"))
    began = time.time()
    got = locate.first_range_at(p, r.withColumn("v", F.col("o")), ["k"], "at", "o", "v").agg(F.count("v"), F.sum("v")).first()
    want = [max(0, math.floor((i / n - 0.5) * 2 * n) + 1) if i / n >= 0.5 else 0 for i in range(n)]
    assert got[0] == n and abs(got[1] - sum(want)) <= n and time.time() - began < 60


def test_first_over_spans():
    rng = random.Random(3)
    import numpy as np

    for n in (0, 1, 2, 7, 64, 100):
        spans = [sorted((rng.randint(0, n), rng.randint(0, n))) for _ in range(rng.randint(0, 60))]
        lo, hi = np.array([a for a, _ in spans], int), np.array([b for _, b in spans], int)
        want = [next((i for i, (a, b) in enumerate(spans) if a <= x < b), len(spans)) for x in range(n)]
        assert slices.first_over(lo, hi, n).tolist() == want


# ---- ranks -------------------------------------------------------------------------------------------------------------


def test_ranks_and_selection(spark, small_slices):
    rng = random.Random(5)
    rows = [(rng.choice("aab"), rng.choice([rng.gauss(0, 1), 0.0, -0.0, 2.5, 1e300, -1e-300, None])) for _ in range(900)] + [("c", None), ("d", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    by = defaultdict(list)
    for k, v in rows:
        by[k] += [v] if v is not None else []
    got = slices.ranked(df.where("v is not null"), ["k"], "v", "r").collect()
    assert all(r.r == sum(x < r.v for x in by[r.k]) for r in got) and len(got) == sum(map(len, by.values()))
    for q, few in ((0.0, 50), (0.5, 40), (0.82, 10_000), (1.0, 50), (0.5, 10_000)):
        found = {r.k: r.x for r in slices.selected(df, ["k"], "v", q, "x", few=few, bars=16).collect()}
        assert found == {k: sorted(v)[round((len(v) - 1) * q)] if v else 0.0 for k, v in by.items()} | ({"c": 0.0} if "c" not in by else {}), (q, few)


def test_selection_from_one_large_key(spark):
    n = 2_000_000
    df = spark.range(n).select(F.lit(1).alias("k"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 3.0).alias("v"))
    assert slices.selected(df, ["k"], "v", 0.82, "x").first().x == round((n - 1) * 0.82) / 3.0


@pytest.mark.parametrize("first", [None, ["n"]])
def test_inversions_against_pairs(spark, small_slices, first):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "b", "c"]), i, rng.choice([rng.random(), rng.randint(0, 6) / 7, None]), rng.choice([rng.random(), rng.randint(0, 6) / 7, None])) for i in range(400)] + [("two", 500, 0.1, 0.2), ("two", 501, 0.2, 0.1)]
    got = {r.k: (r.n, r.inversions) for r in intervals.inversions(spark.createDataFrame(rows, "k string, n int, a double, b double"), ["k"], "a", "b", first=first, block=8).collect()}
    want = {}
    for k in ("hot", "b", "c"):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        f0 = own[0][3] if first else 0.0
        ab = [(a, None if b is None or f0 is None else (b - f0) % 1.0 if first else b) for _, _, a, b in own]
        ab = [x for x in ab if None not in x]
        want[k] = len(own), sum(x[0] < y[0] and x[1] > y[1] for x in ab for y in ab)
    assert got == want


def test_inversions_of_one_large_key(spark):
    n = 300_000
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("a"), (-F.col("id")).alias("b"))
    assert intervals.inversions(df, ["k"], "a", "b").first().inversions == n * (n - 1) // 2


# ---- peaks -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_peaks_equal_the_greedy_choice(spark, seed):
    rng = random.Random(seed)
    rows, want = [], {}
    for k, (n, by, most) in enumerate([(64, 6.0, 5), (64, 6.0, 5), (40, 25.0, 5), (200, 3.0, 5), (30, 0.5, 5), (5, 9.0, 5)]):
        v = [round(rng.random(), 2) if seed % 2 else (n - i if i % 2 else 0) * 1.0 for i in range(n)]
        rows += [(k, i, float(i), float(n), 0.1, x, by) for i, x in enumerate(v)]
        kept = []
        for i in sorted((i for i in range(n) if v[i] >= 0.1 and v[i] >= v[i - 1] and v[i] > v[(i + 1) % n]), key=lambda i: (-v[i], i)):
            if len(kept) < most and all(min(abs(i - j), n - abs(i - j)) >= by for j in kept):
                kept.append(i)
        want[k] = sorted(kept), by
    df = spark.createDataFrame(rows, "k int, i int, s double, lap double, least double, v double, by double")
    for by in {b for _, b in want.values()}:
        got = defaultdict(list)
        for r in signal.peaks(df.where(F.col("by") == by), ["k"], "v", "lap", "least", by, 5).orderBy("number").collect():
            got[r.k].append(r.i)
        assert dict(got) == {k: x for k, (x, b) in want.items() if b == by and x}


# ---- long rings --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["circle", "cloud", "seam", "one place"])
def test_nearest_of_long_rings_against_all(spark, monkeypatch, shape):
    monkeypatch.setattr(near, "DIRECT", 20)
    monkeypatch.setattr(near, "FAN", 4)
    rng = random.Random(shape)
    at = {"circle": lambda i: (math.cos(i / 30) * 0.1 + 7, math.sin(i / 30) * 0.05 + 50), "cloud": lambda i: (rng.uniform(-5, 5), rng.uniform(-60, 60)), "seam": lambda i: (rng.choice([179.99, -179.99]) + rng.uniform(-0.01, 0.01), rng.uniform(-1, 1)), "one place": lambda i: (1.0, 2.0)}[shape]
    v = [(1, i, *at(i)) for i in range(190)] + [(2, i, float(i), 1.0) for i in range(7)]
    p = [(rng.choice([1, 1, 2, 3]), i, *(x + rng.uniform(-0.02, 0.02) for x in at(rng.randint(0, 189)))) for i in range(60)]
    vd, pd_ = spark.createDataFrame(v, "ring int, seq int, lon double, lat double"), spark.createDataFrame(p, "ring int, id int, plon double, plat double")
    several = (ring.nearest_vertex, ring.nearest_on_line, ring.off_line) if shape == "circle" else (ring.nearest_on_line,) if shape == "cloud" else (ring.nearest_vertex,)
    got = {f.__name__: {r.id: r for r in f(vd, pd_, ["id"]).collect()} for f in several}
    monkeypatch.setattr(near, "DIRECT", 10**9)
    for f in several:
        whole = {r.id: r for r in f(vd, pd_, ["id"]).collect()}
        assert whole.keys() == got[f.__name__].keys() == {i for k, i, *_ in p if k != 3}
        for i, r in whole.items():
            assert got[f.__name__][i].dist_m == pytest.approx(r.dist_m, rel=1e-12, abs=1e-9) and (f is not ring.nearest_vertex or got[f.__name__][i].seq == r.seq)


def test_a_ring_of_a_million_vertices(spark):
    n = 1_000_000
    turn = F.col("id") * (2 * math.pi / n)
    v = spark.range(n).select(F.lit(1).alias("ring"), F.col("id").alias("seq"), (F.cos(turn) * 0.2 + 7).alias("lon"), (F.sin(turn) * 0.1 + 50).alias("lat"))
    t = F.rand(3) * 2 * math.pi
    p = spark.range(10_000).select(F.lit(1).alias("ring"), "id", (F.cos(t) * 0.21 + 7).alias("plon"), (F.sin(t) * 0.11 + 50).alias("plat"))
    began = time.time()
    got = ring.nearest_on_line(v, p, ["id"]).agg(F.count("*"), F.min("dist_m"), F.max("dist_m")).first()
    assert got[0] == 10_000 and 0 <= got[1] and got[2] < 2500 and time.time() - began < 120


# ---- names -------------------------------------------------------------------------------------------------------------


def test_fuzzy_against_every_pair(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcde") for _ in range(n))
    base = [word(rng.randint(1, 14)) for _ in range(150)]

    def bent(s):
        out = list(s)
        for _ in range(rng.randint(0, 3)):
            i = rng.randint(0, len(out))
            out[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "xy"])
        return "".join(out)

    left = [bent(rng.choice(base)) for _ in range(200)] + [None, "", "a", "aaaa", "aaaaa"]
    a, b = spark.createDataFrame([(x,) for x in left], "name string"), spark.createDataFrame([(x,) for x in [*base, "aaaa", "", None]], "k string")
    got = Counter((r.name, r.match, round(r.ratio, 9) if r.ratio else None) for r in locate.fuzzy_names(a, "name", b, "k").collect())
    want = Counter()
    for x in left:
        best = max(((difflib.SequenceMatcher(None, y, x).ratio(), y) for y in [*base, "aaaa"] if x), default=(0, None))
        want[(x, best[1], round(best[0], 9)) if best[0] >= 0.82 else (x, None, None)] += 1
    assert got == want
    bigrams = lambda s: {s[i : i + 2] for i in range(len(s) - 1)}
    loose = sum(bool(bigrams(x) & bigrams(y)) for x in {x for x in left if x} for y in {*base})
    assert locate.fuzzy_candidates(a, "name", b, "k").count() < loose / 2
