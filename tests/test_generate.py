"""From loose segments to verified layouts."""

import math
import random

from pyspark.sql import functions as F

from ringlake.functions import labels
from ringlake.plans import generate

N = 60


def circuit(slug, turn=1.0, size=0.01):
    at = lambda i: (7 + size * math.cos(turn * 2 * math.pi * i / N), 50 + size * math.sin(turn * 2 * math.pi * i / N))
    legs = [(slug, "main", i, "", [at(i), at(i + 1)][:: random.Random(i).choice([1, -1])]) for i in range(N)]
    corners = [(slug, "main", f"t{k}", k, str(k), f"N{(k - 1) // 2}", True, (k - 1) / 6, k % 6 + 1, "", *at(10 * (k - 1))) for k in range(1, 7)]
    return at, legs, corners


def sources(spark, bend=lambda rows: rows):
    legs, corners, starts, layouts = [], [], [], []
    for slug, turn in (("a", 1.0), ("b", -1.0), ("gone", 1.0)):
        at, own, c = circuit(slug, turn)
        legs += own if slug != "gone" else []
        corners += c
        starts.append((slug, "main", *at(0)))
        layouts.append((slug, "main", 2 * math.pi * 0.01 * 111195 * 0.83))
    p = "array<struct<lon:double,lat:double>>"
    c = spark.createDataFrame(bend(corners), "slug string, layout_id string, id string, number int, code string, label string, named boolean, marker double, scale int, grp string, plon double, plat double")
    c = c.withColumn("labels", F.create_map(F.lit("numbered"), labels.numbered(F.col("number")), F.lit("driver"), F.col("label")))
    random.Random(1).shuffle(legs)
    return (
        spark.createDataFrame(legs, f"slug string, layout_id string, ord int, name string, points {p}"), spark.createDataFrame(layouts, "slug string, layout_id string, length_m double"), c,
        c.select("slug", "layout_id", "marker", "plon", "plat"), spark.createDataFrame(starts, "slug string, layout_id string, plon double, plat double"),
    )


def test_circuits_meet_the_bar(spark, tmp_path):
    steps = generate.Steps(spark, str(tmp_path / "plan"))
    got = generate.generated(steps, *sources(spark))
    bar = {r.slug: r for r in got["bar"].collect()}
    assert bar["a"].meets and bar["b"].meets, (bar, got["violations"].collect())
    assert not bar["gone"].meets and bar["gone"].failed == ["outline_points", "corner_grouped"]
    at = {s: circuit(s, t)[0] for s, t in (("a", 1.0), ("b", -1.0))}
    for r in got["corners"].collect():  # each marker lies about where its corner is, whichever way the segments ran
        x, y = at[r.slug](10 * (r.number - 1))
        assert abs(r.lon - x) < 2e-3 and abs(r.lat - y) < 2e-3
    assert {r.slug: r.closed for r in got["traced"].collect()} == {"a": True, "b": True}
    assert {(r.slug, tuple(r.members)) for r in got["complexes"].collect() if r.slug == "a"} == {("a", (1, 2)), ("a", (3, 4)), ("a", (5, 6))}
    assert got["phases"].where("slug = 'a'").count() == 6 and got["sectors"].where("slug = 'a'").count() == 3

    again = generate.Steps(spark, str(tmp_path / "plan"))
    generate.generated(again, *sources(spark))
    assert again.ran == [] and steps.ran[0] == "lines" and steps.ran[-1] == "bar"


def test_a_stopped_plan_goes_on_and_steps_run_anew(spark, tmp_path):
    steps = generate.Steps(spark, str(tmp_path / "plan"))
    first = steps.step("one", lambda: spark.range(3))
    assert first.count() == 3
    try:
        steps.step("two", lambda: first.select(F.raise_error(F.lit("stopped"))))
    except Exception as e:
        assert "stopped" in str(e)
    later = generate.Steps(spark, str(tmp_path / "plan"))
    assert later.step("one", lambda: spark.range(9)).count() == 3 and later.step("two", lambda: spark.range(4)).count() == 4 and later.ran == ["two"]
    anew = generate.Steps(spark, str(tmp_path / "plan"), again=("one",))
    assert anew.step("one", lambda: spark.range(5)).count() == 5 and anew.step("two", lambda: spark.range(6)).count() == 6


def test_faults_fail_the_bar(spark, tmp_path):
    def bend(rows):
        out = []
        for r in rows:
            if r[0] == "a" and r[3] in (2, 4):  # two corners change places on the ground
                r = (*r[:10], *next(x[10:] for x in rows if x[0] == "a" and x[3] == 6 - r[3]))
            if r[0] == "b" and r[3] == 5:
                r = (*r[:10], r[10] + 0.005, r[11])
            out.append(r)
        return out

    got = generate.generated(generate.Steps(spark, str(tmp_path / "bent")), *sources(spark, bend), methods=("relation",))
    bar = {r.slug: r.failed for r in got["bar"].collect()}
    assert "lap_order" in bar["a"] and "on_track" in bar["b"]
