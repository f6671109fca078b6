"""From candidate lines to an emitted layout: the best line is chosen, aligned, turned to the start and closed, and every marker is placed on it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringlake.operators import align, dense, graph, intervals, ring
from ringlake.plans import audit, quality
from ringlake.session import written

KEY = quality.KEY
LAYOUT = ring.Ring(key=tuple(KEY))
#: Rules that a generated layout is held to.
BAR = ["outline_points", "outline_closed", "length_deviation", "item_id_unique", "numbers_1_to_n", "code_present", "numbered_label", "corner_grouped", "lap_order", "on_track"]


def chosen(candidates: DataFrame, expected: DataFrame, r: ring.Ring = ring.R) -> DataFrame:
    """The vertices of each ring's best candidate ``(key, source, rank, seq, lon, lat)`` by ``ring.quality`` against ``expected(key, expected_m)``, the least
    rank among equals, with its ``source`` and ``score``. Candidates of under eight vertices never win against others."""
    key = list(r.key)
    candidates = written(candidates, "candidates")
    own = ring.Ring(key=(*r.key, "source"), seq=r.seq, lon=r.lon, lat=r.lat)
    goal = candidates.select(*key, "source").distinct().join(expected, key)
    rank = candidates.select(*key, "source", "rank").distinct()
    best = ring.quality(candidates, goal, own).join(rank, [*key, "source"]).groupBy(*key).agg(F.min_by(F.struct("source", "score"), F.struct("score", "rank")).alias("b"))
    return candidates.join(best.select(*key, "b.source", "b.score"), [*key, "source"]).select(*key, r.seq, r.lon, r.lat, "source", "score")


def _run(line: DataFrame, anchors: DataFrame, starts: DataFrame, r: ring.Ring) -> tuple[DataFrame, DataFrame]:
    """The cut legs of the densified rings, and of each ring the vertex ``_k`` that it is emitted from, with ``_atr`` and whether it is ``reversed``."""
    key = list(r.key)
    m = dense.cut(ring.opened_ring(line, r), r)  # else the closing vertex stands twice where the start moves
    anchors = written(anchors.select(*key, "marker", "plon", "plat", F.lit(False).alias("_back")), "anchors")
    tied = dense.nearest(m, anchors, ["marker"], r).select(*key, "marker", F.coalesce(F.col("_at") / F.nullif("_total", F.lit(0.0)), F.lit(0.0)).alias("fraction"))
    zero = written(align.placed(m.select(*key, "_total", "_fin").where("_fin is not null").withColumn("marker", F.lit(0.0)), tied, key), "zero")
    start = zero.select(*key, "fraction", "reversed", "_total", "_fin").join(starts.select(*key, "plon", "plat"), key, "left")
    along = F.pmod("fraction", F.lit(1.0)) * F.col("_total")
    at = F.when(F.col("reversed"), F.col("_fin") - along).otherwise(along)  # a reversed ring begins at its last vertex
    own = dense.places(m, start.where("plon is null or plat is null").select(*key, at.alias("_u")).distinct(), r).select(*key, F.col("lon").alias("_x"), F.col("lat").alias("_y"))
    start = start.join(own, key, "left").select(*key, F.coalesce("plon", "_x").alias("plon"), F.coalesce("plat", "_y").alias("plat"), F.col("reversed").alias("_back"))
    first = dense.nearest(m, written(start, "start"), [], r).select(*key, "_k", "_atr", "_totalr", "_vertices")
    return m, written(first.join(zero.select(*key, "reversed"), key), "first")


def outline(line: DataFrame, anchors: DataFrame, starts: DataFrame, r: ring.Ring = ring.R) -> DataFrame:
    """The emitted ring: densified, run the way that the anchors ``(key, marker, plon, plat)`` fit best, begun at the vertex nearest the start line
    ``starts(key, plon, plat)``, or where marker 0 falls, rounded to six places and closed. Vertex 0 is marker 0 of the lap."""
    m, first = _run(line, anchors, starts, r)
    m = m.join(first.select(*r.key, F.col("_k").alias("_first"), "reversed"), list(r.key))
    back = F.col("reversed")
    before = F.pmod(F.col("_first") - F.when(back, 0).otherwise(2), F.col("_vertices")) + 1  # the vertex that is emitted last
    held = lambda k: (k > F.col("_before")) & (k <= F.col("_before") + F.col("_n"))
    number = F.pmod(F.when(back, F.col("_first") - F.col("_k")).otherwise(F.col("_k") - F.col("_first")), F.col("_vertices")) + 1

    def emitted(legs: DataFrame) -> DataFrame:
        return dense.vertices(legs, r, "_first", "reversed", "_vertices").select(*r.key, number.cast("int").alias(r.seq), F.round(r.lon, 6).alias(r.lon), F.round(r.lat, 6).alias(r.lat), "_vertices")

    ends = emitted(m.where(held(F.col("_first")) | held(before))).where(F.col(r.seq).isin(1) | (F.col(r.seq) == F.col("_vertices")))
    return emitted(m).drop("_vertices").unionByName(ring.closing(ends, r))


def emitted(line: DataFrame, anchors: DataFrame, starts: DataFrame, marked: DataFrame, r: ring.Ring = ring.R) -> DataFrame:
    """``placed`` on the ``outline``, without its vertices: their lengths are summed by legs, and only where a marker falls a leg's pieces are looked at."""
    key = list(r.key)
    m, first = _run(line, anchors, starts, r)
    t = marked.where("marker is not null").join(first.select(*key, "_atr", F.col("_totalr").alias("_lap"), "reversed"), key)
    along = F.pmod("marker", F.lit(1.0)) * F.col("_lap")
    t = t.select(*marked.columns, F.when(F.col("reversed"), F.col("_atr") - along).otherwise(F.col("_atr") + along).alias("_u"))
    return dense.places(m, t, r, rounded=True).select(*marked.columns, F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def placed(emitted: DataFrame, marked: DataFrame, r: ring.Ring = ring.R) -> DataFrame:
    """``marked(key, marker, ...)`` with the place of each marker on the emitted ring, whatever placed it before; rows without a marker go."""
    at = ring.points_at(emitted, marked.where("marker is not null"), "marker", r)
    return at.withColumn("lon", F.round("lon", 6)).withColumn("lat", F.round("lat", 6))


class Steps:
    """Named steps of a plan, each a table under ``folder``. A step whose table was finished before is read, not run again, so a plan that was stopped
    goes on where it stopped; ``again`` names steps to run anew, with all that come after them."""

    def __init__(self, spark: SparkSession, folder: str, again: tuple[str, ...] = ()):
        self.spark, self.folder, self.again, self.ran = spark, folder.rstrip("/"), again, []

    def finished(self, name: str) -> bool:
        """Whether the step's table was written to its end; a hidden file says so, which readers skip."""
        sc = self.spark.sparkContext
        mark = sc._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return mark.getFileSystem(sc._jsc.hadoopConfiguration()).exists(mark)

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.ran or name in self.again or not self.finished(name):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
            self.ran.append(name)
        return self.spark.read.parquet(f"{self.folder}/{name}")


def generated(steps: Steps, segments: DataFrame, layouts: DataFrame, corners: DataFrame, anchors: DataFrame, starts: DataFrame, methods: tuple[str, ...] = ("relation", "stitch")) -> dict[str, DataFrame]:
    """From sources to verified layouts; all tables have the key ``slug, layout_id``.

    ``segments(ord, name, points)`` are assembled to laps by each of the ``methods``, and the line that fits ``layouts(length_m)`` best becomes the
    outline, tied to ``anchors(marker, plon, plat)`` and ``starts(plon, plat)``. On it come ``corners(id, number, code, labels, label, named, marker,
    scale, grp, plon, plat)``, their phases and groups, and the timing sectors; at last every rule of ``BAR`` is looked at. Returns the tables
    by name: ``lines, chosen, outline, traced, corners, phases, complexes, sectors, violations, bar``. Layouts without a line have no
    outline and fail the bar; corners without a marker have no place, and null lengths expect nothing.
    """
    s, r = steps, LAYOUT
    goal = layouts.select(*KEY, F.col("length_m").cast("double").alias("expected_m"))
    drawn = segments.join(goal, KEY, "left")
    lines = s.step("lines", lambda: reduce(DataFrame.unionByName, [graph.assembled(drawn, KEY, how).withColumn("source", F.lit(how)).withColumn("rank", F.lit(i)) for i, how in enumerate(methods)]))
    line = s.step("chosen", lambda: chosen(lines, goal, r))
    rim = s.step("outline", lambda: outline(line, anchors, starts, r))
    ends = rim.groupBy(*KEY).agg((F.min_by(F.struct(r.lon, r.lat), r.seq) == F.max_by(F.struct(r.lon, r.lat), r.seq)).alias("closed"))
    size = s.step("traced", lambda: ring.summary(rim, r).select(*KEY, "vertices", F.col("length_m").alias("traced_m")).join(ends, KEY).join(layouts.select(*KEY, "length_m"), KEY).withColumn("lap_m", F.coalesce(F.nullif("length_m", F.lit(0.0)), "traced_m")))
    at = s.step("corners", lambda: placed(rim, corners, r).join(size.select(*KEY, "lap_m"), KEY))
    phased = s.step("phases", lambda: intervals.phases(at, KEY, "marker", "number", "scale", "lap_m", "grp").select(*KEY, "id", "number", "start", "apex", "end", "brakes"))
    groups = s.step("complexes", lambda: intervals.complexes(at, KEY, "number", "grp", "label", "named", "scale"))
    sectors = s.step("sectors", lambda: intervals.sector_rows(intervals.three_sectors(at, KEY, "marker")))
    given = corners.where("plon is not null and plat is not null")

    def faults() -> DataFrame:
        on = written(ring.nearest_on_line(rim, given.select(*KEY, "id", "number", "marker", "plon", "plat"), ["id", "number", "marker"], r), "on")  # inversions read it several times
        items = corners.select(*KEY, F.lit("corners").alias("layer_id"), "id", "number", "code", "labels")
        named = groups.select(*KEY, F.explode("members").alias("number")).join(corners.select(*KEY, "number", "id"), [*KEY, "number"]).groupBy(*KEY).agg(F.collect_list("id").alias("members"))
        lost = layouts.join(size.select(*KEY), KEY, "left_anti")
        return quality.all_of(
            quality.outline_rules(size), quality.violation(lost, "outline_points", "error", F.lit("no line")), quality.length_rules(size), quality.point_rules(items), quality.order_rules(on),
            audit.distance_rules(rim, given.select(*KEY, "id", "plon", "plat")), quality.coverage_rules(corners, named),
        )

    found = s.step("violations", faults)
    checks = layouts.select("slug", F.explode(F.array(*map(F.lit, BAR))).alias("rule"))
    bar = s.step("bar", lambda: quality.roll_up(found, checks, BAR))
    return {"lines": lines, "chosen": line, "outline": rim, "traced": size, "corners": at, "phases": phased, "complexes": groups, "sectors": sectors, "violations": found, "bar": bar}
