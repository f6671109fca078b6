"""Rules over whole tracks, their bar and the audits of curation: violation rows like those of ``quality``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import cyclic, labels
from ringlake.operators import intervals, locate, ring
from ringlake.plans.quality import KEY, all_of, violation

#: Files that a track has, fields that it fills, its timing sectors, and the limits in metres.
FILES = ["source.json", "raw/track.json", "README.md"]
RENDERS = ["svg", "png"]
FIELDS = ["slug", "name", "country", "location", "layouts", "label_layers"]
SECTORS = ["S1", "S2", "S3"]
OFF_TRACK_M, FAR_APEX_M, APEX_REPORT_M, WAY_OFF_M, WAY_CORNER_M = 80.0, 180.0, 260.0, 90.0, 140.0
#: Names of ways that are no corner's.
INFRASTRUCTURE = r"(?i)pit|lane|circuit|raceway|speedway|autodrome|autódromo|hungaroring|layout|track|course|straight|drag|rallycross|kart|skidpad|driving center|piste|glisse|runoff|bypass|club|moto|safety|paddock|stands|stand|sortie|voie"


def _of_track(rows: DataFrame) -> DataFrame:
    return rows if "layout_id" in rows.columns else rows.withColumn("layout_id", F.lit(None).cast("string"))


def file_rules(slugs: DataFrame, files: DataFrame) -> DataFrame:
    """Required files that ``files(slug, file)`` lacks; both renders, or a warning."""
    need = slugs.select("slug", F.explode(F.array(*map(F.lit, FILES))).alias("file"))
    drawn = files.where(F.col("file").isin(*RENDERS)).groupBy("slug").agg(F.count_distinct("file").alias("n"))
    lost = slugs.select("slug").join(drawn, "slug", "left").where(F.coalesce("n", F.lit(0)) < len(RENDERS))
    return all_of(
        violation(_of_track(need.join(files, ["slug", "file"], "left_anti")), "file_present", "error", F.col("file")),
        violation(_of_track(lost), "render_present", "warn", F.lit("render missing")),
    )


def field_rules(tracks: DataFrame) -> DataFrame:
    """``tracks(folder, slug, name, country, location, layouts, label_layers, series)``: filled fields, a slug that is its folder's, and series.
    Fields may be of any type; empty texts, arrays and maps count as missing."""
    kinds = {f.name: f.dataType.typeName() for f in tracks.schema}
    empty = lambda c: F.col(c).isNull() | ((F.size(c) == 0) if kinds[c] in ("array", "map") else (F.col(c).cast("string") == "") if kinds[c] == "string" else F.lit(False))
    rows = _of_track(tracks.withColumn("_lost", F.array_compact(F.array(*[F.when(empty(c), F.lit(c)) for c in FIELDS]))).withColumn("_own", F.col("slug")).withColumn("slug", F.col("folder")))
    return all_of(
        violation(rows.withColumn("f", F.explode("_lost")), "field_present", "error", F.col("f")),
        violation(rows.where(~F.col("_own").eqNullSafe(F.col("folder"))), "slug_is_folder", "error", F.coalesce("_own", F.lit(""))),
        violation(rows.where(empty("series")), "series_present", "warn", F.lit("series")),
    )


def layout_rules(layouts: DataFrame) -> DataFrame:
    """``layouts(slug, layout_id, length_m, direction, corners, unlocated, start_located, pit_entry, pit_exit, sectors)``, in one pass: length and
    direction, corners and their places, start and pit, and exactly the three timing sectors. Layouts without corners are not looked at further."""
    some = F.col("corners") > 0
    rule = lambda name, level, bad, detail: F.when(bad, F.struct(F.lit(name).alias("rule"), F.lit(level).alias("level"), detail.cast("string").alias("detail")))
    found = [
        rule("length_present", "warn", F.coalesce("length_m", F.lit(0.0)) == 0, F.lit("length_m")),
        rule("direction_present", "warn", F.coalesce("direction", F.lit("")) == "", F.lit("direction")),
        rule("corners_present", "error", ~some, F.lit("corners")),
        rule("corners_located", "error", some & (F.size("unlocated") > 0), F.array_join(F.array_sort("unlocated"), ",")),
        rule("start_present", "error", some & ~F.coalesce("start_located", F.lit(False)), F.lit("start_finish")),
        rule("pit_present", "warn", some & (F.col("pit_entry").isNull() | F.col("pit_exit").isNull()), F.lit("pit")),
        rule("three_sectors", "error", some & ~F.coalesce(F.col("sectors") == F.array(*map(F.lit, SECTORS)), F.lit(False)), F.array_join(F.coalesce("sectors", F.array().cast("array<string>")), ",")),
    ]
    return layouts.select(*KEY, F.inline(F.array_compact(F.array(*found))))


def distance_rules(vertices: DataFrame, points: DataFrame) -> DataFrame:
    """Points ``(slug, layout_id, id, plon, plat)`` over 80 m from the outline ``(slug, layout_id, seq, lon, lat)``."""
    d = ring.off_line(vertices, points, ["id"], ring.Ring(key=tuple(KEY))).where(F.col("dist_m") > OFF_TRACK_M)
    return violation(d, "on_track", "error", F.format_string("%s %.0f m", "id", "dist_m"))


def feature_rules(located: DataFrame, features: DataFrame) -> DataFrame:
    """Corner features of the emitted geometry ``(slug, layout_id, id)`` against located corners, by number."""
    count = lambda df, n: df.groupBy(*KEY).agg(F.count("*").alias(n))
    j = count(located, "a").join(count(features, "b"), KEY, "full_outer").na.fill(0, ["a", "b"]).where("a <> b")
    return violation(j, "corner_features", "warn", F.format_string("%d features, %d corners", "b", "a"))


def named_runs(corners: DataFrame) -> DataFrame:
    """``(slug, layout_id, label, members)``: two or more adjacent corners ``(…, id, number, label, labels)`` of one real name."""
    named = labels.has_real_name(F.col("labels"))
    overlay = F.map_values(F.map_filter("labels", lambda k, v: k != "numbered"))
    c = corners.withColumn("_label", F.when(named, F.coalesce(F.nullif("label", F.lit("")), F.try_element_at(overlay, F.lit(1)))))
    g = intervals.equal_runs(c, KEY, ["number", "id"], "_label").where("_label is not null").groupBy(*KEY, "run").agg(F.first("_label").alias("label"), F.array_sort(F.collect_list("id")).alias("members"))
    return g.where(F.size("members") > 1).drop("run")


def repeat_rules(corners: DataFrame, groups: DataFrame) -> DataFrame:
    """Adjacent corners of one name that no group ``(slug, layout_id, members)`` holds together; layouts without groups are let be."""
    runs = named_runs(corners).join(groups.select(*KEY).distinct(), KEY, "left_semi")
    lost = intervals.merged_into(runs, groups, KEY).where("not merged")
    return violation(lost, "repeats_merged", "warn", F.concat("label", F.lit("("), F.array_join("members", ","), F.lit(")")))


def apex_distances(corners: DataFrame, apexes: DataFrame, totals: DataFrame, id_col: str = "id") -> DataFrame:
    """``(slug, layout_id, id, marker, apex, metres)``: each corner's nearest apex of the curvature, the first among equals, and how far the nearest is
    along the lap of ``total_m``: between equals rounding may count, so it is the least distance of all."""
    at = corners.where("marker is not null").select(*KEY, id_col, "marker")
    a = apexes.select(*KEY, F.col("number").alias("apex"), F.col("marker").alias("apex_at"))
    near = locate.nearest_cyclic(at, [id_col], a, KEY, "marker", "apex_at", "apex")
    return at.join(near, [*KEY, id_col]).join(totals.select(*KEY, "total_m"), KEY).select(*KEY, id_col, "marker", "apex", (F.col("least_distance") * F.col("total_m")).alias("metres"))


def apex_rules(corners: DataFrame, apexes: DataFrame, totals: DataFrame, far_m: float = FAR_APEX_M) -> DataFrame:
    """Corners further than ``far_m`` from any apex of the curvature."""
    return violation(apex_distances(corners, apexes, totals).where(F.col("metres") > far_m), "apex_near_curvature", "warn", F.format_string("%s %.0f m", "id", "metres"))


def apex_report(corners: DataFrame, apexes: DataFrame, totals: DataFrame, far_m: float = APEX_REPORT_M) -> DataFrame:
    """Every corner's distance to the nearest apex, the far ones flagged."""
    return apex_distances(corners, apexes, totals).withColumn("far", F.col("metres") > far_m)


def phase_preview(corners: DataFrame, groups: DataFrame, apexes: DataFrame | None = None, digits: int | None = 5) -> DataFrame:
    """``start, apex, end, brakes, span_m`` of corners ``(slug, layout_id, id, number, marker, scale, lap_m)`` under the groups of several members,
    and with ``apexes`` the metres to the nearest one (null over 995)."""
    g = groups.where(F.size("members") > 1).select(*KEY, "label", F.explode("members").alias("id")).groupBy(*KEY, "id").agg(F.max("label").alias("grp"))
    p = intervals.phases(corners.join(g, [*KEY, "id"], "left"), KEY, "marker", "number", "scale", "lap_m", "grp", digits)
    out = p.withColumn("span_m", F.round(cyclic.gap(F.col("start"), F.col("end")) * F.col("lap_m")))
    if apexes is not None:
        d = apex_distances(corners, apexes, corners.select(*KEY, F.col("lap_m").alias("total_m")).distinct()).select(*KEY, "id", F.when(F.col("metres") < 995, F.col("metres")).alias("apex_m"))
        out = out.join(d, [*KEY, "id"], "left")
    return out


def way_corners(vertices: DataFrame, corners: DataFrame, ways: DataFrame, off_m: float = WAY_OFF_M, corner_m: float = WAY_CORNER_M) -> DataFrame:
    """Names that ways ``(slug, layout_id, way, name, plon, plat)`` suggest for corners ``(…, id, marker, labels)``: the way's centre lies near the outline,
    the nearest corner along the lap is close, and does not bear the name yet."""
    r = ring.Ring(key=tuple(KEY))
    w = ways.where(~F.col("name").rlike(INFRASTRUCTURE))
    at = ring.nearest_vertex(vertices, w, ["way", "name"], r).where(F.col("dist_m") <= off_m)
    total = ring.measured(vertices, r).groupBy(*KEY).agg(F.max("total_m").alias("total_m"))
    c = corners.withColumn("_m", F.coalesce("marker", F.lit(0.0)))
    near = locate.nearest_cyclic(at, ["way", "name", "dist_m"], c, KEY, "fraction", "_m", "id").join(total, KEY).withColumn("corner_m", F.col("lap_distance") * F.col("total_m")).where(F.col("corner_m") <= corner_m)
    held = c.select(*KEY, "id", F.transform(F.filter(F.map_values("labels"), lambda x: F.coalesce(x, F.lit("")) != ""), labels.normalized).alias("_held"))
    return near.join(held, [*KEY, "id"]).where(~F.array_contains("_held", labels.normalized(F.col("name")))).select(*KEY, "id", "way", "name", "corner_m", F.col("dist_m").alias("off_m"))


def signals(**found: DataFrame) -> DataFrame:
    """``(slug, signal, n)`` of each named set of violation rows."""
    return all_of(*[df.groupBy("slug").agg(F.count("*").alias("n")).select("slug", F.lit(name).alias("signal"), "n") for name, df in found.items()])


def total_signals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("signals"))


def exit_status(violations: DataFrame, strict: bool = False) -> DataFrame:
    """One row ``status``: 1 if an error stands, or with ``strict`` any violation."""
    bad = F.col("level") == "error" if not strict else F.lit(True)
    return violations.agg(F.max(F.when(bad, 1).otherwise(0)).alias("s")).select(F.coalesce("s", F.lit(0)).alias("status"))


def summary(bars: DataFrame) -> DataFrame:
    """How many tracks meet the bar and how many miss it."""
    return bars.agg(F.count("*").alias("tracks"), F.count_if("meets").alias("meets"), F.count_if(~F.col("meets")).alias("missing"))


def examples(rows: DataFrame, by: list[str], order: list[str], detail: str, most: int = 8) -> DataFrame:
    """The first details of each group as one text, and how many there are."""
    o = W.partitionBy(*by).orderBy(*order)
    first = rows.withColumn("_i", F.row_number().over(o)).withColumn("n", F.count("*").over(W.partitionBy(*by))).where(F.col("_i") <= most)
    return first.groupBy(*by).agg(F.max("n").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.col(detail).alias("d")))), lambda x: x["d"]), ", ").alias("examples"))


def compact(c: Column) -> Column:
    return F.filter(c, lambda x: F.coalesce(x, F.lit("")) != "")
