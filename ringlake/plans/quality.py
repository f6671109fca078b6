"""Integrity rules and audits as violation rows: ``slug, layout_id, rule, level, detail``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.operators import intervals, ring
from ringlake.session import dealt

KEY = ["slug", "layout_id"]


def violation(rows: DataFrame, rule: str, level: str, detail: Column) -> DataFrame:
    return rows.select(*KEY, F.lit(rule).alias("rule"), F.lit(level).alias("level"), detail.cast("string").alias("detail"))


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _flagged(rows: DataFrame, *rules: tuple[str, Column, Column]) -> DataFrame:
    """Violations of one pass over ``rows``: each rule is a name, when a row breaks it, and what it says."""
    found = [F.when(bad, F.struct(F.lit(name).alias("rule"), F.lit("error").alias("level"), detail.cast("string").alias("detail"))) for name, bad, detail in rules]
    return rows.select(*KEY, F.inline(F.array_compact(F.array(*found))))


def _times(by, order: str) -> tuple[Column, Column]:
    """How often a row's key occurs, and whether the row is its first."""
    return F.count("*").over(by), F.row_number().over(by.orderBy(order)) == 1


def point_rules(items: DataFrame) -> DataFrame:
    """Point items ``(slug, layout_id, layer_id, id, number, code, labels)``: unique ids; corners numbered 1..N with unique codes
    and a numbered label. One shuffle by layout serves all windows."""
    corner = F.col("layer_id") == "corners"
    layer = W.partitionBy(*KEY, "layer_id")
    c = dealt(items, ["slug"])  # a part's rows are in memory several times
    for name, by in (("id", W.partitionBy(*KEY, "layer_id", "id")), ("code", W.partitionBy(*KEY, "layer_id", "code")), ("number", W.partitionBy(*KEY, "layer_id", "number"))):
        n, first = _times(by, "id")
        c = c.withColumn(f"_n_{name}", n).withColumn(f"_first_{name}", first)
    c = c.withColumn("_n", F.count("*").over(layer)).withColumn("_nulls", F.count(F.when(F.col("number").isNull(), 1)).over(layer)).withColumn("_lo", F.min("number").over(layer)).withColumn("_hi", F.max("number").over(layer))
    c = c.withColumn("_d", F.sum((F.col("_first_number") & F.col("number").isNotNull()).cast("int")).over(layer)).withColumn("_one", F.row_number().over(layer.orderBy("id")) == 1)
    off = (F.col("_nulls") > 0) | ~F.col("_lo").eqNullSafe(F.lit(1)) | ~F.col("_hi").eqNullSafe(F.col("_n")) | (F.col("_d") != F.col("_n"))
    blank = F.coalesce("code", F.lit("")) == ""
    times = lambda what, col, n: F.concat(F.lit(f"{what} "), F.col(col), F.lit(" x"), F.col(n).cast("string"))
    return _flagged(
        c,
        ("item_id_unique", F.col("_first_id") & (F.col("_n_id") > 1), times("id", "id", "_n_id")),
        ("numbers_1_to_n", corner & F.col("_one") & off, F.format_string("%d corners, %d to %d", "_n", "_lo", "_hi")),
        ("code_present", corner & blank, F.col("id")),
        ("code_unique", corner & ~blank & F.col("_first_code") & (F.col("_n_code") > 1), times("code", "code", "_n_code")),
        ("numbered_label", corner & F.try_element_at("labels", F.lit("numbered")).isNull(), F.col("id")),
    )


def range_rules(items: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Range items ``(slug, layout_id, layer_id, coverage, id, start, end)``: unique ids, start before end, true partitions; in one pass."""
    layer = W.partitionBy(*KEY, "layer_id")
    o = layer.orderBy("start", "end")
    part = F.col("coverage") == "partition"
    n, first = _times(W.partitionBy(*KEY, "layer_id", "id"), "start")
    c = dealt(items, ["slug"]).withColumn("_n_id", n).withColumn("_first_id", first).withColumn("_d", F.col("start") - F.lag("end").over(o)).withColumn("_one", F.row_number().over(o) == 1)
    c = c.withColumn("_a", F.min("start").over(layer)).withColumn("_b", F.max("end").over(layer))
    return _flagged(
        c,
        ("range_id_unique", F.col("_first_id") & (F.col("_n_id") > 1), F.concat(F.lit("id "), F.col("id"), F.lit(" x"), F.col("_n_id").cast("string"))),
        ("start_before_end", ~F.coalesce(F.col("start") < F.col("end"), F.lit(False)), F.col("id")),
        ("partition_contiguous", F.coalesce(part & (F.abs("_d") > tolerance), F.lit(False)), F.col("id")),
        ("partition_covers", F.coalesce(part & F.col("_one") & ((F.abs("_a") > tolerance) | (F.abs(F.col("_b") - 1.0) > tolerance)), F.lit(False)), F.col("layer_id")),
    )


def inner_points(items: DataFrame) -> DataFrame:
    """Landmarks inside a range ``(…, id, start, end, points)`` lie within it."""
    p = items.select(*KEY, "id", "start", "end", F.explode("points").alias("p"))
    return violation(p.where("p.marker < start or p.marker > end"), "point_in_range", "error", F.concat_ws(".", "id", "p.id"))


def label_rules(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Labels use declared layers; the registry ``(slug, layout_id, layers, label_default)`` declares numbered, official and the default."""
    used = items.select(*KEY, F.explode(F.map_keys("labels")).alias("layer")).distinct().join(registry, KEY)
    need = registry.select(*KEY, F.explode(F.array_except(F.array(F.lit("numbered"), F.lit("official")), "layers")).alias("layer"))
    return all_of(
        violation(used.where(~F.array_contains("layers", F.col("layer"))), "label_declared", "error", F.col("layer")),
        violation(need, "registry_mandatory", "error", F.col("layer")),
        violation(registry.where(~F.array_contains("layers", F.col("label_default"))), "default_declared", "error", F.col("label_default")),
    )


def reference_rules(refs: DataFrame, points: DataFrame) -> DataFrame:
    """Every reference ``(slug, layout_id, ref)`` names a point item of its layout."""
    lost = refs.where("ref is not null").join(points.select(*KEY, F.col("id").alias("ref")).distinct(), [*KEY, "ref"], "left_anti")
    return violation(lost, "reference_resolves", "error", F.col("ref"))


def coverage_rules(corners: DataFrame, complexes: DataFrame) -> DataFrame:
    """Every corner under severity 5 is in exactly one group ``(slug, layout_id, members)``; members exist."""
    m = complexes.select(*KEY, F.explode("members").alias("id"))
    n = m.groupBy(*KEY, "id").agg(F.count("*").alias("n"))
    need = corners.where("coalesce(scale, 3) < 5").select(*KEY, "id")
    return all_of(
        violation(need.join(m, [*KEY, "id"], "left_anti"), "corner_grouped", "error", F.col("id")),
        violation(n.where("n > 1"), "corner_grouped_once", "error", F.col("id")),
        violation(m.join(corners.select(*KEY, "id"), [*KEY, "id"], "left_anti").distinct(), "member_exists", "error", F.col("id")),
    )


def empty_groups(complexes: DataFrame) -> DataFrame:
    """Groups ``(slug, layout_id, id, points)`` without a point inside."""
    return violation(complexes.where(F.coalesce(F.size("points"), F.lit(0)) <= 0), "group_has_points", "warn", F.col("id"))


def order_rules(corners: DataFrame) -> DataFrame:
    """Corners ``(slug, layout_id, number, marker, fraction)`` whose order along the lap disagrees with that of their places on the outline, which
    count from the first corner's on; corners without a marker or a place are not looked at, nor layouts under three."""
    c = corners.where("marker is not null and fraction is not null")
    bad = intervals.inversions(c, KEY, "marker", "fraction", first=["number"]).where("inversions > 0")
    return violation(bad, "lap_order", "error", F.format_string("%d inversions", "inversions"))


def centerline_rules(vertices: DataFrame, r: ring.Ring, most: int = 6) -> DataFrame:
    """Outlines with suspiciously long legs or sharp turns back, and the first ``most`` of each."""
    found = ring.anomalies(vertices, r)
    named = F.struct(F.col(r.seq).alias("seq"), "long_m", "back")

    def rule(bad: str, name: str, show) -> DataFrame:
        rows = found.where(F.col(bad).isNotNull())
        first = rows.withColumn("_i", F.row_number().over(W.partitionBy(*KEY).orderBy(r.seq))).where(F.col("_i") <= most)
        listed = first.groupBy(*KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(named)), show), ", ").alias("detail"))
        return violation(listed, name, "warn", F.col("detail"))

    long_ = rule("long_m", "long_leg", lambda x: F.format_string("%d %.0fm", x["seq"], x["long_m"]))
    return all_of(long_, rule("back", "turn_back", lambda x: F.format_string("%d %.0f°", x["seq"], x["back"])))


def length_rules(layouts: DataFrame, warn: float = 0.03, fail: float = 0.10) -> DataFrame:
    """Traced against declared length."""
    d = layouts.withColumn("_d", F.abs(F.col("traced_m") - F.col("length_m")) / F.nullif("length_m", F.lit(0.0))).where(F.col("_d") > warn)
    return d.select(*KEY, F.lit("length_deviation").alias("rule"), F.when(F.col("_d") > fail, "error").otherwise("warn").alias("level"), F.format_string("%.1f%%", F.col("_d") * 100).alias("detail"))


def outline_rules(rings: DataFrame) -> DataFrame:
    """Outlines ``(slug, layout_id, vertices, closed)``: eight vertices or more, and closed."""
    return all_of(violation(rings.where("vertices < 8"), "outline_points", "error", F.col("vertices")), violation(rings.where("not closed"), "outline_closed", "error", F.lit("open")))


def roll_up(violations: DataFrame, checks: DataFrame, bar: list[str]) -> DataFrame:
    """Each slug against the rules of ``bar``: a rule is false where an error of it stands, true where ``checks(slug, rule)`` says it was looked
    at and none stands, else unknown. A slug ``meets`` the bar if all are true; ``failed`` and ``unknown`` list the others in the bar's order."""
    known = F.col("slug").isNotNull()
    seen = checks.select("slug", F.lit(True).alias("_checked"), F.when(known, F.col("rule")).alias("_seen"), F.lit(None).cast("string").alias("_bad"))
    bad = violations.where("level = 'error'").select("slug", F.lit(False).alias("_checked"), F.lit(None).cast("string").alias("_seen"), F.when(known, F.col("rule")).alias("_bad"))
    has = lambda c, x: F.coalesce(F.max(F.col(c) == x), F.lit(False))
    flags = [(has("_seen", x).alias(f"_s{i}"), has("_bad", x).alias(f"_b{i}")) for i, x in enumerate(bar)]
    state = seen.unionByName(bad).groupBy("slug").agg(F.max("_checked").alias("_checked"), *[f for pair in flags for f in pair]).where("_checked")
    listed = lambda cond: F.array_compact(F.array(*[F.when(cond(F.col(f"_s{i}"), F.col(f"_b{i}")), F.lit(x)) for i, x in enumerate(bar)]))
    failed, unknown = listed(lambda s, b: b), listed(lambda s, b: ~s & ~b)
    return state.select("slug", (F.size(failed) + F.size(unknown) == 0).alias("meets"), failed.alias("failed"), unknown.alias("unknown"))
