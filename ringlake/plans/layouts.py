"""Projections of track documents: layers, stats, label lists, the wide corner table, source fields and view settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import labels
from ringlake.operators import ring


def layer_items(layouts: Column, of: str, layer_id: str) -> Column:
    """Items of a layout struct's layer; an empty array without one."""
    found = F.filter(layouts[of], lambda x: x["id"] == layer_id)
    return F.coalesce(F.try_element_at(found, F.lit(1))["items"], F.slice(F.try_element_at(layouts[of], F.lit(1))["items"], 1, 0))


def layout_rows(tracks: DataFrame) -> DataFrame:
    """One row a layout: ``slug, layout_id, layout``."""
    return tracks.select("slug", F.explode("layouts").alias("layout")).select("slug", F.col("layout.id").alias("layout_id"), "layout")


def stats(tracks: DataFrame) -> DataFrame:
    """Each layout's name, kilometres, layers, corners, direction and series, those of the track first."""
    d = tracks.select("slug", F.coalesce("series", F.array().cast("array<string>")).alias("_s"), F.explode("layouts").alias("l"))
    n = lambda c: F.coalesce(F.nullif(F.size(c), F.lit(-1)), F.lit(0))
    all_ = F.concat("_s", F.coalesce("l.series", F.array().cast("array<string>")))
    return d.select("slug", F.col("l.id").alias("layout_id"), F.col("l.name").alias("name"), labels.kilometres(F.col("l.length_m")).alias("km"), n(F.col("l.point_layers")).alias("point_layers"), n(F.col("l.range_layers")).alias("range_layers"),
                    n(layer_items(F.col("l"), "point_layers", "corners")).alias("corners"), F.coalesce("l.direction", F.lit("—")).alias("direction"), F.when(F.size(all_) > 0, F.array_join(all_, ", ")).otherwise("—").alias("series"))


#: The range layers that are shown at first.
SHOWN = ["timing_sectors", "imsa_microsectors", "slow_zones"]


def view(tracks: DataFrame) -> DataFrame:
    """The first view of each layout: outline and all point layers, of the range layers those of ``SHOWN``."""
    d = layout_rows(tracks)
    ids = lambda c: F.transform(c, lambda x: x["id"])
    return d.select("slug", "layout_id", F.lit(True).alias("outline"), ids(F.col("layout.point_layers")).alias("point_layers"), F.filter(ids(F.col("layout.range_layers")), lambda x: x.isin(*SHOWN)).alias("range_layers"))


def visible(state: Column) -> Column:
    """The layers of a map that are switched on."""
    return F.map_filter(state, lambda k, v: F.coalesce(v, F.lit(False)))


def label_list(item_labels: Column) -> Column:
    """The labels of an item that hold something."""
    return F.filter(F.map_values(item_labels), lambda v: F.coalesce(v, F.lit("")) != "")


def unnamed(scale: Column, item_labels: Column) -> Column:
    """A corner slower than fast that has only its number."""
    return (F.coalesce(scale, F.lit(0)) < 5) & ~labels.has_real_name(item_labels)


def unlocated(location: Column) -> Column:
    return location.isNull() | (F.size(location) == 0)


def match_stats(corners: DataFrame, key: list[str]) -> DataFrame:
    """Corners by key: ``matched`` ones (with a location) of ``total``, named ones and unnamed slow ones."""
    return corners.groupBy(*key).agg(F.count("*").alias("total"), F.count_if(~unlocated(F.col("location"))).alias("matched"), F.count_if(labels.has_real_name(F.col("labels"))).alias("named"), F.count_if(unnamed(F.col("scale"), F.col("labels"))).alias("unnamed"))


def anchors(corners: DataFrame, starts: DataFrame, key: list[str]) -> DataFrame:
    """``(key, marker, location)`` that tie the lap to the ground: corners with both, and a start line that the source pins (marker 0 unless given)."""
    c = corners.where(F.col("marker").isNotNull() & ~unlocated(F.col("location"))).select(*key, "marker", "location")
    return c.unionByName(starts.where(~unlocated(F.col("location"))).select(*key, F.coalesce("marker", F.lit(0.0)).alias("marker"), "location"))


def replacement_corners(overrides: DataFrame, key: list[str]) -> DataFrame:
    """Corner rows of ``replace_corners`` lists: code and numbered label follow the number, overlays that hold something are labels, and
    ``match`` tells whether the corner takes part in the name join."""
    i = overrides.select(*key, F.explode("replace_corners").alias("i"))
    code = F.coalesce(F.col("i.code"), F.col("i.number").cast("string"))
    pairs = [(F.lit("numbered"), labels.numbered(code)), *[(F.lit(x), F.nullif(F.col(f"i.{x}"), F.lit(""))) for x in labels.OVERLAYS]]
    m = F.map_from_entries(F.filter(F.array(*[F.struct(k.alias("k"), v.alias("v")) for k, v in pairs]), lambda e: e["v"].isNotNull()))
    return i.select(*key, F.col("i.number").alias("number"), code.alias("code"), m.alias("labels"), "i.marker", "i.direction", "i.scale", F.col("i.complex").alias("grp"), F.coalesce("i.match_osm", F.lit(True)).alias("match"))


def slow_zones(sources: DataFrame) -> DataFrame:
    """Range items of the sources' slow zones."""
    z = sources.select("slug", F.explode("layouts").alias("l")).select("slug", F.col("l.id").alias("layout_id"), F.explode("l.slow_zones").alias("z"))
    return z.select("slug", "layout_id", "z.id", F.col("z.name").alias("label"), "z.start", "z.end")


def straights(laps: DataFrame) -> DataFrame:
    """Straights of lap documents, nameless ones as ''."""
    return laps.select("slug", F.explode("straight").alias("s")).select("slug", F.coalesce("s.name", F.lit("")).alias("name"), "s.start", "s.end")


def sector_marks(laps: DataFrame) -> DataFrame:
    """Sector marks of lap documents that have a place."""
    return laps.select("slug", F.explode("sector").alias("s")).where("s.marker is not null").select("slug", F.coalesce("s.name", F.lit("")).alias("name"), "s.marker")


def lap_metres(declared: Column, traced: Column, prefer: str = "declared") -> Column:
    """A layout's length: declared or traced first, 0 counting as none."""
    d, t = F.nullif(declared, F.lit(0.0)), F.nullif(traced, F.lit(0.0))
    return F.coalesce(d, t) if prefer == "declared" else F.coalesce(t, d)


def range_points(vertices: DataFrame, points: DataFrame, r: ring.Ring = ring.R) -> DataFrame:
    """Landmarks ``(key, id, marker, location)`` with ``lon, lat``: their own location, else their place on the ring (clamped); null without either."""
    key = list(r.key)
    own = points.where(F.col("location").isNotNull()).select(*key, "id", F.col("location")[0].alias("lon"), F.col("location")[1].alias("lat"))
    rest = points.where("location is null")
    on = ring.points_at(vertices, rest.where("marker is not null").select(*key, "id", "marker"), "marker", r, clamp=True).select(*key, "id", "lon", "lat")
    lost = rest.join(on, [*key, "id"], "left_anti").select(*key, "id", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"))
    return own.unionByName(on).unionByName(lost)


def wide_corners(corners: DataFrame, key: list[str], layers: list[str], groups: DataFrame, sectors: DataFrame, ranges: DataFrame, default: str = "driver") -> DataFrame:
    """One row a corner ``(key, id, number, code, labels, direction, scale, marker)``: shown name, a column for each label layer but the numbered one,
    its group of several ``(key, label, members)``, its sector, an arrow, the severity in words, apex and range as percent texts.

    All that a key has meets in windows over it, so sides that are dealt by key already are not shuffled again, and nothing is joined. Of
    sectors that overlap the one that starts first counts. Null keys and ids meet nothing."""
    own = F.struct("id", "number", "code", "labels", "direction", "scale", "marker").alias("_row")
    o = W.partitionBy(*key).orderBy("_pos", "_end")
    seen = F.greatest("_pos", F.max("_end").over(o.rowsBetween(W.unboundedPreceding, -1)))  # where no earlier sector hides it
    s = sectors.where("start < end").dropna(subset=key).select(*key, F.col("start").cast("double").alias("_pos"), F.col("end").cast("double").alias("_end"), "label")
    s = s.withColumn("_pos", seen).where("_pos < _end").select(*key, "_pos", F.struct("_end", "label").alias("_s"))
    upto = W.partitionBy(*key).orderBy("_pos", F.col("_row").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    c = corners.select(*key, F.col("marker").cast("double").alias("_pos"), F.col("id").alias("_at"), own).unionByName(s, allowMissingColumns=True)
    c = c.withColumn("_s", F.last("_s", ignorenulls=True).over(upto)).where("_row is not null").select(*key, "_at", "_row", F.when(F.col("_pos") < F.col("_s._end"), F.col("_s.label")).alias("sector"))
    span = ranges.dropna(subset=key).select(*key, F.coalesce("anchor", F.lit("")).alias("_at"), F.col("id").alias("_own"), F.concat_ws(" → ", labels.percent(F.col("start")), labels.percent(F.col("end"))).alias("range"))
    at = W.partitionBy(*key, "_at")
    j = c.unionByName(span, allowMissingColumns=True).withColumn("_known", F.bool_or(F.col("_row").isNotNull()).over(at))
    j = j.withColumn("_at", F.when(F.col("_known"), F.col("_at")).otherwise(F.col("_own"))).drop("_own", "_known").where("_row is not null or _at is not null")
    member = groups.where(F.size("members") > 1).dropna(subset=key).select(*key, F.col("label").alias("complex"), F.explode("members").alias("_at")).where("_at is not null")
    j = j.unionByName(member, allowMissingColumns=True).withColumn("complex", F.min("complex").over(at)).withColumn("_ranges", F.collect_list("range").over(at)).where("_row is not null")
    j = j.select(*key, "_row.*", "complex", "sector", F.explode_outer("_ranges").alias("range"))
    words = F.trim(F.concat_ws(" ", F.col("scale").cast("string"), labels.scale_word(F.col("scale"))))
    return j.select(*key, "number", F.coalesce("code", F.col("number").cast("string")).alias("code"), labels.resolved(F.col("labels"), default).alias("shown"), *[F.coalesce(F.try_element_at("labels", F.lit(x)), F.lit("")).alias(x) for x in layers if x != "numbered"],
                    F.coalesce("complex", F.lit("")).alias("complex"), F.coalesce("sector", F.lit("")).alias("sector"), F.when(F.col("direction") == "left", "←").when(F.col("direction") == "right", "→").otherwise("").alias("dir"), words.alias("severity"),
                    labels.percent(F.col("marker")).alias("apex"), F.coalesce("range", F.lit("—")).alias("range"))
