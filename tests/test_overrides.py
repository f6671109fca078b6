"""Override documents: null and absence, both blocks, comments and broken documents."""

from ringlake.operators import merge
from ringlake.sources import override_documents as o

from pyspark.sql import functions as F

DOCS = [
    ("a", '{"_comment": "text", "*": {"corners": {"1": {"driver": "All", "marker": 0.25, "match_osm": false}, "3": {}}, "replace_corners": [{"number": 1}]}, "gp": {"corners": {"1": {"driver": null}, "2": {"official": ""}}, "replace_corners": null}, "bad": 7}'),
    ("b", "{broken"), ("c", None), ("d", "[]"), ("e", '{"gp": {"corners": null}}'),
]


def test_blocks_and_fields(spark):
    docs = spark.createDataFrame(DOCS, "slug string, document string")
    layouts = spark.createDataFrame([(s, x) for s, _ in DOCS for x in ("gp", "club")], "slug string, layout_id string")
    b = o.blocks(docs, layouts)
    assert {(r.slug, r.layout_id, r["rank"]) for r in b.collect()} == {("a", "gp", 0), ("a", "gp", 1), ("a", "club", 1), ("e", "gp", 0)}
    f = {(r.layout_id, r.number, r.field): r.value.toJson() for r in o.corner_overrides(b).collect()}
    assert f == {("gp", "1", "driver"): "null", ("gp", "1", "marker"): "0.25", ("gp", "1", "match_osm"): "false", ("gp", "2", "official"): '""', ("club", "1", "driver"): '"All"', ("club", "1", "marker"): "0.25", ("club", "1", "match_osm"): "false"}
    whole = {(r.slug, r.layout_id, r.field): r.value.toJson() for r in o.layout_overrides(b).collect()}
    assert whole == {("a", "gp", "replace_corners"): "null", ("a", "club", "replace_corners"): '[{"number":1}]'}


def test_fields_on_corners(spark):
    docs = spark.createDataFrame(DOCS, "slug string, document string")
    layouts = spark.createDataFrame([("a", "gp"), ("a", "club")], "slug string, layout_id string")
    m = o.field_map(o.corner_overrides(o.blocks(docs, layouts)))
    own = spark.createDataFrame([("a", x, n, "Own", 0.5) for x in ("gp", "club") for n in ("1", "2", "9")], "slug string, layout_id string, number string, driver string, marker double")
    j = own.join(m, ["slug", "layout_id", "number"], "left")
    names = merge.named_layers(F.create_map(F.lit("driver"), "driver", F.lit("official"), F.lit("Off")), o.texts(F.col("fields"), ["driver", "official"]), F.col("number"))
    got = {(r.layout_id, r.number): (r.d, r.m, r.names) for r in j.select("layout_id", "number", o.overridden(F.col("driver"), F.col("fields"), "driver", "string").alias("d"), o.overridden(F.col("marker"), F.col("fields"), "marker", "double").alias("m"), names.alias("names")).collect()}
    assert got["gp", "1"][:2] == (None, 0.25) and got["club", "1"][:2] == ("All", 0.25) and got["gp", "2"][:2] == ("Own", 0.5) and got["gp", "9"][:2] == ("Own", 0.5)
    assert "driver" not in got["gp", "1"][2] and got["club", "1"][2]["driver"] == "All" and "official" not in got["gp", "2"][2] and got["gp", "9"][2]["official"] == "Off"
