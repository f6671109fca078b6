"""The data source of track folders: tables, missing parts, filters on the folder, and the writer's commit."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ringlake.sources import track_folders


@pytest.fixture
def tracks(spark, tmp_path):
    track_folders.register(spark)
    docs = {
        "one": {"slug": "one", "layouts": [{"id": "gp", "name": "GP", "length_m": 5000, "direction": "clockwise", "geometry": {"centerline": "raw/gp.geojson"}, "point_layers": [{"id": "corners", "items": [{"id": "t1", "number": 1, "marker": 0, "location": [1, 2.5], "labels": {"numbered": "Turn 1", "bad": None}}, {}]}],
                                       "range_layers": [{"id": "groups", "items": [{"id": "g", "start": 0.1, "end": 0.2, "members": ["t1"]}]}]}, {"id": "club"}]},
        "empty": {},
    }
    for slug, d in docs.items():
        os.makedirs(tmp_path / slug / "raw")
        (tmp_path / slug / "track.json").write_text(json.dumps(d))
    shape = {"type": "FeatureCollection", "features": [{"properties": {"role": "corner"}, "geometry": {"type": "Point", "coordinates": [0, 0]}}, {"geometry": {"type": "LineString", "coordinates": [[9, 9], [8, 8]]}}, {"properties": {"role": "outline"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [1, 0], [1, 1], [0, 0]]}}]}
    (tmp_path / "one" / "raw" / "gp.geojson").write_text(json.dumps(shape))
    os.makedirs(tmp_path / "no_document")
    return str(tmp_path)


def read(spark, path, table):
    return spark.read.format("track_folders").option("table", table).load(path)


def test_tables(spark, tracks):
    assert [(r.slug, r.layout_id, r.length_m) for r in read(spark, tracks, "layouts").orderBy("layout_id").collect()] == [("one", "club", None), ("one", "gp", 5000.0)]
    items = {(r.kind, r.i): r for r in read(spark, tracks, "items").collect()}
    assert len(items) == 3 and (items["point", 0].marker, items["point", 0].lon, items["point", 0].lat, items["point", 0].labels) == (0.0, 1.0, 2.5, {"numbered": "Turn 1"})
    assert items["point", 1].id is None and items["range", 0].members == ["t1"] and items["range", 0].end == 0.2
    assert [(r.seq, r.lon, r.lat) for r in read(spark, tracks, "vertices").orderBy("seq").collect()] == [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 1.0, 1.0)]
    assert {r.slug for r in read(spark, tracks, "documents").collect()} == {"one", "empty"}
    with pytest.raises(Exception, match="no table"):
        read(spark, tracks, "other").collect()


def test_a_filter_on_the_slug_opens_no_other_folder(spark, tracks):
    os.makedirs(os.path.join(tracks, "broken"))
    with open(os.path.join(tracks, "broken", "track.json"), "w") as f:
        f.write("{")
    assert read(spark, tracks, "layouts").where("slug = 'one'").count() == 2
    assert read(spark, tracks, "layouts").where(F.col("slug").isin("empty", "absent")).count() == 0


def test_written_files_come_back_and_failures_leave_nothing(spark, tmp_path):
    track_folders.register(spark)
    path = str(tmp_path / "out")
    rows = spark.range(40).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"), F.lit("track.json").alias("file"), F.to_json(F.struct(F.array(F.struct(F.col("id").cast("string").alias("id"))).alias("layouts"))).alias("content"))
    rows.repartition(5).write.format("track_folders").mode("append").save(path)
    assert {(r.slug, r.layout_id) for r in read(spark, path, "layouts").collect()} == {(f"s{i}", str(i)) for i in range(40)}
    assert not [x for x in os.listdir(path) if x.startswith("_")]
    bad = rows.withColumn("slug", F.when(F.col("slug") == "s7", "../x").otherwise(F.concat(F.lit("n"), "slug")))
    with pytest.raises(Exception, match="no place"):
        bad.repartition(5).write.format("track_folders").mode("append").save(path)
    assert sorted(x for x in os.listdir(path) if not x.startswith("_")) == sorted(f"s{i}" for i in range(40))  # a task that outlives the abort may leave a hidden folder
    assert read(spark, str(tmp_path / "nowhere"), "items").count() == 0


def test_many_tracks_go_to_few_tasks(spark, tmp_path):
    track_folders.register(spark)
    for i in range(130):
        os.makedirs(tmp_path / f"s{i}")
        (tmp_path / f"s{i}" / "track.json").write_text('{"layouts": [{"id": "a"}]}')
    assert len(track_folders.Reader(str(tmp_path), "layouts", "track.json").partitions()) == 3
    assert read(spark, str(tmp_path), "layouts").count() == 130
