"""Readers and writers of circuit documents: JSON, JSON Lines, GeoJSON, XML settings and text tables.

Schemas are explicit, never inferred. Readers take any path or glob that Spark reads.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Document schemas.
SOURCE = """slug string, name string, aka array<string>, country string, series array<string>, wikidata string, external_ids map<string,string>,
location struct<lat:double,lon:double,locality:string,region:string,timezone:string>, osm struct<bbox:array<double>,relation:bigint>, lovely map<string,string>,
layouts array<struct<id:string,name:string,aka:array<string>,length_m:double,direction:string,active_years:string,lovely:string,series:array<string>,pit:struct<entry:double,exit:double>,start_finish:struct<marker:double,location:array<double>>,slow_zones:array<struct<id:string,name:string,start:double,end:double>>>>"""
LAP = """name string, trackId string, country string, length bigint, year bigint, pitentry double, pitexit double,
turn array<struct<number:int,name:string,start:double,marker:double,end:double,direction:int,scale:int>>, straight array<struct<name:string,start:double,marker:double,end:double>>,
sector array<struct<name:string,number:int,marker:double>>"""
WAYS = "elements array<struct<type:string,id:bigint,tags:map<string,string>,nodes:array<bigint>,geometry:array<struct<lat:double,lon:double>>>>"
RELATION = "elements array<struct<type:string,id:bigint,tags:map<string,string>,members:array<struct<type:string,ref:bigint,role:string,geometry:array<struct<lat:double,lon:double>>>>>>"
POINT = "struct<id:string,label:string,marker:double,location:array<double>,location_source:string,labels:map<string,string>,number:int,code:string,direction:string,scale:int>"
RANGE = "struct<id:string,label:string,start:double,end:double,labels:map<string,string>,anchor:string,members:array<string>,entry_ref:string,exit_ref:string,length_m:double,points:array<struct<id:string,role:string,label:string,marker:double,location:array<double>,point_ref:string>>>"
TRACK = f"""slug string, name string, aka array<string>, country string, series array<string>, wikidata string, location struct<lat:double,lon:double,locality:string,region:string,timezone:string>,
external_ids map<string,string>, label_layers map<string,struct<label:string,description:string>>,
layouts array<struct<id:string,name:string,aka:array<string>,series:array<string>,length_m:double,direction:string,active_years:string,label_default:string,geometry:struct<centerline:string,crs:string>,
point_layers:array<struct<id:string,kind:string,label:string,description:string,series:array<string>,items:array<{POINT}>>>,
range_layers:array<struct<id:string,kind:string,label:string,description:string,series:array<string>,coverage:string,generated:boolean,items:array<{RANGE}>>>>>"""


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row a JSON document with its ``path`` and the ``slug`` of its folder under ``tracks``."""
    d = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("path", F.input_file_name())
    return d if "slug" in d.columns else d.withColumn("slug", F.regexp_extract("path", "/tracks/([^/]+)/", 1))


def json_lines(spark: SparkSession, path: str, schema: str = TRACK) -> DataFrame:
    return spark.read.schema(schema).json(path)


def turns(laps: DataFrame) -> DataFrame:
    """Corners of lap documents: number (their place where omitted), direction word, marker (the cyclic midpoint of start
    and end where missing), and a label map of numbered and driver layers."""
    from ringlake.functions import cyclic, labels

    t = laps.select("slug", F.posexplode("turn").alias("pos", "t"))
    n = F.coalesce(F.col("t.number"), F.col("pos") + 1)
    names = F.when(F.coalesce(F.col("t.name"), F.lit("")) != "", F.create_map(F.lit("numbered"), labels.numbered(n), F.lit("driver"), F.col("t.name"))).otherwise(F.create_map(F.lit("numbered"), labels.numbered(n)))
    marker = F.coalesce(F.col("t.marker"), F.round(cyclic.midpoint(F.col("t.start"), F.col("t.end")), 6))
    return t.select("slug", n.alias("number"), n.cast("string").alias("code"), names.alias("labels"), labels.direction_word(F.col("t.direction")).alias("direction"), F.col("t.scale").alias("scale"), marker.alias("marker"), F.col("t.start").alias("start"), F.col("t.end").alias("end"))


def pit_markers(laps: DataFrame, layouts: DataFrame) -> DataFrame:
    """Pit entry and exit; a layout's own pit object replaces both."""
    j = layouts.join(laps.select("slug", "pitentry", "pitexit"), "slug", "left")
    return j.select("slug", "id", F.when(F.col("pit").isNotNull(), F.col("pit.entry")).otherwise(F.col("pitentry")).alias("entry"), F.when(F.col("pit").isNotNull(), F.col("pit.exit")).otherwise(F.col("pitexit")).alias("exit"))


def outline(spark: SparkSession, path: str) -> DataFrame:
    """Vertices of GeoJSON outlines: a bare LineString, else the feature with role outline, else the first LineString; the
    closing point is dropped, and lines of under four points are left out."""
    shape = "struct<type:string,coordinates:array<array<double>>>"
    d = spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value"))
    head = F.from_json("value", "type string, coordinates array<array<double>>")
    # geometries other than lines have other nestings, so each feature is read twice
    feats = F.from_json("value", "features array<struct<properties:struct<role:string>,geometry:string>>")["features"]
    lines = F.filter(F.transform(feats, lambda f: F.struct(F.coalesce(f["properties"]["role"], F.lit("")).alias("role"), F.from_json(f["geometry"], shape[7:-1].replace(":", " ", 1).replace(",coordinates:", ", coordinates ")).alias("g"))), lambda f: f["g"]["type"] == "LineString")
    role = F.filter(lines, lambda f: f["role"] == "outline")
    c = F.coalesce(F.when(head["type"] == "LineString", head["coordinates"]), F.try_element_at(role, F.lit(1))["g"]["coordinates"], F.try_element_at(lines, F.lit(1))["g"]["coordinates"])
    c = F.when((F.size(c) > 1) & (F.element_at(c, 1) == F.element_at(c, -1)), F.slice(c, 1, F.size(c) - 1)).otherwise(c)
    return d.select("path", c.alias("c")).where(F.size("c") >= 4).select("path", F.posexplode("c").alias("i", "p")).select(F.col("path").alias("ring"), (F.col("i") + 1).alias("seq"), F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))


def xml_setting(document: Column, name: str) -> Column:
    """Value beside a key in an XML settings document."""
    return F.xpath_string(document, F.lit(f"//*[Key='{name}']/Value"))


def parsed_segments(text: Column) -> Column:
    """``name,entry,exit;...`` or ``entry,exit;...`` to ``array<struct<name, entry, exit>>``; another arity is an error."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda s: F.trim(s)), lambda s: s != "")

    def one(s: Column, i: Column) -> Column:
        f = F.transform(F.split(s, ","), lambda x: F.trim(x))
        n = F.size(f)
        bad = F.raise_error(F.concat(F.lit("segment needs two or three fields: "), s))
        return F.when(n == 3, F.struct(f[0].alias("name"), f[1].cast("double").alias("entry"), f[2].cast("double").alias("exit"))).when(n == 2, F.struct(F.concat(F.lit("seg"), (i + 1).cast("string")).alias("name"), f[0].cast("double").alias("entry"), f[1].cast("double").alias("exit"))).otherwise(bad)

    return F.transform(parts, one)


def length_column(text: Column, count: int, title: str = "Length (Inches)") -> Column:
    """Metres of the first ``count`` lines of three digits or more after a column title in extracted text."""
    tail = F.substring_index(text, title, -1)
    found = F.regexp_extract_all(tail, F.lit(r"(?m)^\s*([0-9][0-9,]{2,})\s*$"), F.lit(1))
    return F.when(F.contains(text, F.lit(title)), F.transform(F.slice(found, 1, count), lambda x: F.replace(x, F.lit(","), F.lit("")).cast("double") * 0.0254))


def compact_json(row: Column) -> Column:
    return F.to_json(row)


def write_json_lines(tracks: DataFrame, path: str, order: str = "slug") -> None:
    """One compact document a line, in global order over the part files."""
    tracks.orderBy(order).write.mode("overwrite").json(path)


def index_rows(tracks: DataFrame) -> DataFrame:
    """Catalogue entries: identity, place, layouts with their corner counts and poster paths."""
    corners = lambda l: F.coalesce(F.aggregate(F.filter(l["point_layers"], lambda p: p["id"] == "corners"), F.lit(0), lambda acc, p: acc + F.coalesce(F.size(p["items"]), F.lit(0))), F.lit(0))
    return tracks.select("slug", "name", "country", "series", "location", F.transform("layouts", lambda l: F.struct(l["id"].alias("id"), l["name"].alias("name"), l["length_m"].alias("length_m"), corners(l).alias("corners"), F.concat(F.lit("posters/"), F.col("slug"), F.lit("_"), l["id"], F.lit(".png")).alias("poster"))).alias("layouts"))


def geojson(lines: DataFrame, points: DataFrame, key: list[str]) -> DataFrame:
    """``json`` of one FeatureCollection a key from ``lines(key, seq, lon, lat)`` and ``points(key, role, id, label, lon, lat)``."""
    line = lines.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "lon", "lat"))), lambda p: F.array(p["lon"], p["lat"])).alias("c"))
    feature = lambda kind, c, props: F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit(kind).alias("type"), c.alias("coordinates")).alias("geometry")))
    line = line.select(*key, feature("LineString", F.col("c"), F.struct(F.lit("outline").alias("role"))).alias("line"))
    dots = points.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("role", "id", feature("Point", F.array("lon", "lat"), F.struct("role", "id", "label")).alias("f")))), lambda x: x["f"]).alias("dots"))
    all_ = F.concat(F.array("line"), F.coalesce("dots", F.array().cast("array<string>")))
    return line.join(dots, key, "left").select(*key, F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.filter(all_, lambda x: x.isNotNull()), ","), F.lit("]}")).alias("json"))


def json_schema(kind: T.DataType) -> dict:
    """JSON Schema of a Spark type."""
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind}, "required": [f.name for f in kind if not f.nullable], "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": json_schema(kind.valueType)}
    if isinstance(kind, T.BooleanType):
        return {"type": "boolean"}
    if isinstance(kind, T.IntegralType):
        return {"type": "integer"}
    return {"type": "number"} if isinstance(kind, T.NumericType) else {"type": "string"}


def write_json_schema(kind: T.DataType, path: str) -> None:
    with open(path, "w") as f:
        json.dump({"$schema": "https://json-schema.org/draft/2020-12/schema", **json_schema(kind)}, f, indent=2, sort_keys=True)


def bbox_query(south: float, west: float, north: float, east: float, timeout: int = 180) -> str:
    """Text that asks a map server for the raceways in a box, with their geometry."""
    return f'[out:json][timeout:{timeout}];(way["highway"="raceway"]({south},{west},{north},{east}););out geom;'


def relation_query(relation: int, timeout: int = 120) -> str:
    """Text that asks for one relation with its members' geometry."""
    return f"[out:json][timeout:{timeout}];relation({int(relation)});out geom;"


def slugs(spark: SparkSession, folder: str, file: str = "source.json") -> DataFrame:
    """``slug`` of every track folder that holds ``file``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", file.rsplit("/", 1)[-1]).load(folder).select("path")
    return found.select(F.regexp_extract("path", rf"/([^/]+)/{file}$", 1).alias("slug")).where("slug <> ''").distinct()


def imported(sources: DataFrame, fetched: DataFrame) -> DataFrame:
    """What an import of ``sources`` still lacks: ``(slug, kind, key)`` of every source that a track names and ``fetched(slug, kind, key)`` has not."""
    laps = sources.select("slug", F.explode("layouts").alias("l")).select("slug", F.lit("lap").alias("kind"), F.col("l.lovely").alias("key"))
    rel = sources.select("slug", F.lit("relation").alias("kind"), F.col("osm.relation").cast("string").alias("key"))
    box = sources.where(F.col("osm.bbox").isNotNull()).select("slug", F.lit("ways").alias("kind"), F.lit("bbox").alias("key"))
    need = laps.union(rel).union(box).where("key is not null").distinct()
    return need.join(fetched, ["slug", "kind", "key"], "left_anti")


def unfenced(answer: Column) -> Column:
    """A JSON answer without the code fence around it, if it has one."""
    return F.regexp_replace(F.regexp_replace(answer, r"\A```[^\n]*\n?", ""), r"\n?[^\n]*```\z", "")


def generated_at() -> Column:
    """Now, in UTC, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
