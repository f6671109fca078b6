"""Override documents: sparse JSON in which an absent field inherits and a null one clears, read as VARIANT so that the two stay apart.

A document maps layouts, or ``*`` for all of them, to blocks: ``corners`` holds fields by corner number, anything else holds for
the layout as a whole. What a layout's own block names, null or not, wins over the block of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lower wins.
OWN, SHARED = 0, 1


def members(rows: DataFrame, value: str, name: str, out: str) -> DataFrame:
    """``rows`` once for each member of the object in the VARIANT column ``value``: its ``name``, and what it holds as ``out``. Other values than objects
    give none."""
    tvf = rows.sparkSession.tvf
    object_ = F.when(F.expr(f"schema_of_variant({value}) like 'OBJECT<%'"), F.col(value))
    held = rows.withColumn("_object", object_).where("_object is not null")
    return held.lateralJoin(tvf.variant_explode(F.col("_object").outer())).select(*rows.columns, F.col("key").alias(name), F.col("value").alias(out))


def blocks(documents: DataFrame, layouts: DataFrame, text: str = "document") -> DataFrame:
    """``slug, layout_id, rank, block``: each layout of ``layouts(slug, layout_id)`` with its own block and that of all, where there are such. Null and
    broken documents and members that are no objects, such as comments, give nothing."""
    d = documents.select("slug", F.try_parse_json(F.col(text)).alias("_doc"))
    b = members(d, "_doc", "_layout", "block").select("slug", "_layout", "block")
    own = b.withColumnRenamed("_layout", "layout_id").join(layouts.select("slug", "layout_id"), ["slug", "layout_id"]).withColumn("rank", F.lit(OWN))
    shared = b.where("_layout = '*'").drop("_layout").join(layouts.select("slug", "layout_id"), "slug").withColumn("rank", F.lit(SHARED))
    return own.unionByName(shared).select("slug", "layout_id", "rank", "block")


def corner_overrides(blocks_: DataFrame) -> DataFrame:
    """``slug, layout_id, number, field, value``: one row a field that a block names for a corner, its VARIANT value as it stands, null included."""
    c = blocks_.withColumn("_corners", F.expr("try_variant_get(block, '$.corners', 'variant')"))
    c = members(c, "_corners", "number", "_fields").drop("block", "_corners")
    f = members(c, "_fields", "field", "value").drop("_fields")
    return f.groupBy("slug", "layout_id", "number", "field").agg(F.min_by("value", "rank").alias("value"))


def layout_overrides(blocks_: DataFrame) -> DataFrame:
    """``slug, layout_id, field, value``: what blocks name beside their corners."""
    f = members(blocks_, "block", "field", "value").where("field <> 'corners'")
    return f.groupBy("slug", "layout_id", "field").agg(F.min_by("value", "rank").alias("value"))


def field_map(overrides: DataFrame) -> DataFrame:
    """``slug, layout_id, number, fields``: a map with a VARIANT for each field named; a field that is null in JSON holds a null VARIANT."""
    pair = F.struct("field", "value")
    return overrides.groupBy("slug", "layout_id", "number").agg(F.map_from_entries(F.collect_list(pair)).alias("fields"))


def overridden(own: Column, fields: Column, name: str, kind: str) -> Column:
    """A field's value under a map of overrides: its own where the map does not name it, null where it names it null (or as no ``kind``)."""
    value = F.try_element_at(fields, F.lit(name))
    return F.when(F.coalesce(F.map_contains_key(fields, name), F.lit(False)), F.try_variant_get(value, "$", kind)).otherwise(own)


def texts(fields: Column, names: list[str]) -> Column:
    """The fields of these names as a map of texts, for ``merge.named_layers``: a named null stays in it as null."""
    kept = F.map_filter(F.coalesce(fields, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))), lambda k, v: F.array_contains(F.array(*map(F.lit, names)), k))
    return F.transform_values(kept, lambda k, v: F.try_variant_get(v, "$", "string"))
