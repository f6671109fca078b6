"""Overlays of sparse documents: overrides by layer, upserts by id, label registries and edit patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlake.functions import labels


def overrides(shared: DataFrame, specific: DataFrame, key: list[str], fields: str = "fields") -> DataFrame:
    """Union of both override tables by key; a field of the specific row wins, also where it holds null.

    ``fields`` is a map from field to value: an absent key inherits, a null value clears.
    """
    a, b = shared.select(*key, F.col(fields).alias("_a")), specific.select(*key, F.col(fields).alias("_b"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    both = a.join(b, key, "full_outer").withColumn("_a", F.coalesce("_a", empty)).withColumn("_b", F.coalesce("_b", empty))
    own = F.map_zip_with("_a", "_b", lambda k, x, y: F.when(F.array_contains(F.map_keys("_b"), k), y).otherwise(x))
    return both.select(*key, own.alias(fields))


def named_layers(names: Column, fields: Column, code: Column) -> Column:
    """Label layers of a corner under its override: null or '' deletes a layer, the numbered label follows the code, overlays
    that repeat it go, and the driver layer defaults to the official one unless it was cleared."""
    held = F.map_keys(fields)
    known = F.map_filter(fields, lambda k, v: F.array_contains(F.array(*[F.lit(x) for x in labels.OVERLAYS]), k))
    own = labels.overlaid_maps(names, known)
    number = labels.numbered(code)
    own = F.map_filter(own, lambda k, v: (k != "numbered") & (v != number))
    cleared = F.array_contains(held, "driver") & (F.coalesce(F.try_element_at(fields, F.lit("driver")), F.lit("")) == "")
    official = F.try_element_at(own, F.lit("official"))
    take = F.try_element_at(own, F.lit("driver")).isNull() & F.coalesce(official != "", F.lit(False)) & ~cleared
    extra = F.when(take, F.map_from_arrays(F.array(F.lit("driver")), F.array(official))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return labels.merged_maps(labels.merged_maps(own, extra), F.map_from_arrays(F.array(F.lit("numbered")), F.array(number)))


def upsert(old: DataFrame, new: DataFrame, key: list[str], id_col: str, order: str, payload: list[str]) -> DataFrame:
    """New rows replace old ones of the same id in place, others come after the last."""
    o = old.select(*key, id_col, F.col(order).alias("_o"), F.struct(*payload).alias("_p"))
    n = new.select(*key, id_col, F.col(order).alias("_o2"), F.struct(*payload).alias("_q"))
    most = old.groupBy(*key).agg(F.max(order).alias("_m"))
    j = o.join(n, [*key, id_col], "full_outer").join(most, key, "left")
    place = F.coalesce(F.col("_o"), F.coalesce("_m", F.lit(0)) + F.col("_o2"))
    return j.select(*key, id_col, place.alias(order), F.coalesce("_q", "_p").alias("_r"), F.col("_q").isNotNull().alias("replaced")).select(*key, id_col, order, "_r.*", "replaced")


def registry(items: DataFrame, key: list[str], label_map: str) -> DataFrame:
    """Label layers in use with ``numbered`` and ``official`` always among them, in display order."""
    codes = items.select(*key, F.explode(F.concat(F.map_keys(label_map), F.array(F.lit("numbered"), F.lit("official")))).alias("code")).distinct()
    return codes.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(labels.layer_rank(F.col("code")))), lambda x: x["code"]).alias("layers"))


def default_layer(items: DataFrame, key: list[str], label_map: str, preferred: Column) -> DataFrame:
    """The preferred layer if any item has it, else driver, official, numbered."""
    used = items.groupBy(*key).agg(F.collect_set("_c").alias("_u")) if "_c" in items.columns else items.withColumn("_c", F.explode(F.map_keys(label_map))).groupBy(*key).agg(F.array_distinct(F.collect_set("_c")).alias("_u"), F.max(preferred).alias("_p"))
    have = lambda c: F.array_contains("_u", c)
    return used.select(*key, F.when(have(F.col("_p")), F.col("_p")).when(have(F.lit("driver")), "driver").when(have(F.lit("official")), "official").otherwise("numbered").alias("label_default"))


def patch(old: Column, new: Column) -> Column:
    """Map of the changed fields only; a field that was emptied holds null."""
    both = F.map_zip_with(old, new, lambda k, a, b: F.struct((~F.coalesce(a, F.lit("")).eqNullSafe(F.coalesce(b, F.lit("")))).alias("changed"), F.nullif(b, F.lit("")).alias("to")))
    return F.transform_values(F.map_filter(both, lambda k, v: v["changed"]), lambda k, v: v["to"])
