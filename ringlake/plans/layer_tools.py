"""Registry of layer tools: named functions from a layout's vertices and parameters to a layer's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringlake.operators.merge import upsert

Tool = Callable[..., DataFrame]
TOOLS: dict[str, Tool] = {}


def tool(name: str) -> Callable[[Tool], Tool]:
    def put(f: Tool) -> Tool:
        if name in TOOLS:
            raise ValueError(f"layer tool {name} exists")
        TOOLS[name] = f
        return f

    return put


def run(name: str, *rows: DataFrame, **params) -> DataFrame:
    if name not in TOOLS:
        raise KeyError(f"no layer tool {name}; known: {', '.join(sorted(TOOLS))}")
    return TOOLS[name](*rows, **params)


@tool("curvature_apexes")
def curvature_apexes(vertices: DataFrame, **params) -> DataFrame:
    from ringlake.operators.signal import corner_layers

    return corner_layers(vertices, **params)


@tool("length_partition")
def length_partition(rows: DataFrame, key: list[str], order: list[str], length: str) -> DataFrame:
    from ringlake.operators.intervals import cumulative_partition

    return cumulative_partition(rows, key, order, length)


@tool("xml_segments")
def xml_segments(documents: DataFrame, column: str = "value", setting: str = "Micro Sectors") -> DataFrame:
    from pyspark.sql import functions as F

    from ringlake.sources.documents import parsed_segments, xml_setting

    return documents.select("*", F.inline(parsed_segments(xml_setting(F.col(column), setting))))


# ---- configs -----------------------------------------------------------------------------------------------------


def enabled(configs: DataFrame) -> DataFrame:
    """Configs that are not switched off."""
    return configs.where(F.coalesce("enabled", F.lit(True)))


def resource_file(name: Column, filename: Column, url: Column, path: Column) -> Column:
    """The file a resource is kept under: its given name, else the last part of its address if that has a dot, else its own name; letters, digits,
    dots, lines and dashes only."""
    safe = lambda c: F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.trim(c), r"[^\p{L}\p{N}._-]", "-"), r"^[.-]+|[.-]+$", ""), F.lit("")), F.lit("resource"))
    address = F.regexp_replace(F.coalesce(url, path, name), r"[?#].*$", "")
    base = F.url_decode(F.replace(F.regexp_extract(address, r"([^/]*)/?$", 1), F.lit("+"), F.lit("%2B")))
    return safe(F.when(F.coalesce(filename, F.lit("")) != "", filename).when(F.contains(base, F.lit(".")), base).otherwise(name))


def with_meta(segments: DataFrame, meta: DataFrame, key: list[str]) -> DataFrame:
    """Segments ``(key, i, id, label, start, end)`` with the label, names and bounds that ``meta(key, id, label, official, driver, start, end)`` gives them
    by id whatever its case; bounds of their own come first, and the first starts at 0, the last ends at 1. A segment without bounds is an error."""
    from pyspark.sql import Window as W

    m = meta.select(*key, F.lower("id").alias("id"), F.struct("label", "official", "driver", "start", "end").alias("_m"))
    j = segments.join(m, [*key, "id"], "left")
    by = W.partitionBy(*key)
    lost = F.raise_error(F.concat(F.lit("no bounds for segment "), F.col("id"))).cast("double")
    ends = [F.when(at, fixed).otherwise(F.coalesce(c, f"_m.{c}", lost)).alias(c) for c, at, fixed in (("start", F.col("i") == F.min("i").over(by), 0.0), ("end", F.col("i") == F.max("i").over(by), 1.0))]
    names = F.map_filter(F.create_map(F.lit("official"), F.col("_m.official"), F.lit("driver"), F.col("_m.driver")), lambda k, v: F.coalesce(v, F.lit("")) != "")
    return j.select(*key, "i", "id", F.coalesce(F.nullif("_m.label", F.lit("")), "label").alias("label"), names.alias("labels"), *ends)


def run_config(layers: DataFrame, config: dict, inputs: dict[str, DataFrame], folder: str) -> DataFrame:
    """Runs a config's tool, keeps what it makes as a table under ``folder``, and merges the layer from there into ``layers(slug, layout_id, layer_id, i,
    items)`` by its id: in place, or after the last. ``config``: ``slug, layout, layer_id, tool``, and optionally ``id, params``, with ``inputs`` for the tool."""
    name = config.get("id") or config["tool"]
    made = run(config["tool"], *inputs.values(), **config.get("params", {}))
    path = f"{folder.rstrip('/')}/generated-layers/{''.join(c if c.isalnum() or c in '._-' else '-' for c in name)}"
    items = made.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*made.columns)))).alias("items"))
    items.select(*[F.lit(config[k]).alias(to) for k, to in (("slug", "slug"), ("layout", "layout_id"), ("layer_id", "layer_id"))], F.lit(1).alias("i"), "items").write.mode("overwrite").parquet(path)
    kept = layers.sparkSession.read.parquet(path)
    return upsert(layers, kept, ["slug", "layout_id"], "layer_id", "i", ["items"]).drop("replaced")
