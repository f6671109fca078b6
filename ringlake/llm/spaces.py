"""Shared Spark plumbing of the training-data operators: tables, staging, row keys, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only where the session sets none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = tempfile.mkdtemp(prefix="ringlake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def widths(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of one's own that no column of ``df`` has, whatever its case."""
    used, out = {c.lower() for c in df.columns}, []
    for w in wanted:
        name = f"_{w}"
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(src, dst)`` as ``(node, root)``, root the least node.

    Alternating large-star and small-star rounds; every round is a partial-aggregated minimum and a join
    on the node, so no task holds a component. Stops when a round changes nothing; raises if it never does.
    Nodes without an edge to another node are not returned.
    """
    E = staged(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        both = E.union(E.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = large.where("u <> v").distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        E = staged(small.where("u <> v").distinct(), "cc")
        seen = E.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return E.select(F.col("u").alias("node"), F.col("v").alias("root")).union(E.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = seen
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
