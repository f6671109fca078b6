"""Session defaults for linear-referencing work."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and skew handling on, and a fixed time zone."""
    b = SparkSession.builder.appName("ringlake")
    if master:
        b = b.master(master)
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false"}
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the folder of ``spark.checkpoint.dir`` and read again: what several parts of a plan need is computed once, and lost
    executors do not bring it back. Only where the session names no folder (tests) is it one of this machine."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = tempfile.mkdtemp(prefix="ringlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, key: list[str], each: int = 200_000, times: float = 1.0) -> DataFrame:
    """``rows`` dealt by ``key`` to parts of about ``each`` rows, each row counted ``times``: a number that adaptive execution keeps, so what a task
    holds does not grow with the table. Windows and aggregates by a key that starts with ``key`` need no further shuffle."""
    return rows.repartition(max(1, math.ceil(rows.count() * times / each)), *key)
