"""Shared folders, written intermediate tables and connected components."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only where the setting is absent and the master is local, a temporary
    folder of this machine takes its place.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not process_cache().get("folder"):
        process_cache()["folder"] = "file://" + tempfile.mkdtemp(prefix="vireo-")
        spark.sparkContext.setCheckpointDir(process_cache()["folder"])
    return process_cache()["folder"]


def process_cache() -> dict:
    """A dictionary that lives as long as this Python process, on driver or worker."""
    return sys.__dict__.setdefault("_vireo_process_cache", {})


def only_memory(kind: str, make):
    """This process's memory of one kind (words, an encoder); another kind's is
    given up first, so that one worker never holds two."""
    kept = process_cache()
    if kept.get("kind") != kind:
        if kept.pop("memory", None) is not None:
            given_back()
        kept["kind"], kept["memory"] = kind, make()
    return kept["memory"]


def given_back() -> None:
    """Return this process's free memory to the system, where its allocators can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Rows that a batch handed to Python holds at most while a table is written: texts are long.
BATCH_ROWS = 1000


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vireo/{uuid.uuid4().hex}-{name}"
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(BATCH_ROWS, int(before) if int(before) > 0 else BATCH_ROWS)))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Remove what settle() has left; call it once results have been consumed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/vireo")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the undirected `edges` (u, v).

    Large-star and small-star rounds alternate until every node has one edge,
    to a node that has none to a smaller one; a component is its smallest
    node. Each round is written to the shared folder. Neighbourhood minima are
    combined map-side and joined back, so no task ever holds the neighbours of
    one node.
    """
    now = edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = settle(now, "edges")
    while not is_stars(now):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = settle(small.distinct(), "small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def is_stars(edges: DataFrame) -> bool:
    """Whether every u of the edges (u, v) has one v, and no v is a u."""
    if not edges.groupBy("u").count().where("count > 1").isEmpty():
        return False
    return edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()
