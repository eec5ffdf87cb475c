"""Tables written between steps, so that a plan ends there and its rows stay as they are."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders and tables of this driver process, by application.
_made: dict[str, list[str]] = {}
_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; without one, on a local
    master only, a temporary folder that goes when the process ends."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "folder" not in _local:
        _local["folder"] = tempfile.mkdtemp(prefix="vireo-")
        atexit.register(shutil.rmtree, _local["folder"], ignore_errors=True)
    return "file://" + _local["folder"]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses, for a table of this application."""
    path = f"{shared_folder(spark)}/vireo/{uuid.uuid4().hex}-{name}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settled(df: DataFrame, name: str) -> DataFrame:
    """`df`, written to the shared folder and read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Remove the tables that this application has settled; call it once results have been consumed."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
