"""Incremental runs: what has arrived since the last run, taken once.

A stream over the staging folder with trigger availableNow hands each batch to
the same functions as a full run; the checkpoint remembers what was taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def run_available(spark: SparkSession, source: str, schema: StructType, checkpoint: str, each: Callable[[DataFrame, int], None]):
    """Process all new files of `source` and stop; gives the finished query."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def sessions(df: DataFrame, keys: list[str], at: str, gap: str, late: str | None = None) -> DataFrame:
    """Sessions of rows no further apart than `gap`; a stream needs `late` as its watermark."""
    if late:
        df = df.withWatermark(at, late)
    return df.groupBy(*keys, F.session_window(at, gap).alias("session")).agg(F.count("*").alias("n")).select(*keys, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")
