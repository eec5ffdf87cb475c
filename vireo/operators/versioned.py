"""Keyed parquet tables of which a load rewrites only the buckets that it touches.

A key's hash names its bucket. A load reads the buckets of its rows, joins them
with these, and writes each anew as a folder of its own beside the old one; a
row a bucket in the log, written last and at once, makes them the current ones.
A load that stops before has changed nothing, and any earlier version can still
be read. One load at a time may write a table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vireo.operators.lineage import settled
from vireo.operators.upsert import STATUS, upsert

LOG = "version long, bucket int, part string, new_rows long, updated_rows long, kept_rows long"
#: The current folder of each bucket is broadcast: some 60 bytes each, so 6 MB at most.
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class Bucketed:
    """A table at `path`. `by` (default: all keys) are the key columns whose hash is the bucket: rows equal in
    them are rewritten together. `buckets` stays as it is for the table's life; a bucket of many rows is
    written by several tasks."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    by: tuple[str, ...] = ()
    buckets: int = 256

    def create(self, spark: SparkSession) -> Bucketed:
        """Begin the table, empty; an error if there is one."""
        if not 0 < self.buckets <= MOST_BUCKETS:
            raise ValueError(f"buckets must be 1 to {MOST_BUCKETS}")
        if not set(self.by) <= set(self.keys):
            raise ValueError("the columns that name the bucket must be keys")
        spark.createDataFrame([], LOG).write.parquet(f"{self.path}/log")
        return self

    def bucket(self) -> Column:
        """The bucket of a row with the table's types; nulls hash alike."""
        return F.pmod(F.xxhash64(*(self.by or self.keys)), F.lit(self.buckets)).cast("int")

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LOG).parquet(f"{self.path}/log")

    def version(self, spark: SparkSession) -> int:
        """The number of the last load that was completed; 0 before the first."""
        return self.log(spark).agg(F.max("version")).first()[0] or 0

    def parts(self, spark: SparkSession, version: int) -> DataFrame:
        """bucket and part: the folder that held each bucket as of a version."""
        upto = self.log(spark).where(F.col("version") <= version)
        return upto.groupBy("bucket").agg(F.max_by("part", "version").alias("part"))

    def read(self, spark: SparkSession, version: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """The rows now or as of a version; of the buckets listed in `touched` (column bucket) only, if given.

        Folders of other versions and buckets are pruned while the scan runs.
        """
        version = self.version(spark) if version is None else version
        if version == 0:
            return spark.createDataFrame([], self.schema)
        parts = self.parts(spark, version)
        if touched is not None:
            parts = parts.join(F.broadcast(touched.select("bucket").distinct()), "bucket", "left_semi")
        data = spark.read.schema(StructType([*self.schema.fields, StructField("__part", StringType())])).parquet(f"{self.path}/data")
        return data.join(F.broadcast(parts.select(F.col("part").alias("__part"))), "__part", "left_semi").select(*self.schema.names)

    def typed(self, new: DataFrame) -> DataFrame:
        """The table's columns that `new` has, in the table's types."""
        return new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema if f.name in new.columns])

    def replace(self, touched: DataFrame, rows: DataFrame, status: str | None = None) -> int:
        """Let the buckets listed in `touched` hold `rows` (which must fall into them) and no others; gives the new version.

        What the column `status` says of each row (new, updated, kept, gone: not written) is counted while writing.
        """
        spark = rows.sparkSession
        version = self.version(spark) + 1
        stamp = F.concat_ws("-", F.lit(""), F.lit(version), F.lit(uuid.uuid4().hex))
        part = F.concat(F.lpad(F.col("bucket").cast("string"), 6, "0"), stamp)
        counted = Observation()
        said = F.col(status) if status else F.lit("kept")
        # Counted after the last shuffle: each row once, even if lost map tasks run again.
        written = rows.withColumns({"bucket": self.bucket(), "__status": said}).hint("rebalance", "bucket").observe(
            counted, *[F.count_if(F.col("__status") == s).alias(s) for s in ("new", "updated", "kept")])
        written = written.where("__status <> 'gone'").select(*self.schema.names, part.alias("__part"))
        written.write.mode("append").partitionBy("__part").parquet(f"{self.path}/data")
        n = counted.get
        line = touched.select("bucket").distinct().select(
            F.lit(version).cast("long").alias("version"), "bucket", part.alias("part"), *[F.lit(n.get(s, 0)).cast("long").alias(f"{s}_rows") for s in ("new", "updated", "kept")])
        self.commit(line)
        return version

    def commit(self, line: DataFrame) -> None:
        """Add a load's rows to the log: one file, so they appear at once."""
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def load(self, new: DataFrame, rules: dict[str, str], live: Column | None = None) -> int:
        """Upsert `new` (each key once; see `upsert` for rules) into its buckets; gives the new version.

        Rows of these buckets at which `live` does not hold afterwards go. Columns
        that `new` lacks are null in new rows; no rows make a version that changes nothing.
        """
        spark = new.sparkSession
        rows = settled(self.typed(new), "load")
        touched = rows.select(self.bucket().alias("bucket")).distinct()
        merged = upsert(self.read(spark, touched=touched), rows, self.keys, rules, with_status=True)
        if live is not None:
            merged = merged.withColumn(STATUS, F.when(F.coalesce(live, F.lit(False)), F.col(STATUS)).otherwise("gone"))
        return self.replace(touched, merged, STATUS)

    def expire(self, spark: SparkSession, live: Column) -> int:
        """Rewrite the buckets that hold rows at which `live` does not hold, without these."""
        touched = settled(self.read(spark).where(~F.coalesce(live, F.lit(False))).select(self.bucket().alias("bucket")).distinct(), "expired")
        return self.replace(touched, self.read(spark, touched=touched).where(live))

    def history(self, spark: SparkSession) -> DataFrame:
        """A row a load that touched a bucket: version, buckets, and the rows of these buckets that were new, updated and kept."""
        return self.log(spark).groupBy("version").agg(F.count("*").alias("buckets"), *[F.first(f"{s}_rows").alias(f"{s}_rows") for s in ("new", "updated", "kept")])

    def tidy(self, spark: SparkSession, oldest: int | None = None) -> None:
        """Remove folders that no version from `oldest` (default: the current one) on reads."""
        oldest = self.version(spark) if oldest is None else oldest
        needed = self.parts(spark, oldest).select("part").unionByName(self.log(spark).where(F.col("version") > oldest).select("part"))
        for row in self.log(spark).join(needed, "part", "left_anti").select("part").toLocalIterator():
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/__part={row.part}")
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

