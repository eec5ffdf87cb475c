"""One run of the transform: cleaned rows, errors and the log from one reading of the staging rows.

Rows are parsed once and written; cleaned rows and errors come from there. What
is counted is observed while rows are written, so nothing is scanned to be
counted. A repeated run replaces its errors and its log row.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vireo import schemas
from vireo.functions import parsers as p
from vireo.functions.dictionaries import Vocabulary
from vireo.operators.lineage import settled
from vireo.operators.versioned import Bucketed
from vireo.plans import transform


def cleaned_at(path: str, buckets: int = 4096) -> Bucketed:
    """The cleaned table at a path; `create` begins it."""
    return Bucketed(path, schemas.CLEANED, transform.KEY, buckets=buckets)


def run(rows: DataFrame, cleaned: Bucketed, errors: str, log: str, run_id: int, mode: str = "today", vocabulary: Vocabulary | None = None) -> DataFrame:
    """Transform staging rows, load them into `cleaned`, write the run's errors and its log row; gives that row.

    Errors are rows with a blank title or too many places, and what parsers could
    not read (PARSE_FAIL, with the raw text; the row itself is loaded).
    """
    spark = rows.sparkSession
    started = _now()
    counted, failed = Observation(), Observation()
    good = transform.is_good(F.col("places"), F.col("job_title"))
    both = transform.parsed(p.with_places(transform.spread(rows)), vocabulary).observe(counted, F.count(F.lit(1)).alias("inputs"), F.sum(F.when(good, F.size("places"))).alias("outputs"))
    both = settled(both, "parsed")
    rows = schemas.conformed(transform.with_ids(p.fanned_out(both.where(good)), run_id), schemas.CLEANED)
    version = cleaned.load(transform.once_each(rows), {x: "replace" for x in transform.REFRESHED})
    failures = both.select(F.col("id").alias("src_id"), "job_url", F.explode(transform.unread()).alias("x")).select("src_id", "job_url", "x.*")
    failures = failures.withColumns({"run_id": F.lit(run_id), "error_id": F.xxhash64(F.lit(run_id), "src_id", "job_url", "field_name"), "created_at": F.current_timestamp()})
    failures = schemas.conformed(failures, schemas.ETL_ERROR).drop("run_id").observe(failed, F.count(F.lit(1)).alias("errors"))
    failures.write.mode("overwrite").parquet(f"{errors}/run_id={run_id}")
    loads = cleaned.history(spark).where(F.col("version") == version).first()
    new, updated = (loads.new_rows, loads.updated_rows) if loads else (0, 0)
    line = transform.run_log(counted.get.get("inputs") or 0, counted.get.get("outputs") or 0, new, updated, failed.get.get("errors") or 0, started, _now(), mode, spark)
    line = settled(line.withColumn("run_id", F.lit(run_id)), "log")
    line.drop("run_id").write.mode("overwrite").parquet(f"{log}/run_id={run_id}")
    return line


def errors_of(spark: SparkSession, errors: str) -> DataFrame:
    """The errors of all runs."""
    return spark.read.schema(schemas.ETL_ERROR).parquet(errors)


def log_of(spark: SparkSession, log: str) -> DataFrame:
    """The log rows of all runs."""
    return spark.read.schema(schemas.ETL_LOG).parquet(log)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")
