"""What parsers could not read, and a nightly run that is repeated."""

from pyspark.sql import functions as F

from vireo import schemas
from vireo.operators import lineage
from vireo.plans import nightly, transform


def test_unread(spark):
    schema = ("job_title string, job_posted_at string, job_deadline string, scraped_at string, compensation string, experience string, company_size string, number_recruit string, places array<string>, "
              "salary_min double, salary_max double, exp_min_yr double, exp_max_yr double, company_size_min long, company_size_max long")
    none = [None] * 6
    rows = [
        ("a", "05/02/2026", "", "2026-02-10T08:00:00", "Thỏa thuận 2026", "không", "n/a", "2 người", ["x"], *none),
        ("b", "soon", "x" * 600, "2026-02-10T08:00:00", "99 xu", "5?", "some", "many", ["x", "y"], *none),
        ("c", None, None, None, "5 triệu", "1 năm", "10", None, [], 5e6, None, 1.0, None, None, 10),
        (" ", "soon", None, None, None, None, None, "many", ["x"], *none),
        ("d", "soon", None, None, None, None, None, None, None, *none)]
    got = {r.job_title: {x.field_name: (x.error_type, x.raw_value) for x in r.x} for r in spark.createDataFrame(rows, schema).withColumn("location", F.lit("z")).select("job_title", transform.unread().alias("x")).collect()}
    assert got["a"] == {} and got["c"] == {}
    assert got["b"] == {k: ("PARSE_FAIL", v) for k, v in {"job_posted_at": "soon", "job_deadline": "x" * 500, "compensation": "99 xu", "experience": "5?", "company_size": "some", "number_recruit": "many"}.items()}
    assert got[" "] == {"job_title": ("MISSING_TITLE", " ")} and got["d"] == {"location": ("TOO_MANY_LOCATIONS", "z")}


def test_a_repeated_run_replaces_its_errors_and_log(spark, tmp_path):
    rows = spark.createDataFrame([(1, "https://j/1", "Data Engineer", "Hà Nội", "soon"), (2, "https://j/2", "", "Huế", None)], "id long, job_url string, job_title string, location string, job_posted_at string")
    rows = schemas.conformed(rows.withColumn("scraped_at", F.lit("2026-02-10T08:00:00")), schemas.STAGING)
    cleaned = nightly.cleaned_at(f"{tmp_path}/cleaned", 2).create(spark)
    for _ in range(2):
        nightly.run(rows, cleaned, f"{tmp_path}/errors", f"{tmp_path}/log", 3)
    assert {(r.run_id, r.src_id, r.error_type, r.raw_value) for r in nightly.errors_of(spark, f"{tmp_path}/errors").collect()} == {(3, 1, "PARSE_FAIL", "soon"), (3, 2, "MISSING_TITLE", "")}
    line = nightly.log_of(spark, f"{tmp_path}/log").collect()
    assert [(r.total_input, r.total_output, r.new_rows, r.updated_rows, r.error_rows, r.status) for r in line] == [(2, 1, 0, 1, 2, "WARN")]
    assert cleaned.read(spark).count() == 1 and cleaned.read(spark, 1).count() == 1


def _one_task(spark):
    """Forty staging rows in one partition, as from a small file."""
    rows = spark.range(40).select(F.col("id"), F.concat(F.lit("https://j/"), "id").alias("job_url"), F.lit("Data Engineer").alias("job_title"), F.lit("Hà Nội").alias("location"), F.lit("2026-02-10T08:00:00").alias("scraped_at"))
    return schemas.conformed(rows.coalesce(1), schemas.STAGING)


def test_rows_of_one_task_are_parsed_by_many(spark):
    cleaned, _ = transform.transformed(_one_task(spark), 3)
    assert len({r[0] for r in cleaned.select(F.spark_partition_id()).collect()}) > 4 and cleaned.count() == 40


def test_a_nightly_run_parses_rows_of_one_task_by_many(spark, tmp_path):
    before = set(lineage._made.get(spark.sparkContext.applicationId, []))
    nightly.run(_one_task(spark), nightly.cleaned_at(f"{tmp_path}/cleaned", 2).create(spark), f"{tmp_path}/errors", f"{tmp_path}/log", 3)
    (parsed,) = [x for x in lineage._made[spark.sparkContext.applicationId] if x not in before and x.endswith("-parsed")]
    assert len(spark.read.parquet(parsed).inputFiles()) > 4 and spark.read.parquet(parsed).count() == 40
