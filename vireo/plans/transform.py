"""Staging rows to cleaned rows, one a posting and province, with error rows and a run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo import schemas
from vireo.functions import parsers as p
from vireo.functions.dictionaries import NEGOTIABLE, Vocabulary
from vireo.functions.parsers import found
from vireo.functions.text import cut_to, lowered, stripped
from vireo.operators.upsert import upsert
from vireo.operators.windows import latest

#: Columns that a repeated transform refreshes; the others keep their first value.
REFRESHED = (
    "website_clean job_posted_at_clean job_deadline_clean job_title_clean job_title_detect job_category_clean is_it job_type_clean work_mode_clean salary_min salary_max salary_currency conversion_rate is_negotiable salary_type "
    "exp_min_yr exp_max_yr is_exp_required level_clean hard_skills soft_skills major certifications languages education_clean company_size_min company_size_max industry_level1 industry_level2 number_recruit_clean etl_run_id").split()
#: What a cleaned row is found by.
KEY = ("job_url", "location_province")
#: Most characters of columns with a limit.
LIMITS = {"salary_type": 20, "salary_currency": 10, "level_clean": 50, "job_type_clean": 50, "work_mode_clean": 50}


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores by their key. A file of few megabytes is read by one or two tasks, but a row takes far longer to
    parse than to read or move."""
    context = rows.sparkSession.sparkContext
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism), "id", "job_url")


def transformed(rows: DataFrame, run_id: int, vocabulary: Vocabulary | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows, errors). Rows with a blank title, and those that name more than
    nine places, become errors."""
    rows = spread(rows)
    titled = stripped("job_title") != ""
    df = p.with_places(rows.where(titled))
    errors = rows.where(~titled).select("id", "job_url", F.lit("job_title").alias("field_name"), F.col("job_title").alias("raw_value"), F.lit("MISSING_TITLE").alias("error_type")).unionByName(
        df.where("places is null").select("id", "job_url", F.lit("location").alias("field_name"), F.col("location").alias("raw_value"), F.lit("TOO_MANY_LOCATIONS").alias("error_type")))
    errors = errors.withColumnRenamed("id", "src_id").withColumn("run_id", F.lit(run_id))
    df = parsed(df, vocabulary)
    df = p.fanned_out(df.where("places is not null"))
    return schemas.conformed(with_ids(df, run_id), schemas.CLEANED), schemas.conformed(errors, schemas.ETL_ERROR)


def with_ids(df: DataFrame, run_id: int) -> DataFrame:
    return df.withColumns({"src_id": F.col("id"), "etl_run_id": F.lit(run_id), "is_duplicate": F.lit(False), "etl_id": F.xxhash64("job_url", "location_province")})


def parsed(df: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Staging rows with all cleaned columns but those of their places."""
    c = F.col
    df = p.with_title(df, "job_title", vocabulary)
    df = df.withColumns({"website_clean": p.website(c("website")), **p.dates(c("job_posted_at"), c("job_deadline"), c("scraped_at"), c("job_description")), **p.company(c("company_title")), **p.work_style(c("job_type"), c("work_mode"), c("job_description"))})
    df = p.with_experience(p.with_salary(df))
    df = df.withColumn("level_clean", p.level(c("level"), c("job_title"), c("exp_min_yr"), c("exp_max_yr"), c("job_description"), c("job_requirement")))
    df = p.with_description_fields(df, vocabulary)
    df = df.withColumns({"education_clean": p.education(c("education_level"), c("job_description"), c("job_requirement")), **p.company_size(c("company_size")), **p.industry(c("company_industry"), c("major")), "number_recruit_clean": p.headcount(c("number_recruit"), c("job_title"))})
    df = df.withColumns({k: cut_to(c(k), n) for k, n in LIMITS.items()})
    return df


def unread() -> Column:
    """What the parsers could not read of a parsed row: an array of field_name, raw_value (cut), error_type, error_detail.

    A field fails if it holds something that its parser should have made a value
    of; blanks, and words such as "negotiable" in place of an amount, do not.
    """
    c = F.col
    digit = lambda name: c(name).rlike(r"\d")
    given = lambda name: stripped(name) != ""
    rules = {
        "job_posted_at": (given("job_posted_at") & p.date_of(c("job_posted_at"), c("scraped_at")).isNull(), "no date"),
        "job_deadline": (given("job_deadline") & p.date_of(c("job_deadline"), c("scraped_at")).isNull(), "no date"),
        "compensation": (digit("compensation") & ~found(lowered("compensation"), NEGOTIABLE) & c("salary_min").isNull() & c("salary_max").isNull(), "no amount within the currency's bounds"),
        "experience": (digit("experience") & c("exp_min_yr").isNull() & c("exp_max_yr").isNull(), "no years"),
        "company_size": (given("company_size") & ~lowered("company_size").isin("null", "n/a") & c("company_size_min").isNull() & c("company_size_max").isNull(), "no number"),
        "number_recruit": (given("number_recruit") & ~digit("number_recruit"), "no number")}
    entry = lambda field, kind, detail: F.struct(F.lit(field).alias("field_name"), cut_to(c(field).cast("string"), 500).alias("raw_value"), F.lit(kind).alias("error_type"), F.lit(detail).alias("error_detail"))
    parsers = [F.when(F.coalesce(failed, F.lit(False)), entry(field, "PARSE_FAIL", detail)) for field, (failed, detail) in rules.items()]
    rejected = F.when(stripped("job_title") == "", entry("job_title", "MISSING_TITLE", "")).when(c("places").isNull(), entry("location", "TOO_MANY_LOCATIONS", ""))
    return F.when(rejected.isNotNull(), F.array(rejected)).otherwise(F.array_compact(F.array(*parsers)))


def is_good(places: Column, title: Column) -> Column:
    """Whether a parsed row goes on to the cleaned table."""
    return places.isNotNull() & (stripped(title) != "")


def loaded(old: DataFrame, new: DataFrame) -> DataFrame:
    """The cleaned table after an upsert by posting and province, with upsert_status. Of rows of `new` that share both, the
    one scraped last counts, then the first by the other columns."""
    return upsert(old, once_each(new), list(KEY), {x: "replace" for x in REFRESHED}, with_status=True)


def once_each(new: DataFrame) -> DataFrame:
    """Of rows that share posting and province, the one scraped last, then the first by the other columns."""
    return latest(new, KEY, F.desc_nulls_last("scraped_at") if "scraped_at" in new.columns else "job_url", *[c for c in new.columns if c not in KEY])


def run_log(inputs: int, outputs: int, new: int, updated: int, errors: int, started: str, finished: str, mode: str, spark) -> DataFrame:
    """One log row; WARN when errors exceed a fifth of the input."""
    status = "WARN" if inputs and errors / inputs > 0.2 else "SUCCESS"
    row = spark.range(1).select(
        F.lit(mode).alias("mode"), F.to_timestamp(F.lit(started)).alias("started_at"), F.to_timestamp(F.lit(finished)).alias("finished_at"),
        *[F.lit(v).alias(k) for k, v in {"total_input": inputs, "total_output": outputs, "new_rows": new, "updated_rows": updated, "error_rows": errors, "status": status}.items()])
    row = row.withColumns({"run_date": F.to_date("started_at"), "duration_sec": F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")})
    return schemas.conformed(row, schemas.ETL_LOG)
