"""Raw crawl records to staging rows: white space, per-site rules, code maps, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.functions import dictionaries as d
from vireo.functions.parsers import day_first, found, relative_day
from vireo.functions.text import lowered, one_space, stripped
from vireo.operators.upsert import upsert

FIELDS = ("website", "job_title", "company_title", "location", "experience", "job_type", "work_mode", "level", "job_url", "company_size", "company_industry", "number_recruit", "education_level", "job_posted_at", "job_deadline")
REQUIRED = ("job_title", "job_url")
#: Columns that a repeated crawl refreshes.
REFRESHED = ("job_title", "company_title", "compensation", "experience", "company_size", "company_industry", "job_description", "job_requirement", "job_posted_at", "job_deadline", "scraped_at")


def mapped(c: Column, table: dict[str, str]) -> Column:
    """The table's value for a code, other values as they are."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), c)


def long_text(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit(" ")), "\r\n?", "\n"), " {2,}", " ")
    return stripped(F.regexp_replace(c, "\n{3,}", "\n\n"))


def missing(columns: tuple[str, ...] = REQUIRED) -> Column:
    return F.concat_ws(", ", *[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in columns])


def cleaned(raw: DataFrame) -> DataFrame:
    """Records (strings; description, requirement, category and skills may be arrays) as
    staging rows with is_valid and error_log. Numeric codes are read as text."""
    def text(c: str, separator: str) -> Column:
        if c not in raw.columns:
            return F.lit("")
        if raw.schema[c].dataType.typeName() == "array":
            return F.array_join(F.filter(F.transform(c, long_text), lambda x: x != ""), separator)
        return long_text(F.col(c).cast("string"))

    df = raw.withColumns({
        **{c: one_space(F.col(c).cast("string")) if c in raw.columns else F.lit("") for c in FIELDS}, "job_description": text("job_description", "\n"), "job_requirement": text("job_requirement", "\n"),
        "job_category": one_space(text("job_category", ", ")), "scraped_at": F.replace(stripped("scraped_at"), F.lit(" "), F.lit("T")), "__pay": stripped("compensation")})
    site = lowered("website")
    posted, at = F.col("job_posted_at"), F.col("scraped_at")
    ago = r"(?i)\d+\s+(?:second|minute|hour|day|week|month|year)s?\s+ago|just now"
    first_line = F.trim(F.regexp_extract(posted, r"(?i)^(?:posted\s+)?(.*?ago|just now|[^•|]*)", 1))
    from_posted = F.element_at(F.create_map(*[F.lit(x) for kv in d.WORK_MODE_NAMES.items() for x in kv]), F.lower(first_line))
    mode = mapped(F.lower("work_mode"), d.WORK_MODE_NAMES)
    is_api, is_li, is_it = site == "vietnamwork", site == "linkedin", site == "itviec"
    skills = F.array_join(F.filter(F.transform("skills", lambda x: stripped(x)), lambda x: x != ""), ", ") if "skills" in raw.columns else F.lit("")
    pay = F.col("__pay")
    df = df.withColumns({
        "job_posted_at": F.when(is_li, F.when(posted.rlike(ago), relative_day(posted, at)).otherwise(posted)).when(is_it, F.when(from_posted.isNotNull(), "").otherwise(relative_day(first_line, at)))
        .when((site == "careerlink") & posted.isin("|", "-"), "").otherwise(day_first(posted)),
        "job_deadline": F.when(is_li | is_it, "").otherwise(day_first(F.col("job_deadline"))),
        "company_size": F.when((site == "careerviet") & F.col("company_size").startswith(":"), F.trim(F.replace(F.split("company_size", r"\|")[0], F.lit(":"), F.lit("")))).when(is_api, mapped(F.col("company_size"), d.API_COMPANY_SIZE)).otherwise(F.col("company_size")),
        "job_type": F.when(is_api, mapped(F.col("job_type"), d.API_JOB_TYPE)).otherwise(F.col("job_type")),
        "education_level": F.when(is_api, mapped(F.col("education_level"), d.API_EDUCATION)).otherwise(F.col("education_level")),
        "level": F.when(is_api, mapped(F.col("level"), d.API_LEVEL)).otherwise(F.col("level")),
        "work_mode": F.when(is_it, F.coalesce(from_posted, F.when(mode.isin(*d.WORK_MODE_NAMES.values()), mode), F.lit(""))).otherwise(F.col("work_mode")),
        "job_description": F.when(is_it & (skills != ""), F.concat_ws("\n\n", F.nullif(F.col("job_description"), F.lit("")), F.concat(F.lit("Skills: "), skills))).otherwise(F.col("job_description")),
        "compensation": F.when((pay == "") | found(F.lower(pay), d.NEGOTIABLE), "Thỏa thuận").when(is_api, one_space(F.regexp_replace(pay, r"^0\s*-\s*", ""))).otherwise(one_space(pay))})
    df = df.withColumn("__missing", missing())
    return df.withColumns({"is_valid": F.col("__missing") == "", "error_log": F.when(F.col("__missing") != "", F.concat(F.lit("Thiếu field bắt buộc: "), "__missing"))}).drop("__pay", "__missing", "skills")


def staged(old: DataFrame, rows: DataFrame) -> DataFrame:
    """The staging table after valid rows are loaded by job_url, with upsert_status."""
    return upsert(old, rows.where("is_valid"), ["job_url"], {c: "replace" for c in REFRESHED}, with_status=True)


def snapshot(statuses: DataFrame, keys: tuple[str, ...] = ("website",)) -> DataFrame:
    """Counters of a crawl by site from rows with `status`, and its outcome: FAILED on
    errors, WARN when more than a fifth is invalid, else SUCCESS."""
    n = lambda s: F.count_if(F.col("status") == s)
    out = statuses.groupBy(*keys).agg(F.count("*").alias("total_scraped"), n("new").alias("new_jobs"), n("updated").alias("updated_jobs"), n("duplicate").alias("duplicate_jobs"), n("invalid").alias("invalid_jobs"), n("error").alias("error_jobs"))
    return out.withColumn("status", F.when(F.col("error_jobs") > 0, "FAILED").when(F.col("invalid_jobs") > 0.2 * F.col("total_scraped"), "WARN").otherwise("SUCCESS"))


def filled(old: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Structured answers written back: the title only where it is given, other columns always."""
    named = answers.select(key, *[F.col(c).alias(f"__{c}") for c in answers.columns if c != key], F.lit(True).alias("__met"))
    both = old.join(named, key, "left")
    given = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"__{c}")), F.lit("")), F.col(c)) if c == "job_title" else F.when(F.col("__met"), F.col(f"__{c}")).otherwise(F.col(c))
    return both.select(*[given(c).alias(c) if c in answers.columns and c != key else F.col(c) for c in old.columns])


def structured(rows: DataFrame, ask, schema: str) -> DataFrame:
    """Answers of an outside service: `ask` maps pandas batches to pandas batches of `schema`.

    Only the seam is here; no service is called.
    """
    return rows.mapInPandas(ask, schema)


def read_answer(reply: Column, schema: str) -> Column:
    """The JSON object of a reply, with or without a code fence around it."""
    return F.from_json(F.regexp_extract(reply, r"(?s)(\{.*\})", 1), schema)
