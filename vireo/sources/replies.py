"""Paged replies of the job API: saved replies to records to postings, with what could not be read and which pages are lacking.

Replies are read by Spark's own readers, so they may lie in any store that Spark reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.text import stripped, without_tags
from vireo.functions.dictionaries import API_NO_SALARY, API_PERIODS
from vireo.operators.windows import take_while

RECORD = """jobTitle string, companyName string, jobUrl string, jobDescription string, jobRequirement string, approvedOn string, expiredOn string,
salaryMin long, salaryMax long, salaryCurrency string, salaryPeriodId int, prettySalary string, yearsOfExperience string, typeWorkingId string, jobLevelId string, companySizeId string, highestDegreeId string,
workingLocations array<struct<cityNameVI:string>>, industriesV3 array<struct<industryV3NameVI:string>>, skills array<struct<skillName:string>>, jobFunction struct<parentNameVI:string, children:array<struct<nameVI:string>>>"""
REPLY = "meta struct<nbPages:long>, data array<string>"
BAD = "__bad"


def saved(spark: SparkSession, path: str) -> DataFrame:
    """source, page and body of the files of a folder, a reply a file. The page (from 0) is the last number of the file's name, null without one.

    Spark passes over files of no bytes; `lacking` names their pages.
    """
    files = spark.read.text(path, wholetext=True)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return files.select(F.col("_metadata.file_path").alias("source"), F.try_element_at(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1)).cast("long").alias("page"), F.col("value").alias("body"))


def read(text: Column, schema: str) -> Column:
    """A JSON object as a struct; its field BAD holds the text if it could not be read as the schema says."""
    return F.from_json(text, f"{schema}, {BAD} string", {"columnNameOfCorruptRecord": BAD, "mode": "PERMISSIVE"})


def records(replies: DataFrame, body: str = "body") -> DataFrame:
    """The records of replies: their other columns, nb_pages, position (from 0), record (its JSON) and error.

    A reply that is null or no JSON object, or lacks its list of records, gives one row with error `reply` and its text as the
    record. A reply with an empty list gives no row. A record is not read here; each stays as text.
    """
    others = [c for c in replies.columns if c != body]
    whole = replies.withColumn("__reply", read(F.col(body), REPLY))
    fine = F.col("__reply.data").isNotNull() & F.col(f"__reply.{BAD}").isNull()
    listed = F.when(fine, F.col("__reply.data")).otherwise(F.array(F.col(body)))
    rows = whole.select(*others, F.when(fine, F.col("__reply.meta.nbPages")).alias("nb_pages"), (~fine).alias("__bad_reply"), F.posexplode(listed).alias("position", "record"))
    return rows.withColumn("error", F.when(F.coalesce("__bad_reply", F.lit(True)), "reply")).drop("__bad_reply")


def postings(read_records: DataFrame, record: str = "record") -> DataFrame:
    """Postings of API records, after the other columns; `error` becomes `record` where the record cannot be read.

    Of an unreadable record, the fields that could be read are kept. A column named as a posting's field is replaced.
    """
    df = read_records if "error" in read_records.columns else read_records.withColumn("error", F.lit(None).cast("string"))
    df = df.withColumn("__r", F.when(F.col("error").isNull(), read(F.col(record), RECORD)))
    r = lambda name: F.col(f"__r.{name}")
    given = lambda x: F.nullif(x, F.lit(""))
    names = lambda xs, f: F.array_join(F.filter(F.transform(xs, lambda x: x[f]), lambda x: stripped(x) != ""), ", ")
    amount = lambda name: F.format_number(F.coalesce(r(name), F.lit(0)), 0)
    period = F.coalesce(r("salaryPeriodId"), F.lit(1))
    suffix = F.coalesce(*[F.when(period == k, v) for k, v in API_PERIODS.items()], F.lit(""))
    pay = F.trim(F.concat(amount("salaryMin"), F.lit(" - "), amount("salaryMax"), F.lit(" "), F.coalesce(r("salaryCurrency"), F.lit("")), F.lit(" "), suffix))
    skills = F.when(F.size(r("skills")) > 0, F.concat(F.lit("Skills: "), names(r("skills"), "skillName")))
    fields = {
        "website": F.lit("vietnamwork"), "job_url": r("jobUrl"), "job_title": r("jobTitle"), "company_title": r("companyName"), "location": given(F.get(r("workingLocations"), F.lit(0))["cityNameVI"]), "experience": r("yearsOfExperience"),
        "compensation": F.when((F.coalesce(r("salaryMin"), F.lit(0)) != 0) | (F.coalesce(r("salaryMax"), F.lit(0)) != 0), pay).otherwise(F.coalesce(r("prettySalary"), F.lit(API_NO_SALARY))),
        "job_type": r("typeWorkingId"), "level": r("jobLevelId"), "company_size": r("companySizeId"), "company_industry": given(names(r("industriesV3"), "industryV3NameVI")),
        "job_category": given(F.when(F.size(r("jobFunction.children")) > 0, F.get(r("jobFunction.children"), F.lit(0))["nameVI"]).otherwise(r("jobFunction.parentNameVI"))), "education_level": r("highestDegreeId"),
        "job_description": given(F.concat_ws("\n\n", given(without_tags(r("jobDescription"))), skills)), "job_requirement": given(without_tags(r("jobRequirement"))), "job_posted_at": r("approvedOn"), "job_deadline": r("expiredOn"),
    }
    bad = F.when(F.col("error").isNull() & (F.col("__r").isNull() | r(BAD).isNotNull()), "record")
    kept = [c for c in df.columns if c not in fields and c not in ("__r", "error")]
    return df.select(*kept, *[F.when(F.col("error").isNull(), v).alias(n) for n, v in fields.items()], F.coalesce("error", bad).alias("error"))


def until(found: DataFrame, crawl: list[str], stop: Column) -> DataFrame:
    """Postings of each crawl up to the first, by page and position, at which `stop` holds (it and later ones go)."""
    return take_while(found, crawl, stop, "page", "position")


def lacking(replies: DataFrame, crawl: list[str], body: str = "body") -> DataFrame:
    """The pages (from 0) of each crawl that its replies count but that were not saved or cannot be read, to be asked for again.

    Of counts that differ within a crawl the largest holds; a crawl whose replies give none lacks none that is known.
    """
    whole = replies.select(*crawl, "page", read(F.col(body), REPLY).alias("__reply"))
    whole = whole.where(F.col("__reply.data").isNotNull() & F.col(f"__reply.{BAD}").isNull())
    wanted = whole.groupBy(*crawl).agg(F.max("__reply.meta.nbPages").alias("__n")).where("__n > 0")
    pages = wanted.select(*crawl, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1)).alias("page"))
    return pages.join(whole.select(*crawl, F.col("page").cast("long").alias("page")).distinct(), [*crawl, "page"], "left_anti")
