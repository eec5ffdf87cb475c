"""Schemas of the staging table, the cleaned table and the star, as Spark types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "decimal(18,0)": T.DecimalType(18, 0)}


def columns(text: str) -> StructType:
    """A schema from `name type, ...`, readable before any session exists."""
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in text.split(", "))])


_text = lambda names: ", ".join(f"{n} string" for n in names.split())

#: Ids of postings are 64-bit hashes, and tables that grow with the data are numbered by longs.
STAGING = columns("id long, " + _text(
    "website job_title company_title location experience compensation job_type work_mode level job_url company_size company_industry job_category number_recruit education_level "
    "job_description job_requirement job_posted_at job_deadline scraped_at") + ", is_valid boolean, error_log string, ai_processed boolean")

CLEANED = columns(
    "etl_id long, src_id long, job_url string, scraped_at string, etl_run_id long, etl_processed_at timestamp_ntz, website string, website_clean string, job_posted_at string, job_deadline string, job_posted_at_clean date, job_deadline_clean date, "
    "job_title string, job_title_detect string, job_title_clean string, job_category_clean string, is_it boolean, company_title string, company_title_clean string, company_type string, company_canonical_key string, location string, location_province string, "
    "location_region string, is_vn boolean, job_type string, work_mode string, job_type_clean string, work_mode_clean string, compensation string, salary_min double, salary_max double, salary_currency string, conversion_rate double, is_negotiable boolean, "
    "experience string, exp_min_yr double, exp_max_yr double, is_exp_required boolean, level string, level_clean string, job_description string, job_requirement string, hard_skills string, soft_skills string, major string, certifications string, "
    "languages string, education_level string, education_clean string, company_size string, company_size_min double, company_size_max double, company_industry string, industry_level1 string, industry_level2 string, job_category string, "
    "number_recruit string, number_recruit_clean long, is_valid boolean, is_duplicate boolean, duplicate_of_id long, dedup_method string, error_log string, salary_type string")

FACT = columns(
    "posting_id long, etl_id long, job_url string, dia_diem_id int, cong_ty_id long, nganh_id int, cap_bac_id int, hinh_thuc_id int, nguon_id int, danh_muc_id int, job_title_clean string, job_title_detect string, so_luong_tuyen decimal(18,0), "
    "salary_min decimal(18,0), salary_max decimal(18,0), salary_avg decimal(18,0), salary_currency string, conversion_rate float, is_negotiable boolean, exp_min_yr float, exp_max_yr float, is_exp_required boolean, is_it boolean, is_duplicate boolean, "
    "duplicate_of_id long, dedup_method string, ngay_dang date, etl_run_id long, ngay_crawl date, ngay_deadline date, created_at timestamp, updated_at timestamp, salary_type string")

DIMENSIONS = {
    "dim_nguon": columns("nguon_id int, ten_nguon string"),
    "dim_capbac": columns("cap_bac_id int, ten_cap_bac string"),
    "dim_hinhthuc": columns("hinh_thuc_id int, job_type string, work_mode string"),
    "dim_nganh": columns("nganh_id int, cap_do_1 string, cap_do_2 string"),
    "dim_diadiem": columns("dia_diem_id int, tinh_thanh string, vung string, is_vn boolean"),
    "dim_congty": columns("cong_ty_id long, ten_cong_ty string, canonical_key string, company_type string, quy_mo_min float, quy_mo_max float"),
    "dim_danhmuccongviec": columns("danh_muc_id int, ten_danh_muc string"),
    "dim_require": columns("require_id long, require_type string, require_value string"),
}
BRIDGE = columns("bridge_id long, fact_id long, require_id long")
ETL_LOG = columns(
    "run_id int, run_date date, mode string, target_date date, started_at timestamp, finished_at timestamp, duration_sec float, total_input long, total_output long, new_rows long, updated_rows long, error_rows long, status string, note string")
ETL_ERROR = columns("error_id long, run_id int, src_id long, job_url string, field_name string, raw_value string, error_type string, error_detail string, created_at timestamp")
SNAPSHOT = columns(
    "run_id long, website string, started_at timestamp_ntz, finished_at timestamp_ntz, duration_sec long, total_scraped long, new_jobs long, updated_jobs long, duplicate_jobs long, invalid_jobs long, error_jobs long, status string, session_id string, triggered_by string")


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in order, cast; those that are absent are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def ddl(name: str, schema: StructType) -> str:
    return f"CREATE TABLE {name} (\n" + ",\n".join(f"  {f.name} {f.dataType.simpleString()}" for f in schema) + "\n)"
