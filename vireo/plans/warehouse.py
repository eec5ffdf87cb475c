"""Cleaned rows to a star: eight dimensions, the fact, and the bridge to requirements.

load() gives all tables as they are after the load. Dimensions are joined by
whatever strategy their size allows; companies and requirements, which grow with
the data, are numbered over many tasks. Default rows exist before the fact is
joined, so every posting finds a place and an industry. A repeated load changes
nothing but timestamps. Rows, dimensions and the fact are written between steps:
each is planned and computed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import schemas
from vireo.functions.dictionaries import OTHER_PLACE, UNKNOWN_INDUSTRY
from vireo.functions.text import default_if_blank, null_if_blank
from vireo.operators.lineage import settled
from vireo.operators.upsert import default_row, insert_ignore, upsert, with_numbers, with_surrogates
from vireo.operators.windows import latest

REQUIREMENTS = {"hard_skill": "hard_skills", "soft_skill": "soft_skills", "certification": "certifications", "language": "languages", "major": "major"}
KEPT_IN_FACT = ("etl_id", "posting_id", "job_url", "created_at", "etl_run_id", "salary_avg")


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    tables = {**schemas.DIMENSIONS, "fact_jobpostings": schemas.FACT, "bridge_jobrequire": schemas.BRIDGE}
    return {name: spark.createDataFrame([], schema) for name, schema in tables.items()}


def distinct_trimmed(rows: DataFrame, column: str, alias: str) -> DataFrame:
    return rows.select(null_if_blank(column).alias(alias)).where(F.col(alias).isNotNull()).distinct()


def numbered(old: DataFrame, loaded: DataFrame, order: list[str], large: bool = False) -> DataFrame:
    return settled(with_surrogates(old, loaded, old.columns[0], order, large).select(*old.columns), old.columns[0])


def numbered_on(before: DataFrame, rows: DataFrame, out: str, order: list[str]) -> DataFrame:
    """`rows` with those that have no `out` numbered on from the greatest of `before`."""
    top = before.agg(F.coalesce(F.max(out), F.lit(0)).alias("__top"))
    fresh = with_numbers(rows.where(F.col(out).isNull()).drop(out), "__n", order).crossJoin(F.broadcast(top))  # one row
    return rows.where(F.col(out).isNotNull()).unionByName(fresh.withColumn(out, F.col("__top") + F.col("__n")).drop("__top", "__n"))


def places(rows: DataFrame) -> DataFrame:
    """One row a province: of its regions the least, is_vn false before true."""
    named = rows.select(null_if_blank("location_province").alias("tinh_thanh"), F.col("location_region").alias("vung"), "is_vn").where("tinh_thanh is not null").distinct()
    return latest(named, ["tinh_thanh"], F.asc_nulls_last("vung"), F.asc_nulls_last("is_vn"))


def companies(rows: DataFrame) -> DataFrame:
    name = default_if_blank("company_title_clean", "Unknown")
    return rows.groupBy(name.alias("ten_cong_ty")).agg(F.max("company_canonical_key").alias("canonical_key"), F.max("company_type").alias("company_type"), F.max("company_size_min").cast("float").alias("quy_mo_min"), F.max("company_size_max").cast("float").alias("quy_mo_max"))


def dimensions(old: dict[str, DataFrame], rows: DataFrame) -> dict[str, DataFrame]:
    out = {}
    for table, column, alias in (("dim_nguon", "website_clean", "ten_nguon"), ("dim_capbac", "level_clean", "ten_cap_bac"), ("dim_danhmuccongviec", "job_category_clean", "ten_danh_muc")):
        out[table] = numbered(old[table], insert_ignore(old[table], distinct_trimmed(rows, column, alias), [alias]), [alias])
    forms = rows.select(default_if_blank("job_type_clean", "Full-time").alias("job_type"), default_if_blank("work_mode_clean", "Onsite").alias("work_mode")).distinct()
    out["dim_hinhthuc"] = numbered(old["dim_hinhthuc"], insert_ignore(old["dim_hinhthuc"], forms, ["job_type", "work_mode"]), ["job_type", "work_mode"])
    industries = rows.select(null_if_blank("industry_level1").alias("cap_do_1"), null_if_blank("industry_level2").alias("cap_do_2")).where("cap_do_1 is not null").distinct()
    table = insert_ignore(old["dim_nganh"], industries, ["cap_do_1", "cap_do_2"])
    out["dim_nganh"] = numbered(old["dim_nganh"], default_row(table, {"cap_do_1": UNKNOWN_INDUSTRY, "cap_do_2": UNKNOWN_INDUSTRY}), ["cap_do_1", "cap_do_2"])
    table = insert_ignore(old["dim_diadiem"], places(rows), ["tinh_thanh"])
    other = table.sparkSession.createDataFrame([(OTHER_PLACE, OTHER_PLACE, True)], "tinh_thanh string, vung string, is_vn boolean")
    out["dim_diadiem"] = numbered(old["dim_diadiem"], insert_ignore(table, other, ["tinh_thanh"]), ["tinh_thanh"])
    merged = upsert(old["dim_congty"], companies(rows), ["ten_cong_ty"], {c: "coalesce" for c in ("canonical_key", "company_type", "quy_mo_min", "quy_mo_max")})
    out["dim_congty"] = numbered(old["dim_congty"], merged, ["ten_cong_ty"], large=True)
    return out


def salary_average(low: Column, high: Column) -> Column:
    whole = lambda c: c.cast("decimal(18,0)")
    return F.when(low.isNotNull() & high.isNotNull(), F.round((whole(low) + whole(high)) / 2, 0)).otherwise(F.coalesce(whole(low), whole(high))).cast("decimal(18,0)")


def salary_kind(kind: Column, negotiable: Column) -> Column:
    return F.coalesce(kind, F.when(~negotiable, "monthly").otherwise("negotiable"))


def of_run(rows: DataFrame, mode: str, run_id: str | None) -> DataFrame:
    """Valid rows: all of them, or those of one run."""
    rows = rows.where("is_valid")
    return rows if mode == "all" else rows.where(F.col("etl_run_id").cast("string") == str(run_id))


def fact_rows(rows: DataFrame, dims: dict[str, DataFrame], now: str) -> DataFrame:
    c = F.col
    src = latest(rows, ["etl_id"], F.desc_nulls_last("scraped_at"), F.asc_nulls_last("job_url")).withColumns({
        "k_place": F.coalesce(F.trim("location_province"), F.lit("")), "k_company": default_if_blank("company_title_clean", "Unknown"), "k_1": F.trim("industry_level1"), "k_2": null_if_blank("industry_level2"), "k_level": F.trim("level_clean"),
        "k_type": default_if_blank("job_type_clean", "Full-time"), "k_mode": default_if_blank("work_mode_clean", "Onsite"), "k_site": F.trim("website_clean"), "k_category": F.trim("job_category_clean")})
    place, industry = dims["dim_diadiem"].select("dia_diem_id", "tinh_thanh"), dims["dim_nganh"]
    fallback = place.where(F.col("tinh_thanh") == OTHER_PLACE).select(c("dia_diem_id").alias("other_place")).crossJoin(industry.where((c("cap_do_1") == UNKNOWN_INDUSTRY) & (c("cap_do_2") == UNKNOWN_INDUSTRY)).select(c("nganh_id").alias("other_industry")))
    out = (src.join(place, c("k_place") == c("tinh_thanh"), "left")
           .join(dims["dim_congty"].select("cong_ty_id", "ten_cong_ty"), c("k_company") == c("ten_cong_ty"), "left")
           .join(industry, (c("k_1") == c("cap_do_1")) & c("k_2").eqNullSafe(c("cap_do_2")), "left")
           .join(dims["dim_capbac"], c("k_level") == c("ten_cap_bac"), "left")
           .join(dims["dim_hinhthuc"].select("hinh_thuc_id", c("job_type").alias("d_type"), c("work_mode").alias("d_mode")), (c("k_type") == c("d_type")) & (c("k_mode") == c("d_mode")), "left")
           .join(dims["dim_nguon"], c("k_site") == c("ten_nguon"), "left").join(dims["dim_danhmuccongviec"], c("k_category") == c("ten_danh_muc"), "left")
           .crossJoin(F.broadcast(fallback)))  # one row
    return schemas.conformed(out.withColumns({
        "dia_diem_id": F.coalesce("dia_diem_id", "other_place"), "nganh_id": F.coalesce("nganh_id", "other_industry"), "so_luong_tuyen": F.coalesce("number_recruit_clean", F.lit(1)), "salary_avg": salary_average(c("salary_min"), c("salary_max")),
        "salary_type": salary_kind(c("salary_type"), c("is_negotiable")), "ngay_dang": c("job_posted_at_clean"), "ngay_crawl": F.to_date(F.try_to_timestamp(F.substring(null_if_blank("scraped_at"), 1, 10), F.lit("yyyy-MM-dd"))), "ngay_deadline": c("job_deadline_clean"),
        "created_at": F.to_timestamp(F.lit(now)), "updated_at": F.to_timestamp(F.lit(now))}), schemas.FACT)


def requirements(rows: DataFrame) -> DataFrame:
    """(etl_id, require_type, require_value) of all five columns in one pass."""
    lists = F.array(*[F.struct(F.lit(kind).alias("require_type"), F.split(F.coalesce(F.col(c), F.lit("")), ",").alias("values")) for kind, c in REQUIREMENTS.items()])
    each = rows.select("etl_id", F.explode(lists).alias("r")).select("etl_id", "r.require_type", F.explode("r.values").alias("v"))
    return each.select("etl_id", "require_type", F.trim("v").alias("require_value")).where("require_value <> ''").distinct()


def load(old: dict[str, DataFrame], cleaned: DataFrame, now: str, mode: str = "all", run_id: str | None = None) -> dict[str, DataFrame]:
    """All tables after the load; with mode `all` the fact and the bridge begin afresh."""
    rows = settled(of_run(cleaned, mode, run_id), "load-rows")
    out = dimensions(old, rows)
    spark = cleaned.sparkSession
    fact_before = spark.createDataFrame([], schemas.FACT) if mode == "all" else old["fact_jobpostings"]
    bridge_before = spark.createDataFrame([], schemas.BRIDGE) if mode == "all" else old["bridge_jobrequire"]
    rules = {c: "replace" for c in schemas.FACT.fieldNames() if c not in KEPT_IN_FACT}
    fact = settled(upsert(fact_before, fact_rows(rows, out, now), ["etl_id"], rules), "fact-rows")
    out["fact_jobpostings"] = settled(schemas.conformed(numbered_on(fact_before, fact, "posting_id", ["etl_id"]), schemas.FACT), "fact")
    wanted = requirements(rows)
    named = wanted.select("require_type", "require_value").distinct()
    out["dim_require"] = numbered(old["dim_require"], insert_ignore(old["dim_require"], named, ["require_type", "require_value"]), ["require_type", "require_value"], large=True)
    postings_of = out["fact_jobpostings"].select("etl_id", F.col("posting_id").alias("fact_id"))
    pairs = wanted.join(postings_of, "etl_id").join(out["dim_require"], ["require_type", "require_value"]).select("fact_id", "require_id").distinct()
    table = settled(insert_ignore(bridge_before, pairs, ["fact_id", "require_id"]), "bridge-rows")
    out["bridge_jobrequire"] = schemas.conformed(numbered_on(bridge_before, table, "bridge_id", ["fact_id", "require_id"]), schemas.BRIDGE)
    return out


def postings(tables: dict[str, DataFrame]) -> DataFrame:
    """All postings with their dimensions' names."""
    out = tables["fact_jobpostings"]
    for table, key in (("dim_diadiem", "dia_diem_id"), ("dim_congty", "cong_ty_id"), ("dim_nganh", "nganh_id"), ("dim_capbac", "cap_bac_id"), ("dim_hinhthuc", "hinh_thuc_id"), ("dim_nguon", "nguon_id"), ("dim_danhmuccongviec", "danh_muc_id")):
        out = out.join(tables[table], key, "left")
    return out


def unique_postings(tables: dict[str, DataFrame]) -> DataFrame:
    """Those not marked as duplicates; unmarked (null) ones are left out too."""
    return postings(tables).where("is_duplicate = false")
