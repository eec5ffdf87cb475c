"""Parsers against worked cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from vireo.functions import dictionaries as d
from vireo.functions import parsers as p
from vireo.functions import text as t

REF = "2026-02-10T08:00:00"
DAY = datetime.date


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_salary(spark):
    cases = {
        "15 - 20 triệu": (15000000, 20000000, "VND", "monthly"), "Up to $2000": (None, 2000, "USD", "monthly"), "Từ 10 triệu": (10000000, None, "VND", "monthly"), "$1,000 - 2,000": (1000, 2000, "USD", "monthly"),
        "30 - 40 triệu/năm": (2500000, 3333333, "VND", "yearly"), "$20/hour": (3200, 3200, "USD", "hourly"), "20,000,000 - 30,000,000 VND /tháng": (20000000, 30000000, "VND", "monthly"), "Thỏa thuận": (None, None, None, "negotiable"), "": (None, None, None, "negotiable"),
        "1.000.000.000": (83333333, 83333333, "VND", "monthly")}
    for r in p.with_salary(column(spark, cases, "compensation")).collect():
        assert (r.salary_min, r.salary_max, r.salary_currency, r.salary_type) == cases[r.compensation], r
        assert r.is_negotiable == (r.salary_currency is None)


def test_dates(spark):
    cases = {"05/03/2026": DAY(2026, 3, 5), "2026-03-05": DAY(2026, 3, 5), "còn 5 ngày": DAY(2026, 2, 15), "3 days ago": DAY(2026, 2, 7), "1 month ago": DAY(2026, 1, 11), "2 tuần trước": DAY(2026, 1, 27), "31/02/2026": None, "": None, "2 YEARS AGO (reposted)": DAY(2024, 2, 11)}
    for r in column(spark, cases).select("x", p.date_of(F.col("x"), F.lit(REF)).alias("d"), p.is_old(F.col("x"), F.lit(REF), 3).alias("old")).collect():
        assert r.d == cases[r.x] and r.old == (r.d is not None and (DAY(2026, 2, 10) - r.d).days > 3)
    made = p.dates(F.lit(""), F.lit(""), F.lit(REF), F.lit("Hạn nộp: 20/02/2026"))
    assert tuple(spark.range(1).select(*made.values()).first()) == (DAY(2026, 2, 10), DAY(2026, 2, 20))
    assert column(spark, ["posted 3 days ago", "just now", "soon"]).select(p.relative_day(F.col("x"), F.lit(REF))).toPandas().iloc[:, 0].tolist() == ["07/02/2026", "10/02/2026", "soon"]


def test_places(spark):
    cases = {"Hà Nội, TP.HCM": ["TP. Hà Nội", "TP. Hồ Chí Minh"], "Hà Nội; Hanoi": ["TP. Hà Nội"], "Bình Dương": ["TP. Hồ Chí Minh"], "Singapore, Tokyo": ["Khác"], "": ["Khác"], ",".join("abcdefghij"): None, "Quận 1, Đà Nẵng, Viet Nam": ["TP. Đà Nẵng"]}
    for r in p.with_places(column(spark, cases, "location")).collect():
        assert r.places == cases[r.location], r
    assert sorted(map(tuple, p.fanned_out(p.with_places(column(spark, ["Hà Nội, x"], "location"))).select("location_province", "location_region", "is_vn").collect())) == [("Khác", "Khác", False), ("TP. Hà Nội", "Bắc", True)]


def test_company_and_title(spark):
    cases = {"CTCP ABC Việt Nam": ("CÔNG TY CỔ PHẦN ABC VIỆT NAM", "Cổ phần", "cong ty abc"), "Confidential Company": ("Confidential", "Confidential", None), "N/A": ("Unknown", "Unknown", None)}
    for r in column(spark, cases).select("x", *[v.alias(k) for k, v in p.company(F.col("x")).items()]).collect():
        assert tuple(r)[1:] == cases[r.x]
    titles = {"[HN] Senior Data Engineer (Remote)": ("Senior Data Engineer", "Data Engineer", "Data Analytics", True), "Web Developer": ("Web Developer", "Back-end Developer", "Software Development", True), "Thợ hàn": ("Thợ hàn", None, "Non-IT", False), "python lập trình": ("python lập trình", "Back-end Developer", "Software Development", True)}
    for r in p.with_title(column(spark, titles, "job_title")).collect():
        assert (r.job_title_clean, r.job_title_detect, r.job_category_clean, r.is_it) == titles[r.job_title]


def test_experience(spark):
    cases = {"Không yêu cầu kinh nghiệm": (0, 0, False), "2 năm": (2, 2, True), "Trên 3 năm": (3, None, True), "Dưới 1 năm": (0, 1, True), "6 tháng": (0.5, 0.5, True), "1-3 năm": (1, 3, True), "10 năm kinh nghiệm": (10, 10, True), "1,5 năm": (1.5, 1.5, True), "0 năm kinh nghiệm": (0, 0, False), "": (None, None, None)}
    df = column(spark, cases, "experience").withColumns({"job_description": F.lit(""), "job_requirement": F.lit(None).cast("string")})
    for r in p.with_experience(df).collect():
        assert (r.exp_min_yr, r.exp_max_yr, r.is_exp_required) == cases[r.experience], r


@pytest.mark.parametrize(("made", "want"), [
    (lambda: p.level(F.lit(""), F.lit("Senior Data Engineer"), F.lit(None), F.lit(None), F.lit(""), F.lit("")), "Senior"),
    (lambda: p.level(F.lit(""), F.lit(""), F.lit(1.0), F.lit(3.0), F.lit(""), F.lit("")), "Junior"),
    (lambda: p.education(F.lit("Cử nhân"), F.lit(""), F.lit("")), "Đại học"),
    (lambda: p.headcount(F.lit(""), F.lit("Tuyển 5 nhân viên")), 5), (lambda: p.headcount(F.lit("Nhiều"), F.lit("")), 999), (lambda: p.headcount(F.lit(None), F.lit("x")), 1),
    (lambda: t.without_accents(F.lit("Đắk Lắk é")), "Dak Lak e"), (lambda: p.day_first(F.lit("2026-03-05T1")), "05/03/2026"),
    (lambda: p.work_style(F.lit("Thực tập"), F.lit("Hybrid"), F.lit(""))["work_mode_clean"], "Hybrid"),
    (lambda: p.industry(F.lit("kiểm toán"), F.lit(None))["industry_level2"], "Kế toán và Kiểm toán"),
    (lambda: p.company_size(F.lit("Hơn 50.000"))["company_size_min"], 50000)])
def test_single_values(spark, made, want):
    assert spark.range(1).select(made()).first()[0] == want


def test_whole_word_lists(spark):
    skills = {"mysql và postgresql": "SQL", "asp.net, dotnet": "C#", "php / laravel": "PHP", "rails": "Ruby", "linux": "Bash/Shell", "mongodb; react.js": "JavaScript, React, SQL", "r. một": None, "c++ giỏi": "C++, C/C++"}
    rows = column(spark, skills, "job_description").select("*", F.lit("x").alias("website"), F.lit("").alias("job_requirement"), F.lit("").alias("job_category"))
    assert {r.job_description: r.hard_skills for r in p.with_description_fields(rows).collect()} == skills
    titles = {"Kế toán trưởng": "Chief Accountant", "Chief Financial Officer": "CFO", "Tổng giám đốc": "CEO", "zqcz": None}
    assert {r.job_title: r.job_title_detect for r in p.with_title(column(spark, titles, "job_title")).collect()} == titles
    added = d.Vocabulary({"SQL": ["duckdb"]}, [("Juggler", ["zqcz"])])
    assert [r.job_title_detect for r in p.with_title(column(spark, ["zqcz"], "job_title"), vocabulary=added).collect()] == ["Juggler"]
    assert (len(d.SKILL_WORDS), sum(map(len, d.SKILL_WORDS.values())), len(d.OTHER_TITLES)) == (63, 303, 138)


def test_dates_without_a_failed_reading(spark):
    """A text that is no date is told by its pattern: no date format is tried on it, and digits of other scripts are no error."""
    rows = spark.createDataFrame([("soon", "x"), ("٣ ngày", None), ("31/02/2020", "hạn nộp: 31/02/2024"), ("5-2-2026 (new)", "Apply before 1/2/2024")], "t string, e string")
    made = p.dates(F.col("t"), F.lit(None), F.lit("2024-03-01 09:00:00"), F.col("e"))
    df = rows.select("t", *[v.cast("string").alias(k) for k, v in made.items()])
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {tuple(r) for r in df.collect()} == {("soon", "2024-03-01", None), ("٣ ngày", "2024-03-01", None), ("31/02/2020", "2024-03-01", None), ("5-2-2026 (new)", "2026-02-05", "2024-02-01")}
