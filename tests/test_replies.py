"""Saved replies of the API, read from files."""

import json

from pyspark.sql import functions as F

from vireo.sources import replies


def test_saved_replies(spark, tmp_path):
    full = {"jobUrl": "a", "jobTitle": "T", "salaryMin": 1500, "salaryMax": 20000, "salaryCurrency": "USD", "salaryPeriodId": 3, "prettySalary": "no", "yearsOfExperience": 2, "workingLocations": [], "industriesV3": [{"industryV3NameVI": ""}],
            "jobFunction": {"parentNameVI": "P", "children": []}, "jobDescription": "", "skills": [{"skillName": "SQL"}, {"skillName": ""}, {"skillName": "Go"}], "unknown": {"x": [1]}}
    files = {
        "reply-0.json": json.dumps({"meta": {"nbPages": 4}, "data": [full, {"jobUrl": "b", "salaryMax": 900, "jobDescription": "x &amp; <b>y</b>", "skills": []}]}, indent=1),
        "reply-1.json": json.dumps({"meta": {"nbPages": 5}, "data": [{"jobUrl": "c", "salaryMin": "lots"}, None, {"jobUrl": "d", "prettySalary": "Deal", "jobFunction": {"parentNameVI": "P"}}, "text"]}),
        "reply-2.json": '{"meta": {"nbPages": 4}, "data": [{"jobUrl": "e"}', "reply-4.json": '{"meta": {"nbPages": 4}, "data": []}', "other.json": '{"meta": null}', "reply-7.json": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    saved = replies.saved(spark, str(tmp_path))
    assert {r.source.rsplit("/", 1)[1]: r.page for r in saved.collect()} == {"reply-0.json": 0, "reply-1.json": 1, "reply-2.json": 2, "reply-4.json": 4, "other.json": None}
    # A file without a byte is none to Spark.
    found = {(r.source.rsplit("/", 1)[1], r.position): r for r in replies.postings(replies.records(saved)).collect()}
    assert {k: v.error for k, v in found.items()} == {
        ("reply-0.json", 0): None, ("reply-0.json", 1): None, ("reply-1.json", 0): "record", ("reply-1.json", 1): "record", ("reply-1.json", 2): None, ("reply-1.json", 3): "record", ("reply-2.json", 0): "reply", ("other.json", 0): "reply"}
    a, b, d = found["reply-0.json", 0], found["reply-0.json", 1], found["reply-1.json", 2]
    assert (a.compensation, a.job_category, a.job_description, a.location, a.company_industry, a.experience, a.nb_pages) == ("1,500 - 20,000 USD", "P", "Skills: SQL, Go", None, None, "2", 4)
    assert (b.compensation, b.job_description, b.job_requirement, b.job_category) == ("0 - 900  /tháng", "x & y", None, None) and (d.compensation, d.job_category) == ("Deal", "P")
    assert found["reply-1.json", 0].job_url == "c" and found["reply-2.json", 0].record == files["reply-2.json"]
    lacks = replies.lacking(saved.withColumn("crawl", F.lit(None).cast("int")).fillna(1, ["crawl"]), ["crawl"])
    assert {r.page for r in lacks.collect()} == {2, 3}


def test_no_replies_and_stop(spark):
    none = spark.createDataFrame([], "page long, body string")
    assert replies.postings(replies.records(none)).count() == 0 and replies.lacking(none.withColumn("crawl", F.lit(1)), ["crawl"]).count() == 0
    body = json.dumps({"meta": {"nbPages": 2}, "data": [{"jobUrl": f"u{i}", "approvedOn": "old" if i == 2 else "new"} for i in range(4)]})
    twice = spark.createDataFrame([("x", 0, body), ("x", 1, body), ("y", 0, body.replace("old", "new")), ("y", 0, None)], "crawl string, page long, body string")
    got = replies.until(replies.postings(replies.records(twice)), ["crawl"], F.col("job_posted_at") == "old")
    assert sorted((r.crawl, r.page, r.position, r.job_url) for r in got.collect() if r.error is None) == [("x", 0, 0, "u0"), ("x", 0, 1, "u1"), *[("y", 0, i, f"u{i}") for i in range(4)]]
