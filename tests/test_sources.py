"""Staging by day, pages' blocks, and rows up to the first stop."""

import random

from pyspark.sql import functions as F

from vireo.operators import windows
from vireo.sources import tables


def test_a_day_opens_its_own_folder(spark, tmp_path):
    path = f"{tmp_path}/staging"
    rows = [(i, f"2026-02-{1 + i % 5:02d}T08:00:00+07:00") for i in range(50)] + [(50, None), (51, "soon")]
    tables.write_by_day(spark.createDataFrame(rows, "id long, scraped_at string"), path)
    back = spark.read.parquet(path)
    day = back.where("scrape_day = date'2026-02-03'")
    assert {r.id for r in day.collect()} == {i for i in range(50) if i % 5 == 2}
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scrape_day" in plan and "scrape_day=2026-02-03" in " ".join(day.inputFiles())
    assert {r.id for r in back.where("scrape_day is null").collect()} == {50, 51}
    days = spark.createDataFrame([("2026-02-01",), ("2026-02-04",), ("2026-02-04",)], "d string").select(F.to_date("d").alias("scrape_day"), F.lit(1).alias("run"))
    some = tables.of_days(back, days.where("run = 1"))
    assert {r.id for r in some.collect()} == {i for i in range(50) if i % 5 in (0, 3)}
    # A rerun of one day replaces that day alone.
    tables.write_by_day(spark.createDataFrame([(7, "2026-02-03 10:00")], "id long, scraped_at string"), path)
    again = spark.read.parquet(path)
    assert {r.id for r in again.where("scrape_day = date'2026-02-03'").collect()} == {7} and again.count() == 43


def test_take_while(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, *range(9)]), i, rng.choice([True, False, False, False, None])) for i in range(300)]
    frame = spark.createDataFrame(rows, "k int, at int, id int, old boolean")
    got = {r.id for r in windows.take_while(frame, ["k"], F.col("old"), "at", "id").collect()}
    want = set()
    for key in {r[0] for r in rows}:
        for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
            if r[3]:
                break
            want.add(r[2])
    assert got == want and got
    assert windows.take_while(frame.where("not old"), ["k"], F.col("old"), "at", "id").count() == sum(r[3] is False for r in rows)


def test_blocks_hold_no_code():
    words = "Long enough to be a block of its own, with many words in it."
    page = f"<div><h2>About</h2><script>var a = '<p>1</p>';</script><style>p {{}}</style><p>{words}</p></div>"
    assert tables.block_under(page, "about") == f"About\n{words}"
