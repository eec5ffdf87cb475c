"""Quantiles from sketches of months against the rows'."""

import random

from pyspark.sql import functions as F

from vireo.plans import analytics


def test_merged_sketches(spark):
    rng = random.Random(5)
    rows = [(f"2026-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", rng.choice(["a", "b", None]), rng.choice([None, 5.0, rng.lognormvariate(3, 2), rng.random()])) for _ in range(60_000)] + [(None, "a", 1e9), ("2026-01-01", "small", 3.0), ("2026-02-01", "small", 1.0), ("2026-03-01", "small", 2.0), ("2026-03-01", "none", None)]
    df = spark.createDataFrame(rows, "day string, role string, pay double")
    sketches = analytics.salary_sketches(df, "day", ["role"], F.col("pay"))
    shares = (0.01, 0.5, 0.99)
    for since, before in ((None, None), ("2026-02-01", "2026-09-01")):
        found = analytics.salary_quantiles(sketches, ["role"], shares, since, before).cache()
        kept = df.where("day is not null").where(F.lit(True) if since is None else (F.col("day") >= since) & (F.col("day") < before))
        assert {r.role: r.postings for r in found.collect()} == {r.role: r.n for r in kept.where("pay is not null").groupBy("role").agg(F.count("*").alias("n")).collect()}
        for share in shares:
            errors = [r.rank_error for r in analytics.rank_errors(kept, found, ["role"], "pay", f"q{100 * share:g}", share).collect()]
            assert len(errors) == found.count() and max(errors) <= analytics.RANK_ERROR
        small = found.where("role = 'small'").first()
        assert small["q50"] == (2.0 if since is None else small["q50"]) and small["q50"] in (1.0, 2.0)
        found.unpersist()
    # A size that does not grow with the rows.
    assert sketches.agg(F.max(F.length("sketch"))).first()[0] < 8 * 4 * analytics.SKETCH_SIZE
    assert analytics.salary_quantiles(analytics.salary_sketches(df.where("false"), "day", ["role"], F.col("pay")), ["role"]).count() == 0


def test_rank_error(spark):
    rows = spark.createDataFrame([("a", float(x)) for x in range(100)] + [("b", 1.0)] * 10, "role string, pay double")
    found = spark.createDataFrame([("a", 69.0), ("b", 1.0)], "role string, q50 double")
    got = {r.role: round(r.rank_error, 6) for r in analytics.rank_errors(rows, found, ["role"], "pay", "q50", 0.5).collect()}
    assert got == {"a": 0.19, "b": 0.0}
