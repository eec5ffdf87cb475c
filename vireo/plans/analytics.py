"""Market questions over the star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.functions.dictionaries import EXPERIENCE_BINS, SALARY_BINS
from vireo.functions.parsers import binned


def share(df: DataFrame, by: str, measure: Column, name: str = "demand") -> DataFrame:
    """Sum of the measure by group and its share of the whole."""
    sums = df.groupBy(by).agg(F.sum(measure).alias(name))
    return sums.withColumn("share", F.round(F.col(name) / F.sum(name).over(Window.partitionBy()), 6))


def by_quarter(df: DataFrame, day: str, measure: Column) -> DataFrame:
    return df.groupBy(F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(F.sum(measure).alias("demand"))


def salary_in_vnd(df: DataFrame) -> Column:
    return F.col("salary_avg") * F.col("conversion_rate").cast("decimal(12,2)")


def salary_bins(df: DataFrame, amount: Column, by: list[str]) -> DataFrame:
    return df.where(amount.isNotNull()).groupBy(*by, binned(amount, SALARY_BINS).alias("bin")).agg(F.count("*").alias("postings"))


def experience_bins(df: DataFrame, years: Column, amount: Column) -> DataFrame:
    """Postings and median salary by band of required experience."""
    return df.where(years.isNotNull()).groupBy(binned(years, EXPERIENCE_BINS).alias("band")).agg(F.count("*").alias("postings"), F.percentile(amount, 0.5).alias("median_salary"))


#: KLL sketches of this size put a quantile within RANK_ERROR of its place (a share of the rows) but once in far more than a million
#: times; they hold some three times as many values, whatever the rows. Below this many rows they hold all, and are exact.
SKETCH_SIZE = 1024
RANK_ERROR = 0.01


def salary_sketches(df: DataFrame, day: str, by: list[str], amount: Column) -> DataFrame:
    """A row a month and group: month (its first day), postings with an amount, and the sketch of their amounts. Written once, it answers for any months.

    Amounts and days that are null take no part; null groups are groups.
    """
    rows = df.select(F.trunc(F.to_date(day), "month").alias("month"), *by, amount.cast("double").alias("__amount")).where("month is not null and __amount is not null")
    return rows.groupBy("month", *by).agg(F.count("*").alias("postings"), F.kll_sketch_agg_double("__amount", SKETCH_SIZE).alias("sketch"))


def salary_quantiles(sketches: DataFrame, by: list[Column | str], shares: tuple[float, ...] = (0.5,), since: str | None = None, before: str | None = None) -> DataFrame:
    """postings and the amount at each share (q50 for 0.5) by group of the months from `since` to before `before`, from their sketches alone.

    Each amount is one of the rows' and stands within RANK_ERROR of the share in their order.
    """
    if since:
        sketches = sketches.where(F.col("month") >= F.to_date(F.lit(since)))
    if before:
        sketches = sketches.where(F.col("month") < F.to_date(F.lit(before)))
    merged = sketches.groupBy(*by).agg(F.sum("postings").alias("postings"), F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("__merged"))
    return merged.select("*", *[F.kll_sketch_get_quantile_double("__merged", F.lit(s)).alias(f"q{100 * s:g}") for s in shares]).drop("__merged")


def rank_errors(rows: DataFrame, found: DataFrame, by: list[str], amount: str, quantile: str, share: float) -> DataFrame:
    """By group, how far (a share of the rows) a found quantile is from its place: 0 where rows equal to it cover that place."""
    named = found.select(*[F.col(c).alias(f"__{c}") for c in by], F.col(quantile).alias("__q"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    met = rows.where(F.col(amount).isNotNull()).join(named, same)
    n = met.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(amount) < F.col("__q")).alias("less"), F.count_if(F.col(amount) <= F.col("__q")).alias("upto"))
    return n.select(*by, F.greatest(F.col("less") / F.col("n") - share, share - F.col("upto") / F.col("n"), F.lit(0.0)).alias("rank_error"))


def skills_by_role(tables: dict[str, DataFrame]) -> DataFrame:
    fact = tables["fact_jobpostings"].select(F.col("posting_id").alias("fact_id"), "job_title_detect")
    named = tables["bridge_jobrequire"].join(fact, "fact_id").join(tables["dim_require"], "require_id")
    return named.where("require_type = 'hard_skill'").groupBy("job_title_detect", "require_value").agg(F.count("*").alias("postings"))


def all_against_unique(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("all_postings"), F.count_if(~F.col("is_duplicate")).alias("unique_postings"))
