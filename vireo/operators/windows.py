"""Window operators: latest row a key, chains broken by gaps, first k a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """One row a key, the first in `order` (pass a total order)."""
    return first_k(df, keys, 1, *order)


def first_k(df: DataFrame, keys: Sequence[str], k: int, *order: Column | str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def take_while(df: DataFrame, keys: Sequence[str], stop: Column, *order: str) -> DataFrame:
    """The rows of each key that stand, by `order` (columns, ascending, a total order), before its first row at which `stop` holds.

    Null `stop` does not hold; null keys are a key. Only the first stop of a key
    is sought, so nothing is sorted and a large key is aggregated where its rows are.
    """
    first = df.where(stop).groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("__stop"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(first, same, "left").where(F.col("__stop").isNull() | (F.struct(*order) < F.col("__stop"))).select(*df.columns)


def gap_chains(df: DataFrame, keys: Sequence[str], at: Column, longest_gap: int, row_id: str, *order: Column | str) -> DataFrame:
    """Add `root`: the row_id at the head of the row's chain. A row begins a chain
    when `at` (a number) is more than `longest_gap` past the row before it."""
    df = df.withColumn("__at", at)
    ordered = Window.partitionBy(*keys).orderBy(*order)
    gap = F.col("__at") - F.lag("__at").over(ordered)
    df = df.withColumn("__break", F.coalesce((gap > longest_gap).cast("int"), F.lit(1)))
    df = df.withColumn("__chain", F.sum("__break").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    head = Window.partitionBy(*keys, "__chain").orderBy(*order)
    return df.withColumn("root", F.first(row_id).over(head)).drop("__at", "__break", "__chain")
