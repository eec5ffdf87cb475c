"""Keyed upserts on plain tables, as joins (there is no MERGE on parquet).

Each gives the table as it is after the load; save_version() writes it beside
the old one, never over what is being read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.operators.lineage import settled

STATUS = "upsert_status"


def _matched(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    condition = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
    return old.withColumn("__old", F.lit(True)).alias("o").join(new.withColumn("__new", F.lit(True)).alias("n"), condition, "full_outer")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], rules: dict[str, str], with_status: bool = False) -> DataFrame:
    """`old` after `new` has been loaded: unmatched rows of both, and matched rows by
    each column's rule: `replace` (the new value), `keep` (the old one; also the
    default), `coalesce` (the new value unless null). Null keys match null keys.
    `new` must hold a key once. with_status adds `new`, `updated` or `kept`.
    """
    both = _matched(old, new, keys)
    columns = []
    for c in old.columns:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}") if c in new.columns else F.lit(None)
        rule = rules.get(c, "keep")
        met = {"replace": n, "keep": o, "coalesce": F.coalesce(n, o)}[rule]
        if c in keys:
            value = F.coalesce(o, n)
        else:
            value = F.when(F.col("__old").isNull(), n).when(F.col("__new").isNull(), o).otherwise(met)
        columns.append(value.cast(old.schema[c].dataType).alias(c))
    if with_status:
        columns.append(F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "kept").otherwise("updated").alias(STATUS))
    return both.select(*columns)


def status_counts(upserted: DataFrame) -> DataFrame:
    """One row: new_rows, updated_rows."""
    return upserted.agg(F.count_if(F.col(STATUS) == "new").alias("new_rows"), F.count_if(F.col(STATUS) == "updated").alias("updated_rows"))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`old` and those rows of `new` whose key it lacks; null keys equal null keys."""
    condition = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys])
    fresh = new.alias("n").join(old.select(*keys).alias("o"), condition, "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def default_row(old: DataFrame, row: dict) -> DataFrame:
    """`old` and the row, unless it is there."""
    one = old.sparkSession.createDataFrame([row], ", ".join(f"`{k}` {old.schema[k].dataType.simpleString()}" for k in row))
    return insert_ignore(old, one, list(row))


def with_surrogates(old: DataFrame, loaded: DataFrame, id_column: str, order: Sequence[str], large: bool = False) -> DataFrame:
    """Ids of rows that have none continue from the greatest, in the order of the
    natural key. New rows are numbered in one task unless the dimension is `large`."""
    top = old.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("__top"))
    given, fresh = loaded.where(F.col(id_column).isNotNull()), loaded.where(F.col(id_column).isNull()).drop(id_column)
    ranked = with_numbers(fresh, "__rank", order) if large else fresh.withColumn("__rank", F.row_number().over(Window.orderBy(*order)))
    numbered = ranked.crossJoin(F.broadcast(top)).withColumn(id_column, (F.col("__top") + F.col("__rank")).cast(old.schema[id_column].dataType)).drop("__top", "__rank")  # one row
    return given.unionByName(numbered)


def with_numbers(df: DataFrame, out: str, order: Sequence[str], groups: int | None = None) -> DataFrame:
    """Add 1.. (long) in order, without gaps, over a table of any size.

    Rows are range-partitioned over `groups` (default: the session's shuffle
    partitions) and written with their partition and place there, so counts and
    numbers come from the same rows; the counts, a row a group, are broadcast.
    Nulls sort first; rows equal in `order` are numbered in any order.
    """
    groups = groups or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = settled(df.repartitionByRange(groups, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__seq", F.monotonically_increasing_id()), "numbered")
    starts = parted.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__seq").alias("__first"))
    starts = starts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = parted.join(F.broadcast(starts.select("__part", "__first", "__before")), "__part")
    return numbered.withColumn(out, F.col("__before") + F.col("__seq") - F.col("__first") + 1).drop("__part", "__seq", "__first", "__before")


def save_version(df: DataFrame, root: str, name: str) -> str:
    """Write a new version of a table; gives its path. The caller switches to it."""
    path = f"{root}/{name}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def with_flags(df: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """Duplicate flags (is_duplicate, duplicate_of_id, dedup_method) of `flags` set, others kept."""
    named = flags.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in flags.columns if c != key])
    out = df.join(named, key, "left")
    return out.select(*[F.coalesce(f"__{c}", c).alias(c) if c in flags.columns and c != key else F.col(c) for c in df.columns])


def without_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_duplicate": F.lit(False), "duplicate_of_id": F.lit(None).cast(df.schema["duplicate_of_id"].dataType), "dedup_method": F.lit(None).cast("string")})
