"""Sharding by a hierarchical weighted hash tree.

A key descends from the root to a region, there to a rack and there to a shard.
At each level the children of the node that it has reached make a weighted hash
draw each, from the key, the level and the child, and the smallest draw wins: an
exponential variate of a rate that is the weight below the child. A change of
one leaf's weight changes no draw but those of its own path. So keys leave or
enter only subtrees whose weight changes, and keys elsewhere stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BITS = 52  # of a hash, for a draw
RACKS, PER_RACK = 2, 4


def winner(key: Column, level: str, children: Column, weight) -> Column:
    """The child with the least draw; a child of weight 0 never wins against one with weight."""
    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child), 64 - BITS).cast("double")
        w = weight(child)
        return F.struct(F.when(w > 0, -F.log((bits + 0.5) / float(2**BITS)) / w).otherwise(float("inf")).alias("d"), child.alias("child"))

    return F.array_min(F.transform(children, draw))["child"]


def with_shards(df: DataFrame, key: str, shards: dict[str, int], racks: int = RACKS, per_rack: int = PER_RACK, weights: Sequence[float] | None = None) -> DataFrame:
    """Add an int column for each of `shards`, named by its key: the shard
    (0..n-1) of column `key` when there are n shards.

    Shard s stands in rack s // per_rack, rack r in region r // racks; the last
    ones may be partly filled. Equal keys (null is a key) share a shard; weights
    default to equal, 0 leaves a shard empty. A shard that opens a region of
    its own takes keys only into itself.
    """
    of = F.col(f"`{key}`")

    def sums(values: list[float], size: int) -> list[float]:
        return [sum(values[i : i + size]) for i in range(0, len(values), size)]

    for out, n in shards.items():
        leaf = [float(w) for w in (weights or [1.0] * n)]
        leaf += [0.0] * (-len(leaf) % (racks * per_rack))
        rack = sums(leaf, per_rack)
        region = sums(rack, racks)
        of_node = lambda values: lambda child: F.element_at(F.array(*map(F.lit, values)), child + 1)
        below = lambda node, size: F.sequence(F.col(node) * size, F.col(node) * size + size - 1)
        # A column a level: each is used several times by the next.
        df = df.withColumn("__region", winner(of, "region", F.array(*map(F.lit, range(len(region)))), of_node(region)))
        df = df.withColumn("__rack", winner(of, "rack", below("__region", racks), of_node(rack)))
        df = df.withColumn(out, winner(of, "shard", below("__rack", per_rack), of_node(leaf))).drop("__region", "__rack")
    return df


def with_slot(df: DataFrame, shard: str, out: str, order: Sequence[str], rows: int, shards: int, group_rows: int = 2000) -> DataFrame:
    """Add long column `out`: places 0.. without gaps within each shard.

    Rows that are equal in all of `order` (shard and `order` must be all
    columns) are counted first and made rows again at the end. The others are dealt by a hash of `order` over groups of
    about `group_rows`; group counts are added up and rows are numbered inside
    their group, so no task holds a whole shard, nor all rows of one key.
    """
    groups = max(1, -(-rows // (shards * group_rows)))
    once = df.groupBy(shard, *order).agg(F.count("*").alias("__n")).withColumn("__group", F.pmod(F.xxhash64(*order), F.lit(groups)).cast("int"))
    counts = once.groupBy(shard, "__group").agg(F.sum("__n").alias("__sum"))
    before = Window.partitionBy(shard).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(shard, "__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__group").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = once.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(counts, [shard, "__group"])
    first = F.col("__before") + F.col("__inside")
    return placed.withColumn(out, F.explode(F.sequence(first, first + F.col("__n") - 1))).select(*df.columns, out)


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 24, group_rows: int = 2000) -> DataFrame:
    """Shard, slot and size of each document under the law `key`.

    size is the text's UTF-8 bytes plus 8 (null text: 8, checksum 0). doc_id
    and the number of shards decide alone; grown_shard is the shard when there
    is one more. Null ids are one key, repeated rows stay rows, no rows give
    no rows, further columns are ignored.
    """
    if shards % (RACKS * PER_RACK):
        raise ValueError(f"the law `key` needs a number of shards that fills whole regions of {RACKS * PER_RACK}")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("text_crc32"))
    base = with_shards(base, "doc_id", {"shard": shards, "grown_shard": shards + 1})
    base = with_slot(base, "shard", "slot", ["doc_id", "text_crc32", "size", "grown_shard"], docs.count(), shards, group_rows)
    return base.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
