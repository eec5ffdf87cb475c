"""Mixing sources to target weights, with DataFrame operations only.

Each source's words, in a hashed order of its documents, are packed into
blocks of fixed length. Targets are turned into block slots. Every slot is
drawn into an output shard, which gives each shard multinomial source counts
(on condition that a source's counts add up to its target), and the source's
slots are mapped through a pseudorandom permutation of its block indices, a new
one each round. Blocks and slots are joined by index, which tells what the mix
takes of a document and into which shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import WORD, settle

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2.0
#: Words of a block; the aim for the number of rows that one window orders.
BLOCK, GROUP_ROWS = 64, 2000
SLOTS_OF_TASK = 131_072
SEED = 17
#: Slots of an output shard, on average.
SHARD_SLOTS = 65_536
#: Steps that a permutation walks at most; a domain of a * b >= n has fewer than a places outside 0..n-1.
WALK = 64


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources in code-point order, null last, weigh `weights` over and over and
    share `share` of all sizes. A target stops at `cap` times its source's
    size; what it leaves is shared by weight among the others until none is
    above. That end is found at once: with sources in order of cap / weight,
    a source is capped if an equal rate for all that follow would still lift
    it to its cap.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    df = sizes.withColumn("weight", weight).withColumn("__cap", F.col("source_size") * F.lit(float(cap)))
    whole = Window.partitionBy()
    by_rate = Window.orderBy(F.col("__cap") / F.col("weight"), F.col("source").isNull(), "source")
    df = df.withColumn("__all", F.sum("source_size").over(whole) * F.lit(float(share)))
    df = df.withColumn("__spent", F.coalesce(F.sum("__cap").over(by_rate.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    df = df.withColumn("__left", F.sum("weight").over(by_rate.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    df = df.withColumn("__rate", (F.col("__all") - F.col("__spent")) / F.col("__left"))
    df = df.withColumn("__capped", F.col("__rate") * F.col("weight") >= F.col("__cap"))
    open_rate = F.min(F.when(~F.col("__capped"), F.struct("__spent", "__rate"))).over(whole)["__rate"]
    target = F.when(F.col("__capped"), F.col("__cap")).otherwise(open_rate * F.col("weight"))
    return df.select("source", "source_size", "weight", target.alias("target"))


def hashed(*parts: Column | str) -> Column:
    return F.xxhash64(F.lit(SEED), *parts)


def keyed(source: str = "source") -> Column:
    """The source as a key that tells null from the empty name."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def placed(rows: DataFrame, groups: int) -> DataFrame:
    """Add `start` (long): a row's first word in its source's stream of words, and
    `copy`, which tells rows that are alike in all else apart.

    Rows alike are counted first and made rows again at the end. The others are
    dealt by hash of id and size over `groups`; group sums are added up and rows
    are ordered inside a group, so neither a large source nor an id that many
    rows share makes a large task.
    """
    once = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n")).withColumn("__source", keyed())
    once = once.withColumn("__group", F.pmod(hashed("doc_id", "size"), F.lit(groups)).cast("int")).withColumn("__words", F.col("size") * F.col("__n"))
    sums = once.groupBy("__source", "__group").agg(F.sum("__words").alias("__sum"))
    before = Window.partitionBy("__source").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__source", "__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__source", "__group").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    once = once.withColumn("__inside", F.coalesce(F.sum("__words").over(inside), F.lit(0))).join(sums, ["__source", "__group"])
    each = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    return each.withColumn("start", F.col("__before") + F.col("__inside") + (F.col("copy") - 1) * F.col("size")).drop("__group", "__before", "__inside", "__words", "__n")


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(source, shard, slot, block): the mix, a row a slot.

    A source with n blocks and m slots fills slots 0..m-1; round r of n slots is
    mapped through the source's r-th permutation of its blocks: whole rounds of
    all blocks, then a pseudorandom choice without repetition. Slots draw their
    shard by hash, so each shard has multinomial counts of its sources.
    """
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    df = plan.where("source_size > 0").withColumn("n", blocks)
    df = df.withColumn("m", F.least(F.round(F.col("target") / F.col("source_size") * F.col("n")).cast("long"), F.col("n") * int(CAP)))
    df = df.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.sum("m").over(Window.partitionBy()) / shard_slots)).cast("long")).where("m > 0")
    # The sides of the permutation's domain.
    df = df.withColumn("a", F.ceil(F.sqrt("n")).cast("long")).withColumn("b", F.floor((F.col("n") + F.col("a") - 1) / F.col("a")).cast("long"))
    # Stretches of slots, so that one large source is spread over tasks; a fixed number of
    # partitions, as their size in bytes does not tell how many slots they become.
    words = plan.agg(F.sum("target")).first()[0] or 0.0
    tasks = max(1, int(words / block) // SLOTS_OF_TASK)
    df = df.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1, F.lit(4096).cast("long"))))
    df = df.repartition(tasks, "source", "from").withColumn("slot", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + 4095, F.col("m") - 1))))
    df = df.withColumn("shard", F.pmod(hashed("source", "slot"), F.col("shards"))).withColumn("key", hashed("source", F.floor(F.col("slot") / F.col("n"))))
    return permuted(df.withColumn("i", F.col("slot") % F.col("n")), "i", "block").select("source", "shard", "slot", "block")


def shuffled(i: Column) -> Column:
    """One pass over the domain a * b: four rounds that add a hash of one coordinate to the other."""
    left, right = F.floor(i / F.col("b")).cast("long"), i % F.col("b")

    def turn(r: int, one: str, other: str, side: str):
        def moved(x: Column) -> Column:
            new = F.pmod(x[one] + hashed("key", F.lit(r), x[other]), F.col(side)).alias(one)
            return F.struct(new, x[other].alias(other)) if one == "l" else F.struct(x[other].alias(other), new)

        return moved

    # A lambda's argument is computed once, where nested expressions would be copied.
    start = F.array(F.struct(left.alias("l"), right.alias("r")))
    for r in range(4):
        start = F.transform(start, turn(r, *(("l", "r", "a") if r % 2 == 0 else ("r", "l", "b"))))
    return F.transform(start, lambda x: x["l"] * F.col("b") + x["r"])[0]


def permuted(df: DataFrame, i: str, out: str) -> DataFrame:
    """Add `out`: a permutation of 0..n-1 that `key` chooses, at `i`.

    df has n, a, b (a * b >= n) and key. A place outside 0..n-1 walks on until
    it is inside: that is a bijection, as each pass is one on 0..a*b-1.
    """
    df = df.withColumn("__first", shuffled(F.col(i)))
    step = lambda x, _: F.when(x < F.col("n"), x).otherwise(shuffled(x))
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.col("__first"), step)
    return df.withColumn(out, F.when(F.col("__first") < F.col("n"), F.col("__first")).otherwise(walked)).drop("__first")


def shard_counts(used: DataFrame) -> DataFrame:
    """(shard, source, slots): the multinomial counts of slots()."""
    return used.groupBy("shard", "source").agg(F.count("*").alias("slots"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(segments, plan) of the mix of `docs` (doc_id, source and further columns, size).

    segments has a row for each document and block that overlap and one, with
    null block, for a document without words: the columns of `docs`, `copy`
    and `start` (which identify a row), source_size, target, `block`, `begin`
    and `length` (words of the document there), `times`, how often the mix
    takes the block, and `shards`, where to. A null source is a source; no rows
    give no rows.
    """
    rows = settle(docs, "mixing-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = settle(targets(sizes, weights, share), "mixing-targets")
    at = placed(rows, max(1, -(-rows.count() // group_rows)))
    at = at.join(plan.select(keyed().alias("__source"), "source_size", "target"), "__source")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = at.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    begin = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    end = F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start"))
    parts = parts.withColumn("begin", begin).withColumn("length", end - F.col("begin"))
    # A block has at most CAP slots, so the list is short.
    uses = slots(plan, block, shard_slots).withColumn("__source", keyed()).groupBy("__source", "block").agg(F.count("*").alias("times"), F.sort_array(F.collect_list("shard")).alias("shards"))
    # Exploded rows are many more than the optimizer reckons: without the hint it would broadcast them.
    return parts.join(uses.hint("merge"), ["__source", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0))), plan


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """What the mix takes of each document.

    doc_id, size (words; 0 for a null text), source_size, target (its
    source's), taken: words the mix takes, repeats counted, at most twice the
    size, and, of the output shards that get them, the first (null: none) and
    the number. Repeated rows stay rows; a null doc_id stays null.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size"))
    segments, _ = mix(rows, weights, share, block, shard_slots, group_rows)
    keys = ["doc_id", "size", "source_size", "target", "__source", "start", "copy"]
    taken = segments.groupBy(*keys).agg(F.coalesce(F.sum(F.col("length") * F.col("times")), F.lit(0)).cast("long").alias("taken"), F.array_distinct(F.flatten(F.collect_list("shards"))).alias("__shards"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", F.array_min("__shards").alias("first_shard"), F.size("__shards").alias("n_shards"))
