"""Daily linkage from what earlier runs left: the live chains of each company and province.

A run reads and rewrites only the buckets of the blocks that it has rows in. The
state holds a row a live chain: of the exact pass its key, head and last day; of
the fuzzy pass its head, last day, last title and level. Where each run's rows
are no older than those of the runs before, the links are those of one full run
over all rows. A row that comes late meets the chains as they are now, if it is
no more than the window older than their last row, and does not move them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vireo import schemas
from vireo.operators import linkage
from vireo.operators.candidates import pieces, similar_titles
from vireo.operators.lineage import settled
from vireo.operators.versioned import Bucketed
from vireo.operators.windows import gap_chains, latest

STATE = schemas.columns("co string, prov string, pass string, title string, lvl string, root long, day int, begun long")
BLOCK = ["co", "prov"]
EXACT = [*BLOCK, "title", "lvl"]
ORDER = ["day", "rank", "info", "etl_id"]
FOLDED = "block long, dup_id long, root long, day int, title string, lvl string, begun long"


def state_at(path: str, buckets: int = 4096) -> Bucketed:
    """The table of live chains at a path; `create` begins it."""
    return Bucketed(path, STATE, (*BLOCK, "pass", "title", "lvl", "root"), tuple(BLOCK), buckets)


def exact_step(heads: DataFrame, fresh: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """(rows with root, heads afterwards): keyed rows chained with the live heads (EXACT, root, day) of their keys.

    Rows of one day and key come after a head of that day.
    """
    held = heads.select(*EXACT, F.col("root").alias("etl_id"), "day", F.lit(0).alias("rank"), F.lit(0).alias("info"), F.lit(True).alias("held"))
    rows = held.unionByName(fresh.withColumn("held", F.lit(False)))
    rows = gap_chains(rows, EXACT, F.col("day"), days, "etl_id", "day", F.desc("held"), "rank", F.desc("info"), "etl_id")
    anchor = F.max(F.when(F.col("held"), F.col("etl_id"))).over(Window.partitionBy(*EXACT, "root"))
    rows = settled(rows.withColumn("root", F.coalesce(anchor, "root")), "exact")
    return rows.where("not held").drop("held"), rows.groupBy(*EXACT).agg(F.max_by("root", "day").alias("root"), F.max("day").alias("day"))


def _fold(days: int, least: float):
    """The function of one small block: rows and chains to links and chains."""
    def block(pdf):
        held, rows = _parted(pdf, "title")
        return _frame(pdf["block"].iloc[0], *linkage.folded(held, rows, days, least))

    return block


def _fold_piece(days: int):
    """The function of one piece of a crowded block, with the similar titles in it."""
    def piece(pdf, edges):
        near: dict[int, dict[int, float]] = {}
        for a, b, score in edges[["a", "b", "score"]].itertuples(index=False, name=None):
            near.setdefault(a, {})[b] = score
            near.setdefault(b, {})[a] = score
        names = dict(zip(pdf["title_id"], pdf["title"], strict=True))
        held, rows = _parted(pdf, "title_id")
        links, chains = linkage.chained_on(held, rows, near, days)
        return _frame(pdf["block"].iloc[0], links, [(r, d, names[t], lvl, n) for r, d, t, lvl, n in chains])

    return piece


def _parted(pdf, title: str) -> tuple[list[tuple], list[tuple]]:
    pdf = pdf.sort_values(ORDER, ascending=[True, True, False, True], kind="stable").assign(is_new=True)
    held = pdf["begun"].notna()
    plain = lambda part, names: list(zip(*[part[n].tolist() for n in names], strict=True))
    return plain(pdf[held].astype({"begun": "int64"}), ["etl_id", "day", title, "lvl", "begun"]), plain(pdf[~held], ["etl_id", "day", title, "lvl", "is_new"])


def _frame(block: int, links: list[tuple[int, int]], chains: list[tuple]):
    import pandas as pd

    rows = [(block, dup, root, None, None, None, None) for dup, root in links] + [(block, None, *c) for c in chains]
    out = pd.DataFrame(rows, columns=["block", "dup_id", "root", "day", "title", "lvl", "begun"])
    return out.astype({"dup_id": "Int64", "day": "Int32", "begun": "Int64"})


def begun_first():
    """`begun` of a chain whose first row stands first in its fold."""
    return F.col("day").cast("long") * 2**32


def fuzzy_step(chains: DataFrame, fresh: DataFrame, days: int, least: float = linkage.FUZZY, small_block: int = linkage.SMALL_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(links, chains afterwards): keyed rows folded onto the live chains (BLOCK, title, lvl, root, day, begun) of their blocks.

    Blocks without a row pass as they are; a lone row begins a chain where it
    stands; a crowded block is split by similar titles, as in a full run.
    """
    met = fresh.select(*BLOCK).distinct()
    held = chains.join(met, BLOCK, "left_semi").select(*BLOCK, F.col("root").alias("etl_id"), "day", F.lit(0).alias("rank"), F.lit(0).alias("info"), "title", "lvl", "begun")
    rows = held.unionByName(fresh.select(*BLOCK, *ORDER, "title", "lvl", F.lit(None).cast("long").alias("begun")))
    blocks = settled(rows.groupBy(*BLOCK).agg(F.count("*").alias("n")).withColumn("block", F.monotonically_increasing_id()), "blocks")
    rows = settled(rows.join(blocks, BLOCK).drop(*BLOCK), "rows")
    lone = rows.where("n = 1").select("block", F.lit(None).cast("long").alias("dup_id"), F.col("etl_id").alias("root"), "day", "title", "lvl", begun_first().alias("begun"))
    folded = lone.unionByName(rows.where((F.col("n") > 1) & (F.col("n") <= small_block)).groupBy("block").applyInPandas(_fold(days, least), FOLDED))
    crowded = rows.where((F.col("n") > 1) & (F.col("n") > small_block))
    if not crowded.isEmpty():
        titles = settled(crowded.select("block", "title").distinct().withColumn("title_id", F.monotonically_increasing_id()), "titles")
        edges = settled(similar_titles(titles, least), "similar-titles")
        placed = settled(pieces(titles, edges), "placed")
        own = titles.select(F.col("title_id").alias("a"), F.col("title_id").alias("b"), F.lit(100.0).alias("score"))
        numbered = settled(crowded.join(titles, ["block", "title"]).join(placed, "title_id"), "numbered")
        # A title that has one row and is like no other begins a chain, or its chain stays: most pieces are such.
        single = numbered.groupBy("piece").agg(F.count("*").alias("rows")).withColumn("alone", F.col("rows") == 1).drop("rows")
        parted = numbered.join(single, "piece")
        alone = parted.where("alone").select("block", F.lit(None).cast("long").alias("dup_id"), F.col("etl_id").alias("root"), "day", "title", "lvl", F.coalesce("begun", begun_first()).alias("begun"))
        pairs = edges.unionByName(own).join(placed.withColumnRenamed("title_id", "a"), "a").join(single.where("not alone").select("piece"), "piece")
        # Pieces are many and small: by a number of partitions that is kept, as bytes say little of their work.
        tasks = int(fresh.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = [x.repartition(tasks, "piece").groupBy("piece") for x in (parted.where("not alone").drop("alone"), pairs)]
        folded = folded.unionByName(alone).unionByName(spread[0].cogroup(spread[1]).applyInPandas(_fold_piece(days), FOLDED))
    folded = settled(folded, "folded")
    links = folded.where("dup_id is not null").select("dup_id", F.col("root").alias("canon_id"), F.lit("fuzzy_title").alias("method"))
    after = folded.where("dup_id is null").join(blocks, "block").select(*BLOCK, "title", "lvl", "root", "day", "begun")
    return links, after.unionByName(chains.join(met, BLOCK, "left_anti").select(*after.columns))


def take_exact(spark: SparkSession, state: Bucketed, fresh: DataFrame, today: int, days: int) -> DataFrame:
    """Exact links (dup_id, canon_id) of keyed rows of one run, into a state that no fuzzy pass uses; `today` as days since 1970."""
    fresh = settled(fresh, "fresh")
    touched = settled(fresh.select(state.bucket().alias("bucket")).distinct(), "touched")
    held = settled(state.read(spark, touched=touched), "held")
    rows, heads = exact_step(held, fresh, days)
    state.replace(touched, heads.where(F.col("day") >= today - days).withColumns({"pass": F.lit("exact"), "begun": F.lit(None).cast("long")}).select(*STATE.names))
    return rows.where("etl_id <> root").select(F.col("etl_id").alias("dup_id"), F.col("root").alias("canon_id"))


def run(spark: SparkSession, state: Bucketed, new: DataFrame, today: str, days: int = 45, least: float = linkage.FUZZY, small_block: int = linkage.SMALL_BLOCK, version: int | None = None) -> DataFrame:
    """Links (dup_id, canon_id, method) of the postings `new` of one run, whose chains go into the state.

    Chains whose last row is more than `days` before `today` go from the buckets
    that the run rewrites; `state.expire` clears the others. To repeat a run, as
    after a failure, give the version of the state that it began with; no later
    run may have been taken since. A run without rows leaves the state as it is.
    """
    once = latest(linkage.corpus(new), ["etl_id"], "job_posted_at_clean", "job_title_clean", "website_clean", "company_canonical_key", "location_province", "level_clean")
    fresh = settled(linkage.keyed(once).select(*BLOCK, *ORDER, "title", "lvl"), "fresh")
    touched = settled(fresh.select(state.bucket().alias("bucket")).distinct(), "touched")
    held = settled(state.read(spark, version, touched), "held")
    rows, heads = exact_step(held.where("pass = 'exact'"), fresh, days)
    links, chains = fuzzy_step(held.where("pass = 'fuzzy'"), rows.where("etl_id = root").drop("root"), days, least, small_block)
    exact = rows.where("etl_id <> root").select(F.col("etl_id").alias("dup_id"), F.col("root").alias("canon_id"), F.lit("exact").alias("method"))
    out = settled(exact.unionByName(links), "links")
    after = heads.withColumns({"pass": F.lit("exact"), "begun": F.lit(None).cast("long")}).unionByName(chains.withColumn("pass", F.lit("fuzzy")))
    state.replace(touched, after.where(alive(today, days)).select(*STATE.names))
    return out


def alive(today: str, days: int):
    """Of a row of the state: whether a posting of `today` or later could still meet it."""
    return F.col("day") >= F.datediff(F.to_date(F.lit(today)), F.lit("1970-01-01")) - days
