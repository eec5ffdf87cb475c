"""Duplicate postings: an exact pass chained by gaps, then a fuzzy pass on titles.

The exact pass is windows only. The fuzzy pass is sequential by nature (each
chain is matched by its last title) within a block of company, province and
stretch of time without a gap that ends all chains. An index proposes and a
comparison confirms the similar titles of a block; they split it into pieces
without similar titles in common, and a grouped function folds each piece over
the pairs found. Blocks and pieces with one row, or without a new one, are left
out. Ties in the order fall to etl_id.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.functions.text import lowered, stripped
from vireo.operators.candidates import pieces, similar_among, similar_titles
from vireo.operators.lineage import settled
from vireo.operators.windows import gap_chains, latest

#: Rank of the sites whose postings are preferred as originals; all others rank 99.
SOURCE_RANKS = {"topcv": 1, "vietnamwork": 2, "careerviet": 3, "careerlink": 4}
FUZZY = 92
#: Rows of a block whose similar titles one task finds.
SMALL_BLOCK = 5000
#: Titles of a block that are sooner compared with each other than looked up.
FEW = 60
LINKS = "dup_id long, canon_id long, method string"
#: Names that a batch column may have, the first that exists counts.
RUN_COLUMNS = ("etl_run_id", "run_id", "batch_id", "etl_batch")


def source_rank(site: Column, ranks: dict[str, int] = SOURCE_RANKS) -> Column:
    out = F.lit(99)
    for name, rank in ranks.items():
        out = F.when(F.lower(site) == name, F.lit(rank)).otherwise(out)
    return out


def corpus(df: DataFrame, days: int | None = None, today: str | None = None) -> DataFrame:
    """Valid postings with a date (of the last `days` before `today`), the columns linkage needs
    and what batch columns there are."""
    columns = ["etl_id", *[c for c in RUN_COLUMNS if c in df.columns], "website_clean", "company_title_clean", "company_canonical_key", "location_province", "job_title_clean", "level_clean", "salary_min", "salary_max", "job_posted_at_clean"]
    df = df.where("is_valid and etl_id is not null and job_posted_at_clean is not null").select(*columns)
    return df if days is None else df.where(F.col("job_posted_at_clean") >= F.date_sub(F.to_date(F.lit(today)), days))


def run_column(columns: list[str]) -> str:
    """The batch column that the table has, of those in use."""
    for name in RUN_COLUMNS:
        if name in columns:
            return name
    raise ValueError(f"no batch column; one of {', '.join(RUN_COLUMNS)} is needed")


def keyed(df: DataFrame) -> DataFrame:
    """Postings that can be linked, with their comparison keys, one row an etl_id."""
    df = df.withColumns({
        "co": lowered("company_canonical_key"), "prov": stripped("location_province"), "lvl": lowered("level_clean"), "title": lowered("job_title_clean"), "rank": source_rank(F.col("website_clean")),
        "info": F.col("salary_min").isNotNull().cast("int") + F.col("salary_max").isNotNull().cast("int"), "day": F.datediff("job_posted_at_clean", F.lit("1970-01-01"))})
    return df.where((lowered("company_title_clean") != "unknown") & (F.col("co") != "") & (F.col("prov") != "") & (F.col("lvl") != "unknown") & (F.col("title") != ""))


def exact_links(df: DataFrame, is_new: Column, days: int) -> DataFrame:
    """(dup_id, canon_id, method) of keyed postings that repeat an earlier one."""
    chained = gap_chains(df, ["co", "prov", "title", "lvl"], F.col("day"), days, "etl_id", "day", "rank", F.desc("info"), "etl_id")
    return chained.where(is_new & (F.col("etl_id") != F.col("root"))).select(F.col("etl_id").alias("dup_id"), F.col("root").alias("canon_id"), F.lit("exact").alias("method"))


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """Normalised insert/delete similarity, 0 to 100."""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def title_similarity(a: str, b: str) -> float:
    """The greater of two token measures: sorted tokens compared, and shared tokens
    against shared plus further ones."""
    x, y = sorted(a.split()), sorted(b.split())
    if not x or not y:
        return 0.0
    one, two = set(x), set(y)
    both = " ".join(sorted(one & two))
    left, right = (" ".join(sorted(s)) for s in (one - two, two - one))
    best = indel(" ".join(x), " ".join(y))
    if both and (not left or not right):
        return 100.0
    with_left, with_right = (both + " " + left).strip(), (both + " " + right).strip()
    best = max(best, indel(with_left, with_right))
    if both:
        best = max(best, indel(both, with_left), indel(both, with_right))
    return best


def measures(title: str) -> tuple:
    """The title's tokens as a set, and length and letters of its tokens joined, with and without repeats."""
    tokens = title.split()
    one = set(tokens)
    return one, *(x for t in (tokens, one) for x in (sum(map(len, t)) + len(t) - 1, Counter(" ".join(t))))


def can_reach(a: tuple, b: tuple, least: float) -> bool:
    """False only where the titles of these measures are less similar than `least`; needs no alignment."""
    one, two = a[0], b[0]
    if not one or not two:
        return least <= 0
    shared = one & two
    if len(shared) in (len(one), len(two)):
        return True
    both = sum(map(len, shared)) + len(shared) - 1
    if shared and 200 * both >= least * (both + min(a[3], b[3])):
        return True
    for n, x, m, y in ((a[1], a[2], b[1], b[2]), (a[3], a[4], b[3], b[4])):
        if 200 * min(n, m) >= least * (n + m) and 200 * (x & y).total() >= least * (n + m):
            return True
    return False


def fuzzy_fold(rows: list[tuple], days: int, least: float = FUZZY) -> list[tuple[int, int]]:
    """(dup_id, canon_id) of one block; rows are (etl_id, day, title, level, is_new) in order."""
    return folded_on([], rows, days, least)[0]


def folded_on(held: list[tuple], rows: list[tuple], days: int, least: float = FUZZY) -> tuple[list[tuple[int, int]], list[tuple]]:
    """The links (dup_id, canon_id) of one block's rows, which meet the chains `held`, and the chains afterwards.

    Rows are (etl_id, day, title, level, is_new) in order, chains (root, day,
    title, level, begun). A row joins the live chain (last met within `days`)
    whose last title is most similar, at `least` or more and with equal level
    unless one is blank; the chain begun first wins ties. A row older than a
    chain's last one meets it if no more than `days` older, and leaves its day
    and title as they are. Titles already compared are not compared again, and
    those that cannot be similar enough are not aligned.
    """
    chains = [list(c) for c in held]
    measured = {c[2]: measures(c[2]) for c in chains}
    known: dict[tuple[str, str], float] = {}
    out = []
    for place, (eid, day, title, lvl, is_new) in enumerate(rows):
        chains = [c for c in chains if day - c[1] <= days]
        best, rank = None, None
        mine = measured.get(title) or measured.setdefault(title, measures(title))
        for c in chains:
            if c[3] and lvl and c[3] != lvl or c[1] - day > days:
                continue
            pair = (c[2], title)
            if pair not in known:
                if not can_reach(measured[c[2]], mine, least):
                    continue
                known[pair] = title_similarity(*pair)
            if known[pair] >= least and (best is None or (known[pair], -c[4]) > rank):
                best, rank = c, (known[pair], -c[4])
        if best is None:
            chains.append([eid, day, title, lvl, begun_at(day, place)])
            continue
        if day >= best[1]:
            best[1], best[2] = day, title
        best[3] = best[3] or lvl
        if eid != best[0] and is_new:
            out.append((eid, best[0]))
    return out, [tuple(c) for c in chains]


def folded(held: list[tuple], rows: list[tuple], days: int, least: float = FUZZY) -> tuple[list[tuple[int, int]], list[tuple]]:
    """As `folded_on`; similar titles of a larger block are found first."""
    titles = sorted({r[2] for part in (held, rows) for r in part})
    if len(titles) <= FEW:
        return folded_on(held, rows, days, least)
    number = {t: i for i, t in enumerate(titles)}
    plain = lambda part: [(*r[:2], number[r[2]], *r[3:]) for r in part]
    links, chains = chained_on(plain(held), plain(rows), similar_among(titles, least, title_similarity), days)
    return links, [(root, day, titles[t], lvl, begun) for root, day, t, lvl, begun in chains]


def begun_at(day: int, place: int) -> int:
    """A number that puts chains in order of the day of their first row, then of its place in the fold."""
    return day * 2**32 + place


def chained(rows: list[tuple], near: dict[int, dict[int, float]], days: int) -> list[tuple[int, int]]:
    """As `fuzzy_fold`, of rows (etl_id, day, title number, level, is_new), where `near` holds each title's similar titles
    and how similar they are: a row meets only the live chains that end in one of those."""
    return chained_on([], rows, near, days)[0]


def chained_on(held: list[tuple], rows: list[tuple], near: dict[int, dict[int, float]], days: int) -> tuple[list[tuple[int, int]], list[tuple]]:
    """As `folded_on`, of rows and chains with numbers of titles."""
    ends: dict[int, dict[int, list]] = {}
    for at, c in enumerate(held):
        ends.setdefault(c[2], {})[-1 - at] = [c[0], c[1], c[3], c[4]]
    out = []
    for place, (eid, day, title, lvl, is_new) in enumerate(rows):
        best, at = None, None
        similar = near.get(title, {})
        for other in (similar if len(similar) < len(ends) else [t for t in ends if t in similar]):
            live = ends.get(other)
            if not live:
                continue
            for number in [n for n, c in live.items() if day - c[1] > days]:
                del live[number]
            if not live:
                del ends[other]
            for number, chain in live.items():
                if chain[2] and lvl and chain[2] != lvl or chain[1] - day > days:
                    continue
                rank = (similar[other], -chain[3])
                if best is None or rank > best:
                    best, at = rank, (other, number)
        if at is None:
            ends.setdefault(title, {})[place] = [eid, day, lvl, begun_at(day, place)]
            continue
        other, number = at
        chain = ends[other].pop(number)
        if not ends[other]:
            del ends[other]
        last = title if day >= chain[1] else other
        chain[1], chain[2] = max(day, chain[1]), chain[2] or lvl
        ends.setdefault(last, {})[number] = chain
        if eid != chain[0] and is_new:
            out.append((eid, chain[0]))
    return out, [(c[0], c[1], title, c[2], c[3]) for title, live in ends.items() for c in live.values()]


def fuzzy_links(df: DataFrame, is_new: Column, days: int, least: float = FUZZY, small_block: int = SMALL_BLOCK) -> DataFrame:
    """(dup_id, canon_id, method) by title within company and province.

    Blocks of at most `small_block` rows are folded in one task each. In larger
    ones, similar titles are found over all tasks; chains stay among titles
    that similarity holds together, so a block falls into pieces that are
    folded each for itself, over the pairs found.
    """
    def block(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["day", "rank", "info", "etl_id"], ascending=[True, True, False, True], kind="stable")
        pairs = folded([], list(pdf[["etl_id", "day", "title", "lvl", "is_new"]].itertuples(index=False, name=None)), days, least)[0]
        return pd.DataFrame(pairs, columns=["dup_id", "canon_id"]).assign(method="fuzzy_title")

    def piece(pdf, edges):
        import pandas as pd

        near: dict[int, dict[int, float]] = {}
        for a, b, score in edges[["a", "b", "score"]].itertuples(index=False, name=None):
            near.setdefault(a, {})[b] = score
            near.setdefault(b, {})[a] = score
        pdf = pdf.sort_values(["day", "rank", "info", "etl_id"], ascending=[True, True, False, True], kind="stable")
        pairs = chained(list(pdf[["etl_id", "day", "title_id", "lvl", "is_new"]].itertuples(index=False, name=None)), near, days)
        return pd.DataFrame(pairs, columns=["dup_id", "canon_id"]).assign(method="fuzzy_title")

    rows = df.withColumn("is_new", is_new).select("co", "prov", "etl_id", "day", "rank", "info", "title", "lvl", "is_new")
    # No chain outlives a gap of more than `days`: each stretch between such gaps is folded on its own.
    rows = gap_chains(rows, ["co", "prov"], F.col("day"), days, "etl_id", "day", "rank", F.desc("info"), "etl_id").withColumnRenamed("root", "stretch")
    rows = settled(rows, "stretches")
    block_of = ["co", "prov", "stretch"]
    crowded = rows.groupBy(*block_of).agg(F.count("*").alias("n"), F.max("is_new").alias("any_new")).where("n > 1 and any_new")
    crowded = settled(crowded.withColumn("block", F.monotonically_increasing_id()).select(*block_of, "block", "n"), "blocks")
    rows = rows.join(crowded, block_of).drop(*block_of)
    small = rows.where(F.col("n") <= small_block).groupBy("block").applyInPandas(block, LINKS)
    if crowded.where(F.col("n") > small_block).isEmpty():
        return small
    rows = settled(rows.where(F.col("n") > small_block), "crowded")
    titles = settled(rows.select("block", "title").distinct().withColumn("title_id", F.monotonically_increasing_id()), "titles")
    edges = settled(similar_titles(titles, least), "similar-titles")
    placed = settled(pieces(titles, edges), "placed")
    # A title is similar to itself, whatever the least.
    own = titles.select(F.col("title_id").alias("a"), F.col("title_id").alias("b"), F.lit(100.0).alias("score"))
    numbered = settled(rows.join(titles, ["block", "title"]).join(placed, "title_id").select("piece", "etl_id", "day", "rank", "info", "title_id", "lvl", "is_new"), "numbered")
    kept = numbered.groupBy("piece").agg(F.count("*").alias("n"), F.max("is_new").alias("any_new")).where("n > 1 and any_new").select("piece")
    pairs = edges.unionByName(own).join(placed.withColumnRenamed("title_id", "a"), "a").join(kept, "piece")
    return small.unionByName(numbered.join(kept, "piece").groupBy("piece").cogroup(pairs.groupBy("piece")).applyInPandas(piece, LINKS))


def duplicates(new: DataFrame, history: DataFrame, days: int) -> DataFrame:
    """Links of `new` postings to earlier ones of both frames: exact ones first, then by title."""
    ids = new.select("etl_id").distinct().withColumn("is_new", F.lit(True))
    # A row that repeats an id counts once: the earliest, then the least title.
    once = latest(new.unionByName(history), ["etl_id"], "job_posted_at_clean", "job_title_clean", "website_clean", "company_canonical_key", "location_province", "level_clean")
    both = settled(keyed(once).join(ids, "etl_id", "left").withColumn("is_new", F.coalesce("is_new", F.lit(False))), "postings")
    exact = exact_links(both, F.col("is_new"), days)
    rest = both.join(exact.select(F.col("dup_id").alias("etl_id")), "etl_id", "left_anti")
    return exact.unionByName(fuzzy_links(rest, F.col("is_new"), days))


def daily(df: DataFrame, run_id: int, today: str, load_days: int = 90, match_days: int = 45) -> DataFrame:
    """Links of the postings of one run."""
    rows = corpus(df, max(load_days, match_days), today)
    run = F.col(run_column(rows.columns)) == run_id
    return duplicates(rows.where(run), rows.where(~F.coalesce(run, F.lit(False))), match_days)


def full(df: DataFrame, match_days: int = 45) -> DataFrame:
    """Links of all postings."""
    rows = corpus(df)
    return duplicates(rows, rows.where("false"), match_days)
