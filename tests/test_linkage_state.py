"""Runs day by day give the links of one run over all rows."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from vireo.operators import linkage, linkage_state

COLUMNS = ("etl_id long, etl_run_id int, website_clean string, company_title_clean string, company_canonical_key string, location_province string, job_title_clean string, level_clean string, salary_min double, salary_max double, "
           "job_posted_at_clean date, is_valid boolean")
START = date(2026, 1, 1)


def postings(n, days, seed):
    rng = random.Random(seed)
    words = ["java", "senior", "developer", "kế toán", "trưởng", "nhân viên", "bán hàng", "data", "engineer", "lead"]
    titles = [" ".join(rng.sample(words, rng.randint(2, 5))) for _ in range(14)]
    titles += [t + "s" for t in titles]
    return [(i, 1, rng.choice(["topcv", "itviec", "careerlink"]), "c", rng.choice(["a", "a", "b", "c"]), rng.choice(["Hà Nội", "Huế"]), rng.choice(titles), rng.choice(["", "Junior", "Senior"]),
             rng.choice([None, 1.0]), None, START + timedelta(rng.randrange(days)), True) for i in range(n)]


def links(df):
    return sorted(tuple(r) for r in df.collect())


def in_runs(spark, path, rows, cuts, days, small_block):
    """All links of the runs that end before each cut (day numbers), and the state afterwards."""
    state, out = linkage_state.state_at(path, 8).create(spark), []
    for low, high in zip([0, *cuts], cuts, strict=False):
        part = [r for r in rows if low <= (r[10] - START).days < high]
        out += links(linkage_state.run(spark, state, spark.createDataFrame(part, COLUMNS), str(START + timedelta(high - 1)), days, small_block=small_block))
    return sorted(out), state


def test_runs_equal_the_full_run(spark, tmp_path):
    rows = postings(700, 60, 5)
    want = links(linkage.full(spark.createDataFrame(rows, COLUMNS), 6))
    assert {m for _, _, m in want} == {"exact", "fuzzy_title"} and len(want) > 100
    got, state = in_runs(spark, f"{tmp_path}/s", rows, [20, 21, 40, 60], 6, 5000)
    assert got == want
    # What is dead has gone from the state, as every bucket with rows was met again.
    state.expire(spark, linkage_state.alive(str(START + timedelta(59)), 6))
    low = (START - date(1970, 1, 1)).days + 53
    assert state.read(spark).where(F.col("day") < low).isEmpty() and not state.read(spark).isEmpty()


def test_crowded_blocks_go_on_over_the_index(spark, tmp_path):
    rows = postings(300, 20, 6)
    want = links(linkage.full(spark.createDataFrame(rows, COLUMNS), 9))
    got, _ = in_runs(spark, f"{tmp_path}/s", rows, [10, 20], 9, 1)
    assert got == want and want


def test_titles_alone_in_a_crowded_block_need_no_fold(spark, tmp_path, monkeypatch):
    """Begun or held, they pass as they are; they are met by later rows as in a full run."""
    plain = linkage_state._fold_piece

    def checked(days):
        fold = plain(days)

        def piece(pdf, edges):
            assert len(pdf) > 1
            return fold(pdf, edges)

        return piece

    monkeypatch.setattr(linkage_state, "_fold_piece", checked)
    names = ["".join(chr(97 + (i * k) % 26) for k in range(1, 12)) for i in range(1, 26)]
    one = lambda i, title, day: (i, 1, "topcv", "c", "a", "Huế", title, "", None, None, START + timedelta(day), True)
    rows = [one(i, t, 1) for i, t in enumerate(names)] + [one(100 + i, t, 9) for i, t in enumerate(["x" + names[3], names[4] + "x", "quite another", "once more else"])]
    want = links(linkage.full(spark.createDataFrame(rows, COLUMNS), 9))
    got, state = in_runs(spark, f"{tmp_path}/s", rows, [5, 10], 9, 1)
    assert got == want and {(100, 3), (101, 4)} <= {x[:2] for x in got}
    begun = {r.root: r.begun >> 32 for r in state.read(spark).where("pass = 'fuzzy'").collect()}
    first = (START - date(1970, 1, 1)).days
    assert begun[3] == begun[7] == first + 1 and begun[102] == first + 9


def test_a_run_can_be_repeated_and_late_rows_meet_what_there_is(spark, tmp_path):
    one = lambda i, title, day, level="": (i, 1, "topcv", "c", "a", "Huế", title, level, None, None, START + timedelta(day), True)
    frame = lambda *rows: spark.createDataFrame(list(rows), COLUMNS)
    state = linkage_state.state_at(f"{tmp_path}/s", 4).create(spark)
    go = lambda rows, day, version=None: links(linkage_state.run(spark, state, frame(*rows), str(START + timedelta(day)), 10, version=version))
    assert go([one(1, "java developer", 5), one(2, "kế toán", 5)], 5) == []
    second = [one(3, "java developer", 9), one(4, "developer java", 9), one(5, "kế toán", 30)]
    # The exact copy goes to the head of its chain, the like title too; after a gap a chain begins.
    assert go(second, 30) == [(3, 1, "exact"), (4, 1, "fuzzy_title")]
    assert go(second, 30, 1) == [(3, 1, "exact"), (4, 1, "fuzzy_title")]
    # Late: within ten days before the chain's last row, and too early for it.
    assert go([one(6, "kế toán", 25), one(7, "kế toán", 2)], 30) == [(6, 5, "exact")]
    assert go([], 31) == [] and state.read(spark).where("pass = 'exact' and root = 5").count() == 1
