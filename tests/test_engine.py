"""Linkage, upserts, the load and the queries."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from vireo import schemas
from vireo.operators import lineage, linkage, upsert, windows
from vireo.plans import transform, warehouse
from vireo.sources import tables
from vireo.streaming import incremental

SMALL = "/root/testdata/sf0.001"


def fold(rows, longest):
    """(row, root) of one key's rows in order."""
    out, root, last = [], None, None
    for i, at in rows:
        if root is None or at - last > longest:
            root = i
        out.append((i, root))
        last = at
    return out


def test_chains_equal_a_fold(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("abc"), rng.randrange(400)) for i in range(300)]
    got = windows.gap_chains(spark.createDataFrame(rows, "id long, k string, at long"), ["k"], F.col("at"), 5, "id", "at", "id")
    want = [x for k in "abc" for x in fold([(i, at) for at, i in sorted((at, i) for i, q, at in rows if q == k)], 5)]
    assert {(r.id, r.root) for r in got.collect()} == set(want)


def postings(spark, rows):
    day = datetime.date(2026, 1, 1)
    full = [(i, run, "topcv", co, key, prov, title, lvl, None, None, day + datetime.timedelta(days=at), True) for i, run, co, key, prov, title, lvl, at in rows]
    return spark.createDataFrame(full, "etl_id long, etl_run_id long, website_clean string, company_title_clean string, company_canonical_key string, location_province string, job_title_clean string, level_clean string, salary_min double, salary_max double, job_posted_at_clean date, is_valid boolean")


def test_linkage(spark):
    rows = [(i + 1, 1, "A", "a", "HN", "Dev", "junior", at) for i, at in enumerate((0, 40, 80, 125, 171))]
    rows += [(10, 1, "B", "b", "HN", "java developer", "junior", 0), (11, 2, "B", "b", "HN", "java developer (hn)", "", 3), (12, 2, "B", "b", "HN", "java developer", "senior", 4), (13, 1, "unknown", "u", "HN", "Dev", "junior", 0), (14, 1, "unknown", "u", "HN", "Dev", "junior", 1)]
    got = {tuple(r) for r in linkage.full(postings(spark, rows)).collect()}
    assert got == {(2, 1, "exact"), (3, 1, "exact"), (4, 1, "exact"), (11, 10, "fuzzy_title")}
    assert {tuple(r) for r in linkage.daily(postings(spark, rows), 2, "2026-02-01").collect()} == {(11, 10, "fuzzy_title")}


def test_similarity():
    assert linkage.title_similarity("java developer", "developer java") == 100
    assert linkage.title_similarity("java developer", "java developer (hn)") == 100
    assert linkage.title_similarity("java developer", "nurse") < 60
    assert linkage.common_length("abcbdab", "bdcaba") == 4


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, "a", "x"), (None, "b", None)], "k int, v string, w string")
    new = spark.createDataFrame([(1, None, "y"), (None, "n", "z"), (3, "c", None)], "k int, v string, w string")
    got = {(r.k, r.v, r.w, r.upsert_status) for r in upsert.upsert(old, new, ["k"], {"v": "coalesce"}, with_status=True).collect()}
    assert got == {(1, "a", "x", "updated"), (None, "n", None, "updated"), (3, "c", None, "new")}


def staging(spark):
    base = {"website": "topcv", "job_title": "Senior Data Engineer", "company_title": "CTCP ABC", "location": "Hà Nội, TP.HCM", "experience": "2 năm", "compensation": "15 - 20 triệu", "job_description": "python, sql", "job_requirement": "ielts", "scraped_at": "2026-02-10T08:00:00", "job_posted_at": "05/02/2026"}
    rows = [{**base, "id": 1, "job_url": "u1"}, {**base, "id": 2, "job_url": "u2", "location": "", "company_title": ""}, {**base, "id": 3, "job_url": "u3", "job_title": " "}, {**base, "id": 4, "job_url": "u4", "location": ",".join("abcdefghij")}]
    rows = [r | {"is_valid": True, "ai_processed": True} for r in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.STAGING) for r in rows], schemas.STAGING)


def test_numbers_are_distinct_and_without_gaps(spark):
    rows = spark.range(3_000_000).selectExpr("pmod(xxhash64(id), 100000) k", "id", "id % 7 a", "repeat('x', cast(id % 5 as int)) b")
    got = upsert.with_numbers(rows, "n", ["k", "id"], groups=16)
    assert got.columns == ["k", "id", "a", "b", "n"]
    top = got.agg(F.count("*"), F.countDistinct("n"), F.min("n"), F.max("n"), F.countDistinct("id")).first()
    assert tuple(top) == (3_000_000, 3_000_000, 1, 3_000_000, 3_000_000)
    near = got.where("n between 1499990 and 1500010").orderBy("n").collect()
    assert [(r.k, r.id) for r in near] == sorted((r.k, r.id) for r in near)
    assert upsert.with_numbers(spark.createDataFrame([], "k int"), "n", ["k"]).count() == 0
    assert sorted(r.n for r in upsert.with_numbers(spark.createDataFrame([(None,), (None,), (1,)], "k int"), "n", ["k"]).collect()) == [1, 2, 3]


def test_load_is_idempotent(spark):
    cleaned, errors = transform.transformed(staging(spark), 7)
    assert {(r.src_id, r.error_type) for r in errors.collect()} == {(3, "MISSING_TITLE"), (4, "TOO_MANY_LOCATIONS")}
    cleaned = lineage.settled(cleaned.withColumn("duplicate_of_id", F.when(F.col("job_url") == "u2", F.col("etl_id") - 1)), "cleaned")
    assert cleaned.where("abs(etl_id) > 4294967296").count() == 3
    assert {(r.job_url, r.location_province, r.salary_min) for r in cleaned.collect()} == {("u1", "TP. Hà Nội", 15e6), ("u1", "TP. Hồ Chí Minh", 15e6), ("u2", "Khác", 15e6)}
    keep = lambda tables: {n: spark.createDataFrame(df.collect(), df.schema) for n, df in tables.items()}
    once = keep(warehouse.load(warehouse.empty(spark), cleaned, "2026-02-11"))
    for mode in ("today", "all"):
        again = warehouse.load(once, cleaned, "2026-02-12", mode, "7")
        for name, df in once.items():
            drop = [c for c in df.columns if c in ("created_at", "updated_at")]
            assert sorted(map(repr, df.drop(*drop).collect())) == sorted(map(repr, again[name].drop(*drop).collect())), (name, mode)
    fact = once["fact_jobpostings"]
    assert {r.etl_id for r in fact.collect()} == {r.etl_id for r in cleaned.collect()}
    assert [r.etl_id - r.duplicate_of_id for r in fact.collect() if r.duplicate_of_id is not None] == [1]
    assert fact.count() == 3 and fact.where("dia_diem_id is null or nganh_id is null or cong_ty_id is null or cap_bac_id is null or hinh_thuc_id is null").count() == 0
    assert {r.salary_avg for r in fact.collect()} == {17500000}
    assert once["bridge_jobrequire"].count() == 3 * once["dim_require"].count()
    assert warehouse.unique_postings(once).count() == 3


def test_batch_columns(spark):
    rows = postings(spark, [(1, 1, "B", "b", "HN", "java developer", "junior", 0), (2, 2, "B", "b", "HN", "java developer", "junior", 3), (2, 2, "B", "b", "HN", "java developer", "junior", 3)])
    for name in linkage.RUN_COLUMNS:
        assert {tuple(r) for r in linkage.daily(rows.withColumnRenamed("etl_run_id", name), 2, "2026-02-01").collect()} == {(2, 1, "exact")}
    with pytest.raises(ValueError, match="batch column"):
        linkage.daily(rows.withColumnRenamed("etl_run_id", "load_id"), 2, "2026-02-01")


def test_fuzzy_chains_end_at_gaps(spark):
    """Stretches between gaps are folded apart, with the same links as the block as a whole."""
    rng = random.Random(5)
    titles = ["java developer", "java developer hn", "developer java", "nurse", "night nurse", "chief nurse of the house"]
    rows = [(i, 1, "B", "b", "HN", rng.choice(titles) + " " + "x" * (i % 2), "junior", rng.choice((0, 60, 120, 300)) + rng.randrange(20)) for i in range(1, 120)]
    frame = linkage.keyed(linkage.corpus(postings(spark, rows))).withColumn("is_new", F.lit(True))
    got = {(r.dup_id, r.canon_id) for r in linkage.fuzzy_links(frame, F.col("is_new"), 45).collect()}
    ordered = sorted(frame.collect(), key=lambda r: (r.day, r["rank"], -r["info"], r.etl_id))
    assert got == set(linkage.fuzzy_fold([(r.etl_id, r.day, r.title, r.lvl, True) for r in ordered], 45)) and got


def test_blocks_under_a_heading():
    page = "<div>Far <section><p>" + "a " * 40 + "</p><div><h2>Why <i>Join</i> us</h2></div></section></div>"
    assert tables.block_under(page, "JOIN") == ("a " * 40).strip() + "\nWhy\nJoin\nus"
    assert tables.block_under("<div><h2>Join</h2>" + "b" * 9000 + "</div>", "join") is None
    assert tables.block_under("<div><h2>Join</h2></div><div><h3>join</h3><p>" + "c" * 60, "join") == "join\n" + "c" * 60
    assert tables.block_under(None, "x") is None and tables.block_under("<h2>x", "x") is None


def test_available_now(spark, tmp_path):
    seen = []
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    for _ in range(2):
        incremental.run_available(spark, source, spark.range(1).schema, str(tmp_path / "state"), lambda df, i: seen.append(df.count()))
    assert seen == [5]


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    names = contract.queries()
    assert len(names) > 70 and set(contract.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["fact_upsert_update_list", "nullsafe_join", "bi_skill_by_role", "dedup_exact_gap", "numbered_at_scale", "api_json_flatten", "load_bridge", "load_dimensions"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("orders", "part", "events", "customer", "nation", "region"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    got = contract.queries()[name](spark, SMALL)
    columns = sorted(got.columns)
    want = con.execute(contract.oracle_sql()[name]).df()[columns]
    text = lambda df: sorted(tuple("" if v is None or v != v else str(v) for v in row) for row in df.itertuples(index=False, name=None))
    assert text(got.toPandas()[columns]) == text(want)


def test_fuzzy_titles_are_whole_first_lines(spark, tmp_path):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(12)] + ["of", "and."]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(25)]
    start = "Fully the same start of a line that is longer than sixty characters. "
    lines += [start + "with one end of it", start + "and quite another way of going on from there", start + "with one end of its"]
    lines += [x[: rng.randint(0, len(x))] + rng.choice("xyz ") + x[rng.randint(0, len(x)) :] for x in lines] + [lines[20], ""]
    texts = [x + rng.choice(["", "\nNext line"]) for x in lines]
    spark.createDataFrame([(i, x, "en", "s") for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.dup_id, r.canon_id, r.method) for r in contract.queries()["dedup_fuzzy_title"](spark, str(tmp_path)).collect()}
    seen, want, chains = {}, set(), []
    for i, x in enumerate(lines):
        x = x.strip().lower()
        if x in seen and i - seen[x][1] <= 45:
            seen[x][1] = i
            want.add((i, seen[x][0], "exact"))
            continue
        if not x:
            continue
        seen[x] = [i, i]
        near = [(-linkage.title_similarity(c[1], x), k) for k, c in enumerate(chains) if i - c[2] <= 45]
        near = [n for n in near if n[0] <= -92]
        if near:
            chain = chains[min(near)[1]]
            chain[1], chain[2] = x, i
            want.add((i, chain[0], "fuzzy_title"))
        else:
            chains.append([i, x, i])
    assert got == want and {m for _, _, m in want} == {"exact", "fuzzy_title"}


def test_skills_are_searched_in_the_text(spark, tmp_path):
    texts = ["long " * 3000 + "Kafka, then MongoDB.", None, "x KOTLIN\ny", "nothing"]
    spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.hard for r in contract.queries()["skills_extract"](spark, str(tmp_path)).collect()}
    assert got == {0: "Docker, Kafka, Python, SQL", 1: "SQL", 2: "Kotlin", 3: "Docker, Python"}


def test_certificates_are_searched_in_the_text(spark, tmp_path):
    texts = ["long " * 3000 + "Holds ITIL and a TOPIK.", None, "", "x DELF\ny", "nothing", "hsk4"]
    spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.certifications, r.languages) for r in contract.queries()["cert_language_map"](spark, str(tmp_path)).collect()}
    always, both = "ielts, jlpt, n2", "Tiếng Anh, Tiếng Nhật"
    assert got == {0: ("ielts, itil, jlpt, n2, topik", "Tiếng Anh, Tiếng Hàn, Tiếng Nhật"), 1: (None, None), 2: (always, both), 3: ("delf", "Tiếng Pháp"), 4: (always, both), 5: ("hsk, hsk4", "Tiếng Trung")}


def test_heading_block_is_limited_by_its_text(spark):
    long, much = "<i>word</i> " * 1500, "word " * 1700
    pages = [(0, f"<h2>A</h2>{long}</article>"), (1, f"<h2>A</h2>{much}<h2>B</h2>{'word ' * 20}</article>"), (2, "<h2>A</h2>short</article>")]
    got = {r.page_id: r.block for r in tables.page_fields(spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string")).collect()}
    assert got == {0: ("word " * 1500).strip(), 1: None, 2: None}
