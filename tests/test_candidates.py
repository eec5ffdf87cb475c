"""Similar titles by index, and chains over them, against comparing everything with everything."""

import random

import pytest
from pyspark.sql import functions as F

from vireo.operators import candidates, linkage

WORDS = ["senior", "junior", "data", "engineer", "developer", "java", "back", "end", "backend", "kế", "toán", "trưởng", "nhân", "viên", "kinh", "doanh", "it", "qa", "lead", "c++", "a", "b"]


def titles(rng, n):
    out = []
    for _ in range(n):
        t = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 6)))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(t))
            t = t[:at] + rng.choice(["", "x", "e", " "]) + t[at + rng.randint(0, 1) :]
        out.append(" ".join(t.split()) or "a")
    return out


@pytest.mark.parametrize("least", [60, 80, 92, 100])
def test_no_similar_pair_is_missed(spark, least):
    rng = random.Random(least)
    blocks = {b: sorted(set(titles(rng, 130))) for b in range(2)}
    rows = [(b * 1000 + i, t, b) for b, ts in blocks.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame(rows, "title_id long, title string, block long")
    got = {(r.a, r.b): r.score for r in candidates.similar_titles(frame, least).collect()}
    want = {(a, b): s for a, x, k in rows for b, y, m in rows if k == m and a < b and (s := linkage.title_similarity(x, y)) >= least}
    assert got == want and got


def test_pieces_are_connected_titles(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(150)] + [(i, i + 1) for i in range(500, 560)]
    ids = sorted({x for e in edges for x in e} | set(range(600, 610)))
    name = {i: i for i in ids}
    for _ in ids:
        for a, b in edges:
            name[a] = name[b] = min(name[a], name[b])
    frame = spark.createDataFrame([(i,) for i in ids], "title_id long")
    got = candidates.pieces(frame, spark.createDataFrame([(min(e), max(e)) for e in edges if e[0] != e[1]], "a long, b long"))
    assert {r.title_id: r.piece for r in got.collect()} == name


@pytest.mark.parametrize("small_block", [0, 1200, 5000])
def test_chains_equal_the_plain_fold(spark, small_block):
    rng = random.Random(3)
    pool = titles(rng, 300)
    rows = []
    for i in range(2500):
        b = int(rng.random() < 0.6)
        rows.append((f"c{b}", "p", i, rng.randint(0, 300) if b else rng.choice([*range(0, 40), *range(120, 130)]), rng.randint(1, 3), rng.randint(0, 2), rng.choice(pool), rng.choice(["", "senior", "junior"]), rng.random() < 0.7))
    frame = spark.createDataFrame(rows, "co string, prov string, etl_id long, day int, rank int, info int, title string, lvl string, new boolean")
    got = {(r.dup_id, r.canon_id) for r in linkage.fuzzy_links(frame, F.col("new"), 10, small_block=small_block).collect()}
    want = set()
    for co in ("c0", "c1"):
        each = sorted((r for r in rows if r[0] == co), key=lambda r: (r[3], r[4], -r[5], r[2]))
        want |= set(linkage.fuzzy_fold([(r[2], r[3], r[6], r[7], r[8]) for r in each], 10))
    assert got == want and len(got) > 500


def test_no_titles(spark):
    none = spark.createDataFrame([], "co string, prov string, etl_id long, day int, rank int, info int, title string, lvl string")
    assert linkage.fuzzy_links(none, F.lit(True), 10).count() == 0


def test_long_titles_of_few_syllables_over_many_tiles(spark, monkeypatch):
    """Titles of few syllables hold few rare pieces; a title gives at most two rows a word, and small tiles lose no pair."""
    monkeypatch.setattr(candidates, "TILE", 16)
    rng = random.Random(7)
    base = [" ".join("".join(rng.choice(["th", "an", "in", "er", "on", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 30))) for _ in range(60)]
    made = set(base)
    for t in base:
        for _ in range(2):
            at = rng.randint(0, len(t))
            made.add(" ".join((t[:at] + rng.choice(["", "x", "the ", " "]) + t[at + rng.randint(0, 3) :]).split()))
    rows = [(i, t, 0) for i, t in enumerate(sorted(made))]
    assert all(len(list(candidates.keys_of(t, 92))) <= 2 * len(t.split()) for _, t, _ in rows)
    got = {(r.a, r.b): r.score for r in candidates.similar_titles(spark.createDataFrame(rows, "title_id long, title string, block long"), 92).collect()}
    want = {(a, b): s for a, x, _ in rows for b, y, _ in rows if a < b and (s := linkage.title_similarity(x, y)) >= 92}
    assert got == want and len(got) > 60


def syllables(rng, n):
    """Titles of few syllables, the later half made from the first by a few changed letters or moved words."""
    base = [" ".join("".join(rng.choice(["th", "an", "in", "er", "on", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 60))) for _ in range(n // 2)]
    made = set(base)
    for t in base:
        at, words = rng.randint(0, len(t)), t.split()
        words.insert(0, words.pop(rng.randrange(len(words))))
        made.add(" ".join((t[:at] + rng.choice(["", "x", "the ", " "]) + t[at + rng.randint(0, 3) :]).split()) or "a")
        made.add(" ".join(words + rng.choice([[], [words[0]]])))
    return sorted(made)


@pytest.mark.parametrize("least", [60, 92, 100])
def test_similar_titles_of_one_task_are_those_of_all_comparisons(least):
    rng, compared = random.Random(least), []
    names = sorted({*syllables(rng, 160), *titles(rng, 120)})
    near = candidates.similar_among(names, least, lambda a, b: compared.append((a, b)) or linkage.title_similarity(a, b))
    want = {i: {j: linkage.title_similarity(a, b) for j, b in enumerate(names)} for i, a in enumerate(names)}
    assert near == {i: {j: s for j, s in x.items() if s >= least or i == j} for i, x in want.items()}
    # What has nothing in common is not compared in full: few comparisons find no link.
    assert least < 92 or len(compared) < len(names) + 2 * sum(len(x) - 1 for x in near.values())


@pytest.mark.parametrize("few, long", [(1, 1024), (1, 40), (10**9, 1024)])
def test_pairs_within_so_many_changes(monkeypatch, few, long):
    monkeypatch.setattr(candidates, "FEW_PAIRS", few)
    monkeypatch.setattr(candidates, "LONG", long)
    rng, rows = random.Random(few), []
    for _ in range(400):
        a = "".join(rng.choice("ab c") for _ in range(rng.choice([0, 5, 64, 65, rng.randint(0, 300)])))
        b = list(a if rng.random() < 0.8 else a[::-1])
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 2)] = rng.choice(["", "a", "b"])
        apart = len(a) + len(b) - 2 * linkage.common_length(a, "".join(b))
        rows += [(a, "".join(b), max(0, most), apart <= max(0, most)) for most in (apart - 1, apart, apart + 1, rng.randint(0, 40))]
    left, right, most, want = map(list, zip(*rows, strict=True))
    assert [bool(x) for x in candidates.within(left, right, most)] == want


def test_blocks_of_many_titles_fold_alike_with_held_chains():
    rng = random.Random(11)
    names = [*titles(rng, 150), *syllables(rng, 60)]
    rows = sorted((rng.randint(0, 60), i, rng.choice(names), rng.choice(["", "senior", "junior"]), rng.random() < 0.8) for i in range(900))
    rows = [(i, day, *rest) for day, i, *rest in rows]
    held = linkage.folded_on([], rows[:300], 9)[1]
    links, chains = linkage.folded(held, rows[300:], 9)
    want, left = linkage.folded_on(held, rows[300:], 9)
    assert links == want and len(links) > 100
    assert {c for c in chains if c[1] >= rows[-1][1] - 9} == {c for c in left if c[1] >= rows[-1][1] - 9}
