"""op1, op3, op5 to op9 and the pipeline against brute force on small tables."""

import math
import random
import re

import numpy as np
import pytest

from vireo.llm import minhash, mixing, multi_index, pii, quality, stages, tagpaths, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(n, edges):
    group = list(range(n))
    for a, b in edges:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    return [min(i for i in range(n) if group[i] == g) for g in group]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((240, 8))
    x[200:230] = x[7] + 0.05 * rng.standard_normal((30, 8))
    x[231] = x[7]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    odd = [(300, None), (350, []), (400, [math.nan] * 8), (450, [None] * 8), (500, [0.0] * 8), (550, [1.0]), (None, [1.0] * 8), (0, rows[0][1])]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as v", "1 as n"), rows


def test_topk(vectors):
    df, rows = vectors
    ints = {i: [math.floor(256 * c) for c in v] for i, v in rows} | {500: [0] * 8}
    v = topk.integer_vectors(df)
    got = {}
    for r in topk.top_inner_products(v, v.where("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 150, 200, 500}
    for q, found in got.items():
        score = sorted((-sum(a * b for a, b in zip(ints[q], ints[i], strict=True)), i) for i in ints if i != q)
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(score[:5])]
    assert topk.top_inner_products(v.where("false"), v, 5).count() == 0
    assert topk.top_inner_products(v.where("vec_id < 2"), v.where("vec_id < 2"), 5).count() == 2


def test_topk_over_many_cells(spark):
    """Ties and merging across groups and blocks."""
    rng = np.random.default_rng(11)
    x = rng.integers(-2, 3, (300, 3))
    df = spark.createDataFrame([(int(i), [int(c) for c in v]) for i, v in enumerate(x)], "vec_id long, v array<long>")
    found = {}
    for r in topk.top_inner_products(df, df.where("vec_id % 3 = 0"), 5, group_rows=17, block_queries=13).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(found) == 100
    for q, mine in found.items():
        score = sorted((-int(x[q] @ x[i]), i) for i in range(300) if i != q)
        assert sorted(mine) == [(k + 1, i, -s) for k, (s, i) in enumerate(score[:5])]


def test_pruning_is_exact():
    rng = np.random.default_rng(2)
    c = rng.integers(-9, 9, (3000, 20)) * rng.integers(1, 30, (3000, 1))
    q, ids = rng.integers(-9, 9, (40, 20)), rng.permutation(3000)
    basis = np.linalg.svd(c[:500].astype(float), full_matrices=True)[2].T
    rows, found, score = topk.search_cell(q, np.full(40, -1), c, ids, basis, 5, head=6, step=256)
    for i in range(40):
        want = sorted((-int(s), int(v)) for s, v in zip(c @ q[i], ids, strict=True))[:5]
        assert [(-int(s), int(v)) for s, v in zip(score[rows == i], found[rows == i], strict=True)] == want


def test_vector_near_duplicates(vectors):
    df, rows = vectors
    x = np.asarray([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= 0.95
    np.fill_diagonal(hit, False)
    want = {i: (int(hit[i].sum()), c) for i, c in enumerate(components(len(x), np.argwhere(hit)))}
    got = {r.vec_id: r for r in multi_index.near_duplicates(df).collect()}
    assert set(got) == {*want, 300, 350, 400, 450, 500, 550, None}
    assert sum(n for n, _ in want.values()) > 800
    for i, r in got.items():
        assert (r.n_links, r.component_id) == want.get(i, (0, i)) and r.kept == (r.component_id == i)
    assert multi_index.near_duplicates(df.where("false")).count() == 0


def test_vector_near_duplicates_over_many_cells(spark):
    """Cells, sides and classes of copies against brute force."""
    rng = np.random.default_rng(12)
    centre = rng.standard_normal((60, 8))
    x = np.repeat(centre, 10, axis=0) + 0.12 * rng.standard_normal((600, 8))
    x[500:] = x[3]
    x = x.astype(np.float32).astype(float)
    got = {r.vec_id: r for r in multi_index.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), cell_rows=12, side=20).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    want = components(600, np.argwhere(hit))
    links = np.asarray([got[i].n_links for i in range(600)])
    assert (links <= hit.sum(1)).all() and links.sum() >= 0.99 * hit.sum() and hit.sum() > 12_000
    assert np.mean([got[i].component_id == want[i] for i in range(600)]) > 0.99 and all(got[i].n_links == links[3] for i in range(500, 600))
    index = multi_index.MultiIndex(unit, 600, cell_rows=12)
    assert len(index.first) * len(index.second) >= 36


def test_recall_on_hard_pairs():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    step = rng.standard_normal(x.shape)
    step -= (step * x).sum(1, keepdims=True) * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * step / np.linalg.norm(step, axis=1, keepdims=True)
    index = multi_index.MultiIndex(x, 100_000, cell_rows=512)
    home, _ = index.cells(y)
    _, seen = index.cells(x)
    assert np.mean([h in s for h, s in zip(home, seen, strict=True)]) > 0.99
    assert np.mean([len(s) for s in seen]) < 0.5 * len(index.first) * len(index.second)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 40, 120]))]
        for _ in range(rng.choice([1, 1, 3, 8])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 3, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(words).upper()
            out.append(" ".join(copy))
    out += ["", None, " \t\n", "one", "ONE", "one\x0btwo", "a" * 9000, " ".join(words * 8)]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, 0, 1) for i, t in enumerate(out)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int"), out


def test_text_near_duplicates(texts, spark):
    df, out = texts
    for size in (2, 5):
        sets = []
        for t in out:
            w = [x.encode().lower() for x in WORD.findall(t or "")]
            sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
        edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and 100 * len(a & b) >= 80 * len(a | b)]
        assert edges
        want = components(len(out), edges)
        # Two members a side: several blocks a bucket.
        got = {r.doc_id: r for r in minhash.near_duplicates(df, size, side=2 if size == 2 else minhash.SIDE).collect()}
        assert [(got[i].n_shingles, got[i].component_id, got[i].kept) for i in range(len(out))] == [(len(sets[i]), want[i], want[i] == i) for i in range(len(out))]
    assert minhash.near_duplicates(df.where("false")).count() == 0
    once = minhash.near_duplicates(df).where("kept").count()
    assert minhash.near_duplicates(df.union(df)).where("kept").count() == 2 * once


def test_superminhash_estimates():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    h = minhash.signatures([a, b, a, pool[:1], pool[:0]], 160)
    assert abs((h[0] == h[1]).mean() - 1 / 3) < 0.12 and (h[0] == h[2]).all()
    assert (h[3] != minhash.EMPTY).all() and (h[4] == minhash.EMPTY).all()


def test_personal_data(spark):
    samples = [
        "mail a.b@c.de_f@g.hi now", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004", "4539 1488 0343 6467 and 4539 1488 0343 6468", "+1 (555) 123-4567 x +12", "IBAN GB82 WEST 1234 5698 7654 32.",
        "ssn 123-45-6789 or 123-45-6789 far " + "x" * 60, None, "", "é🙂 x@y.zz", "9" * 5000, "a" * 20000 + "@", "@".join(["a"] * 3000), "1.1.1.1," * 500,
        "GB82 WEST 1234 5698 7654 32 AND MORE", "to DE89370400440532013000 BANK, NO9386011117947 OK", "GB82 WEST 1234 5698 7654 33 DE8937040044053201300 XX93 8601 1117 947"]
    df = spark.createDataFrame(list(enumerate(samples)), "doc_id long, text string").selectExpr("*", "0 as spans", "1 as score")
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    luhn = lambda x: sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(x))) % 10 == 0
    for i, t in enumerate(samples):
        t, want = t or "", []
        bare = lambda m: re.sub("[^0-9]", "", m[0])
        for kind, pattern, ok in (
                ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
                ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(bare(m)) <= 19 and luhn(bare(m))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(bare(m)) <= 15)):
            want += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, t) if ok(m)]
        spans = [s for s in got[i].spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in pii.BASE] == want
        assert got[i].base_sha256 == __import__("hashlib").sha256(",".join(want).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(w.startswith(k) for w in want) for k in pii.BASE]
    assert "iban:5:32" in got[4].spans
    assert got[5].spans == "national:4:15,national:19:30"
    assert got[13].spans == "iban:0:27" and got[14].spans == "iban:3:25,iban:32:47" and got[15].spans == ""
    masked = {r.doc_id: r.text for r in pii.redacted(df).collect()}
    assert masked[0] == "mail [PII][PII] now" and masked[8] == "é🙂 [PII]" and masked[6] is None
    assert pii.redacted(df).columns == df.columns
    assert pii.personal_data(df.where("false")).count() == 0


def test_mixing(spark, texts):
    df, out = texts
    got = {r.doc_id: r for r in mixing.mixed_documents(df).collect()}
    size = [len(WORD.findall(t or "")) for t in out]
    source = [f"s{i % 3}" if i % 7 else None for i in range(len(out))]
    total = {s: sum(n for n, x in zip(size, source, strict=True) if x == s) for s in set(source)}
    names = sorted(x for x in total if x) + [None]
    weight, target, left = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, {}, 1.5 * sum(size)
    live = set(names)
    while over := [s for s in live if left * weight[s] / sum(weight[x] for x in live) > 2 * total[s]]:
        shares = {s: 2.0 * total[s] for s in over}
        target |= shares
        live -= set(over)
        left -= sum(shares.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in live) for s in live}
    for i, r in got.items():
        assert (r["size"], r.source_size) == (size[i], total[source[i]]) and math.isclose(r.target, target[source[i]])
        assert r.taken <= 2 * r["size"]
    for s in names:
        assert abs(sum(r.taken for i, r in got.items() if source[i] == s) - target[s]) <= 64
    assert {r.doc_id: r for r in mixing.mixed_documents(df.repartition(5)).collect()} == got
    assert mixing.mixed_documents(df.where("false")).count() == 0
    assert mixing.mixed_documents(df.union(df)).count() == 2 * len(out)
    seen = mixing.slots(spark.createDataFrame([("a", 640 * 64, 1.0, 960.0 * 64)], "source string, source_size long, weight double, target double")).groupBy("block").count().collect()
    assert len(seen) == 640 and sorted(r["count"] for r in seen) == [1] * 320 + [2] * 320


def test_permutations_are_bijections(spark):
    sizes = [*range(1, 40), 63, 64, 65, 1000, 4097]
    plan = spark.createDataFrame([(f"s{n}", n * 8, 1.0, 16.0 * n) for n in sizes], "source string, source_size long, weight double, target double")
    got = mixing.slots(plan, block=8, shard_slots=100).collect()
    of = {}
    for r in got:
        of.setdefault(r.source, {})[r.slot] = (r.block, r.shard)
    for n in sizes:
        mine = of[f"s{n}"]
        assert sorted(mine) == list(range(2 * n))
        for half in (0, 1):
            assert sorted(mine[half * n + i][0] for i in range(n)) == list(range(n))
    big = [of["s4097"][i][0] for i in range(2 * 4097)]
    steps = np.diff(big[:4097]) % 4097
    assert np.unique(steps).size > 2000 and np.mean(np.asarray(big[:4097]) == np.asarray(big[4097:])) < 0.01


def test_shards_have_multinomial_counts(spark):
    plan = spark.createDataFrame([("a", 64_000, 1.0, 96_000.0), ("b", 32_000, 1.0, 16_000.0)], "source string, source_size long, weight double, target double")
    used = mixing.slots(plan, block=8, shard_slots=1500)
    counts = {(r.source, r.shard): r.slots for r in mixing.shard_counts(used).collect()}
    shards = {k for _, k in counts}
    assert len(shards) == -(-14_000 // 1500)
    for source, all_slots in (("a", 12_000), ("b", 2_000)):
        mine = np.asarray([counts[source, k] for k in sorted(shards)])
        expected = all_slots / len(shards)
        assert mine.sum() == all_slots and 1 < ((mine - expected) ** 2 / expected).sum() < 3 * len(shards)


def test_mixing_of_one_key(spark):
    """Null and repeated ids and rows alike, over several groups a source."""
    rows = [(None, "s", "w " * (i % 90)) for i in range(200)] + [(5, "s", "a b c d e f g")] * 50 + [(6, None, "x y")] * 9
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mixed_documents(df, block=16, group_rows=4, shard_slots=8).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in got) == sorted((d or 0, len(t.split())) for d, _, t in rows)
    whole = sum(len(t.split()) for _, s, t in rows if s)
    assert abs(sum(r.taken for r in got if r.source_size == whole) - got[0].target) < 40 and all(r.taken <= 2 * r["size"] for r in got)
    assert all((r.taken > 0) == (r.n_shards > 0) and (r.first_shard is not None) == (r.n_shards > 0) for r in got) and len({r.first_shard for r in got}) > 20
    again = mixing.mixed_documents(df.repartition(7), block=16, group_rows=4, shard_slots=8).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixed_stage_takes_the_same_words(texts):
    df, out = texts
    stage = stages.mixed(df)
    assert stage.columns == df.columns
    total = sum(len(WORD.findall(r.text)) for r in stage.collect())
    assert abs(total - 1.5 * sum(len(WORD.findall(t or "")) for t in out)) < 300


def test_pages(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
      <header>Site</header><div class="cookie-notice">We use cookies.</div><article><header><h1>Head&amp;line</h1></header><p>One <b>b</b>old,&nbsp;
      text.<p>Two<br>lines; <script>var a="</p>";</script>end.<aside>Side.</aside><div class="share">Share</div><form><p>Mail</form></article>
      <section id="comments"><p>Reader says a long thing, really long, very long indeed.</section><footer>&copy; us"""
    plain = "<div><ul><li>A<li>B</ul></div><div id=x><p>A long sentence, with marks; and more words to read.<p>Another long sentence, with marks, follows here.</div>"
    rows = [(0, "u", page), (1, None, None), (2, "u", ""), (3, "u", plain), (4, "u", "<p>a < b &lt;i&gt;"), (5, "u", "<div>" * 5000 + "deep text here"), (6, "u", "<!-- open <p>x")]
    got = {r.page_id: r for r in tagpaths.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].text == "Head&line One bold, text. Two lines; end."
    assert got[1].text == got[2].text == got[6].text == "" and got[1].n_chars == 0
    assert got[3].text.startswith("A long sentence") and got[3].text.endswith("here.")
    assert got[4].text == "a < b <i>" and got[5].text == "deep text here"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_path_scores_equal_the_formula():
    """Scores recomputed from the definition: sums a path, ratios, smoothing in page order, fusion."""
    rng = random.Random(8)
    for _ in range(30):
        page = "".join(f"<{tag}{rng.choice(['', ' class=x', ' class=ad'])}>{'word, ' * rng.randrange(1, 9)}<a href=u>{'link ' * rng.randrange(4)}</a>{rng.choice(['.', ''])}</{tag}>" for tag in rng.choices(["p", "div", "article", "h2"], k=12))
        found, paths, _ = tagpaths.blocks(page)
        weight, _ = tagpaths.weights(found, paths)
        of = lambda p: [b for b in found if b.path == p]  # noqa: B023, E731
        length = lambda p: sum(len(b.text) - b.linked for b in of(p)) / len(of(p))  # noqa: B023, E731
        marks = lambda p: sum(sum(c in ".,;:!?" for c in b.text) for b in of(p)) / len(of(p))  # noqa: B023, E731
        def smooth(f, i):
            near = [j for j in range(len(found)) if abs(i - j) <= 2]  # noqa: B023
            return sum(f(found[j].path) / (1 + abs(i - j)) for j in near) / sum(1 / (1 + abs(i - j)) for j in near)  # noqa: B023
        text = sum(len(b.text) for b in found) or 1
        unlinked = sum(len(b.text) - b.linked for b in found) or 1
        best = tagpaths.scores(found, weight)
        for p, score in best.items():
            near = [smooth(length, i) * (1 + smooth(marks, i)) for i, b in enumerate(found) if b.path == p]
            inside = [sum(len(x.text) for x in found if x.element.article == b.element.article) / text if b.element.article else 0 for b in of(p)]
            want = weight[p] * (1 + sum(inside) / len(inside)) * sum(len(b.text) - b.linked for b in of(p)) / unlinked * math.sqrt(sum(near) / len(near) * length(p) * (1 + marks(p)))
            assert math.isclose(score, want, rel_tol=1e-9, abs_tol=1e-12)
        # The paths chosen are those of the definition.
        assert tagpaths.content_paths(found, weight) == {p for p in best if best[p] > 0 and best[p] / max(best.values()) >= 0.12}


def test_pages_of_odd_markup():
    say = "<p>A long sentence, with marks; and more words to read than a menu has, some of them long, in every one of its parts.</p>"
    text = tagpaths.main_text(f"<article>{say * 3}</article>")
    for extra in ("<div class=teaser><p>See this, too</p></div>", "<div class=author-bio><p>By A. Writer</p></div>", "<nav><p>Menu here</p></nav>", "<div class=related-posts><h3>More</h3><ul><li><a href=x>One other</a><li><a href=y>And another</a></ul></div>"):
        assert tagpaths.main_text(f"<article>{say * 3}</article>{extra}") == text
        assert tagpaths.main_text(f"<div><div>{say * 3}</div>{extra}</div>") == text
    assert tagpaths.main_text(f"<article>{say}<div class=related-work>{say}</div>{say}</article>") == text
    odd = tagpaths.main_text(f"<article><p title=don't>It isn't gone, as one may see; it has words.</p>{say}<p title='>'>Nor this, with its words.</p></article>")
    assert odd.startswith("It isn't gone,") and odd.endswith("Nor this, with its words.")
    assert "The caption" in tagpaths.main_text(f"<article>{say}<figure><img src=x><figcaption>The caption</figcaption></figure>{say}</article>")
    deep = tagpaths.main_text("<article>" + "<x>" * 300 + "<p>First, with marks; of words.<p>Second, with marks; of words." + "</x>" * 300)
    assert deep == "First, with marks; of words. Second, with marks; of words."
    long = tagpaths.main_text(f"<article>{say * 20_000}</article>")
    assert long.count("A long sentence") == 20_000
    assert tagpaths.main_text("<p " + 'a="b" ' * 5000) == ""


def test_pages_keep_short_blocks_and_marked_wrappers():
    say = "<p>A long sentence, with marks; and more words to read than a menu has, some of them long, in every one of its parts.</p>"
    body = f"<h1>Head</h1>{say}<h2>Sub</h2>{say}<ul><li>One thing<li>Two</ul><p class=x>Short.</p>{say}"
    text = tagpaths.main_text(f"<article>{body}</article>")
    assert text.startswith("Head A long") and "Sub A long" in text and "One thing Two Short. A long" in text
    menu = "<div><ul><li><a href=a>Home</a><li><a href=b>News of the day</a></ul></div>"
    for page in (f"{menu}<div>{body}</div>", f"{menu}<div class='content has-sidebar'>{body}</div>", f"<div class='page sidebar'>{menu}<section>{body}</section></div>", f"{menu}<div id=a><h1>Head</h1></div><div id=b>{body[13:]}</div>"):
        assert tagpaths.main_text(page) == text
    assert tagpaths.main_text(f'<article><header class="entry-header"><h1>Head</h1></header>{body[13:]}<div class=related><p>Related.</div></article>') == text
    assert tagpaths.main_text(f"<div>{body}</div><h3>More</h3>{menu}<div class=ad>{say[:60]}</div>") == text


def test_pages_by_ratios_alone_and_marks_that_weigh():
    """Without names the ratios find the article; with them, marks do not keep out what holds the text, nor let in what ratios cannot tell."""
    say = "<p>A long sentence, with marks; and more words to read than a menu has, some of them long, in every one of its parts.</p>"
    text = tagpaths.main_text(f"<article>{say * 6}</article>")
    menu, foot = "<div><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></div>", "<div>(c) Someone, who lets others read this</div>"
    assert tagpaths.main_text(f"{menu}<div><section>{say * 6}</section></div>{foot}") == text
    assert tagpaths.main_text(f"{menu}<div class=widget><section>{say * 6}</section></div>{foot}") == text
    # Marked prose about as long as the article: comments stay out, within the article and beside it.
    for name in ("comments", "comment-list", "replies"):
        assert tagpaths.main_text(f"<article>{say * 6}</article><div class={name}>{say * 4}</div>") == text
        assert tagpaths.main_text(f"<div><div>{say * 6}</div><div class={name}>{say * 4}</div></div>") == text
    assert tagpaths.main_text(f"<article>{say * 6}</article><aside>{say}</aside><footer>{say}</footer>") == text
    found, paths, _ = tagpaths.blocks(f"<article>{say * 40}</article><footer>{say}</footer>")
    weight, plain = tagpaths.weights(found, paths)
    assert min(weight) > 0.29 and sum(plain) == len(plain) - 2
    # A page of a few words, most of them marked.
    assert tagpaths.main_text("<article><h1>To be.</h1><p>To be.</p></article><div class=ad>Buy this, or that, as you may.</div><footer>(c) Someone, who lets others read this and all</footer>") == "To be. To be."


def test_pages_keep_cells():
    say = "<p>A long sentence, with marks; and more words to read than a menu has, some of them long, in every one of its parts.</p>"
    text = tagpaths.main_text(f"<article>{say * 3}</article>")
    table = "<table><thead><tr><th>Name<th>Value</thead><tr><td>Alpha<td>12<tr><td>Beta<td>7</table>"
    assert tagpaths.main_text(f"<article>{say * 3}{table}</article>") == f"{text} Name Value Alpha 12 Beta 7"
    assert tagpaths.main_text(f"<div>{say * 3}<div>{table}</div></div><footer>Us</footer>").startswith(text)
    assert tagpaths.main_text(f"<article>{say * 2}{table}{say}</article>").split() == f"{tagpaths.main_text(say * 2)} Name Value Alpha 12 Beta 7 {tagpaths.main_text(say)}".split()
    assert tagpaths.main_text(f"<table><tr><td><ul><li><a href=x>Menu</a></ul><td><div>{say * 3}</div></table>") == text
    assert tagpaths.main_text(f"<article>{say * 3}</article><table class=sidebar><tr><td>Alpha</table>") == text


def test_pages_article_is_one_term():
    say = "<p>A long sentence, with marks; and more words to read than a menu has, some of them long, in every one of its parts.</p>"
    menu, advert = "<ul><li><a href=a>Home</a><li><a href=b>News</a></ul>", "<div>Buy now</div>"
    text = tagpaths.main_text(f"<article><h1>Head</h1>{say * 4}</article>")
    assert tagpaths.main_text(f"<article>{menu}<h1>Head</h1>{say * 2}{advert}{say * 2}{menu}</article>") == text
    teasers = "<article><h3><a href=c>Other</a></h3><p>See it.</p></article>" * 3
    assert tagpaths.main_text(f"<div id=body><h1>Head</h1>{say * 4}</div><div id=more>{teasers}</div>") == text


def test_quality(spark):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "slowly", "north", "past", "old", "towns", "and", "fields"]) for _ in range(60)) + "."
    bad = lambda: " ".join(rng.choice(["$$$", "BUY!!", "###", "now%%%", "click&&", ">>>"]) for _ in range(60))
    rows = [(i, good() if i % 3 else bad(), int(bool(i % 3))) for i in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (900, None), (901, "")], "doc_id long, text string").selectExpr("*", "0.5 as score", "1 as predicted")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (900, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    assert len(got) == 303 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i, _, _ in rows if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == {*held, None, *[i for i in (900, 901) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]}
    assert np.mean([got[i].predicted == rows[i][2] for i in held]) > 0.97
    kept = quality.kept_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    repeated = quality.fit(docs.union(docs.selectExpr("doc_id", "'~' || text", "score", "predicted")), labels)
    assert repeated.good == model.good and repeated.bad == model.bad
    nothing = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.scored(docs, nothing).collect()} == {0.5}
    assert quality.scored(docs.where("false"), model).count() == 0


def test_stage_near_duplicates(texts):
    df, out = texts
    kept = stages.distinct(df)
    want = {r.doc_id for r in minhash.near_duplicates(df, 5).collect() if r.kept}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == want
    assert stages.distinct(df.union(df)).count() == len(want)


def test_pipeline(spark, tmp_path):
    """run() against its stages' effects, each recomputed plainly, with a clashing and a further column."""
    import corpus_pipeline
    from tokenizers import Tokenizer
    from vireo.llm.tokens import vocabulary

    rng = random.Random(13)
    words = [f"{a}{b}" for a in ("ri", "lo", "me", "ta", "no") for b in ("ver", "wn", "tal", "sk", "rth")]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    rows = []
    for i in range(240):
        if i % 4 == 3:
            text = " ".join(rng.choice(["$$$", "BUY!!", "###", "now%%%", "click&&", ">>>"]) for _ in range(60))
        elif i % 10 == 5:
            text = rows[i - 5][1]
        elif i % 10 == 6:
            text = say(80) + f" write to a{i}@b.org or +1 (555) 123-4{i}"
        else:
            text = say(rng.choice([40, 90, 700]))
        rows.append((i, text))
    rows += [(300, None), (301, ""), (302, say(3000)), (302, say(3000)), (None, say(50))]
    table = [(i, t, "en", f"s{(i or 0) % 3}" if (i or 0) % 7 else None, len(t or ""), 1.5, 9) for i, t in rows]
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, kept int"
    spark.createDataFrame(table, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 != 3), 0) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append((docs.columns, docs.collect()))
    assert all(c == [x.split()[0] for x in columns.split(", ")] for c, _ in seen[:-1])
    text_of = {(i, t) for i, t in rows}
    good, single, masked, mixed, pieces = (found for _, found in seen)
    bad = {i for i in range(240) if i % 4 == 3}
    ids = [r.doc_id for r in good]
    assert not bad & set(ids) and {i for i, t in rows if t and i not in bad} <= set(ids) and {(r.doc_id, r.text) for r in good} <= text_of
    shingles = lambda t: {tuple(t.split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} if t and t.split() else set()
    sets = [(r.doc_id, r.text, shingles(r.text)) for r in good]
    left = {(r.doc_id, r.text) for r in single}
    for i, t, x in sets:
        smaller = [a for a, _, y in sets if a is not None and i is not None and a < i and x and 100 * len(x & y) >= 80 * len(x | y)]
        assert ((i, t) in left) == (not smaller)
    assert len(masked) == len(single) and not [r for r in masked if r.text and "@b.org" in r.text] and sum("[PII]" in (r.text or "") for r in masked) > 10
    size = lambda t: len(WORD.findall(t or ""))
    whole = {}
    for r in masked:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + size(r.text)
    got = {}
    for r in mixed:
        got[r.doc_id] = got.get(r.doc_id, 0) + size(r.text)
        assert r.n_chars == len(r.text)
    assert all(n <= 2 * whole[i] for i, n in got.items()) and abs(sum(got.values()) - 1.5 * sum(whole.values())) < 300
    library = Tokenizer.from_file(vocabulary(None))
    assert sum(p.length for p in pieces) == sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    filled = {}
    for p in pieces:
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert all([x for o, n in sorted(b) for x in (o, o + n)][1:-1] == [x for o, n in sorted(b)[1:] for x in (o, o)] for b in filled.values())
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    of = lambda found: sorted((p.doc_id or -1, p.start, p.doc_tokens) for p in found if p.start == 0)
    assert of(again) == of(pieces) and sum(p.length for p in again) == sum(p.length for p in pieces)


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    rng = random.Random(21)
    a, b, c = ([f"w{rng.randrange(5000)}" for _ in range(200)] for _ in range(3))
    near = lambda t, x: " ".join([*t[:-1], x])
    rows = [(2, " ".join(a)), (5, near(a, "x")), (5, " ".join(b)), (5, near(b, "y")), (9, " ".join(b)), (5, " ".join(c)), (5, " ".join(c)), (None, " ".join(a)), (7, None), (7, ""), (7, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, 5).where("doc_id is not null").collect())
    assert got == sorted([(2, 196, 2, True), (5, 196, 2, False), *[(5, 196, 5, True)] * 4, (9, 196, 5, False), *[(7, 0, 7, True)] * 3])
    kept = [(r.doc_id, r.text) for r in stages.distinct(df).collect()]
    of_b = [t for i, t in kept if i == 5 and t.startswith(b[0] + " ")]
    assert len(of_b) == 1 and of_b[0] in (" ".join(b), near(b, "y"))
    assert sorted(map(str, kept)) == sorted(map(str, [(2, " ".join(a)), (5, of_b[0]), (5, " ".join(c)), (None, " ".join(a)), (7, None), (7, "")]))
