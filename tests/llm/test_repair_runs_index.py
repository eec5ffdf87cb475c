"""Conversation repair, repeated runs and the positional index against brute force, and their edge cases."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import types as T

from vireo.llm import conversations, decontaminate, runs
from vireo.llm import queries as q

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("segment", T.IntegerType())])


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in texts], DOCS)


# Conversations --------------------------------------------------------------------


def cheapest(letters: str) -> tuple[int, str]:
    """The least (cost, audit) by search over all edits in order of cost and characters."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(letters) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        tail = roles if roles in ("", "s") else roles[-1] + "."
        if (i, tail) in seen:
            continue
        seen.add((i, tail))
        steps = [(2, "I", i, r) for r in "ua"]
        if i < len(letters):
            c = letters[i]
            steps.append((3, "D", i + 1, ""))
            if c != "d":
                cut = int(c.isupper())
                steps += [(cut, "K", i + 1, c.lower()), *[(2 + cut, "R", i + 1, r) for r in "ua"]]
        for more, edit, j, role in steps:
            if re.fullmatch("(s?(ua)*u?)?", roles + role):
                heapq.heappush(heap, (cost + more, audit + edit, j, roles + role))
    raise AssertionError


def test_audits_are_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(1500):
        letters = "".join(rng.choice("suaxSUAXd") for _ in range(rng.randint(0, 7)))
        assert conversations.solved(letters) == cheapest(letters), letters


def test_long_signatures_need_no_deep_recursion():
    cost, audit = conversations.solved("ua" * 20_000 + "d")
    assert (cost, len(audit), audit[-3:]) == (3, 40_001, "KKD")


def conversation(spark, rows):
    kind = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("audit", T.StringType())])
    return spark.createDataFrame([(*r, "other") for r in rows], kind)


def replayed(spark, rows):
    audited, repaired = conversations.repaired(conversation(spark, rows))
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: r["at"]):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    return {r["conv_id"]: r for r in audited.collect()}, lines


def test_repaired_rows(spark):
    audited, lines = replayed(spark, [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Still there?"), (1, 4, "assistant", "Yes"),
        (2, None, "user", "A."), (2, 1, "assistant", " \t"), (2, 2, "assistant", "B."), (2, 2, "assistant", "B."),
        (None, 5, None, None), (3, 7, "tool", "x."), (4, 2**63 - 1, "user", "a."), (4, -(2**63), "user", "b.")])
    assert lines[1] == ["system:Be kind.", "user:Hi.", "assistant:", "user:Still there?", "assistant:Yes"]
    assert [audited[1][c] for c in ("gaps", "illegal", "truncated", "cost", "audit")] == [1, 1, 1, 3, "KKIKK"]
    assert lines[2] == ["user:A.", "assistant:B."]
    assert [audited[2][c] for c in ("gaps", "blank", "duplicate", "illegal", "cost", "audit")] == [0, 1, 1, 2, 6, "KDKD"]
    assert [audited[None][c] for c in ("gaps", "blank", "cost", "audit")] == [0, 1, 3, "D"] and None not in lines
    assert audited[3]["audit"] == "D" and 4 in audited


def test_conversations_query(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", None, "tool"]), rng.choice([None, "", "A.", "A. b! c", "d?", " \n", "long " * 5000])) for _ in range(150)]
    conversation(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in q.op11_signature_repair(spark, str(tmp_path)).collect()}
    of = {}
    for conv, turn, role, text in rows:
        of.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else " " if role is None else role, text)
        of[conv] += [] if kind == 0 else [row, row] if kind == 3 else [row]
    assert got.keys() == of.keys()
    for conv, each in of.items():
        each.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = ["blank" if not r[2].strip(" \t\n\x0b\x0c\r") else "duplicate" if any(r[1:] == p[1:] for p in each[:i]) else "" if re.search(r"[.!?][ \t\n\x0b\x0c\r]*\Z", r[2]) else "truncated" for i, r in enumerate(each)]
        letters = "".join("d" if f in ("blank", "duplicate") else (r[1][:1] if r[1][:1] in "sua" else "x").upper() if f else (r[1][:1] if r[1][:1] in "sua" else "x") for r, f in zip(each, faults, strict=True))
        cost, audit = cheapest(letters)
        turns = {r[0] for r in each} - {None}
        lines, left, after = [], list(each), ""
        for edit in audit:
            row = left.pop(0) if edit != "I" else None
            if edit == "D":
                continue
            role = row[1] if edit == "K" else {"": "user", "s": "user", "u": "assistant", "a": "user"}[after]
            after = role[0]
            lines.append(f"{role}:{row[2] if row else ''}")
        want = {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(each, each[1:], strict=False)),
                **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "cost": cost, "audit": audit, "repaired_sha256": sha256("\n".join(lines).encode()).hexdigest()}
        assert {k: got[conv][k] for k in want} == want


def test_no_conversations(spark, tmp_path):
    conversation(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert q.op11_signature_repair(spark, str(tmp_path)).count() == 0


# Runs -----------------------------------------------------------------------------


def plain_runs(w) -> list[tuple[int, int, int]]:
    found = set()
    for p in range(1, len(w) // 3 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p) and not any(all(w[k] == w[k + d] for k in range(i, j + p - d)) for d in range(1, p)):
                found.add((i, j + p - i, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def with_repeats(rng, n, letters):
    out = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        at, p = rng.randint(0, n), rng.randint(1, 40)
        piece = [rng.randrange(letters) for _ in range(p)]
        m = rng.randint(2 * p, 5 * p + 20)
        out[at : at + m * rng.randint(0, 1)] = [piece[i % p] for i in range(m)]
    return out


def test_runs_are_all_runs():
    rng = random.Random(3)
    batch = [with_repeats(rng, rng.randint(0, 150), rng.choice([1, 2, 3, 50])) for _ in range(250)]
    lengths = np.array([len(x) for x in batch])
    doc, start, length, period = runs.runs_of(np.array([w for x in batch for w in x], np.int64), lengths)
    found = [[] for _ in batch]
    for d, *r in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
        found[d].append(tuple(r))
    assert found == [plain_runs(x) for x in batch]
    assert sum(map(len, found)) > 200


def test_names_of_many_positions_are_those_of_few(monkeypatch):
    rng = np.random.default_rng(1)
    left, right, at = rng.integers(0, 4, 300), rng.integers(0, 4, 300), np.arange(300)
    few = runs.named(left, right, at, 300)
    many = runs.named(left + 2**40, right, at, 300)
    assert ((few[:300, None] == few[None, :300]) == (many[:300, None] == many[None, :300])).all()


def test_runs_query(spark, tmp_path):
    rng = random.Random(4)
    texts = [(i, " ".join(f"w{x}" for x in with_repeats(rng, rng.randint(0, 200), rng.choice([1, 3, 80])))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, " \n\t "), (None, "a b"), (7, "é  x\ty"), (7, "é  x\ty"), (503, "again and " * 30_000), (504, "一 二 " * 50)]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(q.op12_name_doubling_runs(spark, str(tmp_path)).collect(), key=str)
    want = []
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        found = [(0, len(w), 2)] if i == 503 and h % 10 else plain_runs(w)
        drop = {j for s, n, p in found for j in range(s + p, s + n)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        want.append((i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(), sha256(" ".join(x for j, x in enumerate(w) if j not in drop).encode()).hexdigest()))
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted((type(got[0])(**dict(zip(got[0].__fields__, w, strict=True))) for w in want), key=str)]
    assert sum(r["n_runs"] > 0 for r in got) > 20


def test_runs_need_no_common_batch(spark):
    rng = random.Random(5)
    texts = docs(spark, [(i, " ".join(map(str, with_repeats(rng, 100, 3)))) for i in range(30)])
    one, many = (sorted(map(str, runs.periodic_runs(texts, batch_words=n).collect())) for n in (10**6, 1))
    assert one == many
    assert runs.periodic_runs(texts.where("false")).count() == 0


# Positional index ------------------------------------------------------------------


def word_list(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(rng):
    some = lambda n: " ".join(rng.choice(["The", "of", "a-b", "x1", "é", "zu", "Ünd", "k"]) for _ in range(n))
    items = [(1, some(14)), (10, some(25)), (2, some(3)), (3, "the"), (3, some(11)), (4, None), (5, " .,; "), (None, some(12)), (6, "nowhere to be found"), (7, "of of of of")]
    texts = [(i, some(rng.randint(0, 40))) for i in range(60)]
    texts += [(100 + i, f"{some(5)} {items[i % 2][1]} {some(4)}") for i in range(10)]
    texts += [(200, items[0][1]), (200, items[0][1]), (None, items[1][1]), (201, None), (202, ""), (203, "THE,OF;the"), (204, some(5000) + items[1][1])]
    return texts, items


@pytest.mark.parametrize("segment", [1, 300, 10**6])
def test_exact_matches(spark, segment):
    texts, items = corpus(random.Random(6))
    rows = spark.createDataFrame([(*i, 1.5) for i in items], "item_id long, text string, pattern double")
    got = decontaminate.exact_matches(docs(spark, texts), rows, 4, segment).collect()
    want = []
    for doc_id, text in texts:
        w, hit, named = word_list(text), set(), set()
        for item, t in items:
            x = word_list(t)
            for p in ([x[i : i + 4] for i in range(len(x) - 3)] or [x]) if x else []:
                for i in range(len(w) - len(p) + 1):
                    if w[i : i + len(p)] == p:
                        hit |= set(range(i, i + len(p)))
                        named.add("" if item is None else str(item))
        want.append((doc_id, len(w), len(hit), sorted(named)))
    assert sorted(map(str, [tuple(r) for r in got])) == sorted(map(str, want))
    assert sum(x[2] > 0 for x in want) > 20


def test_proximity_matches(spark):
    texts, items = corpus(random.Random(7))
    rows = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.proximity_matches(docs(spark, texts), rows, 7, 5, 300).collect()
    want = []
    for doc_id, text in texts:
        w, named = word_list(text), set()
        for item, t in items:
            x = word_list(t)
            if x and any(set(p) <= set(w[i : i + 7]) for p in ([x[i : i + 5] for i in range(len(x) - 4)] or [x]) for i in range(max(1, len(w) - 6))):
                named.add("" if item is None else str(item))
        want.append((doc_id, len(w), sorted(named)))
    assert sorted(str((r["doc_id"], r["n_words"], r["items"])) for r in got) == sorted(map(str, want))
    with pytest.raises(ValueError, match="within"):
        decontaminate.proximity_matches(docs(spark, texts), rows, 1000)


def test_long_texts_are_taken_apart_between_words(monkeypatch):
    text = ("Ab cd, " * 1000 + "é" * 5000 + " end.").encode()
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    pieces = list(decontaminate.words(text))
    assert len(pieces) > 50 and [w.decode() for p in pieces for w in p] == word_list(text.decode())


def test_empty_tables(spark):
    none, some = docs(spark, []), docs(spark, [(1, "a b c")])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.exact_matches(none, items).count() == 0
    assert [tuple(r) for r in decontaminate.exact_matches(some, items.where("false")).collect()] == [(1, 3, 0, [])]
    assert [tuple(r) for r in decontaminate.exact_matches(some, items).collect()] == [(1, 3, 2, ["1"])]
