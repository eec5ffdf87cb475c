"""op2, op4 and op10 against brute force on small tables."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from vireo.llm import packing, sharding, store
from vireo.llm.tokens import END, Encoder, vocabulary

TEXTS = ["Alpha beta, gamma! " * 40, None, "", "word", "Alpha beta, gamma! " * 40, "x" * 3000, "It's d'une\tÉté 12,5 🙂\n" * 300, "word"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "a", "b", 0) for i, t in enumerate(TEXTS)] + [(None, "lost", "a", "b", 0), (3, "word", "a", "b", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, size string, shard int").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary(None))


def ids(library, text):
    return np.asarray([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def test_chunks_give_the_librarys_ids(library):
    texts = [*TEXTS, "Ab.'s <|endoftext|>x", "İstanbul ΣΑΣ a b", "é é x y\x85z\x1cw"]
    code = Encoder(vocabulary(None))
    for _ in range(2):
        for text, packed in zip(texts, code.batch(texts), strict=True):
            assert np.frombuffer(packed, "<u2").tolist() == library.encode(text or "", add_special_tokens=False).ids


def odd_texts() -> list[str | None]:
    """Texts of pieces drawn from what may join, change or split in the vocabulary, white space of all kinds between them or none."""
    rng = np.random.default_rng(5)
    bits = ["ab", "Ab", "É", "é", "×", "÷", "ß", "ÿ", "x'", "'s", "don't", "'", "<", "<|endoftext|>", "<|ENDOFTEXT|>", "1", "12.5", ",", "!?", "_", "e\u0301", "\u0301", "İ", "ΣΑΣ", "漢字", "🙂", "µ", "\x1c", "\x7f", "\x00", "\x85", "\xa0", "\u3000", " ", "  ", "\n", "\x0b", "\x0c", "\t\r\n"]
    return [None, "", " ", *bits, *("".join(rng.choice(bits, rng.integers(1, 30))) for _ in range(2000))]


@pytest.mark.parametrize("kind", ["string", "large_string"])
def test_flat_ids_are_the_librarys(library, kind):
    texts = [*odd_texts(), *TEXTS]
    code = Encoder(vocabulary(None), remembered=100)
    assert code.apart
    for at in (0, 1, 900):
        ids, ends = code.flat(pa.array(texts, kind).slice(at, 1200), END)
        got = [x.tolist() for x in np.split(ids, ends)[:-1]]
        assert got == [[*library.encode(t or "", add_special_tokens=False).ids, END] for t in texts[at : at + 1200]]
    assert [x.tolist() for x in code.flat(pa.array([], kind), END)] == [[], []]


def test_flat_asks_for_a_piece_once_a_call():
    """The work grows with distinct pieces: words that differ in case or in what follows them are one."""
    code = Encoder(vocabulary(None))
    looked = []
    code.pieces = type("Counted", (dict,), {"__getitem__": lambda _, k: looked.append(k) or code._piece(k)})()
    code.flat(pa.array(["Word word, WORD. word"] * 500), END)
    assert sorted(looked) == [",", ".", "word"]


def test_cuts_of_a_document_do_not_depend_on_its_neighbours():
    rng = np.random.default_rng(3)
    table, docs = store.rolling_table(1 << 16), [rng.integers(0, 49408, n).astype("<u2") for n in (1, 3, 64, 65, 500, 9000, 40_000)]
    cut = lambda ids, at, n: store.boundaries([c for c in store.candidates(ids, table).tolist() if at < c < at + n], at, at + n)
    at = 0
    for d in docs:
        alone = cut(d, 0, len(d))
        assert [e - at for e in cut(np.concatenate(docs), at, len(d))] == alone
        assert alone[-1] == len(d) and all(store.LEAST <= n <= store.MOST for n in np.diff(alone[:-1], prepend=0))
        at += len(d)
    same = [np.concatenate([rng.integers(0, 49408, n), docs[-1]]).astype("<u2") for n in (10, 777)]
    ends = [{len(s) - e for e in cut(s, 0, len(s))} for s in same]
    assert len(ends[0] & ends[1]) > 0.8 * len(ends[0]) > 60


def test_store_round_trip(docs, empty, library):
    written = store.write_store(docs)
    rows = store.starts_and_checksums(written).collect()
    want, at = [], 0
    for doc, text in sorted([(r.doc_id, r.text) for r in docs.collect()], key=lambda r: (r[0] is not None, r[0] or 0)):
        x = ids(library, text)
        want.append((doc, at, len(x), zlib.crc32(x)))
        at += len(x)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    chunks = [bytes(r.digest) for r in written.where("kind = 'chunk'").collect()]
    assert len(chunks) == len(set(chunks)) > 0
    assert store.starts_and_checksums(store.write_store(empty)).count() == 0


def test_store_notices_damage(spark, docs):
    written = store.write_store(docs)
    bad = written.withColumn("ids", __import__("pyspark.sql.functions", fromlist=["x"]).expr("case when kind = 'doc' and length(ids) > 0 then overlay(ids placing X'0000' from 1) else ids end"))
    with pytest.raises(Exception, match="does not match its digest"):
        store.starts_and_checksums(bad).collect()


def test_packing_is_exact_and_tight(docs, empty, library):
    rows = packing.pack_documents(docs.where("doc_id is not null and doc_id <> 3")).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for doc, text in enumerate(TEXTS):
        if doc == 3:
            continue
        x, at = ids(library, text), 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(x), zlib.crc32(x[at : at + p.length]))
            at += p.length
        assert at == len(x)
    for held in bins.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and (at & (at - 1) == 0 or at >= 2048 - packing.SLACK)
    assert packing.pack_documents(empty).count() == 0
    assert packing.pack_documents(docs).agg({"length": "sum"}).first()[0] == sum(len(ids(library, r.text)) for r in docs.collect())


@pytest.mark.parametrize("capacity, waiting", [(2048, 64), (100, 3), (64, 1), (7, 2), (1, 1)])
def test_harmonic_bins(capacity, waiting):
    rng = np.random.default_rng(capacity)
    lengths = [int(x) for x in np.minimum(rng.geometric(3 / capacity if capacity > 3 else 0.5, 700), 3 * capacity + 1)]
    packer = packing.HarmonicPacker(capacity, 5, waiting=waiting)
    for i, n in enumerate(lengths):
        packer.add(i, rng.integers(0, 99, n).astype("<u4"))
        assert len(packer.gaps) <= waiting and all(len(b) < k for k, b in packer.open.items())
    at_end = len(packer.done)
    packer.close()
    bins, pieces = defaultdict(list), defaultdict(list)
    for doc, start, n, _, total, sequence, offset in packer.done:
        bins[sequence].append((offset, n))
        pieces[doc].append((start, n))
        assert n > 0 and total == lengths[doc]
    for doc, found in pieces.items():
        assert [x for s, n in sorted(found) for x in range(s, s + n)] == list(range(lengths[doc]))
    filled = {q: sum(n for _, n in b) for q, b in bins.items()}
    for q, b in bins.items():
        assert [x for o, n in sorted(b) for x in range(o, o + n)] == list(range(filled[q]))
        assert filled[q] <= capacity and (filled[q] >= capacity - packer.slack or filled[q] & (filled[q] - 1) == 0)
    assert set(pieces) == set(range(700)) and min(bins) == 5 and max(bins) == 4 + len(bins)
    # Before the end, a sequence begins with as many documents as its first one's class has.
    for q in {r[5] for r in packer.done[:at_end]}:
        first = min(bins[q])[1]
        if first < capacity and waiting == 64:
            k = min(capacity // first, packer.classes)
            assert len(bins[q]) >= k and all(min(capacity // n, packer.classes) == k for _, n in sorted(bins[q])[:k])


def test_packing_keeps_documents_whole():
    rng = np.random.default_rng(9)
    packer = packing.HarmonicPacker(2048, 0)
    for i in range(4000):
        packer.add(i, np.zeros(int(rng.integers(20, 900)), "<u4"))
    packer.close()
    assert len(packer.done) < 1.4 * 4000


def test_shards(spark, docs, empty):
    rows = sharding.shard_documents(spark, docs).collect()
    assert len(rows) == docs.count()
    assert {(r.doc_id, r["size"]) for r in rows} == {(r.doc_id, len((r.text or "").encode()) + 8) for r in docs.collect()}
    assert sharding.shard_documents(spark, empty).count() == 0
    many = spark.range(20_000).selectExpr("id as doc_id", "repeat('x', cast(id % 7 as int)) as text")
    rows = sharding.shard_documents(spark, many).collect()
    slots = defaultdict(list)
    for r in rows:
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert len(slots) == 24
    assert all(sorted(s) == list(range(len(s))) and 600 < len(s) < 1070 for s in slots.values())
    assert 600 < sum(r.grown_shard == 24 for r in rows) < 1000


def test_shards_of_one_key(spark):
    """Null and repeated ids, and rows that are alike, over several groups a shard."""
    rows = [(None, f"t{i % 50}") for i in range(300)] + [(7, "same")] * 40 + [(8, f"u{i}") for i in range(60)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(spark, df, group_rows=1).collect()
    assert sorted((r.doc_id or -1, r.text_crc32, r["size"]) for r in got) == sorted((d or -1, zlib.crc32((t or "").encode()), len(t or "") + 8) for d, t in rows)
    assert {r.law for r in got} == {"key"} and len({r.shard for r in got if r.doc_id is None}) == 1
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    with pytest.raises(ValueError, match="whole regions"):
        sharding.shard_documents(spark, df, 23)


def test_movement_is_confined(spark):
    """A leaf that gains weight draws keys into its region, within it into its rack, within that to itself."""
    df = spark.range(20_000).withColumnRenamed("id", "k")
    place = lambda s: (s // 8, s // 4, s)
    for before, after, leaf in (([1.0] * 16, [1.0] * 5 + [3.0] + [1.0] * 10, 5), ([1.0] * 9, [1.0] * 10, 9), ([1.0] * 24, [1.0] * 25, 24), ([1.0], [1.0, 1.0], 1)):
        both = sharding.with_shards(sharding.with_shards(df, "k", {"a": len(before)}, weights=before), "k", {"b": len(after)}, weights=after).collect()
        moved = [(place(r.a), place(r.b)) for r in both if r.a != r.b]
        assert moved and all(next(y for x, y in zip(a, b, strict=True) if x != y) in place(leaf) for a, b in moved)
    weighed = sharding.with_shards(df, "k", {"a": 4}, weights=[1, 0, 2, 1]).groupBy("a").count().collect()
    got = {r.a: r["count"] for r in weighed}
    assert set(got) == {0, 2, 3} and 9500 < got[2] < 10500


def test_the_tree_places_keys(spark):
    df = spark.range(5_000).withColumnRenamed("id", "k")
    trees = [[r.a for r in sharding.with_shards(df, "k", {"a": 24}, racks, per_rack).orderBy("k").collect()] for racks, per_rack in ((2, 4), (1, 24), (3, 2))]
    for one, two in ((0, 1), (0, 2), (1, 2)):
        assert np.mean([a == b for a, b in zip(trees[one], trees[two], strict=True)]) < 0.5
    assert all(min(np.bincount(t, minlength=24)) > 140 for t in trees)
