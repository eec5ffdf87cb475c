"""Near-duplicate documents by SuperMinHash.

Each shingle draws, step by step, one rank of a random permutation of the
signature's places and a fraction; a place keeps the least step + fraction.
Ranks of one shingle are correlated (no place twice), which lowers the
estimate's variance, and a document is done at the first step after which
every place is filled. Bands of the signature make buckets; candidates are
confirmed on the full sets; groups are joined by distributed union.

Copies (equal sets) are one class before anything else; a class has a number of
its own, so rows that share a doc_id but not their text stay apart. In a bucket all
members are compared with two pivots, the least member and one chosen by hash;
what that has joined needs no further comparison. Members of a bucket that are
still apart are then compared exhaustively, in blocks of bounded size, first
by signature and then by short hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import components, only_memory, settle

#: Similarity in per cent; bands and rows of each: a pair at 80 % shares no bucket with probability 3e-6.
SIMILARITY, BANDS, ROWS = 80, 32, 5
#: Signatures that agree in this many standard deviations less than expected are not compared on full sets.
DEVIATIONS = 4.5
#: Words that a worker remembers; shingles hashed at a time; members on a side of a block.
REMEMBERED, CHUNK, SIDE = 200_000, 60_000, 1024
EMPTY = np.uint32(0xFFFFFFFF)
SKETCH = "doc_id long, key long, n_shingles long, print binary, buckets array<long>, sketch binary"
#: With doc_id this names a text; rows that share both are copies.
KEY = "xxhash64(cast(text as string))"


def mixed(z: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes() -> dict:
    def make():
        from xxhash import xxh64_intdigest

        class Words(dict):
            def __missing__(self, word):
                if len(self) >= REMEMBERED:
                    self.clear()
                value = self[word] = xxh64_intdigest(word)
                return value

        return Words()

    return only_memory("words", make)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `size` words; of all words, where there are fewer; none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = mixed(np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words)))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(words) - n + 1 + i]
    return np.unique(mixed(out))


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """One row of `places` ranks a set; an empty set's places stay EMPTY."""
    h = np.full((len(sets), places), EMPTY, np.uint32)
    parts, owners, held = [], [], 0

    def work() -> None:
        x, doc = np.concatenate(parts), np.concatenate(owners)
        order = np.tile(np.arange(places, dtype=np.uint8), (len(x), 1))
        live = np.arange(len(x))
        mine = np.full_like(h, EMPTY)
        for j in range(places):
            z = mixed(x[live] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            k = j + (((z & np.uint64(0xFFFFFFFF)) * np.uint64(places - j)) >> np.uint64(32)).astype(np.intp)
            place = order[live, k]
            order[live, k] = order[live, j]
            rank = (z >> np.uint64(40)).astype(np.uint32) | np.uint32(j << 24)
            np.minimum.at(mine.reshape(-1), doc[live] * places + place, rank)
            if j % 4 == 0 or len(live) < 2_000:
                live = live[~(mine != EMPTY).all(1)[doc[live]]]
            if not len(live):
                break
        np.minimum(h, mine, out=h)

    for i, s in enumerate(sets):
        for at in range(0, len(s), CHUNK):
            piece = s[at : at + CHUNK]
            parts.append(piece)
            owners.append(np.full(len(piece), i, np.intp))
            held += len(piece)
            if held >= CHUNK:
                work()
                parts, owners, held = [], [], 0
    if held:
        work()
    return h


def fingerprint(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Set size, fingerprint, buckets and 8-bit signature of each row; fingerprint
    and buckets are null for an empty set."""
    if bands * rows > 255:
        raise ValueError("a signature has at most 255 places")

    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingles(t, size) for t in part.column(2).to_pylist()]
                h = signatures(sets, bands * rows)
                key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sets), 1))
                for r in range(rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + h.reshape(len(sets), bands, rows)[:, :, r])
                small = (h * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                full = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if s.size else None for s in sets], pa.binary()),
                    pa.array([k.view(np.int64).tolist() if ok else None for k, ok in zip(key, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([x.tobytes() if ok else None for x, ok in zip(small, full, strict=True)], pa.binary())],
                    names=["doc_id", "key", "n_shingles", "print", "buckets", "sketch"])

    return docs.selectExpr("cast(doc_id as long) doc_id", f"{KEY} key", "cast(text as string) text").mapInArrow(sketch, SKETCH)


def least_agreement(similarity: int, places: int) -> float:
    s = similarity / 100
    return places * s - DEVIATIONS * (places * s * (1 - s)) ** 0.5


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, similarity: int, places: int) -> DataFrame:
    """The pairs (a, b) of class representatives that are similar enough on full sets."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"), F.col("print").alias(f"p_{x}"))
    wide = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)")
    needed = least_agreement(similarity, places)

    def likely(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, places) for c in ("s_a", "s_b"))
            yield batch.filter(pa.array((a == b).sum(1) >= needed)).select(["a", "b", "p_a", "p_b"])

    wide = settle(wide.select("a", "b", "p_a", "p_b", "s_a", "s_b").mapInArrow(likely, "a long, b long, p_a binary, p_b binary"), "likely")
    # The same plan at every size: texts are shuffled to their pairs, never pairs sent to all texts.
    of = lambda x: texts.select(F.col("rep").alias(x), F.col("text").alias(f"t_{x}"))
    full = wide.hint("merge").join(of("b"), "b").hint("merge").join(of("a"), "a")

    def confirm(batches: Iterator) -> Iterator:
        import pyarrow as pa

        last, known = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for r in batch.slice(at, 500).to_pylist():
                    if last != (r["a"], r["t_a"]):
                        last, known = (r["a"], r["t_a"]), shingles(r["t_a"], size)
                    other = shingles(r["t_b"], size)
                    both = len(np.intersect1d(known, other, assume_unique=True))
                    if 100 * both >= similarity * (len(known) + len(other) - both) and fingerprint(known) == r["p_a"] and fingerprint(other) == r["p_b"]:
                        out.append((r["a"], r["b"]))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return full.select("a", "b", "t_a", "t_b", "p_a", "p_b").mapInArrow(confirm, "a long, b long")


def pivots(members: DataFrame) -> DataFrame:
    """Pairs of each member with two members of its bucket: the least by id and the
    least by a hash that differs between eighths of the buckets."""
    chance = F.xxhash64("doc_id", F.pmod("bucket", F.lit(8)))
    chosen = members.groupBy("bucket").agg(F.array(F.min_by("rep", "doc_id"), F.min_by("rep", chance)).alias("with"))
    pairs = members.join(chosen, "bucket").select("rep", F.explode("with").alias("other")).where("rep <> other")
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def apart(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with their component, of buckets that hold more than one."""
    joined = components(links.selectExpr("a u", "b v")).withColumnRenamed("node", "rep")
    named = members.join(joined, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ones = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    return named.join(open_ones, "bucket")


def short_sets(texts: DataFrame, size: int) -> DataFrame:
    """(rep, shorts): the low 32 bits of each shingle's hash, sorted."""
    def shorten(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sets = [np.unique(shingles(t, size).astype(np.uint32)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "shorts"])

    return texts.select("rep", "text").mapInArrow(shorten, "rep long, shorts binary")


def crossings(rows: DataFrame, similarity: int, places: int, side: int = SIDE) -> DataFrame:
    """Pairs of a bucket's members in different components that sizes, signatures and
    short sets allow. Of components that a block has surely joined no more pairs
    are given: those are similar with two shingles to spare."""
    parts = rows.groupBy("bucket").agg(F.ceil(F.count("*") / side).cast("int").alias("parts"))
    dealt = rows.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    # Block (i, j), i <= j, holds parts i and j.
    blocks = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bucket", "rep", "n", "sketch", "shorts", "component", "part", F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"))
    needed = least_agreement(similarity, places)

    def compare(t):
        import pyarrow as pa

        rep, n, component, part = (t.column(c).to_numpy() for c in ("rep", "n", "component", "part"))
        s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, places)
        shorts = [np.frombuffer(x, np.uint32) for x in t.column("shorts").to_pylist()]
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        group = component.copy()
        out = set()
        for x in left:
            able = right[(group[right] != group[x]) & (100 * np.minimum(n[right], n[x]) >= similarity * np.maximum(n[right], n[x]))]
            able = able[(s[able] == s[x]).sum(1) >= needed]
            for y in able:
                if group[x] == group[y]:
                    continue
                both = len(np.intersect1d(shorts[x], shorts[y], assume_unique=True))
                union = len(shorts[x]) + len(shorts[y]) - both
                if 100 * (both + 2) >= similarity * (union - 2):
                    out.add((min(rep[x], rep[y]), max(rep[x], rep[y])))
                if 100 * (both - 2) >= similarity * (union + 2):
                    group[group == group[y]] = group[x]
        return pa.table({"a": pa.array([int(a) for a, _ in out], pa.int64()), "b": pa.array([int(b) for _, b in out], pa.int64())})

    return blocks.groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 2, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS, side: int = SIDE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of `docs`.

    Documents without words link with nothing and are their own component.
    Rows that repeat a doc_id stay rows; each takes part, and is linked, with its
    own text. A null doc_id links with nothing. No rows give no rows.
    """
    return decisions(docs, size, similarity, bands, rows, side).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def decisions(docs: DataFrame, size: int = 2, similarity: int = SIMILARITY, bands: int = BANDS, rows: int = ROWS, side: int = SIDE) -> DataFrame:
    """doc_id, key, n_shingles, component_id and chosen of each row: chosen are the rows
    of one text a group, that of the least doc_id and then key."""
    places = bands * rows
    drawn = settle(sketches(docs, size, bands, rows), "sketches")
    able = drawn.where("print is not null and doc_id is not null")
    classes = able.groupBy("print").agg(F.min(F.struct("doc_id", "key", "n_shingles", "buckets", "sketch")).alias("x"))
    # The numbers hold from here on, as the table is written once.
    classes = classes.selectExpr("monotonically_increasing_id() rep", "x.doc_id doc_id", "x.key key", "x.n_shingles n", "print", "x.buckets buckets", "x.sketch sketch")
    classes = settle(classes, "classes")
    spread = classes.select("rep", "doc_id", F.explode("buckets").alias("bucket"))
    crowded = spread.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket")
    members = settle(spread.join(crowded, "bucket"), "members")
    # One text of each class that shares a bucket, fetched once.
    wanted = members.select("rep").distinct().join(classes.select("rep", "doc_id", "key"), "rep")
    texts = docs.selectExpr("cast(doc_id as long) doc_id", f"{KEY} key", "cast(text as string) text").join(wanted.hint("merge"), ["doc_id", "key"])
    texts = settle(texts.groupBy("doc_id", "key").agg(F.first("rep").alias("rep"), F.first("text").alias("text")).select("rep", "text"), "texts")
    tested = settle(pivots(members), "pairs")
    links = settle(confirmed(tested, classes, texts, size, similarity, places), "confirmed")
    rest = settle(apart(members.drop("doc_id"), links).join(classes.select("rep", "n", "sketch"), "rep"), "apart")
    open_texts = texts.join(rest.select("rep").distinct(), "rep", "left_semi")
    rest = rest.join(settle(short_sets(open_texts, size), "short-sets"), "rep")
    last = settle(crossings(rest, similarity, places, side).join(tested, ["a", "b"], "left_anti"), "pairs")
    links = links.union(settle(confirmed(last, classes, texts, size, similarity, places), "confirmed"))
    first = F.struct("doc_id", "key")
    joined = components(links.selectExpr("a u", "b v")).withColumnRenamed("node", "rep").join(classes.select("rep", first.alias("own")), "rep")
    joined = settle(joined, "joined")
    least = joined.groupBy("component").agg(F.min("own").alias("first"))
    of_class = classes.select("print", "rep", first.alias("own")).join(joined.join(least, "component").select("rep", "first"), "rep", "left")
    of_class = of_class.select("print", F.coalesce("first", "own").alias("first"))
    linked = able.select("doc_id", "key", "n_shingles", "print").join(of_class, "print").select("doc_id", "key", "n_shingles", F.col("first.doc_id").alias("component_id"), (first == F.col("first")).alias("chosen"))
    alone = drawn.where("print is null or doc_id is null").select("doc_id", "key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("chosen"))
    return linked.union(alone)
