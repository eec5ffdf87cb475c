"""Benchmark decontamination by a distributed positional inverted index.

Documents are dealt into segments of whole documents. For each term of a
segment the index holds one row: how often the term occurs and its positions,
so a term that occurs everywhere is split by segment and no row outgrows one.
Each document's words follow those of the one before it after a gap, so nothing
is found across two documents.

A search takes patterns: terms, each with the stretch of positions, relative to
the pattern's start, that must hold it (a phrase: one position each; proximity:
the same `within` positions for all). The terms of a pattern are ranked by how
often they occur in all documents. The rarest term's positions, adjusted by its
offset, give the starts that can be; the next terms' positions thin them out.
A pattern with a term that no document has is dropped before any list is read.

Words: A-Z lower-cased, then runs of letters a-z, digits and all characters
beyond ASCII. Null and empty texts have no words and no patterns; they are not
found and nothing is found in them. Each row of documents is judged for itself,
also where ids or whole rows repeat or are null. Items of one id are one item
with the patterns of all its rows; a null id counts as an item that is named by
the empty string. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import settle

#: Words of a window; words of a segment; unused positions between two documents (`within` is at most one more).
WINDOW, SEGMENT, GAP = 10, 1 << 21, 64
#: After the rarest term, so many are taken one by one; all others at once. Patterns of a block: so many, as a power of two, meet one list together.
SINGLY, BLOCK = 1, 12
#: Bytes of a text that are taken apart at a time.
PIECE = 1 << 20
#: Fixed value: each byte as a byte of a word, or as white space.
BYTES = bytes(b if b >= 128 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
INDEX = "segment long, term binary, n long, postings binary, documents array<struct<doc_id: long, start: long, n_words: long>>"
FOUND = "segment long, pattern long, starts binary"


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, some at a time."""
    clean, at = (text or b"").translate(BYTES), 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


class Names(dict):
    """A number for each term, in the order of first sight."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def index_documents(docs: DataFrame, segment_words: int = SEGMENT, gap: int = GAP) -> DataFrame:
    """The index of `docs` (doc_id, text): a row for each term of a segment, and one a segment that lists its documents.

    The rows of one evaluation belong together: write them before use.
    """

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("postings", pa.binary()),
                            ("documents", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64())])))])
        segment = TaskContext.get().partitionId() << 32
        terms, parts, listed, end = Names(), [], [], 0

        def rows() -> Iterator:
            if terms:
                both, done = np.empty(sum(len(p) for _, p in parts), np.uint64), 0
                for s, p in parts:
                    own = both[done : done + len(p)]
                    own[:] = p
                    own <<= np.uint64(32)
                    own |= np.arange(s, s + len(p), dtype=np.uint64)
                    done += len(p)
                both.sort()
                counts = np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(terms))
                first = np.concatenate([[0], np.cumsum(counts)])
                steps = (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                steps[1:] -= steps[:-1].copy()
                steps[first[:-1]] = (both[first[:-1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                postings = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer((first * 4).astype(np.int32)), pa.py_buffer(steps)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), segment)), pa.array(list(terms), pa.binary()), pa.array(counts, pa.int64()), postings, pa.nulls(len(terms), schema.field("documents").type)], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([None], pa.binary()), pa.array([None], pa.int64()), pa.array([None], pa.binary()), pa.array([listed], schema.field("documents").type)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = end
                for some in words(text.as_py()):
                    parts.append((end, np.fromiter(map(terms.__getitem__, some), np.uint32, len(some))))
                    end += len(some)
                listed.append({"doc_id": doc_id, "start": start, "n_words": end - start})
                end += gap
                if end >= segment_words:
                    yield from rows()
                    segment, terms, parts, listed, end = segment + 1, Names(), [], [], 0
        if listed:
            yield from rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(build, INDEX)


def term_lists(items: DataFrame) -> DataFrame:
    """(item_id string, terms) of the items (item_id, text) that have words."""

    def split(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = [[w for some in words(t.as_py()) for w in some] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.binary()))], names=["item_id", "terms"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return named.mapInArrow(split, "item_id string, terms array<binary>").where("size(terms) > 0")


def phrases(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """(item_id, terms): each run of `length` words of an item; all its words, where there are fewer."""
    lists = settle(term_lists(items), "item-terms")
    starts = F.sequence(F.lit(1), F.greatest(F.size("terms") - length + 1, F.lit(1)))
    return lists.select("item_id", "terms", F.explode(starts).alias("at")).select("item_id", F.expr(f"slice(terms, at, {length})").alias("terms"))


def numbered(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns (item_id, terms) as (pattern, terms), each once, and (pattern, items): the items that have it."""
    once = patterns.groupBy("terms").agg(F.collect_set("item_id").alias("items")).withColumn("pattern", F.monotonically_increasing_id())
    once = settle(once, "patterns")
    return once.select("pattern", "terms"), once.select("pattern", "items")


def ranked(patterns: DataFrame, index: DataFrame, within: int | None) -> DataFrame:
    """(pattern, rank, term, low, high) of patterns of which every term occurs: rank 0 is the rarest;
    the term must stand between `low` and `high` past the pattern's start."""
    listed = patterns.select("pattern", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    if within is None:
        listed = listed.select("pattern", "size", "term", F.col("offset").alias("low"), F.col("offset").alias("high"))
    else:
        listed = listed.select("pattern", "term", F.lit(0).alias("low"), F.lit(within - 1).alias("high")).distinct()
        listed = listed.join(listed.groupBy("pattern").agg(F.count("*").alias("size")), "pattern")
    asked = settle(listed.select("term").distinct(), "asked-terms")
    often = index.select("term", "n").join(asked, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("often"))
    known = listed.join(often, "term")
    by = Window.partitionBy("pattern")
    known = known.withColumn("known", F.count("*").over(by)).where("known = size")
    return settle(known.withColumn("rank", F.row_number().over(by.orderBy("often", "low", "term")) - 1).select("pattern", "rank", "term", "low", "high"), "ranked")


def positions(postings: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(postings, np.uint32), dtype=np.int64)


def near(starts: np.ndarray, at: np.ndarray, low: int, high: int) -> np.ndarray:
    """The starts that have one of the positions `at` between `low` and `high` past them."""
    return starts[np.searchsorted(at, starts + low, "left") < np.searchsorted(at, starts + high, "right")]


def asked(lists) -> Iterator[tuple]:
    """The fields of each list of structures: numbers as arrays, bytes as Arrow values."""
    ends, fields = lists.offsets.to_numpy(), lists.values.flatten()
    for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        yield tuple(f[i:j].to_numpy() if str(f.type).startswith("int") else f[i:j] for f in fields)


def occurrences(index: DataFrame, patterns: DataFrame, within: int | None = None) -> DataFrame:
    """(segment, pattern, starts) of all occurrences: of the terms in their order, or,
    with `within`, of all of them in any order in so many consecutive positions.

    `index` has been written; starts are 64-bit positions in the segment.
    """
    terms = ranked(patterns, index, within)
    sizes = terms.groupBy("pattern").agg(F.count("*").alias("size"))

    def propose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, out, segments = [], [], []
            for segment, postings, (pattern, low, high) in zip(batch.column(0).to_pylist(), batch.column(1), asked(batch.column(2)), strict=True):
                at = positions(postings.as_py())
                for lo, hi in zip(low.tolist(), high.tolist(), strict=True):
                    out.append((at - lo if lo == hi else np.unique(at[:, None] - np.arange(lo, hi + 1)[None, :])).tobytes())
                ids.append(pattern)
                segments += [segment] * len(pattern)
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(np.concatenate([np.empty(0, np.int64), *ids])), pa.array(out, pa.binary())], names=["segment", "pattern", "starts"])

    def thin(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, out, segments = [], [], []
            for segment, postings, (pattern, low, high, starts) in zip(batch.column(0).to_pylist(), batch.column(1), asked(batch.column(2)), strict=True):
                at = positions(postings.as_py())
                for i, lo, hi, s in zip(pattern.tolist(), low.tolist(), high.tolist(), starts, strict=True):
                    left = near(np.frombuffer(s.as_py(), np.int64), at, lo, hi)
                    if len(left):
                        ids.append(i)
                        out.append(left.tobytes())
                        segments.append(segment)
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["segment", "pattern", "starts"])

    def shared(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            left = []
            for lists in batch.column(2).to_pylist():
                common = np.frombuffer(lists[0], np.int64)
                for other in lists[1:]:
                    common = np.intersect1d(common, np.frombuffer(other, np.int64), assume_unique=True)
                left.append(common.tobytes())
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(left, pa.binary())], names=["segment", "pattern", "starts"])
            yield kept.filter(pa.array([len(x) > 0 for x in left]))

    def met(asks: DataFrame, ranks: DataFrame, keys: list[str], step) -> DataFrame:
        """The lists of the terms of some ranks that are asked for, each read once for a block of patterns."""
        columns = [c for c in ("pattern", "low", "high", "starts") if c in asks.columns]
        each = asks.groupBy(*keys, F.shiftright("pattern", BLOCK)).agg(F.collect_list(F.struct(*columns)).alias("asked"))
        lists = index.select("segment", "term", "postings").join(ranks.select("term"), "term", "left_semi")
        return lists.join(each, keys).select("segment", "postings", "asked").mapInArrow(step, FOUND)

    def thinned(found: DataFrame, ranks: DataFrame) -> DataFrame:
        return met(found.join(ranks, "pattern"), ranks, ["segment", "term"], thin)

    left = settle(met(terms.where("rank = 0"), terms.where("rank = 0"), ["term"], propose), "rarest")
    done = None
    for rank in range(SINGLY):
        left = left.join(sizes, "pattern")
        whole = left.where(F.col("size") == rank + 1).select("segment", "pattern", "starts")
        done = whole if done is None else done.unionByName(whole)
        left = settle(thinned(left.where(F.col("size") > rank + 1).select("segment", "pattern", "starts"), terms.where(F.col("rank") == rank + 1)), f"thinned-{rank + 1}")
    left = left.join(sizes, "pattern")
    done = done.unionByName(left.where(F.col("size") == SINGLY + 1).select("segment", "pattern", "starts"))
    # Few starts are left: the lists of all further terms are read at once, and a start counts if each has it.
    rest = thinned(left.where(F.col("size") > SINGLY + 1).select("segment", "pattern", "starts"), terms.where(F.col("rank") > SINGLY))
    rest = rest.groupBy("segment", "pattern").agg(F.collect_list("starts").alias("lists")).join(sizes, "pattern").where(F.size("lists") == F.col("size") - SINGLY - 1)
    return done.unionByName(rest.select("segment", "pattern", "lists").mapInArrow(shared, FOUND))


def by_document(index: DataFrame, found: DataFrame, items: DataFrame, lengths: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for each document; `lengths` has (pattern, length): the positions an occurrence covers."""
    wide = found.join(items, "pattern").join(lengths, "pattern")
    each = wide.groupBy("segment").agg(F.collect_list(F.struct("starts", "length", "items")).alias("found"))
    segments = index.where("documents is not null").select("segment", "documents")

    def tell(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                docs = row["documents"]
                first = np.array([d["start"] for d in docs], np.int64)
                last = first + np.array([d["n_words"] for d in docs], np.int64)
                covered = np.zeros(int(last[-1]) + 2, np.int32)
                named: dict[int, set[str]] = {}
                for f in row["found"] or []:
                    starts = np.frombuffer(f["starts"], np.int64)
                    own = np.searchsorted(first, starts + f["length"] - 1, "right") - 1
                    np.add.at(covered, np.maximum(starts, first[own]), 1)
                    np.add.at(covered, np.minimum(starts + f["length"], last[own]), -1)
                    for d in np.unique(own).tolist():
                        named.setdefault(d, set()).update(f["items"])
                hit = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
                yield pa.RecordBatch.from_arrays([
                    pa.array([d["doc_id"] for d in docs], pa.int64()), pa.array([d["n_words"] for d in docs], pa.int64()), pa.array(hit[last] - hit[first], pa.int64()),
                    pa.array([sorted(named.get(i, ())) for i in range(len(docs))], pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "items"])

    return segments.join(each, "segment", "left").select("documents", "found").mapInArrow(tell, "doc_id long, n_words long, n_hit long, items array<string>")


def exact_matches(docs: DataFrame, items: DataFrame, length: int = WINDOW, segment_words: int = SEGMENT) -> DataFrame:
    """(doc_id, n_words, n_hit, items) a document: words that windows of `length` words of an item cover, and the items with such windows."""
    index = settle(index_documents(docs, segment_words), "postings")
    patterns, of_items = numbered(phrases(items, length))
    return by_document(index, occurrences(index, patterns), of_items, patterns.select("pattern", F.size("terms").alias("length")))


def proximity_matches(docs: DataFrame, items: DataFrame, within: int, length: int = WINDOW, segment_words: int = SEGMENT) -> DataFrame:
    """(doc_id, n_words, n_hit, items) a document: as `exact_matches`, where all words of a window stand in `within`
    consecutive words in any order (a word that the window repeats need stand once). n_hit counts the words of such stretches."""
    if not 1 <= within <= GAP:
        raise ValueError(f"within is from 1 to {GAP}")
    index = settle(index_documents(docs, segment_words), "postings")
    patterns, of_items = numbered(phrases(items, length))
    return by_document(index, occurrences(index, patterns, within), of_items, patterns.select("pattern", F.lit(within).alias("length")))

