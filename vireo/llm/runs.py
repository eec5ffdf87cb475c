"""Runs of words that repeat with a period, by power-of-two names.

Names (Karp, Miller and Rosenberg): level 0 numbers a document's words; level
k + 1 numbers pairs of names of level k that lie 2^k apart, so equal names mean
equal stretches of 2^k words. Names are a document's own, and a stretch that
occurs once in its document gets none: it cannot be part of a repetition, so
higher levels hold few positions.

Candidates: a run of period q and at least 3 q words (24 at least) repeats its
words q apart over 2 q positions or more, which hold a whole cell of the grid of
step 2^k, with k the greatest such that 2^k <= q (3 at least). So every grid
position is compared, by name, with those 2^k to 2^(k+1) - 1 further on. A
match is extended to both sides by the names of descending levels; no hashes,
and no sorted suffixes.

A run: a stretch of consecutive words with smallest period q and at least
max(24, 3 q) words that no neighbouring word extends keeping that period.
Words are separated by ASCII white space. A null or empty text has no words, no
runs, and collapses to the empty text; so does one of white space. Ids are
passed on as they are, null and repeated ones too; each row is judged for
itself. Further columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vireo.llm.decontaminate import Names

#: Fixed values of the definition: least words and least periods of a run, and the level whose cells any such run holds.
LEAST_WORDS, LEAST_PERIODS, LEAST_LEVEL = 24, 3, 3
#: Words that are named at a time (whole documents; a longer one alone); pairs compared at a time.
BATCH_WORDS, PAIRS = 1 << 18, 1 << 21
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def planted_words(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words, of a tenth of the documents with a periodic tail: chosen, begun and given its period by the crc32 of
    the decimal id. A null id changes nothing."""
    found = words(doc_id, text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not found:
        return found
    n, g = len(found), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + i % p] for i in range(n - a)]


def named(left: np.ndarray, right: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Names for the pairs (left, right) at positions `at`; -1 where a pair occurs once and elsewhere. One more place than n."""
    names = np.full(n + 1, -1, np.int32)
    if not len(at):
        return names
    bits = np.uint64(max(int(left.max()), int(right.max()), n).bit_length())
    if 3 * int(bits) <= 64:
        keys = np.sort((left.astype(np.uint64) << bits | right.astype(np.uint64)) << bits | at.astype(np.uint64))
        at = (keys & (np.uint64(1) << bits) - np.uint64(1)).astype(np.int64)
        new = np.concatenate([[True], keys[1:] >> bits != keys[:-1] >> bits])
    else:
        order = np.lexsort((right, left))
        left, right, at = left[order], right[order], at[order]
        new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    number = np.cumsum(new) - 1
    repeated = np.bincount(number)[number] > 1
    names[at[repeated]] = number[repeated]
    return names


def levels_of(ids: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Names of each level; `owner` and `ends` give each position's document and that document's end."""
    n = len(ids)
    out = [named(owner, ids, np.arange(n), n)]
    while True:
        size = 1 << len(out) - 1
        last = out[-1]
        at = np.flatnonzero(last >= 0)
        at = at[at + 2 * size <= ends[at]]
        at = at[last[at + size] >= 0]
        if not len(at):
            return out
        names = named(last[at], last[at + size], at, n)
        if not (names >= 0).any():
            return out
        out.append(names)


def extended(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many words after (before, where `back`) a equal those after (before) b, by descending levels."""
    total = np.zeros(len(a), np.int64)

    def advance(level: int, which: np.ndarray) -> np.ndarray:
        names, size = levels[level], 1 << level
        x, y = (a[which] - total[which] - size, b[which] - total[which] - size) if back else (a[which] + total[which], b[which] + total[which])
        inside = x >= 0 if back else y < len(names)
        hit = which[inside][(names[x[inside]] == names[y[inside]]) & (names[x[inside]] >= 0)]
        total[hit] += size
        return hit

    which = np.arange(len(a))
    while len(which):
        which = advance(len(levels) - 1, which)
    for level in range(len(levels) - 2, -1, -1):
        advance(level, np.arange(len(a)))
    return total


def candidates(levels: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period): the first grid position of each row of positions of a grid that match so far apart."""
    for level in range(LEAST_LEVEL, len(levels)):
        names, step = levels[level], 1 << level
        low, high = (1 if level == LEAST_LEVEL else step), 2 * step
        grid = np.flatnonzero(names[:-1:step] >= 0) * step
        for some in np.array_split(grid, max(1, -(-len(grid) * step // PAIRS))):
            far = some[:, None] + np.arange(low, high)[None, :]
            hit = (far < len(names)) & (names[np.minimum(far, len(names) - 1)] == names[some][:, None])
            row, q = np.nonzero(hit)
            at, q = some[row], q + low
            before = at - step
            same = (before >= 0) & (names[before] >= 0) & (names[before] == names[before + q])
            yield at[~same], q[~same]


def runs_of(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs of the documents whose words `ids` hold one after the other, by
    document, start and period; starts count from the document's first word."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begins = np.cumsum(lengths) - lengths
    levels = levels_of(ids, owner, (begins + lengths)[owner]) if len(ids) else []
    found = [np.empty((0, 3), np.int64)]
    for at, q in candidates(levels):
        start = at - extended(levels, at, at + q, back=True)
        end = at + q + extended(levels, at, at + q, back=False)
        long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.unique(np.stack([start[long], end[long], q[long]], 1), axis=0))
    all_runs = np.unique(np.concatenate(found), axis=0)
    # A stretch found with several periods has the least: with three of each in it, that divides the others.
    first = np.concatenate([[True], (all_runs[1:, :2] != all_runs[:-1, :2]).any(1)])[: len(all_runs)]
    start, end, q = all_runs[first].T
    order = np.lexsort((q, start))
    start, end, q = start[order], end[order], q[order]
    doc = owner[start] if len(start) else start
    return doc, start - begins[doc], end - start, q


def periodic_runs(docs: DataFrame, words_of: Callable[[int | None, bytes | None], list[bytes]] = words, batch_words: int = BATCH_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): each document's runs by start and period, and its words, joined by one space,
    without those that any run contains after its first period."""

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kept = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

        def done(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            numbers = Names()
            lengths = np.array([len(t) for t in texts], np.int64)
            flat = np.concatenate([np.fromiter(map(numbers.__getitem__, t), np.int64, len(t)) for t in texts])
            doc, start, length, period = runs_of(flat, lengths)
            runs: list[list[dict]] = [[] for _ in texts]
            cut: dict[int, np.ndarray] = {}
            for d, s, n, q in zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist(), strict=True):
                runs[d].append({"start": s, "length": n, "period": q})
                cut.setdefault(d, np.zeros(len(texts[d]), bool))[s + q : s + n] = True
            collapsed = [b" ".join(t if i not in cut else [t[j] for j in np.flatnonzero(~cut[i]).tolist()]) for i, t in enumerate(texts)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths), pa.array(runs, pa.list_(kept)), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = words_of(doc_id, text.as_py())
                if texts and held + len(found) > batch_words:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(found)
                held += len(found)
        if texts:
            yield done(ids, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(find, RUNS)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first; null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), lambda best, r: F.when(better(best, r), r).otherwise(best))


def listed(runs: Column | str) -> Column:
    """All runs as lines of start, length and period."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
