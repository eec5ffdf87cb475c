"""Harmonic packing of token streams into fixed-length sequences.

Lengths are partitioned into reciprocal-capacity classes: class k holds lengths
in (capacity / (k + 1), capacity / k] and fills each of its bins with exactly k
documents; the last class holds all shorter ones. What is left in a bin that has
its k documents is a gap. A document that some gap can take whole goes into the
tightest such gap instead of its class; only where too many gaps are open is a
document cut, to fill the largest ones. Documents longer than a sequence give
whole sequences first. Each worker (a partition of the scan) fills its own bins,
whatever other workers do; nothing is shuffled. What a worker holds at its end
is joined, fullest bins first, and the very last sequence is cut into sequences
of descending powers of two, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from vireo.llm.tokens import END, REMEMBERED, crc, encoder, vocabulary, with_end

CAPACITY = 2048
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Documents encoded at a time.
BATCH = 256
#: The last class, bins with a gap that wait at once, and the tokens that may stay empty in a sequence.
CLASSES, WAITING, SLACK = 64, 64, 4


class HarmonicPacker:
    """Bins of one worker. A piece is (doc_id, start, ids, doc_tokens); what has its
    place is in `done`, as rows of SCHEMA."""

    def __init__(self, capacity: int, first: int, classes: int = CLASSES, waiting: int = WAITING, slack: int = SLACK):
        self.capacity, self.next = capacity, first
        self.classes, self.waiting, self.slack = min(classes, capacity), waiting, min(slack, capacity // 64)
        self.open: dict[int, list] = {}
        #: (gap, number, pieces) of full classes' bins, by gap.
        self.gaps: list[tuple[int, int, list]] = []
        self.number = 0
        self.done: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        """A document: whole sequences, then what is left as one piece."""
        total, at = len(ids), 0
        while total - at >= self.capacity:
            self._emit([(doc, at, ids[at : at + self.capacity], total)])
            at += self.capacity
        if total > at:
            self._place((doc, at, ids[at:], total))

    def _emit(self, pieces: list) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, len(ids), crc(ids), total, self.next, at))
            at += len(ids)
        self.next += 1

    def _bin(self, pieces: list, gap: int) -> None:
        """A bin that has what it needs of its class."""
        if gap <= self.slack:
            self._emit(pieces)
        else:
            self.number += 1
            insort(self.gaps, (gap, self.number, pieces))

    def _place(self, piece: tuple) -> None:
        while True:
            n = len(piece[2])
            i = bisect_left(self.gaps, (n,))
            if i < len(self.gaps):
                gap, _, pieces = self.gaps.pop(i)
                pieces.append(piece)
                self._bin(pieces, gap - n)
                return
            if len(self.gaps) < self.waiting:
                break
            gap, _, pieces = self.gaps.pop()
            pieces.append((piece[0], piece[1], piece[2][:gap], piece[3]))
            self._emit(pieces)
            piece = piece[0], piece[1] + gap, piece[2][gap:], piece[3]
        k = min(self.capacity // n, self.classes)
        held = self.open.setdefault(k, [])
        held.append(piece)
        if len(held) == k:
            del self.open[k]
            self._bin(held, self.capacity - sum(len(p[2]) for p in held))

    def close(self) -> None:
        """Place all that waits: the emptiest bins' pieces fill the fullest bins' gaps."""
        bins = [(sum(len(p[2]) for p in b), i, b) for i, b in enumerate([*[b for _, _, b in self.gaps], *self.open.values()])]
        bins = [b for _, _, b in sorted(bins, reverse=True)]
        self.open, self.gaps = {}, []
        supply: list[tuple] = []
        while bins:
            mine = bins.pop(0)
            gap = self.capacity - sum(len(p[2]) for p in mine)
            while gap > 0:
                if not supply:
                    if not bins:
                        break
                    supply = bins.pop()
                piece = supply.pop()
                if len(piece[2]) > gap:
                    supply.append((piece[0], piece[1] + gap, piece[2][gap:], piece[3]))
                    piece = piece[0], piece[1], piece[2][:gap], piece[3]
                mine.append(piece)
                gap -= len(piece[2])
            if gap:
                self._in_powers(mine)
            else:
                self._emit(mine)
            if supply and not bins:
                bins, supply = [supply], []

    def _in_powers(self, pieces: list) -> None:
        left = sum(len(p[2]) for p in pieces)
        pieces = pieces[::-1]
        while left:
            room = size = 1 << (left.bit_length() - 1)
            out = []
            while room:
                doc, start, ids, total = pieces.pop()
                if len(ids) > room:
                    pieces.append((doc, start + room, ids[room:], total))
                    ids = ids[:room]
                out.append((doc, start, ids, total))
                room -= len(ids)
            self._emit(out)
            left -= size


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of all documents with their sequence and offset there.

    A null or empty text is its end id alone. Repeated rows are packed each;
    a null doc_id stays null; no rows give no rows; other columns are ignored.
    sequence_id is unique over all workers: the partition's number times 2^36
    plus the worker's own count, so a rerun of a lost task repeats it. A worker
    holds the ids of at most CLASSES open bins and WAITING bins with a gap.
    """
    path = vocabulary(tokenizer)

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        code = encoder(path, remembered)
        packer = HarmonicPacker(capacity, TaskContext.get().partitionId() << 36)

        def table():
            columns = list(zip(*packer.done, strict=True)) or [[]] * 7
            packer.done = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), BATCH):
                for doc, packed in zip(ids[at : at + BATCH], code.batch(texts.slice(at, BATCH).to_pylist()), strict=True):
                    packer.add(doc, with_end(packed, code.width, end))
                yield table()
        packer.close()
        yield table()

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(pack, SCHEMA)
