"""Quality by compression: which of two dictionaries shortens a text more.

One zstandard dictionary is built from texts labelled good, one from texts
labelled bad. The difference of a text's two compressed sizes, normalised by
its own and by its compressed size, and how far the text compresses at all
make its score: a logistic curve, fitted on texts that dictionaries built
from the other labelled texts have compressed, turns them into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The fit sees at most so many labelled texts of each class, of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 1_500, 32_768
DICTIONARY, LEVEL = 32_768, 3
THRESHOLD = 0.3
FOLDS = 5


def is_held_out(doc_id) -> F.Column:
    """crc32 of the id as text is a multiple of 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    weights: np.ndarray | None = None
    level: int = LEVEL

    def compressors(self):
        import zstandard

        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False))
        return out

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Rows of: difference over size, difference over compressed size, compressed share, its square, 1."""
        good, bad = self.compressors() if not hasattr(self, "_kept") else self._kept
        self._kept = good, bad
        sizes = np.asarray([(len(bad.compress(t)), len(good.compress(t)), len(t)) for t in texts], dtype=float).reshape(-1, 3)
        worse, better, raw = sizes[:, 0], sizes[:, 1], np.maximum(sizes[:, 2], 1)
        share = better / (raw + 20)
        return np.column_stack([(worse - better) / raw, (worse - better) / np.maximum(worse, better), share, share**2, np.ones(len(raw))])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -500, 500)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_kept"}


def dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the texts themselves where there are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[:size] or b"\n" * 8


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the likeliest curve, with a weak pull to 0 (so that separable
    samples end), by Newton steps on standardised columns; the last column is 1."""
    centre, spread = x.mean(0), x.std(0)
    centre[-1], spread[-1] = 0, 1
    spread[spread == 0] = 1
    a = (x - centre) / spread
    w, pull = np.zeros(x.shape[1]), np.array([0.3] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + np.diag(pull), a.T @ (y - p) - pull * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    out = w / spread
    out[-1] = w[-1] - (w[:-1] * centre[:-1] / spread[:-1]).sum()
    return out


def trained(good: list[bytes], bad: list[bytes], folds: int = 4) -> CompressionModel:
    """Dictionaries of all texts; the curve from features that dictionaries of the other folds give."""
    model = CompressionModel(dictionary(good, DICTIONARY), dictionary(bad, DICTIONARY))
    x, y = [], []
    for f in range(folds):
        part = lambda texts, inside: [t for i, t in enumerate(texts) if (i % folds == f) == inside]  # noqa: B023, E731
        seen_good, seen_bad = part(good, False), part(bad, False)
        if not seen_good or not seen_bad:
            continue
        fold = CompressionModel(dictionary(seen_good, DICTIONARY), dictionary(seen_bad, DICTIONARY))
        for label, texts in ((1.0, part(good, True)), (0.0, part(bad, True))):
            if texts:
                x.append(fold.features(texts))
                y.append(np.full(len(texts), label))
    if len({v for part in y for v in part}) == 2:
        model.weights = logistic(np.concatenate(x), np.concatenate(y))
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> CompressionModel:
    """Learn from labelled rows that are not held out.

    Of each class the `rows` first by hash of the id are taken, without null
    or empty texts and those above `most` bytes, of texts that share an id the
    least; that bounds what reaches the driver. The curve is moved to the classes' shares among all labelled rows
    that may be learned from. Without texts of both classes every score is 0.5.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    known = known.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for q in (0, 1)]
    ids = chosen[0].union(chosen[1])
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.octet_length("text").between(1, most))
    # At most 2 * rows ids, and one text of each.
    found = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality")).collect()
    shares = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    seen: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sorted(found, key=lambda r: (r.doc_id, r.text)):
        seen[r.quality].append(r.text.encode())
    model = trained(seen[1], seen[0])
    if model.weights is not None:
        # The sample holds the classes in other shares than the table; the curve moves by the log of the odds.
        model.weights[-1] += math.log(shares[1] / shares[0]) - math.log(len(seen[1]) / len(seen[0]))
    return model


def scored(docs: DataFrame, model: CompressionModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row; a null text scores as an empty one."""
    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(model.scores(texts), pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", is_held_out(F.col("doc_id"))).mapInArrow(score, "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def kept_documents(docs: DataFrame, model: CompressionModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score at or above the threshold, with all their columns."""
    at = docs.columns.index("text")

    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.scores(texts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
