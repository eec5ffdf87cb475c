"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are halved; each half has its own codebook, and the two
codebooks' product is a grid of cells. A vector lies in the cell of its
nearest codewords and visits further cells in order of cost (multi-sequence
traversal of the two sorted lists), where a cell's cost is the squared
distance to its border: the square of how far each half would have to move.
It stops at the cost within which a vector displaced by the threshold's
distance in a random direction stays with the target recall; that cost is
measured on the sample that the codebooks are fitted on. Cosines are then
computed exactly, in blocks of bounded size. Equal vectors are one class, that
counts as many links as it has members, so copies are never compared.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import components, settle

COSINE, RECALL = 0.95, 0.99
#: Bounds of the sample that codebooks are fitted on, of a codebook, and of a side of a block of comparisons.
SAMPLE_ROWS, CODEWORDS, SIDE = 16_384, 1024, 2_048
CELL_ROWS = 512
SEED = 7


def unit_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v): rows that can link, divided by their length.

    Null and empty vectors, those with null or non-finite components, zero
    ones and those of another than the most common length cannot; nor can
    rows without vec_id. Rows that repeat a vec_id count once (the least vector).
    """
    x = df.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) x").where(
        "vec_id is not null and size(x) > 0 and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity')) and exists(x, e -> e <> 0)")
    lengths = x.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    x = x.where(F.size("x") == (lengths[0]["n"] if lengths else 0)).groupBy("vec_id").agg(F.min("x").alias("x"))
    # The largest component is taken out first: squares then neither overflow nor vanish.
    x = x.withColumn("x", F.transform("x", lambda e: e / F.array_max(F.transform("x", lambda y: F.abs(y)))))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e))
    return x.withColumn("__norm", norm).select("vec_id", F.transform("x", lambda e: e / F.col("__norm")).alias("v"))


def codebook(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from distinct random points."""
    rng = np.random.default_rng(SEED)
    points = np.unique(points, axis=0)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        for j in range(points.shape[1]):
            sums = np.bincount(near, weights=points[:, j], minlength=len(centres))
            counts = np.bincount(near, minlength=len(centres))
            centres[counts > 0, j] = sums[counts > 0] / counts[counts > 0]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1)[None, :].__sub__(2 * points @ centres.T).argmin(1)


def border_costs(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(home codeword, squared distance to the border with each codeword's region)."""
    d = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    home = d.argmin(1)
    square = (centres**2).sum(1)
    between = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * centres @ centres.T, 1e-300))[home]
    cost = (np.maximum(d - d[np.arange(len(d)), home][:, None], 0) / (2 * between)) ** 2
    cost[np.arange(len(d)), home] = 0
    return home, cost


def visits(a: np.ndarray, b: np.ndarray, most: float) -> list[tuple[int, int]]:
    """Cells (i, j) with a[i] + b[j] <= most, by rising sum: multi-sequence traversal."""
    one, two = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    one, two = one[a[one] <= most], two[b[two] <= most]
    out, heap = [], [(0.0, 0, 0)]
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > most:
            break
        out.append((int(one[i]), int(two[j])))
        if j + 1 < len(two):
            heapq.heappush(heap, (a[one[i]] + b[two[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(one):
            heapq.heappush(heap, (a[one[i + 1]] + b[two[0]], i + 1, 0))
    return out


class MultiIndex:
    """Two codebooks and the cost at which a traversal ends."""

    def __init__(self, sample: np.ndarray, rows: int, cosine: float = COSINE, recall: float = RECALL, cell_rows: int = CELL_ROWS):
        half = max(1, sample.shape[1] // 2)
        self.half, self.cosine = half, cosine
        k = int(min(CODEWORDS, max(1, round((rows / cell_rows) ** 0.5)), len(sample)))
        self.first, self.second = codebook(sample[:, :half], k), codebook(sample[:, half:], k) if sample.shape[1] > half else np.zeros((1, 0))
        rng = np.random.default_rng(SEED)
        some = sample[rng.permutation(len(sample))[:2048]]
        needed = []
        for _ in range(4):
            # A unit vector at exactly the threshold's cosine, in a random direction.
            step = rng.standard_normal(some.shape)
            step -= (step * some).sum(1, keepdims=True) * some
            size = np.linalg.norm(step, axis=1, keepdims=True)
            moved = cosine * some + np.sqrt(1 - cosine**2) * step / np.where(size > 0, size, 1)
            cost = np.zeros(len(some))
            for centres, x, y in self.halves(some, moved):
                cost += border_costs(x, centres)[1][np.arange(len(x)), nearest(y, centres)]
            needed.append(cost)
        self.most = float(np.quantile(np.concatenate(needed), recall)) * 1.05 + 1e-12

    def halves(self, *vectors):
        return [(self.first, *[x[:, : self.half] for x in vectors]), (self.second, *[x[:, self.half :] for x in vectors])]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """(home cell, visited cells) of each vector; home is among the visited."""
        (ca, xa), (cb, xb) = self.halves(x)
        ha, a = border_costs(xa, ca)
        hb, b = border_costs(xb, cb)
        n = len(cb)
        return ha * n + hb, [[i * n + j for i, j in visits(a[r], b[r], self.most)] for r in range(len(x))]


def forest(a: np.ndarray, b: np.ndarray, hit: np.ndarray, left: np.ndarray, right: np.ndarray, parent: dict[int, int]) -> None:
    """Join the ids of linked rows and columns in `parent`."""
    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in np.flatnonzero(hit.any(1)):
        mine = root(int(a[left[i]]))
        for j in np.flatnonzero(hit[i]):
            other = root(int(b[right[j]]))
            if other != mine:
                low, high = min(mine, other), max(mine, other)
                parent[high] = low
                mine = low


def near_duplicates(df: DataFrame, cosine: float = COSINE, recall: float = RECALL, cell_rows: int = CELL_ROWS, side: int = SIDE) -> DataFrame:
    """vec_id, n_links, component_id and kept, a row for each distinct vec_id.

    Vectors that cannot link have no links and are their own component; a null
    vec_id gives one row with null component, kept. No pairs are ever written:
    a block of comparisons gives a link count a class and a spanning forest
    of its links. cell_rows is the aim for a cell's size, side bounds a block.
    """
    ids = df.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    # 128 bits, from two hashes, name equal vectors.
    named = settle(unit_vectors(df).withColumn("same", F.concat_ws(":", F.xxhash64("v"), F.xxhash64(F.lit(1), "v"))), "unit-vectors")
    classes = named.groupBy("same").agg(F.min(F.struct("vec_id", "v")).alias("x"), F.count("*").alias("n")).selectExpr("x.vec_id vec_id", "x.v v", "n", "same")
    vectors = settle(classes, "classes")
    rows = vectors.count()
    alone = ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not rows:
        return alone
    sample = np.asarray([r.v for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE_ROWS).collect()])
    index = MultiIndex(sample, rows, cosine, recall, cell_rows)

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.asarray(part.column(1).to_pylist())
                home, seen = index.cells(x)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(home, pa.int64()), pa.array(seen, pa.list_(pa.int64()))], names=["vec_id", "v", "n", "home", "seen"])

    # 2 * CODEWORDS half vectors travel with the task.
    placed = settle(vectors.select("vec_id", "v", "n").mapInArrow(assign, "vec_id long, v array<double>, n long, home long, seen array<long>"), "cells")
    # A cell's residents, and so its probes, are split by hash into sides of bounded size.
    sides = placed.groupBy("home").agg(F.ceil(F.count("*") / side).cast("int").alias("parts")).withColumnRenamed("home", "cell")
    probes = placed.select("vec_id", "v", "n", "home", F.explode("seen").alias("cell"))
    asked = probes.groupBy("cell").agg(F.ceil(F.count("*") / side).cast("int").alias("asked"))
    grid = sides.join(asked, "cell")
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    there = placed.withColumnRenamed("home", "cell").join(grid, "cell").select("vec_id", "v", "n", F.col("cell").alias("home"), "seen", "cell", part("parts").alias("i"), F.lit(False).alias("probe"), across("asked").alias("j"))
    # Only residents need the list of cells they visit.
    unlisted = F.lit(None).cast("array<long>").alias("seen")
    here = probes.join(grid, "cell").select("vec_id", "v", "n", "home", unlisted, "cell", part("asked").alias("j"), F.lit(True).alias("probe"), across("parts").alias("i"))

    def compare(t):
        import pyarrow as pa

        probe = t.column("probe").combine_chunks().to_numpy(zero_copy_only=False)
        id_of, home, n = (t.column(c).to_numpy() for c in ("vec_id", "home", "n"))
        x = t.column("v").combine_chunks().flatten().to_numpy().reshape(len(id_of), -1)
        left, right = np.flatnonzero(probe), np.flatnonzero(~probe)
        links = np.zeros(len(id_of), np.int64)
        parent: dict[int, int] = {}
        if len(left) and len(right):
            seen = t.column("seen").combine_chunks()
            visited = [set(seen[int(r)].as_py()) for r in right]
            for at in range(0, len(left), 512):
                rows = left[at : at + 512]
                hit = (x[rows] @ x[right].T >= cosine) & (id_of[rows][:, None] != id_of[right][None, :])
                links[rows] += hit @ n[right]
                # A pair is met from both sides if the resident visits the probe's cell too; else this block counts for both.
                for cell in np.unique(home[rows]):
                    here = home[rows] == cell
                    unseen = np.asarray([cell not in s for s in visited])
                    if unseen.any():
                        links[right[unseen]] += n[rows][here] @ hit[np.ix_(here, unseen)]
                forest(id_of, id_of, hit, rows, right, parent)
        linked = np.flatnonzero(links)
        roots = []
        for v in parent:
            r = v
            while parent[r] != r:
                r = parent[r]
            if r != v:
                roots.append((v, r))
        return pa.table({
            "vec_id": pa.array([*id_of[linked].tolist(), *[v for v, _ in roots]], pa.int64()),
            "n": pa.array([*links[linked].tolist(), *[0] * len(roots)], pa.int64()),
            "other": pa.array([*[None] * len(linked), *[r for _, r in roots]], pa.int64())})

    met = settle(there.unionByName(here).groupBy("cell", "i", "j").applyInArrow(compare, "vec_id long, n long, other long"), "links")
    counts = met.groupBy("vec_id").agg(F.sum("n").alias("met"))
    joined = components(met.where("other is not null").selectExpr("vec_id u", "other v"))
    of_class = vectors.select("vec_id", "n", "same").join(counts, "vec_id", "left").join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    of_class = of_class.select("same", (F.coalesce("met", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component"))
    out = ids.join(named.select("vec_id", "same").join(of_class, "same"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
