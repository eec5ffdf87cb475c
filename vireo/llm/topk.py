"""Exact top-k inner products over integer vectors.

Candidates are dealt by hash over groups of bounded size, queries over blocks
of bounded size; a cell is one group against one block. In a cell candidates
are taken by descending length. Both sides are rotated by the right singular
vectors of a bounded sample, so that the leading coordinates hold most of a
product; what the rest can add is at most the product of the two residual
lengths (Cauchy-Schwarz). A candidate block whose greatest length cannot reach
a query's k-th best score ends the scan for that query; a candidate whose
partial sum plus residual bound cannot reach it is skipped; all others get
their exact integer product. Cells keep k rows a query; a window merges them.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of a cell, of the sample that the rotation is fitted on, and of a candidate block.
GROUP_ROWS, BLOCK_QUERIES, SAMPLE_ROWS, STEP = 65_536, 8_192, 8_192, 2_048
#: Bytes of a group's vectors at 8 a component; a cell holds several copies of them.
GROUP_BYTES = 32 << 20
HEAD = 16


def integer_vectors(df: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): v holds floor(scale * x) of each component.

    Null vectors, empty ones, those with a null or non-finite component, those
    whose length is not the table's most common one and rows without vec_id
    take no part. Rows that repeat a vec_id count once (the least vector).
    """
    x = df.selectExpr("cast(vec_id as long) vec_id", "cast(embedding as array<double>) x").where(
        "vec_id is not null and size(x) > 0 and forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity'))")
    lengths = x.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim = lengths[0]["n"] if lengths else 0
    v = F.transform("x", lambda e: F.floor(e * F.lit(float(scale))).cast("long"))
    return x.where(F.size("x") == dim).select("vec_id", v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def rotation(vectors: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Right singular vectors of a sample of at most `rows` vectors, chosen by hash of the id."""
    sample = np.asarray([r.v for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).collect()], dtype=float)
    # They are the eigenvectors of the components' products, by falling eigenvalue: no matrix of rows by rows.
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1].copy()


def search_cell(queries, query_ids, vectors, ids, basis, k: int, head: int = HEAD, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, candidate id, score): each query's k best of `vectors`,
    ties to the smaller id, the query's own id left out."""
    order = np.lexsort((ids, -np.linalg.norm(vectors.astype(float), axis=1)))
    vectors, ids = vectors[order], ids[order]
    c, q = vectors.astype(float), queries.astype(float)
    c_len, q_len = np.linalg.norm(c, axis=1), np.linalg.norm(q, axis=1)
    exact = len(c) == 0 or c_len.max(initial=0) * q_len.max(initial=0) < 2**52
    c_rot, q_rot = c @ basis, q @ basis
    c_rest, q_rest = np.linalg.norm(c_rot[:, head:], axis=1), np.linalg.norm(q_rot[:, head:], axis=1)
    floor = np.full(len(q), -np.inf)
    kept = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]
    at, size = 0, min(step, 256)
    while at < len(c):
        slack = 1e-9 * q_len * c_len[at] + 1e-6
        live = np.flatnonzero(q_len * c_len[at] + slack >= floor)
        if not len(live):
            break
        here = slice(at, at + size)
        bound = q_rot[live, :head] @ c_rot[here, :head].T + np.outer(q_rest[live], c_rest[here])
        able = (bound + slack[live][:, None] >= floor[live][:, None]) & (query_ids[live][:, None] != ids[here][None, :])
        rows, columns = np.flatnonzero(able.any(1)), np.flatnonzero(able.any(0))
        if len(rows):
            able = able[np.ix_(rows, columns)]
            if exact:
                score = q[live[rows]] @ c[here][columns].T
            else:
                score = queries[live[rows]] @ vectors[here][columns].T
            shown = np.where(able, score.astype(float), -np.inf)
            best = floor[live[rows]]
            if shown.shape[1] > k:
                best = np.maximum(best, np.partition(shown, -k, axis=1)[:, -k])
            a, b = np.nonzero(able & (shown >= best[:, None]))
            new = [live[rows[a]], ids[here][columns[b]], score[a, b].astype(np.int64)]
            kept = [np.concatenate(x) for x in zip(kept, new, strict=True)]
            order = np.lexsort((kept[1], -kept[2], kept[0]))
            kept = [x[order] for x in kept]
            first = np.searchsorted(kept[0], kept[0], side="left")
            rank = np.arange(len(first)) - first
            kth = rank == k - 1
            floor[kept[0][kth]] = kept[2][kth]
            kept = [x[rank < k] for x in kept]
        at, size = at + size, step
    return tuple(kept)


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5, group_rows: int = GROUP_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k greatest products.

    Both frames have vec_id and v as integer_vectors() gives them. Fewer than
    k candidates give fewer rows; no vectors or no queries give no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score long"
    n, asked = vectors.count(), queries.count()
    if not n or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    basis = rotation(vectors)
    group_rows = max(1, min(group_rows, GROUP_BYTES // (8 * max(1, len(basis)))))
    block_queries = max(1, min(block_queries, GROUP_BYTES // (8 * max(1, len(basis)))))
    groups = max(-(-n // group_rows), min(2 * spark.sparkContext.defaultParallelism, -(-n // 2048)))
    blocks = -(-asked // block_queries)
    place = lambda c, of: F.pmod(F.xxhash64(c), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    base = vectors.select("vec_id", "v", F.lit(False).alias("asks"), place("vec_id", groups).alias("g")).withColumn("b", every(blocks))
    asks = queries.select("vec_id", "v", F.lit(True).alias("asks"), place("vec_id", blocks).alias("b")).withColumn("g", every(groups))

    def cell(t):
        import pyarrow as pa

        asks = t.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
        ids = t.column("vec_id").to_numpy()
        v = t.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        rows, found, score = search_cell(v[asks], ids[asks], v[~asks], ids[~asks], basis, k)
        return pa.table({"query_id": pa.array(ids[asks][rows], pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64())})

    cells = base.unionByName(asks).groupBy("g", "b").applyInArrow(cell, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
