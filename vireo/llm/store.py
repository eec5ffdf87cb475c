"""Content-addressed store of token-id streams.

A rolling hash over a window of ids cuts each document's stream into chunks;
a chunk's address is its digest. The store is one table of records in
ascending doc_id order, split into shards by doc_id range:

* `doc` records hold a document's recipe (digests and lengths of its chunks)
  and, end to end, the chunks that no other place in the corpus uses;
* `chunk` records hold a chunk that is used more than once, exactly once, in
  the shard of its first use;
* `manifest` records hold a shard's counts and the Merkle root over the
  recipes of its documents, in order.

Reading fetches shared chunks by digest, checks every chunk against its
digest and every shard against its Merkle root. Null and empty texts are
their end id alone; repeated rows are stored each (their chunks once); a null
doc_id sorts first; no rows make an empty store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vireo.llm.common import settle
from vireo.llm.tokens import END, crc, encoder, vocabulary, with_end

WINDOW = 8
#: A cut is made where this many low bits of the rolling hash are 0, between the least and the most ids.
CUT_BITS, LEAST, MOST = 8, 64, 2048
SHARD_TOKENS, SHARD_ROWS = 8_000_000, 100_000
#: Bytes of text that are encoded at a time.
PART_BYTES = 4 << 20

STREAM = "row long, doc_id long, n_tokens long, leaf binary, digests array<binary>, lens array<int>, ids binary"
RECORD = (
    "kind string, shard int, doc_id long, row long, pos long, n_tokens long, start long, leaf binary, digests array<binary>, "
    "lens array<int>, shared array<int>, ids binary, digest binary, root binary")


def digest(data: bytes) -> bytes:
    return blake2b(data, digest_size=16).digest()


def rolling_table(size: int) -> np.ndarray:
    """A 32-bit hash for each id, from the splitmix64 rule; `size` is a power of two."""
    z = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).astype(np.uint32)


def candidates(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where the cyclic hash of the last WINDOW ids lets a chunk end, over many documents' ids at once.

    The hash is the exclusive or of the ids' hashes, turned by their distance; it
    doubles its window until that is WINDOW. Places that look back into the
    document before lie under LEAST, where no cut is made.
    """
    h, k = table[ids & (len(table) - 1)], 1
    while k < WINDOW:
        turned = (h[:-k] << np.uint32(k)) | (h[:-k] >> np.uint32(32 - k))
        h[k:] ^= turned
        k *= 2
    return np.flatnonzero((h & np.uint32((1 << CUT_BITS) - 1)) == 0) + 1


def boundaries(cuts: list[int], last: int, n: int) -> list[int]:
    """Ends of the chunks of the ids from `last` to n; content decides, so equal passages are cut alike."""
    ends = []
    for c in [*cuts, n]:
        while c - last > MOST:
            last += MOST
            ends.append(last)
        if c - last >= LEAST or c == n and c > last:
            ends.append(c)
            last = c
    return ends


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairs are hashed upwards; an odd last one rises as it is; none: the digest of nothing."""
    if not leaves:
        return digest(b"")
    while len(leaves) > 1:
        leaves = [digest(b"".join(leaves[i : i + 2])) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
    return leaves[0]


def values(column) -> list:
    """An Arrow column, not nested, as Python values; much quicker than to_pylist()."""
    return column.to_numpy(zero_copy_only=False).tolist()


def lists(column) -> list[list]:
    """An Arrow column of lists as Python lists; a null list is empty."""
    at, held = column.offsets.to_numpy(), values(column.flatten())
    return [held[i:j] for i, j in pairwise((at - at[0]).tolist())]


def parts(batch) -> Iterator:
    """A record batch in runs of rows of some PART_BYTES of text; a longer text is a run of its own or ends one."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    at = [0, *(np.flatnonzero(np.diff(sizes // PART_BYTES)) + 1).tolist(), batch.num_rows]
    for begin, stop in pairwise(at):
        if stop > begin:
            yield batch.slice(begin, stop - begin)


def streams(docs: DataFrame, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Each document's ids with its chunks' digests and lengths."""
    path = vocabulary(tokenizer)

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        code, row = encoder(path), TaskContext.get().partitionId() << 36
        hashes = rolling_table(1 << 16)
        for batch in batches:
            for part in parts(batch):
                ids, stops = code.flat(part.column(1), end)
                begins = np.concatenate([[0], stops[:-1]])
                cuts = candidates(ids, hashes)
                held = zip(np.searchsorted(cuts, begins, "right").tolist(), np.searchsorted(cuts, stops).tolist(), begins.tolist(), stops.tolist(), strict=True)
                cuts = cuts.tolist()
                chunks = [boundaries(cuts[i:j], first, stop) for i, j, first, stop in held]
                view, ends = memoryview(ids.astype(code.dtype, copy=False)).cast("B"), [e for x in chunks for e in x]
                digests = [digest(view[s * code.width : e * code.width]) for s, e in zip([0, *ends], ends, strict=False)]
                counts = np.cumsum([0, *map(len, chunks)])
                leaves = [digest(b"".join(digests[i:j])) for i, j in pairwise(counts.tolist())]
                offsets = pa.array(counts, pa.int32())
                packs = pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(np.concatenate([[0], stops * code.width]).astype(np.int32)), pa.py_buffer(view)])
                rows = np.arange(row, row + len(stops))
                row += len(stops)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), part.column(0), pa.array(stops - begins, pa.int64()), pa.array(leaves, pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(digests, pa.binary())), pa.ListArray.from_arrays(offsets, pa.array(np.diff(ends, prepend=0), pa.int32())), packs],
                    names=["row", "doc_id", "n_tokens", "leaf", "digests", "lens", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(encode, STREAM)


def records(streamed: DataFrame, shards: int) -> DataFrame:
    """The store's records from written streams."""
    uses = streamed.select("doc_id", "row", F.posexplode("digests").alias("idx", "digest"))
    repeated = uses.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "idx")).alias("first")).where("n > 1")
    flagged = uses.join(repeated, "digest").select("doc_id", "row", "idx", (F.struct("doc_id", "row", "idx") == F.col("first")).alias("owner"))
    flags = flagged.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(F.struct("idx", "owner"))).alias("flags"))
    nothing = {c: F.lit(None).cast(t) for c, t in streamed.dtypes if c not in ("doc_id", "row")}
    both = streamed.withColumn("flags", F.lit(None).cast("array<struct<idx:int,owner:boolean>>")).unionByName(flags.withColumns(nothing))
    ordered = both.repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row", F.col("flags").isNull())

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        nested = {"digests": pa.list_(pa.binary()), "lens": pa.list_(pa.int32()), "shared": pa.list_(pa.int32())}
        plain = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(c, nested.get(c) or plain[t]) for c, t in (x.split() for x in RECORD.split(", "))])
        shard, pos, start, leaves, pending = TaskContext.get().partitionId(), 0, 0, [], (None, {})

        def made(n: int, **columns):
            """n records; columns that are not given are null, single values repeat."""
            fill = lambda f: pa.nulls(n, f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name] if isinstance(columns[f.name], list) else [columns[f.name]] * n, f.type)
            return pa.RecordBatch.from_arrays([fill(f).cast(f.type) for f in schema], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows, counts, ids, flagged = values(part.column("row")), values(part.column("n_tokens").fill_null(0)), values(part.column("ids")), part.column("flags").to_pylist()
                recipes, lengths = lists(part.column("digests")), lists(part.column("lens"))
                docs, shared, kept, starts, chunks = [], [], [], [], []
                for i, row in enumerate(rows):
                    if flagged[i] is not None:
                        pending = row, {f["idx"]: f["owner"] for f in flagged[i]}
                        continue
                    flags = pending[1] if pending[0] == row else {}
                    own = ids[i]
                    if flags:
                        width, place, parts = len(own) // counts[i], 0, []
                        for k, (d, n) in enumerate(zip(recipes[i], lengths[i], strict=True)):
                            chunk = own[place : place + n * width]
                            place += n * width
                            if k not in flags:
                                parts.append(chunk)
                            elif flags[k]:
                                chunks.append((d, chunk))
                        own = b"".join(parts)
                    docs.append(i)
                    shared.append(sorted(flags))
                    kept.append(own)
                    starts.append(start)
                    start += counts[i]
                if docs:
                    mine = part.take(pa.array(docs))
                    leaves += values(mine.column("leaf"))
                    yield made(
                        len(docs), kind="doc", shard=shard, pos=list(range(pos, pos + len(docs))), start=starts, shared=shared, ids=kept,
                        **{c: mine.column(c) for c in ("doc_id", "row", "n_tokens", "leaf", "digests", "lens")})
                    pos += len(docs)
                if chunks:
                    yield made(len(chunks), kind="chunk", shard=shard, digest=[d for d, _ in chunks], ids=[c for _, c in chunks])
        if pos:
            yield made(1, kind="manifest", shard=shard, pos=pos, n_tokens=start, root=merkle_root(leaves))

    return ordered.select("doc_id", "row", "n_tokens", "leaf", "digests", "lens", "ids", "flags").mapInArrow(write, RECORD)


def write_store(docs: DataFrame, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Write the store of all `docs` to the shared folder; gives its records."""
    streamed = settle(streams(docs, tokenizer, end), "streams")
    tokens, rows = streamed.agg(F.sum("n_tokens"), F.count("*")).first()
    shards = max(1, -(-(tokens or 0) // SHARD_TOKENS), -(-rows // SHARD_ROWS))
    return settle(records(streamed, shards), "store")


def read_store(store: DataFrame) -> DataFrame:
    """(shard, pos, doc_id, start, n_tokens, ids): each document's ids, 32 bits
    each, checked against their digests; `start` counts from the shard's first id."""
    return rebuilt(store, lambda ids: ids.tobytes(), "binary")


def rebuilt(store: DataFrame, finish: Callable[[np.ndarray], object], kind: str) -> DataFrame:
    """read_store() with finish(ids), of SQL type `kind`, for ids."""
    documents = store.where("kind = 'doc'").select("shard", "pos", "row", "doc_id", "start", "n_tokens", "leaf", "digests", "lens", "shared", "ids")
    whole = documents.where("size(shared) = 0").withColumn("fetched", F.lit(None).cast("array<struct<idx:int,ids:binary>>"))
    parted = documents.where("size(shared) > 0")
    wanted = parted.select("row", F.explode("shared").alias("idx"), "digests").select("row", "idx", F.expr("digests[idx]").alias("digest"))
    chunks = store.where("kind = 'chunk'").select("digest", "ids")
    fetched = wanted.join(chunks, "digest").groupBy("row").agg(F.collect_list(F.struct("idx", "ids")).alias("fetched"))
    both = whole.unionByName(parted.join(fetched, "row", "left"))

    def rebuild(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                done = []
                for leaf, recipe, lens, own, fetched in zip(values(part.column("leaf")), lists(part.column("digests")), lists(part.column("lens")), values(part.column("ids")), part.column("fetched").to_pylist(), strict=True):
                    given = {f["idx"]: f["ids"] for f in fetched or ()}
                    mine = sum(lens) - sum(lens[k] for k in given)
                    width = len(own) // mine if mine else len(given[0]) // lens[0]
                    parts, place = [], 0
                    for k, n in enumerate(lens):
                        chunk = given.get(k)
                        if chunk is None:
                            chunk = own[place : place + n * width]
                            place += n * width
                        parts.append(chunk)
                    if [digest(x) for x in parts] != recipe or digest(b"".join(recipe)) != leaf:
                        raise ValueError(f"document {part.column('doc_id')[len(done)].as_py()}: a chunk does not match its digest")
                    done.append(finish(np.frombuffer(b"".join(parts), dtype=f"<u{width}").astype("<u4")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("shard", "pos", "doc_id", "start", "n_tokens")), pa.array(done, pa.int64() if kind == "long" else pa.binary())], names=["shard", "pos", "doc_id", "start", "n_tokens", "ids"])

    return both.select("shard", "pos", "doc_id", "start", "n_tokens", "leaf", "digests", "lens", "ids", "fetched").mapInArrow(rebuild, f"shard int, pos long, doc_id long, start long, n_tokens long, ids {kind}")


def starts_and_checksums(store: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of all documents, read back from the
    store, after each shard's Merkle root has been checked.

    A running sum over the manifests, one row a shard, gives where a shard
    begins.
    """
    read = rebuilt(store, crc, "long").withColumnRenamed("ids", "ids_crc32")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = store.where("kind = 'manifest'").select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    verified = roots_checked(store)
    return read.join(bases.join(verified, "shard"), "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def roots_checked(store: DataFrame) -> DataFrame:
    """The shards whose recipes give the manifest's Merkle root; a mismatch raises.

    A task holds one shard's leaves (the digests of its recipes), which SHARD_ROWS and SHARD_TOKENS bound.
    """
    leaves = store.where("kind in ('doc', 'manifest')").select("shard", "kind", "pos", "leaf", "root")

    def check(df):
        import pandas as pd

        found = df[df.kind == "doc"].sort_values("pos")
        wanted = df[df.kind == "manifest"]
        root = merkle_root([bytes(x) for x in found.leaf])
        if len(wanted) != 1 or bytes(wanted.root.iloc[0]) != root or wanted.pos.iloc[0] != len(found):
            raise ValueError(f"shard {df.shard.iloc[0]} does not match its manifest")
        return pd.DataFrame({"shard": df.shard.iloc[:1]})

    return leaves.groupBy("shard").applyInPandas(check, "shard int")


def open_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
