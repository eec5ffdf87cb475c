"""Similar titles of a block, proposed by an index of their words and by counts of their letters.

Two titles that reach the least similarity share something:

* words: where one title's words make up most of the other's, some word of the
  other's rarest ones (as many as may be missing, and one more) is in both, so
  each title asks for a few rare words and meets the titles that hold them;
* letters: where the titles differ in at most d letters, so do their lengths
  and their counts of letters, and their stretches of k letters in at most
  (2 k - 1) d. Titles are dealt by length into tiles of bounded size, and each
  two tiles of near lengths are a group in which counts and bitmaps of
  stretches are compared as arrays; alignments of many pairs at once follow.

What is proposed is compared in full; nothing similar is missed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import compress, islice
from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.operators.lineage import settled

#: Titles of a tile, about. Two tiles are compared in one group.
TILE = 2048
#: Classes of letters that are counted, each up to MOST, so that the differences of all add up to 16 bits.
LETTERS, MOST = 32, 1000
#: Letters of a stretch.
GRAM = 4
#: Pairs of texts that are aligned at once, and letters after which those that need too many changes are given up.
BATCH, STEP = 4096, 32
#: Fewer pairs, or texts of more letters, are aligned one pair at a time.
FEW_PAIRS, LONG = 64, 1024
KEYS = "block long, title_id long, key string, weight long, budget long, ask boolean, letters long"
FOUND = "a long, b long, score double"


def word_keys(tokens: set[str], least: float) -> Iterator[tuple[str, int, int]]:
    """(key, weight, budget) of each word: the rarest that together weigh more than the budget are asked for."""
    length = sum(map(len, tokens)) + len(tokens) - 1
    budget = int(length * (200 - 2 * least) / (200 - least) + 1e-9)
    for token in tokens:
        yield token, len(token) + 1, budget


def bits(parts: Iterator[str]) -> int:
    """Which of 64 classes the parts fall into, as the bits of a signed number."""
    mask = 0
    for part in set(parts):
        mask |= 1 << crc32(part.encode()) % 64
    return mask - (1 << 64) if mask >> 63 else mask


def keys_of(title: str, least: float) -> Iterator[tuple]:
    """Rows of KEYS, after the id: what the title holds, and (`ask`) what it may ask for."""
    once = set(title.split())
    letters = bits(c for t in once for c in t)
    for key, weight, budget in word_keys(once, least):
        yield key, 0, 0, False, letters
        yield key, weight, budget, True, letters


def letters_and_stretches(texts: list[str], in_order: bool, bits: int):
    """(lengths, counts of letters, bitmaps) of texts; a stretch of letters and how often it came before set one of `bits` bits.

    Stretches have GRAM letters, spaces among them, where the words stand in the order in which they are compared; else
    they have GRAM - 1 letters of one word and the spaces beside it.
    """
    import numpy as np

    u, long = np.uint64, GRAM if in_order else GRAM - 1
    lengths = np.array([len(x) for x in texts], np.int64)
    codes = np.frombuffer((" " + "  ".join(texts) + " ").encode("utf-32-le"), np.uint32).astype(u)
    at = np.repeat(np.arange(len(texts)), lengths + 2)
    letters = np.bincount(at * LETTERS + (codes % u(LETTERS)).astype(np.int64), minlength=LETTERS * len(texts)).reshape(-1, LETTERS)
    last = len(codes) - long + 1
    if last <= 0:
        return lengths, np.minimum(letters, MOST).astype(np.int16), np.zeros((len(texts), bits // 64), u)
    hashed = np.zeros(last, u)
    for k in range(long):
        hashed = hashed * u(0x100000001B3) + codes[k : last + k]
    hashed = hashed * u(0x9E3779B97F4A7C15) >> u(24)
    meant = at[:last] == at[long - 1 :]
    if not in_order:
        for k in range(1, long - 1):
            meant &= codes[k : last + k] != 32
    keys = np.sort((at[:last][meant].astype(u) << u(40)) | hashed[meant])
    place = np.arange(len(keys))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], keys[1:] != keys[:-1])), place, 0)) if len(keys) else place
    bit = ((((keys & u((1 << 40) - 1)) + (place - first).astype(u) * u(0x9E3779B97F4A7C15)) * u(0xBF58476D1CE4E5B9)) >> u(32)).astype(np.int64) % bits
    owner = (keys >> u(40)).astype(np.int64)
    maps = []
    for low in range(0, len(texts), 256):
        part = np.zeros((min(256, len(texts) - low), bits), bool)
        ends = np.searchsorted(owner, [low, low + 256])
        part[owner[ends[0] : ends[1]] - low, bit[ends[0] : ends[1]]] = True
        maps.append(np.packbits(part, axis=1).view(u))
    return lengths, np.minimum(letters, MOST).astype(np.int16), np.concatenate(maps)


def close_counts(texts: list[str], others: list[str] | None, least: float, in_order: bool) -> Iterator[tuple[int, int]]:
    """Places of the texts and others, each words joined by spaces, that letters and stretches do not tell apart. Without
    others, the texts are compared with each other, each two of them once.

    A letter put in or taken out changes one count of letters and at most 2 k - 1 stretches of k letters. Counts are cut
    off and stretches fall on bits, which only makes texts more alike.
    """
    import numpy as np

    if not texts or others == []:
        return
    bits = min(1 << 16, max(1 << 10, 1 << (16 * max(map(len, texts + (others or [])))).bit_length()))
    n, letters, stretches = left = letters_and_stretches(texts, in_order, bits)
    m, other_letters, other_stretches = left if others is None else letters_and_stretches(others, in_order, bits)
    rows, columns = np.argsort(n, kind="stable"), np.argsort(m, kind="stable")
    n, m, share, changed = n[rows], m[columns], (100 - least) / 100, 2 * (GRAM if in_order else GRAM - 1) - 1
    letters, other_letters = letters[rows], np.ascontiguousarray(other_letters[columns].T)
    for at in range(0, len(n), 64):
        some = slice(at, min(at + 64, len(n)))
        low, high = np.searchsorted(m, n[some][0] * least / (200 - least) - 1e-6, "left"), np.searchsorted(m, n[some][-1] * (200 - least) / least + 1e-6, "right")
        if low == high:
            continue
        differ = np.zeros((len(n[some]), high - low), np.int16)
        one = np.empty_like(differ)
        for k in range(LETTERS):
            np.subtract(other_letters[k, low:high], letters[some, k, None], out=one)
            np.add(differ, np.abs(one, out=one), out=differ)
        i, j = np.nonzero(differ <= (n[some] * share)[:, None].astype(np.float32) + (m[low:high] * share + 0.01).astype(np.float32))
        i, j = i + at, j + low
        if others is None:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1024):
            x, y = i[part : part + 1024], j[part : part + 1024]
            apart = np.bitwise_count(stretches[rows[x]] ^ other_stretches[columns[y]]).sum(1)
            near = apart <= changed * np.floor((n[x] + m[y]) * share + 1e-6)
            yield from zip(rows[x[near]].tolist(), columns[y[near]].tolist(), strict=True)


def padded(texts: list[str], lengths, fill: int):
    """The texts' classes of letters as a matrix, rows filled up with a class of their own."""
    import numpy as np

    out = np.full((len(texts), max(1, int(lengths.max()))), fill, np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) % LETTERS
    return out


def within_one(a: str, b: str, most: int) -> bool:
    """As `within`, of one pair and exactly: for few pairs or long texts."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    spare_a, spare_b = (most + n - m) // 2, (most + m - n) // 2
    masks: dict[str, int] = {}
    row = width = 0
    for at in range(0, m, STEP):
        end = min(at + STEP, m)
        reach = min(end + spare_a, n)
        for i in range(width, reach):
            masks[a[i]] = masks.get(a[i], 0) | 1 << i
        row |= (1 << reach) - (1 << width)
        width, full = reach, (1 << reach) - 1
        for c in b[at:end]:
            hit = row & masks.get(c, 0)
            row = ((row + hit) | (row - hit)) & full
        if end - width + row.bit_count() > spare_b:
            return False
    return True


def within(lefts: list[str], rights: list[str], most: list[int]):
    """For each pair of texts, False only where more than `most` letters put in and taken out are needed.

    The longest common subsequences of classes of letters grow by one letter of all right texts at a time, as rows of
    bits; a letter stands for none that is further on than left letters may be left out, and pairs are given up once
    the part read so far needs more.
    """
    import numpy as np

    if len(lefts) < FEW_PAIRS or max(map(len, lefts)) > LONG:
        return [within_one(*x) for x in zip(lefts, rights, most, strict=True)]
    u = np.uint64
    n, m, most = (np.array(x, np.int64) for x in ([len(x) for x in lefts], [len(x) for x in rights], most))
    out = np.abs(n - m) <= most
    live = np.nonzero(out)[0]
    if not len(live):
        return out
    left, right = padded(lefts, n, LETTERS), padded(rights, m, LETTERS + 1)
    kinds, masks, rows = LETTERS + 2, [], []
    n, m, most = n[live], m[live], most[live]
    spare_n, spare_m, at = (most + n - m) // 2, (most + m - n) // 2, 0
    while len(live) and at < m.max():
        end = at + STEP
        for limb in range(len(rows), int(-(-min(n.max(), end + spare_n.max()) // 64))):
            mask = np.zeros((len(left), kinds), u)
            for k, column in enumerate(range(64 * limb, min(64 * limb + 64, left.shape[1]))):
                mask[live, left[live, column]] |= u(1 << k)
            masks.append(mask.reshape(-1))
            rows.append(np.full(len(live), (1 << 64) - 1, u))
        for column in range(at, min(end, right.shape[1])):
            place = live * kinds + right[live, column]
            carry = None
            for limb, (mask, row) in enumerate(zip(masks, rows, strict=True)):
                here = mask[place]
                total = row + (row & here)
                over = total < row
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over
                rows[limb] = total | (row & ~here)
        # Letters of the left texts that may have been met so far, and those of them that stand in the subsequence.
        reach, met = np.minimum(n, end + spare_n), 0
        for limb, row in enumerate(rows):
            inside = np.clip(reach - 64 * limb, 0, 64).astype(u)
            keep = np.where(inside == 64, u((1 << 64) - 1), (u(1) << (inside & u(63))) - u(1))
            met = met + np.bitwise_count(~row & keep).astype(np.int64)
        good = np.minimum(m, end) - met <= spare_m
        out[live[~good]] = False
        # Pairs read to the end are settled.
        good &= m > end
        live, n, m, spare_n, spare_m, at = live[good], n[good], m[good], spare_n[good], spare_m[good], end
        rows = [row[good] for row in rows]
    return out


def letter_pairs(titles: list[str], others: list[str] | None, once: bool, least: float) -> Iterator[tuple[int, int]]:
    """Places of the titles and others (or of two titles) whose words, in order of the alphabet, differ in few enough letters.

    With `once`, words count once, and those of both titles stand before the others.
    """
    sides = [[sorted(set(t.split()) if once else t.split()) for t in x] for x in (titles, others or [])]
    (texts, other_texts), (sets, other_sets) = ([[f(w) for w in x] for x in sides] for f in (" ".join, frozenset))
    if others is None:
        sides, other_texts, other_sets = [sides[0]] * 2, texts, sets
    pairs = close_counts(texts, None if others is None else other_texts, least, not once)
    letters = max(map(len, texts + other_texts), default=1)
    while some := list(islice(pairs, max(1, min(BATCH, BATCH * 512 // max(1, letters))))):
        most = [int((len(texts[i]) + len(other_texts[j])) * (100 - least) / 100 + 1e-9) for i, j in some]
        if once:
            left = [" ".join([w for w in sides[0][i] if w not in other_sets[j]]) for i, j in some]
            right = [" ".join([w for w in sides[1][j] if w not in sets[i]]) for i, j in some]
        else:
            left, right = [texts[i] for i, _ in some], [other_texts[j] for _, j in some]
        yield from compress(some, within(left, right, most))


def mostly_held(one: frozenset, two: frozenset, least: float) -> bool:
    """Whether the words of both make up most of one title's words."""
    shared = one & two
    if not shared or len(shared) in (len(one), len(two)):
        return bool(shared)
    length = lambda words: sum(map(len, words)) + len(words) - 1
    return 200 * length(shared) >= least * (length(shared) + min(length(one), length(two))) - 1e-6


def size_of(length: int, least: float) -> int:
    """The class of a length, as wide as lengths of similar texts may differ."""
    return math.floor(math.log(length) / width_of(least))


def width_of(least: float) -> float:
    return math.log(max((200 - least) / least, 1.05)) + 1e-9


def similar_among(titles: list[str], least: float, similarity: Callable[[str, str], float]) -> dict[int, dict[int, float]]:
    """For each place of these distinct titles, the places of similar ones and how similar they are: as `similar_titles`, for
    the titles of a block that one task holds. A title is similar to itself, whatever the least."""
    near: dict[int, dict[int, float]] = {i: {i: 100.0} for i in range(len(titles))}

    def compare(a: int, b: int) -> None:
        if a != b and b not in near[a] and (score := similarity(titles[a], titles[b])) >= least:
            near[a][b] = near[b][a] = score

    words = [frozenset(t.split()) for t in titles]
    holders: dict[str, list[int]] = {}
    for i, own in enumerate(words):
        for w in own:
            holders.setdefault(w, []).append(i)
    for i, own in enumerate(words):
        before = 0
        for key, weight, budget in sorted(word_keys(own, least), key=lambda k: (len(holders[k[0]]), k[0])):
            if before > budget:
                break
            before += weight
            for j in holders[key]:
                if mostly_held(own, words[j], least):
                    compare(i, j)
    for once in (False, True):
        sizes: dict[int, list[int]] = {}
        for i, t in enumerate(titles):
            if text := " ".join(words[i] if once else t.split()):
                sizes.setdefault(size_of(len(text), least), []).append(i)
        for size, own in sizes.items():
            wider = sizes.get(size + 1, [])
            for other, names in ((own, None), (wider, [titles[k] for k in wider])):
                for i, j in letter_pairs([titles[k] for k in own], names, once, least):
                    compare(own[i], other[j])
    return near


def by_letters(titles: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of similar titles that differ in few letters; a pair may come twice.

    Words count with repeats and without, each by lengths of its own. A length
    class is as wide as lengths may differ, so similar titles lie in one class or in two neighbours.
    """
    from vireo.operators.linkage import title_similarity

    def compared(pdf):
        import pandas as pd

        sides = [pdf[pdf["side"] != 1], pdf[pdf["side"] != 0]]
        ids, names = ([x[c].tolist() for x in sides] for c in ("title_id", "title"))
        out, itself = [], pdf["side"].iloc[0] == 2
        for i, j in letter_pairs(names[0], None if itself else names[1], bool(pdf["once"].iloc[0]), least):
            a, b = ids[0][i], ids[1][j]
            if (score := title_similarity(names[0][i], names[1][j])) >= least:
                out.append((min(a, b), max(a, b), score))
        return pd.DataFrame(out, columns=["a", "b", "score"]).astype({"a": "int64", "b": "int64", "score": "float64"})

    c = F.col
    width = width_of(least)
    words = F.filter(F.split("title", r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    kinds = titles.select("block", "title_id", "title", F.explode(F.array(F.struct(F.lit(True).alias("once"), F.array_distinct(words).alias("words")), F.struct(F.lit(False).alias("once"), words.alias("words")))).alias("k"))
    rows = kinds.where(F.size("k.words") > 0).select("block", "title_id", "title", "k.once", F.floor(F.log(F.length(F.array_join("k.words", " ")).cast("double")) / width).alias("size"))
    rows = settled(rows, "title-lengths")
    tiles = rows.groupBy("block", "once", "size").agg(F.ceil(F.count("*") / TILE).cast("int").alias("n"))
    beside = lambda by, name: tiles.select("block", "once", (c("size") + by).alias("size"), c("n").alias(name))
    tiles = settled(tiles.join(beside(1, "below"), ["block", "once", "size"], "left").join(beside(-1, "above"), ["block", "once", "size"], "left"), "title-tiles")
    dealt = rows.join(tiles, ["block", "once", "size"]).withColumn("at", F.pmod(F.xxhash64("title_id"), "n").cast("int"))
    upto = lambda n: F.when(c(n) > 0, F.sequence(F.lit(0), c(n) - 1)).otherwise(F.array().cast("array<int>"))
    group = lambda size, low, high, top, side: F.struct(size.alias("low"), low.alias("tile"), high.alias("other"), F.lit(top).alias("wider"), side.alias("side"))
    groups = F.concat(
        F.transform(upto("n"), lambda x: group(c("size"), F.least(c("at"), x), F.greatest(c("at"), x), 0, F.when(x == c("at"), 2).when(c("at") < x, 0).otherwise(1))),
        F.transform(upto("above"), lambda x: group(c("size"), c("at"), x, 1, F.lit(0))), F.transform(upto("below"), lambda x: group(c("size") - 1, x, c("at"), 1, F.lit(1))))
    dealt = dealt.select("block", "once", "title_id", "title", F.explode(groups).alias("g")).select("block", "once", "title_id", "title", "g.*")
    return dealt.groupBy("block", "once", "low", "tile", "other", "wider").applyInPandas(compared, FOUND)


def by_words(titles: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of similar titles of which one holds most words of the other."""
    from vireo.operators.linkage import title_similarity

    def keys(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = [(block, i, *r) for i, t, block in zip(*(c.to_pylist() for c in part.columns), strict=True) for r in keys_of(t, least)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()))],
                                                 names=["block", "title_id", "key", "weight", "budget", "ask", "letters"])

    def compared(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out, known = [], {}
            of = lambda t: known.get(t) or known.setdefault(t, frozenset(t.split()))
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if mostly_held(of(x), of(y), least) and (score := title_similarity(x, y)) >= least:
                    out.append((a, b, score))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "score"])

    rows = settled(titles.select("title_id", "title", "block").mapInArrow(keys, KEYS), "title-keys")
    holds = rows.where("not ask").select("block", "key", F.col("title_id").alias("other"), F.col("letters").alias("letters_b"))
    often = holds.groupBy("block", "key").agg(F.count("*").alias("often"))
    asked = rows.where("ask").join(often, ["block", "key"])
    before = F.sum("weight").over(Window.partitionBy("title_id").orderBy("often", "key").rowsBetween(Window.unboundedPreceding, -1))
    asked = asked.withColumn("before", F.coalesce(before, F.lit(0))).where("before <= budget")
    # Of words that make up most of a title, few letters can be missing.
    missing = F.bit_count(F.col("letters").bitwiseAND(F.bitwise_not("letters_b")))
    pairs = asked.join(holds, ["block", "key"]).where((F.col("title_id") != F.col("other")) & (missing <= F.col("budget")))
    pairs = pairs.select(F.least("title_id", "other").alias("a"), F.greatest("title_id", "other").alias("b")).distinct()
    text = lambda x: titles.select(F.col("title_id").alias(x), F.col("title").alias(f"title_{x}"))
    return pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "title_a", "title_b").mapInArrow(compared, FOUND)


def similar_titles(titles: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of the pairs of `titles` (title_id, title, block) in one block that are at least so similar.

    a < b; titles of a block are distinct. `titles` has been written.
    """
    return by_words(titles, least).unionByName(by_letters(titles, least)).distinct()


def pieces(titles: DataFrame, edges: DataFrame) -> DataFrame:
    """(title_id, piece): the titles that edges (a, b) hold together, named by the least id.

    Each round every title takes the least name of its neighbours and then the
    name of that name, so names travel in doubling steps; rounds are written.
    """
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "title-neighbours")
    now = settled(titles.select("title_id", F.col("title_id").alias("piece")).join(both.select(F.col("a").alias("title_id")).distinct(), "title_id", "left_semi"), "pieces")
    while True:
        offered = both.join(now.select(F.col("title_id").alias("b"), "piece"), "b").groupBy("a").agg(F.min("piece").alias("least"))
        # What a title learns holds for the title that names it too: names are hooked onto lesser ones, then followed.
        joined = now.join(offered, F.col("title_id") == F.col("a")).select("title_id", "piece", F.least("piece", "least").alias("least"))
        hooks = joined.groupBy("piece").agg(F.min("least").alias("root"))
        step = joined.join(hooks, "piece").select("title_id", F.col("piece").alias("old"), F.col("root").alias("piece"))
        names = step.select(F.col("title_id").alias("piece"), F.col("piece").alias("root"))
        step = settled(step.join(names, "piece").select("title_id", "old", F.col("root").alias("piece")), "pieces")
        changed = step.where("old <> piece").limit(1).count()
        now = step.select("title_id", "piece")
        if not changed:
            break
    return titles.select("title_id").join(now, "title_id", "left").select("title_id", F.coalesce("piece", "title_id").alias("piece"))

