"""The operators as stages: documents in, documents (at the end pieces) out.

Stages keep the columns of what they get, in order, whatever further columns
there are; their own working columns begin with two underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm import minhash, mixing, packing, pii, quality
from vireo.llm.common import WORD, settle

#: Words of a shingle, and similarity in per cent, of the near-duplicate stage.
SHINGLE, SIMILARITY = 5, 80
#: Chunks and words that the packing stage's workers remember: they outlive the stage beside other stages' memory.
REMEMBERED = 60_000


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that the classifier does not reject; null and empty texts are scored as empty."""
    return quality.kept_documents(docs, quality.fit(docs, labels))


def distinct(docs: DataFrame) -> DataFrame:
    """Rows of one text a group, that of the least doc_id; those without words or id stay.

    Rows that repeat a doc_id are judged each by its own text; of rows that
    repeat both doc_id and text one stays.
    """
    found = settle(minhash.decisions(docs, SHINGLE, SIMILARITY), "groups")
    key = [F.col("doc_id").cast("long") == F.col("__id"), F.expr(minhash.KEY) == F.col("__text")]
    named = found.where("doc_id is not null").select(F.col("doc_id").alias("__id"), F.col("key").alias("__text"), "chosen")
    gone = named.where("not chosen").select("__id", "__text").distinct()
    kept = docs.join(gone.hint("merge"), key, "left_anti")
    repeated = settle(named.where("chosen").groupBy("__id", "__text").count().where("count > 1").select("__id", "__text"), "repeated")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, key, "left_anti").unionByName(kept.join(repeated, key, "left_semi").dropDuplicates(["doc_id", "text"]))


def masked(docs: DataFrame) -> DataFrame:
    return pii.redacted(docs)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each of up to two times that words of a
    document are taken, with those words (and the white space after them) as
    its text and n_chars counted anew.

    Rows equal in doc_id, source and text count once; rows of which nothing is
    taken, those without words among them, are not in the mix.
    """
    # 128 bits, from two orders of the columns: no two of 10^15 different rows are likely to share them.
    keyed = docs.withColumn("__key", F.concat_ws(":", F.xxhash64("doc_id", "source", "text"), F.xxhash64(F.lit(1), "text", "source", "doc_id")))
    rows = keyed.select(F.col("__key").alias("doc_id"), F.col("source").cast("string").alias("source"), mixing.words(F.col("text").cast("string")).alias("size"))
    rows = settle(rows, "sizes")
    once = rows.dropDuplicates(["doc_id"])
    segments, _ = mixing.mix(once)
    ranges = segments.where("times > 0").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("begin", "length", "times"))).alias("__ranges"), F.sum("length").alias("__words"), F.sum(F.when(F.col("times") > 1, F.col("length"))).alias("__again"), F.first("size").alias("__size"))
    if once.count() < rows.count():
        keyed = keyed.dropDuplicates(["__key"])
    both = keyed.join(ranges.withColumnRenamed("doc_id", "__key").hint("merge"), "__key")
    whole = (F.col("__words") == F.col("__size")) & ((F.col("__again") == F.col("__size")) | F.col("__again").isNull())
    tokens = F.when(whole, F.array().cast("array<string>")).otherwise(F.regexp_extract_all("text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)))
    both = both.withColumn("__tokens", tokens)

    def taken(words, least: int):
        part = F.flatten(F.transform(F.filter("__ranges", lambda r: r["times"] >= least), lambda r: F.slice("__tokens", (r["begin"] + 1).cast("int"), r["length"].cast("int"))))
        return F.when(words == F.col("__size"), F.col("text")).when(words > 0, F.rtrim(F.array_join(part, "")))

    texts = F.array(taken(F.col("__words"), 1), taken(F.col("__again"), 2))
    out = both.withColumn("__text", F.explode(F.filter(texts, lambda t: t.isNotNull())))
    columns = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.char_length("__text").cast(docs.schema["n_chars"].dataType)
    return out.withColumns(columns).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, remembered=REMEMBERED)
