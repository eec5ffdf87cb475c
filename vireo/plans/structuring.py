"""Structuring of descriptions by an outside service, kept by content: a text that has an answer is never asked again.

A run asks for the texts of its rows that have no answer yet, up to a limit, and
keeps answers and failures in a keyed table. A later run goes on where it ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo import schemas
from vireo.operators.lineage import settled
from vireo.operators.versioned import Bucketed
from vireo.plans.ingest import filled

ANSWERS = schemas.columns("content string, reply string, tries long, failure string, run_id long")
#: The text that a service is given, in order.
TEXTS = ("job_title", "job_description", "job_requirement")
TRIES = 3


def kept_at(path: str, buckets: int = 256) -> Bucketed:
    """The table of answers at `path`, a row a text; call create() once."""
    return Bucketed(path, ANSWERS, ("content",), buckets=buckets)


def content(texts: tuple[str, ...] = TEXTS) -> Column:
    """The hash of what is asked: rows whose texts are equal share it, null and empty texts are alike."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(c, F.lit("")) for c in texts])), 256)


def asked(rows: DataFrame, ask: Callable[[dict[str, str]], str], texts: tuple[str, ...] = TEXTS) -> DataFrame:
    """content, reply and failure: `ask` is given a row's texts by name and returns the reply; what it raises is its failure.

    A reply without a JSON object is a failure too. Calls run in tasks, one after
    the other in each; a task that is lost may repeat its calls.
    """
    import pyarrow as pa

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies, failures = [], []
            for row in batch.select(list(texts)).to_pylist():
                try:
                    replies.append(ask({k: v or "" for k, v in row.items()}))
                    failures.append(None)
                except Exception as e:  # the service's own errors, of any kind, are kept
                    replies.append(None)
                    failures.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(replies, pa.string()), pa.array(failures, pa.string())], names=["content", "reply", "failure"])

    told = rows.select("content", *texts).mapInArrow(call, "content string, reply string, failure string")
    found = F.nullif(F.regexp_extract("reply", r"(?s)(\{.*\})", 1), F.lit(""))
    object_ = F.when(F.try_parse_json(found).isNotNull(), found)
    return told.select("content", object_.alias("reply"), F.coalesce("failure", F.when(object_.isNull(), F.concat(F.lit("no JSON object: "), F.coalesce("reply", F.lit(""))))).alias("failure"))


def open_texts(rows: DataFrame, answers: DataFrame, texts: tuple[str, ...] = TEXTS, tries: int = TRIES) -> DataFrame:
    """The distinct texts of `rows` without an answer and with fewer than `tries` failures: content, texts, tries so far, and when first scraped."""
    wanted = rows.where(F.concat(*[F.trim(F.coalesce(c, F.lit(""))) for c in texts]) != "").withColumn("content", content(texts))
    distinct = wanted.groupBy("content").agg(*[F.max(F.coalesce(c, F.lit(""))).alias(c) for c in texts], F.min("scraped_at").alias("scraped_at"))
    known = answers.select("content", F.col("reply").isNotNull().alias("__answered"), F.col("tries").alias("__tries"))
    left = distinct.join(known, "content", "left").where(~F.coalesce("__answered", F.lit(False)) & (F.coalesce("__tries", F.lit(0)) < tries))
    return left.select("content", *texts, F.coalesce("__tries", F.lit(0)).alias("tries"), "scraped_at")


def run(spark: SparkSession, rows: DataFrame, kept: Bucketed, ask: Callable[[dict[str, str]], str], run_id: int, most: int | None = 50, tasks: int = 1, texts: tuple[str, ...] = TEXTS, tries: int = TRIES) -> int:
    """Ask for open texts from `tasks` tasks and keep what comes; gives how many were asked.

    At most `most` are (None: all), those scraped first before others: a limit by purpose, the service's.

    Replies are written before they are kept, so that later steps never call again.
    """
    left = open_texts(rows, kept.read(spark), texts, tries)
    turn = settled(left if most is None else left.orderBy("scraped_at", "content").limit(most), "turn")
    if turn.isEmpty():
        return 0
    told = settled(asked(turn.repartition(tasks), ask, texts), "replies")
    met = told.join(turn.select("content", "tries"), "content").select("content", "reply", (F.col("tries") + 1).alias("tries"), "failure", F.lit(run_id).cast("long").alias("run_id"))
    kept.load(met, {"reply": "replace", "tries": "replace", "failure": "replace", "run_id": "replace"})
    return told.count()


def structured(rows: DataFrame, answers: DataFrame, schema: str, texts: tuple[str, ...] = TEXTS, key: str = "id") -> DataFrame:
    """`rows` with the fields (`name string, ...`) of their texts' answers written in and `ai_processed` set; rows whose texts have none stay as they are.

    Null fields of an answer are empty texts; a title is written only where the answer has one.
    """
    found = answers.where("reply is not null").select("content", F.from_json("reply", schema).alias("__a"))
    names = [x.split()[0] for x in schema.split(",")]
    met = rows.select(key, content(texts).alias("content")).join(found, "content")
    given = met.select(key, *[F.trim(F.coalesce(F.col(f"__a.{n}"), F.lit(""))).alias(n) for n in names], F.lit(True).alias("ai_processed"))
    return filled(rows, given, key)


def failures(answers: DataFrame, tries: int = TRIES) -> DataFrame:
    """Texts without an answer: content, tries, the last failure, and whether they will be asked again."""
    return answers.where("reply is null").select("content", "tries", "failure", (F.col("tries") < tries).alias("asked_again"))
