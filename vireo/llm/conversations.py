"""Repair of the structure of conversations, each distinct signature solved once.

A conversation's rows are ordered by turn (nulls first), role and text. Each row
becomes one letter of the signature: its role's initial (s, u, a; x for others),
a capital if its text is cut off, or d if it must go (blank, or a repetition of
an earlier row). Distinct signatures are solved by memoised recursion; the
cheapest edits (the audit: Keep, Rerole, Delete, Insert) are joined back and
replayed over the rows.

Null roles and texts are read as one space; a null conv_id is a conversation of
its own; null turns come first and count in no gap. Rows that repeat count each,
the later ones as duplicates. Further columns are left out. A conversation
without rows has an empty signature and audit, at no cost.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vireo.llm.common import settle

#: White space; marks that end a sentence; costs of the edits, and of a kept row that is cut off.
SPACE, ENDS = "\x20\t\n\x0b\x0c\r", (".", "!", "?")
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: The role that must come next after nothing, a system row, a user row, an assistant row; where a conversation may end.
NEXT, MAY_END = {"": "u", "s": "u", "u": "a", "a": "u"}, ("", "a")
ROLES = {"u": "user", "a": "assistant"}
#: Rows of a signature that recursion goes through at a time.
DEPTH = 100


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): the rows, damaged as the crc32 of `conv_id:turn` says; those dropped are not `present`."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn")).cast("binary")), F.lit(20))
    df = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), of("role").alias("role"), of("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), times.alias("copy")).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text and present) with their place `at` in the conversation, from 1, their fault, letter and initial."""
    rows = rows.withColumns({"role": F.coalesce("role", F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    order = Window.partitionBy("conv_id").orderBy(F.desc("present"), F.asc_nulls_first("turn"), "role", "text")
    same = Window.partitionBy("conv_id", "role", "text").orderBy("at")
    rows = rows.withColumns({"at": F.row_number().over(order), "initial": F.substring("role", 1, 1), "last_initial": F.lag(F.substring("role", 1, 1)).over(order), "last_turn": F.lag("turn").over(order)})
    tail = F.rtrim("text", F.lit(SPACE))
    fault = F.when(tail == "", "blank").when(F.row_number().over(same) > 1, "duplicate").when(~F.right(tail, F.lit(1)).isin(*ENDS), "truncated")
    rows = rows.withColumn("fault", fault)
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return rows.withColumn("letter", letter)


def signatures(rows: DataFrame) -> DataFrame:
    """A row for each conversation of the judged rows: counts of gaps, faults and illegal neighbours, and its signature."""
    here = F.col("present")
    count = lambda c: F.count(F.when(here & c, 1))
    turns = count(F.col("turn").isNotNull() & (F.col("last_turn").isNull() | (F.col("last_turn") != F.col("turn"))))
    span = F.expr("try_add(try_subtract(max(if(present, turn, null)), min(if(present, turn, null))), 1)")
    letters = F.array_sort(F.collect_list(F.when(here, F.struct("at", "letter"))))
    pair = F.concat("last_initial", "initial")
    return rows.groupBy("conv_id").agg(
        F.coalesce(span - turns, F.lit(0)).alias("gaps"), *[count(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        count((F.col("at") > 1) & ~pair.isin("su", "ua", "au")).alias("illegal"), F.array_join(F.transform(letters, lambda x: x["letter"]), "").alias("signature"))


def solved(signature: str) -> tuple[int, str]:
    """Least cost and audit of a signature; of equally cheap audits the least by characters.

    The edits that are open at one place have different letters, so the least
    letter among the cheapest makes the least audit. Two insertions in a row
    are all that can help: a third would come back to where the first began.
    """
    n, memo = len(signature), {}

    def least(i: int, after: str, inserted: int) -> tuple[int, str]:
        key = (i, after, inserted)
        if key in memo:
            return memo[key]
        options = [(0, "")] if i == n and after in MAY_END else []
        if i < n:
            letter = signature[i]
            keep, extra = letter.lower(), CUT_OFF * letter.isupper()
            options.append((DELETE + least(i + 1, after, 0)[0], "D"))
            if letter != "d":
                options.append((REROLE + extra + least(i + 1, NEXT[after], 0)[0], "R"))
                if keep == NEXT[after] or (keep == "s" and after == ""):
                    options.append((extra + least(i + 1, keep, 0)[0], "K"))
        if inserted < 2:
            options.append((INSERT + least(i, NEXT[after], inserted + 1)[0], "I"))
        memo[key] = min(options) if options else (1 << 60, "")
        return memo[key]

    for i in range(n, -1, -DEPTH):
        for after in NEXT:
            least(i, after, 0)
    i, after, inserted, audit = 0, "", 0, []
    while (edit := least(i, after, inserted)[1]):
        audit.append(edit)
        if edit == "I":
            after, inserted = NEXT[after], inserted + 1
            continue
        if edit != "D":
            after = signature[i].lower() if edit == "K" else NEXT[after]
        i, inserted = i + 1, 0
    return least(0, "", 0)[0], "".join(audit)


def audits(conversations: DataFrame) -> DataFrame:
    """`conversations` with cost and audit in place of the signature, each distinct one solved once."""

    def solve(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            both = [solved(s) for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in both], pa.int64()), pa.array([a for _, a in both], pa.string())], names=["signature", "cost", "audit"])

    once = conversations.select("signature").distinct().mapInArrow(solve, "signature string, cost long, audit string")
    return conversations.join(settle(once, "solved"), "signature").drop("signature")


def replayed(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, at, role, text): the rows of each conversation after the edits of its audit.

    Rows stream by conversation and place behind their audit, so no
    conversation is held as a whole.
    """
    first = audited.select("conv_id", F.lit(0).alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    every = first.unionByName(rows.where("present").select("conv_id", "at", "role", "text", F.lit(None).cast("string").alias("audit")))

    def replay(batches: Iterator) -> Iterator:
        import pyarrow as pa

        state = {"id": None, "audit": "", "edit": 0, "after": "", "at": 0}

        def put(out: list, role: str, text: str) -> None:
            state["at"] += 1
            state["after"] = role[:1]
            out.append((state["id"], state["at"], role, text))

        def insert(out: list) -> None:
            while state["audit"][state["edit"] : state["edit"] + 1] == "I":
                put(out, ROLES[NEXT[state["after"]]], "")
                state["edit"] += 1

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["conv_id", "at", "role", "text"])

        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["at"] == 0:
                    insert(out)
                    state |= {"id": row["conv_id"], "audit": row["audit"], "edit": 0, "after": "", "at": 0}
                    continue
                insert(out)
                edit = state["audit"][state["edit"]]
                state["edit"] += 1
                if edit != "D":
                    put(out, row["role"] if edit == "K" else ROLES[NEXT[state["after"]]], row["text"])
            yield batch_of(out)
        out = []
        insert(out)
        yield batch_of(out)

    dealt = every.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return dealt.select("conv_id", "at", "role", "text", "audit").mapInArrow(replay, "conv_id long, at long, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations as `replayed` streams them: sha256 of `role:text`, joined by line feeds."""

    def digest(batches: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa

        now, begun = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["at"] == 1:
                    if begun is not None:
                        out.append((now, begun.hexdigest()))
                    now, begun = row["conv_id"], sha256()
                else:
                    begun.update(b"\n")
                begun.update(f"{row['role']}:{row['text']}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["conv_id", "repaired_sha256"])
        if begun is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([begun.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audited conversations (counts, cost, audit) and the repaired rows of `rows` (conv_id, turn, role, text;
    `present`, if there is such a column, is false on rows that only name their conversation)."""
    if "present" not in rows.columns:
        rows = rows.select("conv_id", "turn", "role", "text", F.lit(True).alias("present"))
    known = settle(judged(rows.select("conv_id", "turn", "role", "text", "present")), "judged")
    audited = settle(audits(signatures(known)), "audited")
    return audited, replayed(known, audited)
