"""Tables of which a load rewrites only the buckets that it touches."""

import random

import pytest
from pyspark.sql import functions as F

from vireo import schemas
from vireo.operators import versioned

SCHEMA = schemas.columns("k long, first string, last string, best int, day int")
RULES = {"last": "replace", "best": "coalesce", "day": "replace"}


def rows_of(df):
    return {r.k: tuple(r)[1:] for r in df.collect()}


def test_loads_rewrite_their_buckets_alone(spark, tmp_path):
    table = versioned.Bucketed(f"{tmp_path}/t", SCHEMA, ("k",), buckets=16).create(spark)
    assert table.read(spark).count() == 0 and table.version(spark) == 0
    rng, want, states = random.Random(3), {}, []
    for run in range(3):
        new = {}
        for k in rng.sample([None, *range(60)], 60 if run == 0 else 3):
            new[k] = (f"f{run}", f"l{run}", rng.choice([None, run]), run)
        frame = spark.createDataFrame([(k, *v) for k, v in new.items()], SCHEMA)
        before = dict(table.parts(spark, run).collect())
        assert table.load(frame, RULES) == run + 1
        status = [0, 0]
        for k, (first, last, best, day) in new.items():
            old = want.get(k)
            status[old is not None] += 1
            want[k] = (first, last, best, day) if old is None else (old[0], last, old[2] if best is None else best, day)
        states.append(dict(want))
        assert rows_of(table.read(spark)) == want
        line = table.history(spark).where(F.col("version") == run + 1).first()
        assert [line.new_rows, line.updated_rows] == status
        # The folders of the other buckets are still the ones read.
        met = {r.bucket for r in frame.select(table.bucket().alias("bucket")).collect()}
        after = dict(table.parts(spark, run + 1).collect())
        assert {b for b in after if before.get(b) != after[b]} == met and line.buckets == len(met)
    # Each version can be read until it is tidied away.
    assert [rows_of(table.read(spark, v + 1)) for v in range(3)] == states
    touched = spark.createDataFrame([(7,)], SCHEMA.names[0] + " long").select(table.bucket().alias("bucket"))
    part = table.read(spark, touched=touched)
    assert 7 in rows_of(part) and part.count() < len(want)
    assert "dynamicpruning" in part._jdf.queryExecution().executedPlan().toString().lower()
    table.tidy(spark, 2)
    assert rows_of(table.read(spark, 2)) == states[1] and rows_of(table.read(spark)) == want


def test_a_stopped_load_changes_nothing(spark, tmp_path, monkeypatch):
    table = versioned.Bucketed(f"{tmp_path}/t", SCHEMA, ("k",), buckets=4).create(spark)
    old = spark.createDataFrame([(k, "a", "a", k, 0) for k in range(20)], SCHEMA)
    table.load(old, RULES)
    want = rows_of(table.read(spark))
    bad = spark.createDataFrame([(k, "b", "b", 5, 1) for k in range(10)], SCHEMA).withColumn("last", F.when(F.col("k") == 3, F.raise_error("stop")).otherwise(F.col("last")))
    with pytest.raises(Exception, match="stop"):
        table.load(bad, RULES)
    assert rows_of(table.read(spark)) == want and table.version(spark) == 1

    # Stopped between the data and the log: the rows lie there, but no one reads them.
    rows = spark.createDataFrame([(k, "c", "c", 9, 2) for k in range(10)], SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(versioned.Bucketed, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.load(rows, RULES)
    assert rows_of(table.read(spark)) == want and table.version(spark) == 1
    table.load(rows, RULES)
    now = rows_of(table.read(spark))
    assert len(now) == 20 and now[4] == ("a", "c", 9, 2) and now[15] == want[15]


def test_dead_rows_go(spark, tmp_path):
    table = versioned.Bucketed(f"{tmp_path}/t", SCHEMA, ("k",), buckets=4).create(spark)
    table.load(spark.createDataFrame([(k, "a", "a", k, k) for k in range(20)], SCHEMA), RULES)
    table.load(spark.createDataFrame([(0, "b", "b", 0, 30)], SCHEMA), RULES, F.col("day") >= 10)
    here = {k for k in rows_of(table.read(spark))}
    assert set(range(10, 20)) | {0} <= here and len(here) < 20
    table.expire(spark, F.col("day") >= 10)
    assert {k for k in rows_of(table.read(spark))} == set(range(10, 20)) | {0}
    # An empty load is a version of nothing.
    table.load(spark.createDataFrame([], SCHEMA), RULES)
    assert table.read(spark).count() == 11
    with pytest.raises(ValueError, match="must be keys"):
        versioned.Bucketed(f"{tmp_path}/u", SCHEMA, ("k",), ("day",)).create(spark)
