"""Answers kept by content, over runs with failures between."""

import json
import os

from pyspark.sql import functions as F

from vireo.plans import structuring

SCHEMA = "job_title string, job_requirement string, level string"
COLUMNS = "id long, job_title string, job_description string, job_requirement string, level string, scraped_at string, ai_processed boolean, extra int"


def test_texts_are_asked_once(spark, tmp_path):
    calls, down = tmp_path / "calls", tmp_path / "down"
    calls.mkdir()

    def ask(text):
        name = text["job_description"].replace(" ", "_")
        number = len(os.listdir(calls))
        (calls / f"{name}-{number}-{os.getpid()}").write_text("")
        if down.exists() and name in ("d2", "d3"):
            raise ConnectionError("away")
        if name == "bad":
            return "I cannot."
        if name == "half":
            return '{"level": "x"'
        return "```json\n" + json.dumps({"job_title": "Clean" if name == "d1" else None, "job_requirement": f" need {name} ", "level": "Senior"}) + "\n```"

    asked = lambda: sorted(x.split("-")[0] for x in os.listdir(calls))
    texts = ["d1", "d2", "d3", "d1", "bad", "half", "", None, "d4"]
    rows = spark.createDataFrame([(i, None if x in ("", None) else "T", x, None if i % 2 else "", "old", f"2026-02-{1 + i:02d}", False, i) for i, x in enumerate(texts)], COLUMNS)
    kept = structuring.kept_at(str(tmp_path / "answers"), 4).create(spark)
    down.write_text("")
    assert structuring.run(spark, rows, kept, ask, 1, most=3) == 3 and asked() == ["d1", "d2", "d3"]
    state = {r.content: (r.reply is not None, r.tries, r.failure) for r in kept.read(spark).collect()}
    assert sorted(state.values(), key=str) == [(False, 1, "ConnectionError: away"), (False, 1, "ConnectionError: away"), (True, 1, None)]
    down.unlink()
    # The second run asks again for what failed and goes on; d1 is not asked again.
    assert structuring.run(spark, rows, kept, ask, 2, most=10, tasks=2) == 5
    assert asked() == ["bad", "d1", "d2", "d2", "d3", "d3", "d4", "half"]
    # What fails three times is left; answers stay.
    assert [structuring.run(spark, rows, kept, ask, n) for n in (3, 4, 5)] == [2, 2, 0] and asked().count("bad") == 3 and asked().count("d1") == 1
    left = structuring.failures(kept.read(spark)).collect()
    assert sorted((r.tries, r.failure, r.asked_again) for r in left) == [(3, "no JSON object: I cannot.", False), (3, 'no JSON object: {"level": "x"', False)]
    got = {r.id: r for r in structuring.structured(rows, kept.read(spark), SCHEMA).collect()}
    assert len(got) == len(texts) and got[0].__fields__ == rows.columns
    assert {i: (r.job_title, r.job_requirement, r.level, r.ai_processed) for i, r in got.items()} == {
        0: ("Clean", "need d1", "Senior", True), 3: ("Clean", "need d1", "Senior", True), 1: ("T", "need d2", "Senior", True), 2: ("T", "need d3", "Senior", True), 8: ("T", "need d4", "Senior", True),
        4: ("T", "", "old", False), 5: ("T", None, "old", False), 6: (None, "", "old", False), 7: (None, None, "old", False)}
    assert structuring.run(spark, rows.where(F.lit(False)), kept, ask, 9) == 0
