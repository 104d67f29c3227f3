"""Replies, requests and incremental ratings."""

import json

import pytest
from pyspark.sql import functions as F

from pagetally.operators import scoring, summaries


def test_parse_replies(spark):
    cases = {
        '{"exposure": 7, "rationale": "r"}': ("scored", 7.0, "r", None),
        '```json\n{"exposure": 7, "rationale": "r"}\n```': ("scored", 7.0, "r", None),
        '{"exposure": 7.5}': ("scored", 7.5, None, None),
        '{"exposure": 42, "rationale": null}': ("scored", 42.0, None, None),
        '{"exposure": null, "rationale": "r"}': ("scored", None, "r", None),
        '{"exposure": 1, "rationale": "r", "tone": "x", "n": 2}': ("scored", 1.0, "r", {"tone": "x", "n": 2}),
        "{'exposure': 1}": ("failed", None, None, None),
        '{"exposure": 5}] tail': ("failed", None, None, None),
        '{"exposure": 5}} tail': ("failed", None, None, None),
        '{"exposure": NaN}': ("failed", None, None, None),
        '{"exposure": "8"}': ("failed", None, None, None),
        '{"rationale": "r"}': ("failed", None, None, None),
        "{}": ("failed", None, None, None), "null": ("failed", None, None, None),
        "[1]": ("failed", None, None, None), "7": ("failed", None, None, None),
        "not json": ("failed", None, None, None), "": ("failed", None, None, None),
        '{"exposure": 7} trailing': ("failed", None, None, None),
        '{"exposure": 7}, {"exposure": 8}': ("failed", None, None, None),
        '```{"exposure": 7}```': ("failed", None, None, None),
    }
    frame = spark.createDataFrame([(reply,) for reply in cases] + [(None,)], "reply string")
    got = {row.reply: row for row in scoring.parse_replies(frame).collect()}
    for reply, (status, exposure, rationale, extras) in cases.items():
        row = got[reply]
        assert (row.status, row.exposure, row.rationale) == (status, exposure, rationale), reply
        assert (json.loads(row.extras) if row.extras else None) == extras
        assert (row.reason is None) == (status == "scored")
    assert got[None].status == "failed"


def test_requests_are_chat_json(spark):
    docs = spark.createDataFrame([("a", 'say "é"\n')], "slug string, text string")
    row = scoring.score_requests(docs, "some/model").first()
    request = json.loads(row.request)
    assert request["model"] == "some/model" and request["temperature"] == 0.2
    assert [m["role"] for m in request["messages"]] == ["system", "user"]
    assert request["messages"][1]["content"] == 'say "é"\n'
    assert "AI Exposure" in scoring.RUBRIC and "0 to 10" in scoring.RUBRIC


def scorer(text):
    if "boom" in text:
        raise ValueError("no answer")
    return "bad" if "bad" in text else json.dumps({"exposure": len(text), "rationale": text})


def setup(spark):
    master = spark.createDataFrame(
        [(i, f"s{i}", f"T{i}") for i in range(6)], "ord bigint, slug string, title string")
    docs = spark.createDataFrame(
        [("s0", "one"), ("s1", "boom"), ("s2", "bad one"), ("s3", ""), ("s5", "five!")],
        "slug string, text string")
    old = spark.createDataFrame(
        [("s0", "T0", 9.0, "kept", None), ("gone", "G", 1.0, "kept", None)],
        "slug string, title string, exposure double, rationale string, extras string")
    return master, docs, old


def outcome(run):
    return ({r.slug: (r.title, r.exposure, r.rationale) for r in run.scores.collect()},
            {r.slug: (r.status, r.reason) for r in run.statuses.collect()})


def test_incremental_run(spark):
    master, docs, old = setup(spark)
    run = scoring.score_incremental(master, docs, old, scorer)
    scores, statuses = outcome(run)
    assert scores == {"s0": ("T0", 9.0, "kept"), "gone": ("G", 1.0, "kept"), "s5": ("T5", 5.0, "five!")}
    assert statuses == {"s0": ("cached", None), "s1": ("failed", "no answer"),
                        "s2": ("failed", "not one JSON object"), "s3": ("no_input", None),
                        "s4": ("no_input", None), "s5": ("scored", None)}
    assert {r.status: r.n for r in summaries.run_stats(run.statuses).collect()} == {
        "cached": 1, "failed": 2, "no_input": 2, "scored": 1}


def test_forced_slice_starts_empty(spark):
    master, docs, old = setup(spark)
    scores, statuses = outcome(scoring.score_incremental(master, docs, old, scorer, 0, 1, force=True))
    assert scores == {"s0": ("T0", 3.0, "one")} and statuses == {"s0": ("scored", None)}
    scores, statuses = outcome(scoring.score_incremental(master, docs, old, scorer, -1, None))
    assert set(scores) == {"s0", "gone", "s5"} and set(statuses) == {"s5"}


def test_scorer_runs_once_per_document(spark, tmp_path):
    master, docs, old = setup(spark)
    log = tmp_path / "calls"
    log.mkdir()

    def counting(text):
        import uuid
        (log / f"{text.replace('!', '')}-{uuid.uuid4().hex}").write_text("")
        return scorer(text)

    outcome(scoring.score_incremental(master, docs, old, counting))
    assert sorted(path.name.split("-")[0] for path in log.iterdir()) == ["bad one", "boom", "five"]


def test_a_run_that_died_is_resumed(spark, tmp_path):
    rows = [(i, f"s{i}", f"T{i}") for i in range(12)]
    master = spark.createDataFrame(rows, "ord bigint, slug string, title string")
    docs = spark.createDataFrame([(f"s{i}", f"text {i}") for i in range(12)], "slug string, text string")
    old = spark.createDataFrame(
        [], "slug string, title string, exposure double, rationale string, extras string")
    calls, down, log = tmp_path / "calls", tmp_path / "down", str(tmp_path / "log")
    calls.mkdir()
    batch = {r.slug: r.b for r in docs.select("slug", F.pmod(F.xxhash64("slug"), F.lit(3)).alias("b")).collect()}
    doomed = {f"text {slug[1:]}" for slug, b in batch.items() if b == 1}
    assert set(batch.values()) == {0, 1, 2}
    down.write_text("")

    def counting(text):
        import uuid
        if text in doomed and down.exists():
            raise KeyboardInterrupt     # no failure of a row: it ends the task
        (calls / f"{text}-{uuid.uuid4().hex}").write_text("")
        return json.dumps({"exposure": len(text) % 11, "rationale": "r", "more": [1]})

    with pytest.raises(Exception):
        scoring.score_incremental(master, docs, old, counting, log=log, batches=3)
    assert {p.name.split("-")[0] for p in calls.iterdir()} == {
        f"text {slug[1:]}" for slug, b in batch.items() if b == 0}
    down.unlink()
    run = scoring.score_incremental(master, docs, old, counting, log=log, batches=3)
    assert sorted(p.name.split("-")[0] for p in calls.iterdir()) == sorted(f"text {i}" for i in range(12))
    assert {r.slug: (r.exposure, r.extras) for r in run.scores.collect()} == {
        f"s{i}": (float(len(f"text {i}")), '{"more":[1]}') for i in range(12)}
    assert {r.slug: r.status for r in run.statuses.collect()} == {
        slug: "cached" if b == 0 else "scored" for slug, b in batch.items()}
    again = scoring.score_incremental(master, docs, old, counting, log=log)
    assert again.scores.count() == 12 and len(list(calls.iterdir())) == 12
