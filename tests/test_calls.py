"""Models behind functions, prompts, and files that executors write."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import calls, tasks
from sparkloom.plans import prompts
from sparkloom.sources import writing


def test_presets_and_prompts():
    assert prompts.parsed_presets("thumb-32=32, square=256x128,7, ,") == [prompts.Preset("thumb-32", 32, 32), prompts.Preset("square", 256, 128), prompts.Preset("7", 7, 7)]
    assert prompts.parsed_presets("") == []
    with pytest.raises(ValueError, match="preset"):
        prompts.parsed_presets("a=x")
    assert prompts.fingerprint({"a": 1, "b": 2}) == prompts.fingerprint({"b": 2, "a": 1}) != prompts.fingerprint({"a": 1})
    made = prompts.label_prompt([(2, "dog", ""), (1, "cat", "small")], fields={"tags": "list"})
    assert "1=cat (small)\n2=dog" in made.text and made.schema["required"] == ["labels", "tags"]
    assert made.version != prompts.label_prompt([(1, "cat", "small")]).version


def test_a_turn_of_the_labelling_loop(spark):
    q = spark.createDataFrame([(i, f"p{i}", "pending", 0, None) for i in range(4)], "file_pk long, path string, status string, attempt int, next_run_at timestamp_ntz")

    def call(paths):
        return ['{"labels":[2,1]}' if p == "p0" else '{"labels":[9]}' if p == "p1" else "what" for p in paths]

    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    busy, results = calls.dispatched(q, now, 3, call, [9])
    made = {r["file_pk"]: r for r in results.collect()}
    assert made[0]["labels"] == [1, 2] and made[0]["ok"] and not made[1]["ok"] and not made[2]["ok"] and 3 not in made
    after = tasks.after_results(busy, results.withColumn("finished_at", now), attempts=3, base=1, factor=2, most=9)
    assert {r["file_pk"]: r["status"] for r in after.collect()} == {0: "done", 1: "pending", 2: "pending", 3: "pending"}


def test_failed_calls_are_errors_of_their_rows(spark):
    def call(texts):
        if "bad" in texts:
            raise RuntimeError("down")
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([(1, "a"), (2, "bad")], "k long, t string").coalesce(1)
    made = {r["k"]: (r["reply"], r["error"]) for r in calls.answered(rows, "k", "t", call, batch=1).collect()}
    assert made == {1: ("A", None), 2: (None, "RuntimeError: down")}


def test_enrichment_and_embedding(spark):
    texts = spark.createDataFrame([(1, "hello world"), (2, "x" * 50), (3, "")], "file_pk long, text string")
    none = spark.createDataFrame([], "file_pk long, model_name string, subject string, summary string, doc_type string, entities_json string, tags_json string, truncated boolean, text_len long, word_count long, raw_payload string")
    once = calls.enriched(texts, none, "m", 20, lambda t: [json.dumps({"subject": x[:5], "tags": ["t"]}) for x in t])
    made = {r["file_pk"]: r for r in once.collect()}
    assert sorted(made) == [1, 2] and made[1]["subject"] == "hello" and made[2]["truncated"] and made[1]["doc_type"] == "t"
    assert calls.enriched(texts, once, "m", 20, lambda t: ["no"] * len(t)).filter("raw_payload = 'no'").count() == 0
    chunks = spark.createDataFrame([(1, 0, "a"), (1, 1, "bb")], "file_pk long, chunk_id int, chunk string")
    done = spark.createDataFrame([(1, 0, "m")], "file_pk long, chunk_id int, model_name string")
    assert [tuple(r) for r in calls.embedded(chunks, done, "m", lambda t: [[float(len(x))] for x in t]).collect()] == [(1, 1, "m", 1, [2.0])]


def test_responses(spark):
    raw = json.dumps({"choices": [{"message": {"content": "hi"}, "finish_reason": "stop"}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}})
    assert tuple(spark.range(1).select(calls.response_parts(F.lit(raw)).alias("r")).first()["r"]) == ("hi", "stop", 3, 2)
    lines = [(1, 0, 'data: {"choices":[{"delta":{"content":"a"}}]}'), (1, 1, 'data: {"choices":[{"delta":{"content":"b"}}]}'), (1, 2, "data: [DONE]")]
    assert calls.streamed_text(spark.createDataFrame(lines, "k int, n int, line string"), ["k"], "n", "line").first()["content"] == "ab"


def test_registration(spark):
    known = spark.createDataFrame([(1, "a", 32)], "preset_id int, name string, width int")
    new = spark.createDataFrame([(0, "a", 64), (0, "c", 1), (0, "b", 2)], "preset_id int, name string, width int")
    assert sorted(tuple(r) for r in calls.registered(known, new, "preset_id", ["name"]).collect()) == [(1, "a", 32), (2, "b", 2), (3, "c", 1)]


def test_files_are_written_once(spark, tmp_path):
    (tmp_path / "src").write_bytes(b"1")
    plan = spark.createDataFrame([(str(tmp_path / "src"), str(tmp_path / "out/a"), None), (None, str(tmp_path / "out/b"), b"22"), (str(tmp_path / "none"), str(tmp_path / "out/c"), None)], "src string, dst string, content binary")
    made = {os.path.basename(r["dst"]): (r["done"], bool(r["error"])) for r in writing.materialised(plan).collect()}
    assert made == {"a": ("hardlink", False), "b": ("written", False), "c": (None, True)}
    assert (tmp_path / "out/b").read_bytes() == b"22"
    assert {r["done"] for r in writing.materialised(plan).collect()} == {"kept", None}
    writing.moved(str(tmp_path / "out/b"), str(tmp_path / "in/b"))
    with pytest.raises(FileExistsError):
        writing.moved(str(tmp_path / "out/a"), str(tmp_path / "in/b"))
