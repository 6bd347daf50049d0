"""Calls of outside models by an injected function: batches on executors, answers checked as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keeping import kept
from .keys import insert_missing, upsert
from .labels import checked_labels
from .tasks import after_claim, after_results, claimable, claimed
from .texts import open_work, parsed_reply, within_budget

RESPONSE = "choices array<struct<message: struct<content: string>, finish_reason: string>>, usage struct<prompt_tokens: long, completion_tokens: long>"


def answered(rows: DataFrame, key: str, ask: str, call: Callable[[list[str]], list[str]], *, batch: int = 32) -> DataFrame:
    """key, reply and error of `call` on the column `ask`, some rows at a time; a call that fails is an error of its rows."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a in range(0, len(rows), batch):
                part = rows.iloc[a : a + batch]
                try:
                    replies, error = list(call(part["ask_"].tolist())), None
                    if len(replies) != len(part):
                        raise ValueError("as many replies as questions are asked for")
                except Exception as e:  # recorded with its rows: they can be tried again
                    replies, error = [None] * len(part), f"{type(e).__name__}: {e}"[:1000]
                yield pd.DataFrame({key: part[key].tolist(), "reply": replies, "error": [error] * len(part)})

    return rows.select(key, F.col(ask).alias("ask_")).mapInPandas(run, f"{key} {kind}, reply string, error string")


def response_parts(raw: Column) -> Column:
    """struct(content, finish_reason, prompt_tokens, completion_tokens) of a chat completion."""
    r = F.from_json(raw, RESPONSE)
    first = F.get(r["choices"], 0)
    return F.struct(first["message"]["content"].alias("content"), first["finish_reason"].alias("finish_reason"), r["usage"]["prompt_tokens"].alias("prompt_tokens"), r["usage"]["completion_tokens"].alias("completion_tokens"))


def streamed_text(lines: DataFrame, keys: list[str], order: str, line: str) -> DataFrame:
    """keys and content of captured `data: {...}` lines of streamed completions, in order; [DONE] ends one."""
    body = F.regexp_extract(line, r"^data:\s*(\{.*\})\s*$", 1)
    delta = F.get_json_object(body, "$.choices[0].delta.content")
    parts = lines.select(*keys, F.struct(F.col(order).alias("o"), F.coalesce(delta, F.lit("")).alias("t")).alias("p"))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["t"]), "").alias("content"))


def embedded(chunks: DataFrame, done: DataFrame, model: str, encode: Callable[[list[str]], list[list[float]]], *, most: int | None = None) -> DataFrame:
    """file_pk, chunk_id, model_name, dim, vector for the chunks that have no vector of the model yet."""
    todo = open_work(chunks, done, ["file_pk", "chunk_id"], model)
    todo = todo.orderBy("file_pk", "chunk_id").limit(most) if most else todo

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            vectors = encode(rows["chunk"].tolist())
            yield pd.DataFrame({"file_pk": rows["file_pk"], "chunk_id": rows["chunk_id"], "model_name": model, "dim": [len(v) for v in vectors], "vector": list(vectors)})

    return todo.select("file_pk", "chunk_id", "chunk").mapInPandas(run, "file_pk long, chunk_id int, model_name string, dim int, vector array<float>")


def enriched(predictions: DataFrame, done: DataFrame, model: str, budget: int, call: Callable[[list[str]], list[str]], *, skip_long: bool = False) -> DataFrame:
    """`done` with a row for each text that the model hasn't seen: the parsed reply, what was cut, and the raw reply."""
    todo = within_budget(open_work(predictions, done, ["file_pk"], model), budget, skip=skip_long)
    made = answered(todo, "file_pk", "text", call).join(todo.drop("text"), "file_pk")
    parts = made.select("file_pk", F.lit(model).alias("model_name"), parsed_reply(F.coalesce("reply", F.lit(""))).alias("p"), "truncated", "text_len", "word_count", F.col("reply").alias("raw_payload"))
    new = parts.select("file_pk", "model_name", "p.*", "truncated", "text_len", "word_count", "raw_payload")
    return upsert(done, new, ["file_pk", "model_name"])


def dispatched(tasks: DataFrame, as_of: Column, limit: int, call: Callable[[list[str]], list[str]], uncertain: list[int]) -> tuple[DataFrame, DataFrame]:
    """One turn of a labelling loop: tasks in work after a claim, and the checked results (file_pk, labels, ok, error)."""
    claims = claimed(tasks, as_of, limit)
    replies = answered(claims, "file_pk", "path", call)
    checked = replies.select("file_pk", checked_labels(F.coalesce("reply", F.lit("")), uncertain).alias("c"), F.col("error").alias("failed"))
    error = F.coalesce("failed", F.col("c.error"))
    return after_claim(tasks, claims), checked.select("file_pk", "c.labels", error.isNull().alias("ok"), error.alias("error"))


def dispatched_until_done(
    tasks: DataFrame, as_of: Callable[[], Column], limit: int, call: Callable[[list[str]], list[str]], uncertain: list[int], *, attempts: int, base: float, factor: float, most: float
) -> tuple[DataFrame, DataFrame]:
    """Turns of dispatched() until no task can be claimed: the tasks then, and file_pk with labels of those that were done.

    tasks: file_pk, path, status, attempt, next_run_at, last_error and others. as_of() gives the time of a turn. Tasks that
    wait for a later time are left as they are. Each turn's tables are kept, so a call is made once for a claim. The tasks
    are those of one run.
    """
    if limit < 1:
        raise ValueError("a turn must claim a task at least")
    done = None
    while not tasks.filter(claimable(now := as_of())).isEmpty():
        busy, checked = dispatched(tasks, now, limit, call, uncertain)
        checked = kept(checked.withColumn("finished_at", now))
        ended = after_results(busy, checked, attempts=attempts, base=base, factor=factor, most=most).withColumnRenamed("last_error", "error_")
        due = F.timestamp_micros("next_run_us").cast(tasks.schema["next_run_at"].dataType)
        rows = tasks.drop("status", "attempt").join(ended, "file_pk").withColumn("next_run_at", F.coalesce(due, "next_run_at")).withColumn("last_error", F.coalesce("error_", "last_error"))
        tasks = kept(rows.select(*tasks.columns))
        good = checked.filter("ok").select("file_pk", "labels")
        done = good if done is None else done.unionByName(good)
    return tasks, tasks.select("file_pk", F.lit(None).cast("array<int>").alias("labels")).limit(0) if done is None else done


def registered(known: DataFrame, new: DataFrame, key: str, unique: list[str]) -> DataFrame:
    """Known rows and the new ones whose `unique` columns are not among them, with the next keys: presets, settings, runs.
    Such tables are short."""
    from pyspark.sql import Window

    fresh = new.join(known.select(*unique), unique, "left_anti").dropDuplicates(unique)
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("top_"))
    numbered = fresh.crossJoin(F.broadcast(top)).withColumn(key, (F.col("top_") + F.row_number().over(Window.orderBy(*unique))).cast(known.schema[key].dataType))
    return insert_missing(known, numbered.select(*known.columns), [key])
