"""Texts: overlapping chunks, work that is still open, a hashing encoder, and enrichment replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import without_fence, word_count
from .keys import latest


def chunks(rows: DataFrame, size: int, overlap: int, *, key: str = "file_pk", text: str = "text") -> DataFrame:
    """key, chunk_id, char_start, char_end, chunk: pieces of `size` characters, `overlap` shared with the next.

    The last one is the first that reaches the end. Null and empty texts have none.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError("size must be positive and overlap lie in 0..size - 1")
    step, n = size - overlap, F.length(text)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    # pieces are cut before they become rows, so that no row carries the whole text
    piece = lambda k: F.struct(k.alias("chunk_id"), (k * step).alias("char_start"), F.least(k * step + size, n).alias("char_end"), F.substring(text, k * step + 1, F.lit(size)).alias("chunk"))
    return rows.filter(F.length(text) > 0).select(key, F.explode(F.transform(F.sequence(F.lit(0), last), piece)).alias("x")).select(key, "x.*")


def replaced_chunks(old: DataFrame, new: DataFrame, key: str = "file_pk") -> DataFrame:
    """Old chunks but for the files that have new ones."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def run_texts(predictions: DataFrame, *, run_id: object | None = None, most: int | None = None) -> DataFrame:
    """file_pk and text of a run's predictions, or of each file's latest run (by created_at, then run_id) if none is named;
    null and empty texts are left out before. `most` files at most, by file_pk."""
    rows = predictions.filter(F.length("text") > 0)
    rows = latest(rows, ["file_pk"], ["created_at", "run_id"]) if run_id is None else rows.filter(F.col("run_id") == run_id)
    rows = rows.select("file_pk", "text")
    return rows if most is None else rows.orderBy("file_pk").limit(most)


def chunked_run(old: DataFrame, predictions: DataFrame, size: int, overlap: int, *, run_id: object | None = None, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Chunks after a run was cut anew: its files' old ones are replaced; and one row, the number of files cut."""
    rows = run_texts(predictions, run_id=run_id, most=most)
    return replaced_chunks(old, chunks(rows, size, overlap)), rows.agg(F.count("*").alias("documents"))


def open_work(rows: DataFrame, done: DataFrame, keys: list[str], model: str) -> DataFrame:
    """Rows that have no result of the model yet."""
    return rows.join(done.filter(F.col("model_name") == model).select(*keys), keys, "left_anti")


def hashed_vector(text: Column, width: int = 16) -> Column:
    """A deterministic encoder: counts of words by hash, scaled to unit length; zeros without words."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    places = F.transform(words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 4), 16, 10).cast("int") % width)
    # one-element transforms bind a value that the lambda inside would make again for each element
    bound = lambda value, f: F.transform(F.array(value), f)[0]
    counted = lambda own: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.size(F.filter(own, lambda p: p == k)).cast("double"))
    scaled = lambda c: bound(F.sqrt(F.aggregate(c, F.lit(0.0), lambda t, x: t + x * x)), lambda norm: F.transform(c, lambda x: (x / norm).cast("float")))
    return F.when(F.size(words) > 0, bound(bound(places, counted), scaled)).otherwise(F.array_repeat(F.lit(0.0).cast("float"), width))


def character_budget(max_tokens: int, chars_per_word: float, tokens_per_word: float) -> int:
    if chars_per_word <= 0 or tokens_per_word <= 0:
        raise ValueError("ratios must be positive")
    return int(max_tokens * chars_per_word / tokens_per_word)


def within_budget(rows: DataFrame, budget: int, *, key: str = "file_pk", text: str = "text", skip: bool = False) -> DataFrame:
    """key, text_len, word_count, truncated and text cut to the budget; with `skip`, longer texts are left out."""
    long = F.length(text) > budget
    rows = rows.filter(F.length(text) > 0)
    rows = rows.filter(~long) if skip else rows
    return rows.select(key, F.length(text).cast("long").alias("text_len"), word_count(F.col(text)).cast("long").alias("word_count"), long.alias("truncated"), F.substring(text, 1, budget).alias("text"))


def parsed_reply(raw: Column) -> Column:
    """struct(subject, summary, doc_type, entities_json, tags_json) of a reply; all null if it is no JSON object.

    Subject and summary are given if they are texts. doc_type is the first tag, if tags are a list and it is a text.
    Entities and tags are given back as JSON, whatever they are, where their key is present (a JSON null as null's text).
    """
    value = F.try_parse_json(without_fence(raw))
    kind = lambda v: F.schema_of_variant(v)
    good = kind(value).startswith("OBJECT")
    at = lambda path: F.try_variant_get(value, path, "variant")
    text = lambda path: F.when(good & (kind(at(path)) == "STRING"), F.try_variant_get(value, path, "string"))
    json = lambda path: F.when(good, F.to_json(at(path)))
    first = F.when(kind(at("$.tags")).startswith("ARRAY"), text("$.tags[0]"))
    return F.struct(text("$.subject").alias("subject"), text("$.summary").alias("summary"), first.alias("doc_type"), json("$.entities").alias("entities_json"), json("$.tags").alias("tags_json"))
