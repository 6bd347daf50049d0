"""Joins of files, tasks and predictions, pages by key, and totals for a dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import collision_suffix, without_fence


def page_after(rows: DataFrame, key: str, last: object | None, size: int) -> DataFrame:
    """The next rows by `key` after `last` (from the first on, if null): a bounded page."""
    return (rows if last is None else rows.filter(F.col(key) > last)).orderBy(key).limit(size)


def truth_rows(predictions: DataFrame, files: DataFrame, run_id: object) -> DataFrame:
    """file_pk, path and labels of a run's predictions whose file is known: what an evaluation compares with."""
    own = predictions.filter(F.col("run_id") == run_id)
    return own.join(files.select("file_pk", "path"), "file_pk").select("file_pk", "path", "labels")


def files_with_tasks(files: DataFrame, tasks: DataFrame, run_id: object | None = None) -> DataFrame:
    """Files that have a task (of the run), each once: what a prediction is made for."""
    own = tasks if run_id is None else tasks.filter(F.col("run_id") == run_id)
    return files.join(own.select("file_pk"), "file_pk", "left_semi")


def label_rows(predictions: DataFrame, files: DataFrame, *, run_id: object | None = None, most: int | None = None) -> DataFrame:
    """file_pk, path, run_id, labels, text of predictions with their files: what the graphs are built from, by file and run;
    `most` of them at most."""
    own = predictions if run_id is None else predictions.filter(F.col("run_id") == run_id)
    out = own.join(files.select("file_pk", "path"), "file_pk").select("file_pk", "path", "run_id", "labels", "text")
    return out if most is None else out.orderBy("file_pk", "run_id").limit(most)


def keys_of_paths(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows by path with the file_pk of that path; unknown paths are left out."""
    return rows.join(files.select("file_pk", "path"), "path")


def keys_of_stems(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows by stem with the smallest file_pk whose file name, without its suffix, is that stem; others are left out."""
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return rows.join(files.groupBy(stem.alias("stem")).agg(F.min("file_pk").alias("file_pk")), "stem")


def free_targets(rows: DataFrame, taken: DataFrame, order: str) -> DataFrame:
    """Rows (rel, hint, `order`) with target: rel for the first row by `order` that asks for it if no row of `taken` (rel)
    has it; for all others rel with collision_suffix() before its ending. `order` is different on all rows of a rel."""
    first = rows.groupBy("rel").agg(F.min(order).alias("first_"))
    free = first.join(taken.select("rel"), "rel", "left_anti")
    ending = collision_suffix(F.col("rel"), F.coalesce("hint", F.lit("")))
    apart = r"^(.*[^/])(\.[^./]+)$"
    other = F.when(F.rlike("rel", F.lit(apart)), F.concat(F.regexp_extract("rel", apart, 1), ending, F.regexp_extract("rel", apart, 2))).otherwise(F.concat("rel", ending))
    target = F.when(F.col(order) == F.col("first_"), F.col("rel")).otherwise(other)
    return rows.join(free, "rel", "left").withColumn("target", target).drop("first_")


def evaluated_run(predictions: DataFrame, truth: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(sample, label, truth, predicted) of two tables (file_pk, labels) over all labels of a vocabulary, for the measures of
    labels.multilabel() and per_label(). Files that are in one table alone are left out; a null list holds no label."""
    both = truth.select("file_pk", F.col("labels").alias("t")).join(predictions.select("file_pk", F.col("labels").alias("p")), "file_pk")
    held = lambda own: F.coalesce(F.array_contains(own, F.col("label_id")), F.lit(False))
    each = both.crossJoin(F.broadcast(vocabulary.agg(F.collect_set("label_id").alias("ids")))).withColumn("label_id", F.explode("ids"))  # one row of a short list
    return each.select(F.col("file_pk").alias("sample"), F.col("label_id").alias("label"), held("t").alias("truth"), held("p").alias("predicted"))


def totals(files: DataFrame, predictions: DataFrame, embeddings: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: files, hashed, pending, uniques, dupes, near_dupes, labelled, unembedded, enrichable.

    files: file_pk, content_hash, is_exact_dupe, near_of, status. The last two count labelled files with a text that have no
    vector, or no enrichment. Each table is reduced to a row a file before it is joined.
    """
    n = lambda c: F.count(F.when(c, 1)).cast("long")
    hashed, dupe = F.col("content_hash").isNotNull(), F.coalesce("is_exact_dupe", F.lit(False))
    a = files.agg(F.count("*").alias("files"), n(hashed).alias("hashed"), n(F.col("status") == 0).alias("pending"), n(hashed & ~dupe).alias("uniques"), n(dupe).alias("dupes"), n(F.col("near_of").isNotNull()).alias("near_dupes"))
    told = predictions.groupBy("file_pk").agg(F.max(F.length(F.coalesce("text", F.lit(""))) > 0).alias("some"))
    mark = lambda rows, name: rows.select("file_pk").distinct().withColumn(name, F.lit(True))
    each = told.join(mark(embeddings, "vector"), "file_pk", "left").join(mark(enriched, "rich"), "file_pk", "left")
    b = each.agg(F.count("*").alias("labelled"), n(F.col("some") & F.col("vector").isNull()).alias("unembedded"), n(F.col("some") & F.col("rich").isNull()).alias("enrichable"))
    return a.crossJoin(F.broadcast(b))  # one row each


def ingest_counters(items: DataFrame) -> DataFrame:
    """kind ('download', 'unarchive', 'sort'), ok and errors of (kind, error) rows; a kind without rows has zeros."""
    spark = items.sparkSession
    kinds = spark.createDataFrame([("download",), ("unarchive",), ("sort",)], "kind string")
    counts = items.groupBy("kind").agg(F.count(F.when(F.col("error").isNull(), 1)).alias("ok"), F.count("error").alias("errors"))
    return kinds.join(counts, "kind", "left").fillna(0, ["ok", "errors"])


def text_field(reply: Column, name: str, *, required: bool) -> Column:
    """struct(value, error) of a field that must be a text: a missing or null one is an error if it is required, and null
    otherwise; one of another kind is an error. An empty text counts as missing."""
    v = F.try_variant_get(F.try_parse_json(without_fence(reply)), f"$.{name}", "variant")
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    value = F.when(kind == "STRING", F.nullif(F.trim(F.try_variant_get(v, "$", "string")), F.lit("")))
    lacking = F.lit(f"{name} is required") if required else F.lit(None).cast("string")
    error = F.when(~kind.isin("STRING", "VOID"), f"{name} must be a text").when(value.isNull(), lacking)
    return F.struct(value.alias("value"), error.alias("error"))


def list_field(reply: Column, name: str, *, required: bool) -> Column:
    """struct(value, error) of a field that must be a list of texts: as text_field(); an empty list is a value."""
    v = F.try_variant_get(F.try_parse_json(without_fence(reply)), f"$.{name}", "variant")
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    value = F.when(kind.isin("ARRAY<STRING>", "ARRAY<VOID>"), F.try_variant_get(v, "$", "array<string>"))
    good = value.isNotNull() & ~F.exists(value, lambda x: x.isNull())
    lacking = F.lit(f"{name} is required") if required else F.lit(None).cast("string")
    error = F.when((kind != "VOID") & ~F.coalesce(good, F.lit(False)), f"{name} must be a list of texts").when(kind == "VOID", lacking)
    return F.struct(F.when(good, value).alias("value"), error.alias("error"))
