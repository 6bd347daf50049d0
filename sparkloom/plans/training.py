"""From labelled predictions to a classifier: frame, split, one-vs-rest regression, batch prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import upsert
from ..operators.labels import named, without_labels
from ..operators.lookups import files_with_tasks


def training_frame(predictions: DataFrame, files: DataFrame, tasks: DataFrame, vocabulary: DataFrame, run_id: object, excluded: list[int] | None = None) -> DataFrame:
    """path, labels, names, text, latency_ms of a run's predictions whose task is done."""
    own = predictions.filter(F.col("run_id") == run_id)
    own = without_labels(own, excluded) if excluded else own
    done = tasks.filter((F.col("run_id") == run_id) & (F.col("status") == "done")).select("file_pk", "latency_ms")
    rows = own.join(files.select("file_pk", "path"), "file_pk").join(done, "file_pk")
    return rows.join(named(own, vocabulary), "file_pk").select("file_pk", "path", "labels", "names", "text", "latency_ms")


def split(rows: DataFrame, key: str, *, percent: int = 20, seed: int = 42) -> DataFrame:
    """Add is_valid: a hash of the key decides, so a row stays on its side whatever else is in the table."""
    return rows.withColumn("is_valid", F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(key))), 1, 8), 16, 10).cast("long"), F.lit(100)) < percent)


def fit_one_vs_rest(rows: DataFrame, features: str, label: str, *, iterations: int = 20):
    """A logistic regression for each value of `label`, on an array column of features."""
    from pyspark.ml.classification import LogisticRegression, OneVsRest
    from pyspark.ml.functions import array_to_vector

    data = rows.select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"))
    return OneVsRest(classifier=LogisticRegression(maxIter=iterations)).fit(data)


def predicted(model, rows: DataFrame, features: str, key: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    data = rows.select(key, array_to_vector(F.col(features).cast("array<double>")).alias("features"))
    return model.transform(data).select(key, F.col("prediction").cast("int").alias("label"))


def files_to_predict(files: DataFrame, tasks: DataFrame, target_run: object, source_run: object | None = None) -> DataFrame:
    """Files that have a task of the source run, or of the target run if no source is named."""
    return files_with_tasks(files, tasks, target_run if source_run is None else source_run)


def after_predictions(predictions: DataFrame, tasks: DataFrame, made: DataFrame, target_run: object) -> tuple[DataFrame, DataFrame]:
    """Predictions with those made (file_pk, labels; each file once) for the run, and tasks with that run's tasks of those
    files done. Columns that `made` lacks are null."""
    rows = made.withColumn("run_id", F.lit(target_run).cast(predictions.schema["run_id"].dataType))
    rows = rows.select(*((F.col(c) if c in rows.columns else F.lit(None).cast(predictions.schema[c].dataType).alias(c)) for c in predictions.columns))
    hit = (F.col("run_id") == target_run) & F.col("made_")
    done = tasks.join(made.select("file_pk", F.lit(True).alias("made_")), "file_pk", "left").withColumn("status", F.when(hit, "done").otherwise(F.col("status")))
    return upsert(predictions, rows, ["file_pk", "run_id"]), done.select(*tasks.columns)
