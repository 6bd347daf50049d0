"""A queue of tasks as a table: creation, claims, ends, retries, and what runs stand at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import backoff_seconds, run_status
from .keys import numbered

STATUSES = ["pending", "processing", "done", "error"]


def sampled(rows: DataFrame, key: str, pool: int) -> DataFrame:
    """A stride of `pool` percent by rising key: a row is taken where the count of rows times `pool` passes a hundred."""
    if not 1 <= pool <= 100:
        raise ValueError("pool must lie in 1..100")
    i = F.col("n_") + 1
    take = F.expr(f"((n_ + 1) * {pool}) div 100 > (n_ * {pool}) div 100")
    return numbered(rows, key, "n_").filter(take & (i > 0)).drop("n_")


def created(tasks: DataFrame, files: DataFrame, run_id: object, pool: int = 100) -> DataFrame:
    """Pending tasks of a run for its sampled canonical files that have none yet: file_pk, run_id, status, attempt."""
    new = sampled(files, "file_pk", pool).select("file_pk")
    return new.join(tasks.filter(F.col("run_id") == run_id).select("file_pk"), "file_pk", "left_anti").select(
        "file_pk", F.lit(run_id).alias("run_id"), F.lit("pending").alias("status"), F.lit(0).alias("attempt")
    )


def recovered(tasks: DataFrame) -> DataFrame:
    """What was in work when a run broke off is pending again, without times."""
    lost = F.col("status") == "processing"
    return tasks.withColumn("started_at", F.when(~lost, F.col("started_at"))).withColumn("status", F.when(lost, "pending").otherwise(F.col("status")))


def claimable(as_of: Column) -> Column:
    return (F.col("status") == "pending") & (F.col("next_run_at").isNull() | (F.col("next_run_at") <= as_of))


def claimed(tasks: DataFrame, as_of: Column, limit: int) -> DataFrame:
    """The next tasks by path, with the attempt that begins: file_pk, path, attempt."""
    rows = tasks.filter(claimable(as_of)).orderBy("path", "file_pk").limit(max(limit, 0))
    return rows.select("file_pk", "path", (F.col("attempt") + 1).cast("int").alias("attempt"))


def after_claim(tasks: DataFrame, claims: DataFrame) -> DataFrame:
    """Tasks with the claimed ones in work. A claim is a bounded batch."""
    own = claims.select("file_pk", F.col("attempt").alias("claimed_"))
    rows = tasks.join(own, "file_pk", "left")
    hit = F.col("claimed_").isNotNull()
    return rows.withColumn("status", F.when(hit, "processing").otherwise(F.col("status"))).withColumn("attempt", F.coalesce("claimed_", "attempt")).drop("claimed_")


def after_results(tasks: DataFrame, results: DataFrame, *, attempts: int, base: float, factor: float, most: float) -> DataFrame:
    """Tasks in work that have a result (file_pk, ok, error, finished_at) are done, retried later, or in error for good."""
    own = results.select("file_pk", "ok", F.col("error").alias("error_"), "finished_at")
    rows = tasks.join(own, "file_pk", "left")
    hit = (F.col("status") == "processing") & F.col("ok").isNotNull()
    again = hit & ~F.col("ok") & (F.col("attempt") < attempts)
    status = F.when(hit & F.col("ok"), "done").when(again, "pending").when(hit, "error").otherwise(F.col("status"))
    wait = F.when(again, backoff_seconds(F.col("attempt"), base, factor, most))
    return rows.select(
        "file_pk", status.alias("status"), "attempt", F.when(hit & ~F.col("ok"), F.col("error_")).alias("last_error"),
        (F.unix_micros(F.col("finished_at").cast("timestamp")) + F.round(wait * 1_000_000).cast("long")).alias("next_run_us"),
    )


def status_counts(tasks: DataFrame) -> DataFrame:
    """A row for each run with the number of tasks of each status, and the run's own status."""
    n = [F.count(F.when(F.col("status") == s, 1)).cast("long").alias(s) for s in STATUSES]
    return tasks.groupBy("run_id").agg(*n).withColumn("run_status", run_status(F.col("pending"), F.col("processing"), F.col("error")))


def progress(counts: DataFrame, per_second: float) -> DataFrame:
    """Share done in percent, and seconds left at a rate; null without a rate."""
    total = sum((F.col(s) for s in STATUSES[1:]), F.col("pending"))
    ended = F.col("done") + F.col("error")
    left = (total - ended) / F.lit(per_second) if per_second > 0 else F.lit(None).cast("double")
    return counts.select("run_id", F.when(total > 0, 100.0 * ended / total).otherwise(0.0).alias("percent"), left.alias("seconds_left"))
