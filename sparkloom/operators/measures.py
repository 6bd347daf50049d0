"""Latencies and rates: nearest-rank percentiles, histograms, averages over time, and tuning decisions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TICKS = " ▁▂▃▄▅▆▇█"


def percentiles(rows: DataFrame, keys: list[str], value: str, points: list[int]) -> DataFrame:
    """Nearest-rank percentiles of each group."""
    made = [F.expr(f"percentile_disc({p / 100}) within group (order by {value})").alias(f"p{p}") for p in points]
    return rows.groupBy(*keys).agg(*made)


def upper_median(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value at place n div 2 (from 0) of each sorted group, from counts of equal values."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
    return run.filter("upto > n div 2").groupBy(*keys).agg(F.min(value).alias("upper_median"))


def dashboard_percentiles(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """p50 at place n div 2, p95 at place int(0.95 n) if there are more than 20, else the largest."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys)
    run = counts.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
    p95 = F.expr("case when n > 20 then (n * 95) div 100 else n - 1 end")
    return run.groupBy(*keys).agg(F.min(F.when(F.expr("upto > n div 2"), F.col(value))).alias("p50"), F.min(F.when(F.col("upto") > p95, F.col(value))).alias("p95"))


def histogram(rows: DataFrame, value: str, bins: int) -> DataFrame:
    """bin, low and n of bins of equal width; the last is closed, empty ones are kept, one bin if all values are equal."""
    ends = rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / width))).cast("int")
    counts = rows.filter(F.col(value).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = ends.filter("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0), F.when(F.col("hi") == F.col("lo"), 0).otherwise(bins - 1))).alias("bin"))
    return every.join(counts, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def rates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """n, errors, error_percent, mean and per-second throughput of (ts, is_error, value) rows."""
    span = F.max(F.unix_micros(F.col("ts").cast("timestamp"))) - F.min(F.unix_micros(F.col("ts").cast("timestamp")))
    n, errors = F.count("*"), F.count(F.when(F.col("is_error"), 1))
    return rows.groupBy(*keys).agg(
        n.cast("long").alias("n"), errors.cast("long").alias("errors"), (100.0 * errors / n).alias("error_percent"),
        F.avg("value").alias("mean"), F.when(span > 0, n * 1e6 / span).alias("per_second"),
    )


def token_rates(rows: DataFrame, keys: list[str], *, wall_seconds: float) -> DataFrame:
    """Tokens a second of (completion_tokens, generation_s) rows: over the time of generation if it is known, else over
    the wall; null without tokens."""
    tokens, spent = F.sum("completion_tokens"), F.sum("generation_s")
    return rows.groupBy(*keys).agg(F.when(tokens > 0, tokens / F.when(spent > 0, spent).otherwise(F.lit(max(wall_seconds, 1e-9)))).alias("tokens_per_second"))


def batch_efficiency(batches: DataFrame) -> DataFrame:
    """One row: mean fill in percent of (actual, size) batches; 0 without any."""
    return batches.filter("size > 0").agg(F.coalesce(F.avg(100.0 * F.col("actual") / F.col("size")), F.lit(0.0)).alias("batch_efficiency"))


def last_n(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("n_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("n_") <= n).drop("n_")


def moving_mean(rows: DataFrame, keys: list[str], order: list[str], value: str, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    return rows.withColumn("moving_mean", F.avg(value).over(w))


def decayed_mean(rows: DataFrame, keys: list[str], seconds: str, value: str, halflife: float) -> DataFrame:
    """The exponential mean after all samples of a key: each step moves by 1 - 0.5 ** (dt / halflife), the first sets it."""
    steps = F.array_sort(F.collect_list(F.struct(F.col(seconds).alias("s"), F.col(value).alias("v"))))
    fold = F.aggregate(
        "steps",
        F.struct(F.lit(None).cast("double").alias("s"), F.lit(None).cast("double").alias("m")),
        lambda t, x: F.struct(
            x["s"].cast("double").alias("s"),
            F.when(t["m"].isNull(), x["v"].cast("double")).otherwise(t["m"] + (1 - F.pow(F.lit(0.5), (x["s"] - t["s"]) / halflife)) * (x["v"] - t["m"])).alias("m"),
        ),
        lambda t: t["m"],
    )
    return rows.groupBy(*keys).agg(steps.alias("steps")).select(*keys, fold.alias("decayed_mean"))


def sparkline(rows: DataFrame, keys: list[str], order: list[str], value: str, n: int) -> DataFrame:
    """The last n values of each key as a line of ticks."""
    from pyspark.sql.functions import desc

    own = last_n(rows, keys, [desc(c) for c in order], n)
    w = Window.partitionBy(*keys)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    tick = F.least(F.lit(len(TICKS) - 1), F.floor((F.col(value) - lo) / F.greatest(F.lit(1e-9), hi - lo) * (len(TICKS) - 1))).cast("int")
    own = own.withColumn("tick", F.substring(F.lit(TICKS), tick + 1, F.lit(1)))
    return own.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "tick"))), lambda x: x["tick"]), "").alias("line"))


def smoothed(rows: DataFrame, keys: list[str], order: list[str], value: str, alpha: float) -> DataFrame:
    """Add ema: the exponential mean of the values so far, by keys; the first sets it, each further one moves it by `alpha`.

    A row looks back only as far as a value still weighs 1e-18, which is below a double's precision, so that no row holds
    all of a key's values.
    """
    back = 0 if alpha >= 1 else math.ceil(18 * math.log(10) / -math.log(1 - alpha))
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-back, 0)
    rows = rows.withColumn("seen_", F.collect_list(F.col(value).cast("double")).over(w))
    ema = F.aggregate(F.slice("seen_", 2, F.size("seen_")), F.get("seen_", 0), lambda t, x: t + alpha * (x - t))
    return rows.withColumn("ema", ema).drop("seen_")


def with_cool_down(decisions: DataFrame, keys: list[str], order: str, batches: int) -> DataFrame:
    """Decisions of a loop, where one that scales is held ('cooldown') until `batches` further turns have passed since the
    last one that was carried out. A key's decisions are a short log; they are walked in order."""
    log = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("decision").alias("d"))))
    scales = lambda x: x["d"].isin("scale_up", "scale_down")
    start = F.expr("named_struct('left', 0, 'out', cast(array() as array<struct<o:bigint,d:string>>))")
    walked = F.aggregate(
        F.col("log"),
        start,
        lambda t, x: F.struct(
            F.when(scales(x) & (t["left"] <= 0), F.lit(batches)).otherwise(F.greatest(t["left"] - 1, F.lit(0))).alias("left"),
            F.array_append(t["out"], F.struct(x["o"].cast("long").alias("o"), F.when(scales(x) & (t["left"] > 0), "cooldown").otherwise(x["d"]).alias("d"))).alias("out"),
        ),
        lambda t: t["out"],
    )
    return decisions.groupBy(*keys).agg(log.alias("log")).select(*keys, F.explode(walked).alias("x")).select(*keys, F.col("x.o").alias(order), F.col("x.d").alias("decision"))


def suggested_concurrency(current: Column, p95: Column, target: float, lo: int, hi: int, step: int = 4) -> Column:
    moved = F.when(p95 < 0.85 * target, current + step).when(p95 > 1.10 * target, current - step).otherwise(current)
    return F.greatest(F.lit(lo), F.least(F.lit(hi), moved)).cast("int")


def tuned(p95: Column, error_percent: Column, batches: Column, *, target: float, most_errors: float, warm: int, first_token: tuple[Column, float] | None = None, tokens: tuple[Column, float] | None = None) -> Column:
    """'warmup', 'scale_down' (failing or slow), 'scale_up' (fast and healthy) or 'hold'.

    first_token: the time to the first token and its target; tokens: the rate of tokens and the least one. Nulls of
    either say nothing.
    """
    slow, fast = p95 > 1.10 * target, p95 < 0.85 * target
    if first_token is not None:
        slow = slow | F.coalesce(first_token[0] > 1.10 * first_token[1], F.lit(False))
        fast = fast & F.coalesce(first_token[0] < 0.85 * first_token[1], F.lit(True))
    if tokens is not None:
        fast = fast & F.coalesce(tokens[0] >= tokens[1], F.lit(True))
    return F.when(batches < warm, "warmup").when((error_percent > most_errors) | slow, "scale_down").when(fast, "scale_up").otherwise("hold")


def tuned_sizes(decision: Column, inflight: Column, batch: Column, *, step: int, batch_step: int, bounds: tuple[int, int], batch_bounds: tuple[int, int]) -> Column:
    """struct(inflight, batch) after a decision, within bounds; a batch is never smaller than what is in flight."""
    way = F.when(decision == "scale_up", 1).when(decision == "scale_down", -1).otherwise(0)
    held = decision == "warmup"
    clamp = lambda x, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), x))
    n = F.when(held, inflight).otherwise(clamp(inflight + step * way, *bounds))
    m = F.when(held, batch).otherwise(F.greatest(clamp(batch + batch_step * way, *batch_bounds), n))
    return F.struct(n.cast("int").alias("inflight"), m.cast("int").alias("batch"))
