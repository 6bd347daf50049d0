"""Shards that all hold the mixture of the sources: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

#: Rows that one window group is meant to hold; the number of groups follows the table.
GROUP_ROWS = 20_000


def _positions(df: DataFrame, within: list[str], point: str, order: list[Column], groups: int) -> DataFrame:
    """Add `rank` (from 0, over all rows of a stratum by `order`) and `stratum_rows`.

    `point` lies in [0, 1] and never falls along `order`. Rows are dealt by slices of it, counts of slices are
    summed up, and only a slice is ever sorted in one task, however many rows a stratum has.
    """
    sliced = df.withColumn("slice", F.least(F.lit(groups - 1), F.floor(F.col(point) * groups)).cast("int"))
    sizes = sliced.groupBy(*within, "slice").agg(F.count("*").alias("slice_rows"))
    stratum = Window.partitionBy(*within)
    before = stratum.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *within,
        "slice",
        F.coalesce(F.sum("slice_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("slice_rows").over(stratum).alias("stratum_rows"),
    )
    own = Window.partitionBy(*within, "slice").orderBy(*order)
    ranked = sliced.withColumn("rank_in_slice", F.row_number().over(own))
    return (
        ranked.join(sizes, [*within, "slice"])
        .withColumn("rank", F.col("rows_before") + F.col("rank_in_slice") - 1)
        .drop("slice", "rank_in_slice", "rows_before")
    )


def interleaved_shards(
    df: DataFrame,
    n_shards: int,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    overhead: int = 16,
) -> DataFrame:
    """Deal rows to `n_shards` shards whose row counts are at most one apart and whose mixture of sources is that of the table.

    The rows of each source are shuffled by a seeded hash of the id and ranked; rank k of n stands at the fraction
    (k + u) / n, u in 0..1 being the source's own, or else sources of equal size would come in bursts; all rows are
    sorted by that fraction and the sequence is cut into equal runs.

    Returns doc_id, source, size (UTF-8 bytes of the text plus `overhead`), text_crc32, law ('rows'), shard,
    slot (from 0 in each shard, without gaps) and grown_shard (null under this law).

    A null text has no bytes and the checksum of the empty text; a null source is a source of its own; null ids are
    kept. Equal rows are interchangeable: each takes a place of its own. Ties in the hash go by id, size and checksum.
    An empty table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col(source_col).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source_col).cast("string"))).alias("stratum"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)).alias("key"),
    )
    rows = stored(rows.withColumn("point", F.col("key") / float(1 << 52)), "shards-rows")
    total = rows.count()
    groups = max(4 * partitions(spark), -(-total // GROUP_ROWS))
    tie = [F.col(c) for c in ("key", "doc_id", "size", "text_crc32")]
    phase = F.pmod(F.xxhash64(F.lit(seed), F.col("stratum")), F.lit(1 << 20)) / float(1 << 20)
    ranked = _positions(rows, ["stratum"], "point", tie, groups)
    ranked = ranked.select("doc_id", "source", "size", "text_crc32", "stratum", "key", ((F.col("rank") + phase) / F.col("stratum_rows")).alias("fraction"))
    ranked = stored(ranked, "shards-ranked").withColumn("whole", F.lit(0))
    placed = _positions(ranked, ["whole"], "fraction", [F.col("fraction"), F.col("stratum"), *tie], groups)
    n = max(total, 1)
    shard = F.expr(f"cast((cast({n_shards} as bigint) * (rank + 1) - 1) div {n} as int)")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"rank - (cast(shard as bigint) * {n}) div {n_shards}").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
