"""Upserts, new keys, and dense numbers without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .keeping import kept


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the one that is largest by the columns `order`, kept by partial aggregation alone."""
    last = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("_last")).select("_last.*")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All new rows, and the old ones whose key isn't among them."""
    return old.join(new.select(*keys), keys, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All old rows, and one new row for each key that isn't among them."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti").select(*old.columns).dropDuplicates(keys))


def upsert_keyed(old: DataFrame, new: DataFrame, place: list[str], key: str) -> DataFrame:
    """All new rows (without `key`; each `place` once), and the old ones whose place isn't among them. A new row takes the
    key of the old one in its place, or the next after the largest, by place. Columns that only old rows have become null."""
    own = new.select(*new.columns, *(F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns if c != key and c not in new.columns))
    known = own.join(old.select(*place, key), place)
    fresh = own.join(old.select(*place), place, "left_anti").withColumn("place_", F.struct(*place))
    top = old.agg(F.coalesce(F.max(key), F.lit(0)).alias("top_"))  # one row
    given = numbered(fresh, "place_", "n_").crossJoin(F.broadcast(top)).withColumn(key, (F.col("top_") + F.col("n_") + 1).cast(old.schema[key].dataType))
    rest = old.join(new.select(*place), place, "left_anti")
    return rest.select(*old.columns).unionByName(known.select(*old.columns)).unionByName(given.select(*old.columns))


def next_key(rows: DataFrame, key: str) -> DataFrame:
    return rows.agg(F.coalesce(F.max(key) + 1, F.lit(1)).cast("long").alias("next_key"))


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Add `name`: 0, 1, 2 ... by rising `key` (of any type that has an order), which no two rows share.

    Rows are dealt by ranges of keys, as even as a sample tells, sorted there and kept with their places; only the counts
    of ranges are summed in order. So no task sees the whole table, however the keys lie.
    """
    placed = kept(rows.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)  # the task and the place in it make up the number
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(sums), "_part").withColumn(name, (F.col("_before") + own).cast("long")).drop("_part", "_before", "_at")
