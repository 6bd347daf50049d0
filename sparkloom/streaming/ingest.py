"""Arrival of items as a stream: each micro-batch is merged into a table, by version folders of Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keys import latest, upsert


class Snapshots:
    """A table as a log of versions: a row for each version names the folder of its rows. A version is seen only once
    its row is written, so a batch that fails half-way or is repeated changes nothing that readers see."""

    def __init__(self, spark: SparkSession, place: str, schema: str):
        self.spark, self.place, self.schema = spark, place.rstrip("/"), schema

    def _log(self) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema("version long, batch long, folder string").parquet(f"{self.place}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last(self) -> tuple[int, int, str] | None:
        log = self._log()
        row = log.orderBy(F.desc("version")).first() if log is not None else None
        return tuple(row) if row else None

    def read(self) -> DataFrame:
        last = self.last()
        return self.spark.read.schema(self.schema).parquet(last[2]) if last else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, batch: int) -> None:
        last = self.last()
        folder = f"{self.place}/rows-{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        self.spark.createDataFrame([((last[0] if last else 0) + 1, batch, folder)], "version long, batch long, folder string").coalesce(1).write.mode("append").parquet(f"{self.place}/log")


def merge_stream(rows: DataFrame, table: Snapshots, keys: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest row of each key: batches are merged in order, and one that was merged before is passed over."""

    def merge(batch: DataFrame, number: int) -> None:
        last = table.last()
        if last and last[1] >= number:
            return
        table.write(upsert(table.read(), latest(batch, keys, [order]), keys), number)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, *, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """window_start, event_type, n over event time; works on streams (with a watermark) and on tables."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    return own.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")
