"""Steps kept as tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Where it is unset, a local session gets one of its own;
    a cluster is refused, for its executors would write where others can't read."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="sparkloom-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """A step of a loop, written to the shared folder and read again: this cuts its lineage."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/loop-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
