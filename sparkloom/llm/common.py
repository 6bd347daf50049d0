"""Places and files in the shared folder, materialised steps, and small helpers of the operators here."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keeping import shared_dir

__all__ = ["discarded", "id_text", "new_folder", "partitions", "read_file", "shared_dir", "stored", "table", "write_file"]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for one step of one run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it again: later steps never recompute it, whatever executors are lost.

    discarded() removes a step that nothing reads any more. Those that a result still reads stay until whoever started the
    run clears the folder.
    """
    spark = df.sparkSession
    place = new_folder(spark, label)
    df.write.parquet(place)
    made = spark.read.schema(df.schema).parquet(place)
    made.place_ = place
    return made


def discarded(*steps: DataFrame) -> None:
    """Remove steps that stored() has written, once all that was made from them has been stored itself."""
    for step in steps:
        fs, root = pafs.FileSystem.from_uri(step.place_)
        fs.delete_dir(root)


def write_file(folder: str, data: bytes) -> str:
    """Called by tasks: a new file of the shared folder under a name of its own, so that a repeated attempt never writes
    to a file that another has named."""
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    name = uuid.uuid4().hex
    with fs.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(data)
    return name


def read_file(folder: str, name: str) -> bytes:
    fs, root = pafs.FileSystem.from_uri(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        return f.read()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so that further columns never clash with those an operator adds."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
