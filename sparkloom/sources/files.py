"""Files and lists of URLs as tables."""

from __future__ import annotations

import csv
import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import is_archive, suffix


def listing(spark: SparkSession, root: str, *, suffixes: list[str] | None = None) -> DataFrame:
    """path, size, mtime (microseconds) of all files below a folder; contents are never read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rows = rows.select("path", F.col("length").alias("size"), F.unix_micros("modificationTime").alias("mtime"))
    return rows if suffixes is None else rows.filter(suffix(F.col("path")).isin(suffixes))


def digests(spark: SparkSession, root: str) -> DataFrame:
    """path, size and the digest of the content of all files."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return rows.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("content_hash"))


def text_files(spark: SparkSession, root: str) -> DataFrame:
    """stem and text of all .txt files; bytes that are no UTF-8 are replaced."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(root)
    return rows.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("stem"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def url_lines(spark: SparkSession, path: str) -> DataFrame:
    """One URL a line; blank lines and those that begin with # are left out."""
    return usable_urls(spark.read.text(path).select(F.col("value").alias("url")))


def usable_urls(rows: DataFrame) -> DataFrame:
    url = F.trim("url")
    return rows.select(url.alias("url")).filter((url != "") & ~url.startswith("#"))


def url_table(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a CSV file: the column url, link or href, whatever its case; else the first column. The first line that isn't
    blank is data if no column has such a name and it begins with http; if not, that line alone is left out. Rows that are
    too short have none."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    cells = next(csv.reader([first[0]])) if first else [""]
    names = [x.strip().lower() for x in cells]
    place = next((names.index(n) for n in ("url", "link", "href") if n in names), None)
    headed = place is not None or not names[0].startswith("http")
    schema = ", ".join(f"_c{i} string" for i in range(len(names)))
    rows = spark.read.schema(schema).option("header", headed).option("escape", '"').csv(path)
    return usable_urls(rows.select(F.col(f"_c{place or 0}").alias("url")))


def archive_members(files: DataFrame) -> DataFrame:
    """path, member, content, error of the zip and tar archives among (path, content) rows.

    A member that would leave the folder has an error and no content; so has an archive that can't be read.
    """

    def unsafe(name: str) -> bool:
        return name.startswith(("/", "\\")) or ".." in name.replace("\\", "/").split("/") or name[1:2] == ":"

    def members(path: str, content: bytes) -> Iterator[tuple]:
        try:
            if path.lower().endswith(".zip"):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in z.infolist():
                        if not m.is_dir():
                            yield (path, m.filename, None, "unsafe path") if unsafe(m.filename) else (path, m.filename, z.read(m), None)
            else:
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    for m in t:
                        if not m.isdir():
                            bad = unsafe(m.name) or not m.isfile()
                            yield (path, m.name, None, "unsafe path") if bad else (path, m.name, t.extractfile(m).read(), None)
        except Exception as e:  # one bad archive is a row, not the end of the job
            yield path, None, None, f"{type(e).__name__}: {e}"[:1000]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame(list(members(path, bytes(content))), columns=["path", "member", "content", "error"])

    return files.filter(is_archive(F.col("path"))).select("path", "content").mapInPandas(run, "path string, member string, content binary, error string")


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """label_id, name, description of a JSON list; white space squeezed. Raises if an id or a length isn't allowed."""
    raw = spark.read.option("multiLine", "true").schema("id int, name string, description string").json(path)
    squeezed = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    rows = raw.select(F.col("id").alias("label_id"), squeezed("name").alias("name"), squeezed("description").alias("description"))
    bad = rows.filter("label_id is null or label_id < 1 or name = '' or length(name) > 64 or description = '' or length(description) > 120").limit(1).count()
    if bad or rows.groupBy("label_id").count().filter("count > 1").limit(1).count():
        raise ValueError("ids must be unique and positive, names 1 to 64 and descriptions 1 to 120 characters")
    return rows.orderBy("label_id")
