"""Derivatives of images: those wanted become pending rows, are resized, encoded and written by executors, and what
became of each is told by its row's status."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.writing import write_whole
from .catalog import missing_presets
from .images import pixels, resized
from .keeping import kept
from .keys import upsert_keyed

# fixed values: what a status stands for
PENDING, DONE, FAILED = 0, 1, 2
#: What tells a derivative from all others.
PLACE = ["file_pk", "preset", "transform_cfg_id"]


def pending(derivatives: DataFrame, wanted: DataFrame) -> DataFrame:
    """Derivatives with the wanted ones (PLACE, run_id, out_rel, width, height, fmt; each place once) pending.

    One that is known keeps its deriv_pk and loses its error; the others get keys after the largest, by place. Other rows stay.
    """
    fresh = wanted.withColumn("status", F.lit(PENDING)).withColumn("error", F.lit(None).cast("string"))
    return upsert_keyed(derivatives, fresh, PLACE, "deriv_pk")


def after_results(derivatives: DataFrame, results: DataFrame) -> DataFrame:
    """Derivatives with the status and error of their results (deriv_pk, ok, error), each deriv_pk once. Rows without a
    result stay; results of unknown rows are left out."""
    own = results.select("deriv_pk", "ok", F.coalesce("error", F.lit("")).alias("error_"))
    rows = derivatives.join(own, "deriv_pk", "left")
    status = F.when(F.col("ok"), DONE).when(F.col("ok").isNotNull(), FAILED).otherwise(F.col("status"))
    error = F.when(F.col("ok"), F.lit(None).cast("string")).when(F.col("ok").isNotNull(), F.col("error_")).otherwise(F.col("error"))
    return rows.withColumn("status", status.cast("int")).withColumn("error", error).select(*derivatives.columns)


def failed(derivatives: DataFrame, wanted: DataFrame, error: Column) -> DataFrame:
    """As pending(), but the wanted ones are marked as failed at once: their image can't be read."""
    marked = wanted.withColumn("status", F.lit(FAILED)).withColumn("error", error)
    return upsert_keyed(derivatives, marked, PLACE, "deriv_pk")


def open_transforms(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """(file_pk, transform_cfg_id) without a finished run: finished ones are used again, failed ones are tried again."""
    return wanted.join(runs.filter(F.col("status") == DONE).select("file_pk", "transform_cfg_id"), ["file_pk", "transform_cfg_id"], "left_anti")


def after_transforms(runs: DataFrame, made: DataFrame) -> DataFrame:
    """Runs with those just made; one of the same file and settings keeps its run_id."""
    return upsert_keyed(runs, made, ["file_pk", "transform_cfg_id"], "run_id")


def png(image: np.ndarray) -> bytes:
    """A (channels, height, width) image of bytes as PNG: grey, grey with alpha, colour, or colour with alpha."""
    c, h, w = image.shape
    lines = np.zeros((h, 1 + w * c), np.uint8)  # each begins with its filter: none
    lines[:, 1:] = image.transpose(1, 2, 0).reshape(h, w * c)

    def part(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes())) + part(b"IEND", b"")


def written(images: DataFrame, todo: DataFrame) -> DataFrame:
    """deriv_pk, ok and error of (deriv_pk, file_pk, width, height, dst): the image is resized, encoded as PNG and appears
    whole under `dst`, in a folder that all executors share; what is there is kept, so that a task can be run again.

    images: file_pk and `image` as the image source has it. Each image travels once, whatever sizes are wanted of it. One
    that is missing, null or broken is an error of its rows.
    """
    jobs = todo.groupBy("file_pk").agg(F.collect_list(F.struct("deriv_pk", "width", "height", "dst")).alias("jobs"))  # a row a preset
    rows = jobs.join(images.select("file_pk", "image"), "file_pk", "left").select("jobs", "image.data", "image.height", "image.width", "image.nChannels")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own, data, h, w, c in zip(batch["jobs"], batch["data"], batch["height"], batch["width"], batch["nChannels"], strict=True):
                for job in own:
                    try:
                        if data is None:
                            raise ValueError("no image")
                        write_whole(job["dst"], png(resized(pixels(data, int(h), int(w), int(c)), job["width"], job["height"])))
                        out.append((job["deriv_pk"], True, None))
                    except (OSError, ValueError, KeyError) as e:
                        out.append((job["deriv_pk"], False, f"{type(e).__name__}: {e}"[:1000]))
            yield pd.DataFrame(out, columns=["deriv_pk", "ok", "error"])

    return rows.mapInPandas(run, "deriv_pk long, ok boolean, error string")


def derived(derivatives: DataFrame, files: DataFrame, images: DataFrame, presets: DataFrame, folder: str, *, transform_cfg_id: int = 0, run_id: int | None = None) -> DataFrame:
    """Derivatives after one pass: what files lack of the presets (preset, width, height; a short list) is made and written
    to folder/preset/file_pk.png. Finished ones are not made again, failed ones are."""
    done = derivatives.filter(F.col("transform_cfg_id") == transform_cfg_id).select("file_pk", "preset", "status")
    lacking = missing_presets(files, presets, done).join(F.broadcast(presets), "preset")
    wanted = lacking.select(
        "file_pk", "preset", F.lit(transform_cfg_id).alias("transform_cfg_id"), F.lit(run_id).cast("long").alias("run_id"),
        F.format_string("%s/%d.png", "preset", "file_pk").alias("out_rel"), "width", "height", F.lit("png").alias("fmt"),
    )
    marked = kept(pending(derivatives, wanted))
    todo = marked.join(wanted.select(*PLACE), PLACE, "left_semi").select("deriv_pk", "file_pk", "width", "height", F.concat(F.lit(f"{folder}/"), "out_rel").alias("dst"))
    return after_results(marked, kept(written(images, todo)))
