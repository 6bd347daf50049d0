"""Files written by executors: originals linked or copied, encoded derivatives, moves into folders."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def link_or_copy(src: str, dst: str, mode: str = "hardlink") -> str:
    """What was done: 'kept' (there already), 'hardlink', 'symlink' or 'copy', which also stands in for links that fail."""
    if os.path.lexists(dst):
        return "kept"
    os.makedirs(os.path.dirname(dst), exist_ok=True)
    try:
        if mode == "hardlink":
            os.link(src, dst)
            return mode
        if mode == "symlink":
            os.symlink(os.path.abspath(src), dst)
            return mode
    except OSError:
        pass
    return write_whole(dst, src)


def write_whole(dst: str, data: bytes | str) -> str:
    """A file appears under its name only when it is complete. data: bytes, or the file to copy."""
    if os.path.exists(dst) and os.path.getsize(dst):
        return "kept"
    os.makedirs(os.path.dirname(dst), exist_ok=True)
    part = f"{dst}.{uuid.uuid4().hex}.part"
    if isinstance(data, str):
        shutil.copy2(data, part)
    else:
        with open(part, "wb") as f:
            f.write(data)
    os.replace(part, dst)
    return "copy" if isinstance(data, str) else "written"


def moved(src: str, dst: str) -> str:
    """Into its place; an error if something is there."""
    if os.path.lexists(dst):
        raise FileExistsError(dst)
    os.makedirs(os.path.dirname(dst), exist_ok=True)
    shutil.move(src, dst)
    return "moved"


def materialised(plan: DataFrame, mode: str = "hardlink") -> DataFrame:
    """dst, done and error of (src, dst, content) rows: content is written, or where it is null src is linked or copied.
    The folder must be one that all executors share. Rows can be run again: what is there is kept."""

    def one(src: str | None, dst: str, content: bytes | None) -> tuple:
        try:
            return dst, link_or_copy(src, dst, mode) if content is None else write_whole(dst, bytes(content)), None
        except OSError as e:
            return dst, None, f"{type(e).__name__}: {e}"[:1000]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([one(*r) for r in zip(b["src"], b["dst"], b["content"], strict=True)], columns=["dst", "done", "error"])

    return plan.select("src", "dst", "content").mapInPandas(run, "dst string, done string, error string")
