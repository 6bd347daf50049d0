"""Texts of a batch as codes of their distinct parts, so that costly work is done once for each part."""

from __future__ import annotations

import contextlib
import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The mark that stands for a space in pieces.
MARK = "▁"


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A large_string array without nulls whose offsets begin at 0 (some kernels fail on others); a null text is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    data = pa.py_buffer(b"") if data is None else data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), data)


@dataclass
class Parts:
    """words: distinct parts; codes: those of all texts, one after the other; bounds: where each text's codes begin, and the end."""

    words: pa.Array
    codes: np.ndarray
    bounds: np.ndarray


def _coded(lists: pa.Array) -> Parts:
    offsets = lists.offsets.to_numpy()
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return Parts(flat.dictionary.cast(pa.large_string()), flat.indices.to_numpy(zero_copy_only=False), (offsets - offsets[0]).astype(np.int64))


def whitespace_parts(texts: pa.Array) -> Parts:
    """Parts between runs of ASCII white space; none is empty."""
    parts = _coded(pc.ascii_split_whitespace(texts))
    empty = pc.index(parts.words, pa.scalar("", pa.large_string())).as_py()
    if empty < 0:
        return parts
    stay = parts.codes != empty
    return Parts(parts.words, parts.codes[stay], np.concatenate([[0], np.cumsum(stay)])[parts.bounds])


def marked_parts(texts: pa.Array) -> tuple[Parts, np.ndarray]:
    """Parts of texts as a piece model sees them: a run of marks, then all up to the next mark. Also each part's number of marks.

    A mark is put before the text, and marks stand for spaces. An empty text has no parts. The words returned are
    without their marks; equal words after runs of different length are different parts.
    """
    texts = pc.replace_substring(texts, MARK, " ")
    parts = _coded(pc.split_pattern(texts, " "))
    codes, bounds, count = parts.codes, parts.bounds, len(parts.words)
    lengths = np.diff(bounds)
    filled = pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
    empty = pc.index(parts.words, pa.scalar("", pa.large_string())).as_py()
    if empty < 0:
        return parts, np.ones(count, np.int64)
    last = np.zeros(len(codes), bool)
    last[bounds[1:][lengths > 0] - 1] = True
    text_filled = np.repeat(filled, lengths)
    stay = np.flatnonzero(((codes != empty) | last) & text_filled)
    before = np.concatenate([[-1], stay[:-1]]) if stay.size else stay
    begin = np.repeat(bounds[:-1], lengths)[stay]
    marks = stay - np.maximum(before, begin - 1)
    kept_before = np.concatenate([[0], np.cumsum(np.bincount(stay, minlength=len(codes)))]) if len(codes) else np.zeros(1, np.int64)
    codes, bounds = codes[stay].astype(np.int64), kept_before[bounds]
    several = np.flatnonzero(marks > 1)
    word_marks = np.ones(count, np.int64)
    if several.size:
        pairs, where = np.unique(np.stack([codes[several], marks[several]], 1), axis=0, return_inverse=True)
        codes[several] = count + where.ravel()
        words = pa.concat_arrays([parts.words, parts.words.take(pa.array(pairs[:, 0]))])
        return Parts(words, codes, bounds), np.concatenate([word_marks, pairs[:, 1]])
    return Parts(parts.words, codes, bounds), word_marks


def code_points(words: pa.Array, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each after its marks, and the bounds of the words."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = leads[offsets - offsets[0]]
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if marks is None:
        return points, bounds
    shift = np.concatenate([[0], np.cumsum(marks)])
    out = np.full(points.size + shift[-1], ord(MARK), np.uint32)
    lengths = np.diff(bounds)
    out[np.arange(points.size) + np.repeat(shift[1:], lengths)] = points
    return out, bounds + shift


def gathered(values: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` that `codes` name, one after the other, and how long each is."""
    sizes = np.diff(bounds)[codes]
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if ends.size else 0) + np.repeat(bounds[:-1][codes] - (ends - sizes), sizes)
    return values[at], sizes


def slices(batches, column: int = 1, most_bytes: int = 24 << 20):
    """Arrow batches cut so that the texts of each have about `most_bytes` at most (a longer text stands alone)."""
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        lots = np.cumsum(sizes) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    trim()


def trim() -> None:
    """Give freed memory back: workers stay for further tasks, and what they hold counts beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)
