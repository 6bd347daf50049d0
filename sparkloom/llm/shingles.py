"""Distinct word shingles of texts, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .segments import whitespace_parts

#: Odd multipliers, one for each place in a shingle, and for its number of words.
PLACES = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(64)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles of `width` words.

    A-Z are lower-cased and words stand between ASCII white space. With fewer words the whole sequence is one shingle;
    without words the set is empty.
    """
    parts = whitespace_parts(pc.ascii_lower(texts))
    words = np.fromiter(map(xxhash.xxh64_intdigest, parts.words.cast(pa.large_binary()).to_pylist()), np.uint64, len(parts.words))
    flat = words[parts.codes] if len(words) else np.zeros(0, np.uint64)
    whole = np.zeros(max(0, flat.size - width + 1), np.uint64)
    for k in range(width):
        whole += flat[k : k + whole.size] * PLACES[k]
    whole = mixed(whole + PLACES[32 + width])
    out = []
    for a, b in zip(parts.bounds[:-1].tolist(), parts.bounds[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(whole[a : b - width + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            out.append(mixed((flat[a:b] * PLACES[: b - a]).sum(keepdims=True, dtype=np.uint64) + PLACES[32 + b - a]) if b > a else flat[:0])
    return out
