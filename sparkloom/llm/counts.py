"""Token counts under a unigram vocabulary: one dynamic programme over a trie of the distinct pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text
from .pieces import UNKNOWN_COST, Pieces, pieces
from .segments import code_points, marked_parts, slices, text_array

#: Base of the rolling hash (odd, so that it has an inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15
#: Deeper pre-tokens are scored on their own: a trie has one level for each of their characters.
DEEP = 200


class Unigram:
    """Scores of pieces, found by the hash of their characters."""

    def __init__(self, model: Pieces):
        self.scores_of = {x: float(model.scores[i]) for x, i in model.normal.items()}
        self.longest = max(map(len, self.scores_of))
        self.unknown = min(self.scores_of.values()) - UNKNOWN_COST
        found = sorted((self._hash(x), s) for x, s in self.scores_of.items())
        self.hashes = np.array([h for h, _ in found], np.uint64)
        self.scores = np.array([s for _, s in found])
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.powers = np.array([pow(BASE, k, 1 << 64) for k in range(self.longest + 1)], np.uint64)

    @staticmethod
    def _hash(x: str) -> int:
        h = 0
        for c in x:
            h = (h * BASE + ord(c) + 1) % (1 << 64)
        return h

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Scores, or -inf where no piece has the hash."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.hashes.size - 1)
        return np.where(self.hashes[at] == hashes, self.scores[at], -np.inf)

    def counts(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and score of each word's best segmentation.

        A character without a piece costs `unknown` and gives as many tokens as it has bytes. Among equal scores the
        longest last piece wins.
        """
        lengths = np.diff(bounds)
        tokens, best = np.zeros(lengths.size, np.int64), np.zeros(lengths.size)
        shallow = np.flatnonzero((lengths > 0) & (lengths <= DEEP))
        for w in np.flatnonzero(lengths > DEEP).tolist():
            tokens[w], best[w] = self._deep(points[bounds[w] : bounds[w + 1]])
        if shallow.size:
            tokens[shallow], best[shallow] = self._trie(points, bounds[:-1][shallow], lengths[shallow])
        return tokens, best

    def _trie(self, points: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level by level: insert the words' characters as nodes, then score every node once from its ancestors."""
        deepest = int(lengths.max())
        node = np.zeros(begins.size, np.int64)
        live = np.arange(begins.size)
        parents, chars, levels, terminal = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [0, 1], np.zeros(begins.size, np.int64)
        for depth in range(deepest):
            live = live[lengths[live] > depth]
            c = points[begins[live] + depth].astype(np.int64)
            own, back = np.unique(node[live] << 21 | c, return_inverse=True)
            parents.append(own >> 21)
            chars.append(own & ((1 << 21) - 1))
            node[live] = levels[-1] + back.ravel()
            levels.append(levels[-1] + own.size)
            ends = live[lengths[live] == depth + 1]
            terminal[ends] = node[ends]
        parent, char = np.concatenate(parents), np.concatenate(chars)
        total = np.zeros(parent.size, np.uint64)
        for depth in range(1, deepest + 1):
            at = slice(levels[depth], levels[depth + 1])
            total[at] = total[parent[at]] * np.uint64(BASE) + (char[at] + 1).astype(np.uint64)
        score, count = np.full(parent.size, -np.inf), np.zeros(parent.size, np.int64)
        score[0] = 0.0
        width = np.where(char < 0x80, 1, np.where(char < 0x800, 2, np.where(char < 0x10000, 3, 4)))
        for depth in range(1, deepest + 1):
            at = np.arange(levels[depth], levels[depth + 1])
            line = [at]
            for _ in range(min(depth, self.longest)):
                line.append(parent[line[-1]])
            for size in range(len(line) - 1, 0, -1):
                start = line[size]
                piece = self.lookup(total[at] - total[start] * self.powers[size])
                step = np.ones(at.size, np.int64)
                if size == 1:
                    step = np.where(np.isinf(piece), width[at], 1)
                    piece = np.where(np.isinf(piece), self.unknown, piece)
                better = score[start] + piece > score[at]
                score[at] = np.where(better, score[start] + piece, score[at])
                count[at] = np.where(better, count[start] + step, count[at])
        return count[terminal], score[terminal]

    def _deep(self, points: np.ndarray) -> tuple[int, float]:
        """One long word: pieces at all places are looked up at once, then one pass."""
        n = points.size
        hashes = np.zeros((self.longest + 1, n), np.uint64)
        for size in range(1, min(self.longest, n) + 1):
            hashes[size, : n - size + 1] = hashes[size - 1, : n - size + 1] * np.uint64(BASE) + (points[size - 1 :].astype(np.uint64) + np.uint64(1))
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for size in range(self.longest, 0, -1):
            if size > n:
                continue
            found = self.lookup(hashes[size, : n - size + 1])
            for i in np.flatnonzero(~np.isinf(found)).tolist():
                ends[i + size].append((size, float(found[i])))
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            own, tokens = -np.inf, 0
            for size, piece in ends[end]:
                if score[end - size] + piece > own:
                    own, tokens = score[end - size] + piece, count[end - size] + 1
            if not ends[end] or ends[end][-1][0] != 1:
                if score[end - 1] + self.unknown > own:
                    own, tokens = score[end - 1] + self.unknown, count[end - 1] + len(chr(points[end - 1]).encode("utf-8", "surrogatepass"))
            score[end], count[end] = own, tokens
        return count[n], score[n]


@lru_cache(maxsize=4)
def unigram(path: str) -> Unigram:
    return Unigram(pieces(path))


def token_counts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens and score: every whole text's tokens under the pieces' scores as a unigram model.

    Pre-tokens are a run of spaces with all up to the next space. The distinct ones of each Arrow batch go into a trie,
    a prefix is scored once for all that share it, and counts at terminals are summed by text. Nothing is shuffled.
    A null or empty text has no tokens and the score 0. Repeated rows and null ids are kept as they are. An empty table
    gives an empty result. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(model_path)
        for batch in slices(batches):
            parts, marks = marked_parts(text_array(batch.column(1)))
            tokens, scores = model.counts(*code_points(parts.words, marks))
            sums = [np.concatenate([[0], np.cumsum(x[parts.codes])])[parts.bounds] for x in (tokens, scores)]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(parts.bounds), pa.int64()), pa.array(np.diff(sums[0]), pa.int64()), pa.array(np.diff(sums[1]), pa.float64())], names=["doc_id", "n_pretokens", "n_tokens", "score"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_pretokens long, n_tokens long, score double")
