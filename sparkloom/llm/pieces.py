"""Piece vocabularies: encoding by vectorised merge rounds, decoding, and counts by unigram scores over a trie."""

from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .segments import code_points, gathered, marked_parts, slices, text_array

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.iinfo(np.int32).max
#: Longer words are merged with a queue: rounds over one very long word would go over all of it again and again.
LONG = 1500
#: What an unknown character costs beyond the least score of a piece.
UNKNOWN_COST = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        elif tag & 7 == 2:
            size = number()
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, data[at : at + size]
            at += size


class Pieces:
    """A piece model read from its file: BPE with byte fallback, spaces as marks, texts taken as they are."""

    def __init__(self, path: str):
        self.text: list[str] = []
        scores, kinds, normal = [], [], {3: 1, 4: 1, 5: 1}
        with open(path, "rb") as file:
            model = file.read()
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                self.text.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif field == 3:
                normal |= dict(_fields(value))
        if normal.get(2) or normal[4] or not normal[3] or not normal[5]:
            raise ValueError("only models that take texts as they are, with a mark put first and for each space, are known")
        self.scores, self.kinds = np.array(scores), np.array(kinds)
        if {USER, UNUSED} & set(kinds) or (self.kinds == BYTE).sum() != 256:
            raise ValueError("only models with bytes, without user-defined and unused pieces, are known")
        self.unknown = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        self.byte_ids = np.array([i for _, i in sorted((int(self.text[i][3:5], 16), i) for i in np.flatnonzero(self.kinds == BYTE))], np.int32)
        self._symbols()
        self._pairs()

    def _symbols(self) -> None:
        """A number for each normal piece (its id) and for each character that occurs in one (its id, or one beyond all ids)."""
        self.normal = {self.text[i]: int(i) for i in np.flatnonzero(self.kinds == NORMAL)}
        self.symbol = dict(self.normal)
        for c in sorted({c for x in self.normal for c in x}):
            self.symbol.setdefault(c, len(self.text) + len(self.symbol))
        self.of_point = np.full(0x110000, -1, np.int32)
        for x, i in self.symbol.items():
            if len(x) == 1:
                self.of_point[ord(x)] = i
        self.width = 2 * len(self.text) + len(self.symbol)
        order = np.unique(-self.scores)
        self.rank = np.searchsorted(order, -self.scores).astype(np.int32)

    def _pairs(self) -> None:
        """Every way to merge two symbols to a piece; and the pieces whose merge can make a better pair or one as good."""
        merges, unsafe = {}, np.zeros(len(self.text), bool)
        for x, i in self.normal.items():
            for k in range(1, len(x)):
                left, right = self.symbol.get(x[:k]), self.symbol.get(x[k:])
                if left is not None and right is not None:
                    merges[left * self.width + right] = i
                for part in (left, right):
                    if part is not None and part < len(self.text) and self.scores[i] >= self.scores[part]:
                        unsafe[part] = True
        self.merges, self.unsafe = merges, unsafe
        self.keys = np.array(sorted(merges), np.int64)
        self.made = np.array([merges[k] for k in self.keys.tolist()], np.int32)
        bits = 1
        while (1 << bits) < 8 * len(self.keys):
            bits += 1
        self.hash_shift = np.uint64(64 - bits)
        home = self._home(self.keys)
        self.slots = np.full((1 << bits) + 64, -1, np.int64)
        self.slot_piece = np.full(self.slots.size, -1, np.int32)
        self.probes = 1
        for k, at, made in zip(self.keys.tolist(), home.tolist(), self.made.tolist(), strict=True):
            start = at
            while self.slots[at] >= 0:
                at += 1
            self.slots[at], self.slot_piece[at], self.probes = k, made, max(self.probes, at - start + 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.hash_shift).astype(np.int64)

    def pair_pieces(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        keys = left.astype(np.int64) * self.width + right
        at = self._home(keys)
        found = np.where(self.slots[at] == keys, self.slot_piece[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.slots[at] >= 0))
        for step in range(1, self.probes):
            if not open_.size:
                break
            at_next = at[open_] + step
            hit = self.slots[at_next] == keys[open_]
            found[open_[hit]] = self.slot_piece[at_next[hit]]
            open_ = open_[~hit & (self.slots[at_next] >= 0)]
        found[(left < 0) | (right < 0)] = -1
        return found

    def encode(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as code points, and their bounds.

        Rounds over flat arrays: in every word, the pairs of least rank are merged, all at once from the left, and the
        arrays are made dense again, until no pair is left. Where such a merge may give a pair that is as good or
        better, only the leftmost one is merged in that round, so that the order is that of one merge at a time.
        """
        lengths = np.diff(bounds)
        sym = self.of_point[points].copy()
        lost = sym < 0
        sym[lost] = -2 - points[lost].astype(np.int32)
        word = np.repeat(np.arange(lengths.size, dtype=np.int32), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for w in np.flatnonzero(lengths > LONG):
            merged = self._merge_queue(sym[bounds[w] : bounds[w + 1]].tolist())
            done.append((np.array(merged, np.int32), np.full(len(merged), w, np.int32)))
        if done:
            short = np.repeat(lengths <= LONG, lengths)
            sym, word = sym[short], word[short]
        while sym.size:
            piece = np.full(sym.size, -1, np.int32)
            piece[:-1] = np.where(word[:-1] == word[1:], self.pair_pieces(sym[:-1], sym[1:]), -1)
            rank = np.where(piece >= 0, self.rank[piece], NONE)
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([starts, [sym.size]]))
            best = np.minimum.reduceat(rank, starts)
            going = np.repeat(best != NONE, sizes)
            if not going.all():
                done.append((sym[~going], word[~going]))
                sym, word, piece, rank = sym[going], word[going], piece[going], rank[going]
                sizes, best = sizes[best != NONE], best[best != NONE]
                if not sym.size:
                    break
            hit = rank == np.repeat(best, sizes)
            at = np.flatnonzero(hit)
            single = self.unsafe[piece[at]]
            if single.any():
                first = np.concatenate([[True], word[at][1:] != word[at][:-1]])
                at_single = np.zeros(word[-1] + 1, bool)
                at_single[word[at[single]]] = True
                at = at[first | ~at_single[word[at]]]
            run = np.concatenate([[True], np.diff(at) != 1])
            at = at[((at - np.maximum.accumulate(np.where(run, at, 0))) & 1) == 0]
            sym[at] = piece[at]
            stay = np.ones(sym.size, bool)
            stay[at + 1] = False
            sym, word = sym[stay], word[stay]
        sym = np.concatenate([x for x, _ in done]) if done else np.zeros(0, np.int32)
        word = np.concatenate([x for _, x in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(word, kind="stable")
        return self._ids(sym[order], word[order], lengths.size)

    def _merge_queue(self, sym: list[int]) -> list[int]:
        """One merge at a time: least rank first, leftmost among equal ones."""
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def add(i: int) -> None:
            j = after[i] if i >= 0 else len(sym)
            if i >= 0 and j < len(sym) and sym[i] >= 0 and sym[j] >= 0:
                made = self.merges.get(sym[i] * self.width + sym[j])
                if made is not None:
                    heapq.heappush(queue, (int(self.rank[made]), i, sym[i], sym[j], made))

        for i in range(len(sym)):
            add(i)
        gone = [False] * len(sym)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i]
            if gone[i] or j >= len(sym) or sym[i] != left or sym[j] != right:
                continue
            sym[i], gone[j], after[i] = made, True, after[j]
            if after[j] < len(sym):
                before[after[j]] = i
            add(before[i])
            add(i)
        return [x for x, g in zip(sym, gone, strict=True) if not g]

    def _ids(self, sym: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become bytes."""
        lost = np.flatnonzero((sym < 0) | (sym >= len(self.text)))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=words))])
        if not lost.size:
            return sym.astype(np.int32), bounds
        names = {i: x for x, i in self.symbol.items() if i >= len(self.text)}
        spelt = [(chr(-2 - s) if s < 0 else names[s]).encode("utf-8", "surrogatepass") for s in sym[lost].tolist()]
        size = np.ones(sym.size, np.int64)
        size[lost] = [len(x) for x in spelt]
        ends = np.cumsum(size)
        ids = np.repeat(sym, size).astype(np.int32)
        places = np.concatenate([np.arange(e - len(x), e) for e, x in zip(ends[lost], spelt, strict=True)])
        ids[places] = self.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
        return ids, np.concatenate([[0], ends])[bounds]

    def decode(self, ids: list[int]) -> str:
        """Text of any ids: marks are spaces, the one put first goes, bytes that are no UTF-8 become U+FFFD each."""
        out, run, first = [], bytearray(), True

        def flush() -> None:
            data = bytes(run)
            while data:
                try:
                    out.append(data.decode())
                    break
                except UnicodeDecodeError as e:
                    out.append(data[: e.start].decode() + "�")
                    data = data[e.start + 1 :]
            run.clear()

        for i in ids:
            kind = self.kinds[i]
            if kind == BYTE:
                run.append(int(self.text[i][3:5], 16))
                first = False
                continue
            flush()
            if kind == CONTROL:
                continue
            piece = " ⁇ " if kind == UNKNOWN else self.text[i].replace("▁", " ")
            out.append(piece[1:] if first and kind != UNKNOWN and piece.startswith(" ") else piece)
            first = False
        flush()
        return "".join(out)

    def decode_words(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of the ids of each word, marks as spaces; the bytes of a character lie in one word."""
        kinds = getattr(self, "_spelt", None)
        if kinds is None:
            spelt = [bytes([int(x[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else x.replace("▁", " ").encode() for x, k in zip(self.text, self.kinds, strict=True)]
            kinds = self._spelt = (np.frombuffer(b"".join(spelt), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelt])]))
        data, sizes = gathered(kinds[0], kinds[1], ids)
        ends = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        whole = data.tobytes()
        return [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _spelt_ids(ids: np.ndarray, bounds: np.ndarray, names: list[str]) -> list[bytes]:
    """Decimal ids of each word, joined by commas."""
    spelt = list(map(names.__getitem__, ids.tolist()))
    at = bounds.tolist()
    return [",".join(spelt[a:b]).encode() for a, b in zip(at[:-1], at[1:], strict=True)]


def encoded_digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return doc_id, n_tokens, ids_sha256 and decoded_sha256.

    The distinct words of each Arrow batch are merged in vectorised rounds (Pieces.encode); nothing is shuffled.
    A null or empty text has no ids. Rows are independent: repeated rows and null ids are kept as they are. An empty
    table gives an empty result. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        names = list(map(str, range(len(model.text))))
        for batch in slices(batches):
            parts, marks = marked_parts(text_array(batch.column(1)))
            ids, bounds = model.encode(*code_points(parts.words, marks))
            spelt, texts = _spelt_ids(ids, bounds, names), model.decode_words(ids, bounds)
            sizes = np.diff(bounds)
            total = np.concatenate([[0], np.cumsum(sizes[parts.codes])])[parts.bounds]
            codes, at = parts.codes.tolist(), parts.bounds.tolist()
            id_digests, text_digests = [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                own = codes[a:b]
                id_digests.append(hashlib.sha256(b",".join(map(spelt.__getitem__, own))).hexdigest())
                text_digests.append(hashlib.sha256(b"".join(map(texts.__getitem__, own))[1:]).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(np.diff(total), pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every whole text, as encoded_digests() takes them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in slices(batches):
            parts, marks = marked_parts(text_array(batch.column(1)))
            ids, bounds = model.encode(*code_points(parts.words, marks))
            flat, sizes = gathered(ids, bounds, parts.codes)
            ends = np.concatenate([[0], np.cumsum(sizes)])[parts.bounds]
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))], names=["doc_id", "ids"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([model.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
