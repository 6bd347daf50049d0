"""Training sequences from documents: vector bin packing under limits on tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .segments import gathered, slices, text_array, whitespace_parts

#: Words that are encoded in one call, with a special token between them.
JOINED = 2000
#: Words of texts whose ids are gathered at once.
GATHERED = 200_000
#: Items among which the next for a sequence is chosen.
POOL = 512
#: A sequence is closed with so many tokens of room, rather than given a shorter piece of a text.
LEAST_PIECE = 16


#: Open sequences of tasks that are packed again by one task.
GATHERED_OPEN = 256
#: How a tokenizer must see texts for word_ids() to hold: fixed values of the vocabulary files it is made for.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer of a file. One that doesn't lower-case, or parts texts other than by SPLIT, is refused, for words
    encoded on their own would have other ids."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    told = json.loads(made.to_str())
    steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    bytes_after = len(steps) == 2 and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
    if told["normalizer"] != NORMALIZER or not bytes_after or steps[0] != SPLIT or told["model"]["type"] != "BPE":
        raise ValueError(f"packing knows no tokenizer like {path}: it must lower-case and part texts as SPLIT says")
    return made


def _plain_ids(tokenizer, words: list[str]) -> list[list[int]]:
    """Ids of words of a-z alone: such a word is one pre-token that normalisation leaves as it is."""
    merge = tokenizer.model.tokenize
    return [[t.id for t in merge(w)] for w in words]


def _odd_ids(tokenizer, words: list[str], between: str) -> list[list[int]]:
    """Ids of any words. They are joined by the special token `between`, which parts what the tokenizer sees and shows
    in the ids where a word ends; words that hold it are encoded one by one."""
    mark = tokenizer.token_to_id(between)
    alone = {i for i, w in enumerate(words) if between in w}
    ids = tokenizer.encode(between.join("" if i in alone else w for i, w in enumerate(words)), add_special_tokens=False).ids
    out: list[list[int]] = [[]]
    for i in ids if words else ():
        if i == mark:
            out.append([])
        else:
            out[-1].append(i)
    for i in alone:
        out[i] = tokenizer.encode(words[i], add_special_tokens=False).ids
    return out[: len(words)]


def word_ids(tokenizer, words: pa.Array, between: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word on its own, and their bounds. A full stop or comma that ends a word after a letter is a
    pre-token of its own, so words are encoded once for all such endings."""
    ended = pc.match_substring_regex(words, r"[a-z][.,]$")
    stems = pc.replace_substring_regex(words, r"([a-z])[.,]$", r"\1").dictionary_encode()
    unique = stems.dictionary
    plain = pc.match_substring_regex(unique, r"^[a-z]+$").to_numpy(zero_copy_only=False)
    flat, sizes = [], np.zeros(len(unique) + 3, np.int64)
    for first in range(0, len(unique), JOINED):
        own, is_plain = unique.slice(first, JOINED).to_pylist(), plain[first : first + JOINED].tolist()
        simple = iter(_plain_ids(tokenizer, [w for w, p in zip(own, is_plain, strict=True) if p]))
        odd = iter(_odd_ids(tokenizer, [w for w, p in zip(own, is_plain, strict=True) if not p], between))
        found = [next(simple if p else odd) for p in is_plain]
        sizes[first : first + len(own)] = list(map(len, found))
        flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[first : first + len(own)].sum())))
    for k, c in enumerate(".,"):
        flat.append(np.array(tokenizer.encode(c, add_special_tokens=False).ids, np.uint32))
        sizes[len(unique) + k] = flat[-1].size
    ending = np.where(ended.to_numpy(zero_copy_only=False), np.where(pc.ends_with(words, ".").to_numpy(zero_copy_only=False), 0, 1), 2) + len(unique)
    ids, spread = gathered(np.concatenate(flat), np.concatenate([[0], np.cumsum(sizes)]), np.stack([stems.indices.to_numpy(), ending], 1).ravel())
    return ids, np.concatenate([[0], np.cumsum(spread.reshape(-1, 2).sum(1))])


def text_ids(tokenizer, texts: pa.Array, between: str, end_id: int | None) -> Iterator[np.ndarray]:
    """Ids of each whole text, ended by `end_id` if there is one. The tokenizer parts texts at white space."""
    # lower case comes first in any case; where a special token may stand it must be left as it is
    texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    parts = whitespace_parts(texts)
    del texts
    flat, bounds = word_ids(tokenizer, parts.words, between)
    end = np.array([] if end_id is None else [end_id], np.uint32)
    lots = parts.bounds // GATHERED
    cuts = [0, *(np.flatnonzero(np.diff(lots[:-1])) + 1).tolist(), len(parts.bounds) - 1]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = parts.bounds[a : b + 1]
        ids, sizes = gathered(flat, bounds, parts.codes[own[0] : own[-1]])
        at = np.concatenate([[0], np.cumsum(sizes)])[own - own[0]].tolist()
        for x, y in zip(at[:-1], at[1:], strict=True):
            yield np.concatenate([ids[x:y], end])


@dataclass
class Limits:
    """What a sequence can hold at most of each."""

    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


@dataclass
class Packer:
    """Places pieces of examples into sequences, one open sequence at a time.

    Of the items in the pool that fit whole, that one is placed whose demands (tokens, segments, loss-bearing tokens,
    each as a share of its limit) have the largest dot product with the room that is left. Where none fits whole, the
    item with the largest is cut at the room. A sequence is closed if its segments are used up or too little room is
    left for a piece.
    """

    limits: Limits
    first_id: int
    made: int = 0
    pool: list[list] = field(default_factory=list)

    def __post_init__(self):
        self._open()
        self.demands = np.zeros((0, 3))

    def _open(self) -> None:
        self.room = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        self.offset = 0

    def _close(self) -> None:
        self.made += 1
        self._open()

    def add(self, item: object, tokens: int, loss_from: int, start: int = 0) -> Iterator[tuple]:
        """Yields (item, start, length, sequence, offset) of all that is placed; tokens from `loss_from` on bear loss, and
        those before `start` have a place already."""
        whole = min(self.limits.tokens, self.limits.loss)
        if loss_from <= start:  # full sequences need no search
            while tokens - start >= whole and self.limits.segments:
                if self.offset:
                    break
                yield item, start, whole, self.first_id + self.made, 0
                self._close()
                start += whole
        if start < tokens:
            self.pool.append([item, start, tokens, loss_from])
        if len(self.pool) >= POOL:
            yield from self._place(POOL // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._place(0)

    def open_id(self) -> int | None:
        """The sequence that is not full yet, if there is one."""
        return self.first_id + self.made if self.offset else None

    def _place(self, leave: int) -> Iterator[tuple]:
        if not self.pool:
            return
        rows = np.array([[e - s, 1, e - max(s, lf)] for _, s, e, lf in self.pool], float)
        rows[:, 2] = np.maximum(rows[:, 2], 0)
        alive = np.ones(len(self.pool), bool)
        limit = np.array([self.limits.tokens, self.limits.segments, self.limits.loss], float)
        left = len(self.pool)
        while left > leave:
            fits = alive & (rows <= self.room).all(1)
            value = (rows / limit) @ (self.room / limit)
            if fits.any():
                k = int(np.argmax(np.where(fits, value, -1.0)))
                item, start, end, _ = self.pool[k]
                yield item, start, end - start, self.first_id + self.made, self.offset
                self.room -= rows[k]
                self.offset += end - start
                alive[k], left = False, left - 1
            else:
                k = int(np.argmax(np.where(alive, value, -1.0)))
                item, start, end, loss_from = self.pool[k]
                cut = self._cut(start, end, loss_from)
                if self.room[1] >= 1 and (cut >= LEAST_PIECE or not self.offset):
                    yield item, start, cut, self.first_id + self.made, self.offset
                    self.offset += cut
                    self.pool[k][1] = start + cut
                    rows[k] = [end - start - cut, 1, max(0, end - max(start + cut, loss_from))]
                self._close()
                continue
            if self.room[0] < LEAST_PIECE or self.room[1] < 1 or self.room[2] < 1:
                self._close()
        self.pool = [x for x, a in zip(self.pool, alive, strict=True) if a]

    def _cut(self, start: int, end: int, loss_from: int) -> int:
        """Tokens from `start` on that still fit."""
        free = max(0, min(end, loss_from) - start)
        return int(min(end - start, self.room[0], free + self.room[2]))


PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


class Pieces:
    """Documents, or pieces of them, that wait for their places, and the rows of those that have one.

    `held` of a row are the ids of a piece that lies in the sequence that is open at the end of a task.
    """

    def __init__(self, doc_kind: pa.DataType, packer: Packer, with_ids: bool):
        self.packer, self.with_ids, self.waiting, self.done, self.last, self.number = packer, with_ids, {}, [], [], 0
        names = ["doc_id", *(x.split()[0] for x in PIECE.split(", ")), "held", *["ids"] * with_ids]
        self.schema = pa.schema(list(zip(names, [doc_kind] + [pa.int64()] * 7 + [pa.binary()] + [pa.list_(pa.int64())] * with_ids, strict=True)))

    def add(self, doc: object, ids: np.ndarray, loss_from: int, *, start: int = 0, doc_tokens: int | None = None) -> None:
        """ids: those of the document from `start` on."""
        if ids.size:
            self.waiting[self.number] = (doc, ids, loss_from, start, ids.size if doc_tokens is None else doc_tokens)
            self._note(self.packer.add(self.number, start + ids.size, loss_from, start))
            self.number += 1

    def _note(self, placed: Iterator[tuple]) -> None:
        for key, start, length, sequence, offset in placed:
            doc, ids, loss_from, first, doc_tokens = self.waiting[key]
            own = ids[start - first : start - first + length].astype("<u4")
            row = [doc, start, length, zlib.crc32(own.tobytes()), doc_tokens, sequence, offset, max(0, start + length - max(start, loss_from)), own.tobytes()]
            # rows of the sequence that is being filled wait with their ids until it is closed
            if self.last and self.last[0][5] != sequence:
                self._close(False)
            self.last.append(row + ([own.tolist()] if self.with_ids else []))

    def _close(self, still_open: bool) -> None:
        for row in self.last:
            if not still_open:
                row[8] = None
        self.done += self.last
        self.last = []

    def rows(self) -> pa.RecordBatch:
        """What has its place for good so far."""
        kept = {x[0] for x in self.packer.pool}
        for key in [k for k in self.waiting if k not in kept]:
            del self.waiting[key]
        columns = list(zip(*self.done, strict=True)) if self.done else [()] * len(self.schema)
        self.done = []
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)

    def finish(self) -> pa.RecordBatch:
        self._note(self.packer.finish())
        if self.last:
            self._close(self.last[0][5] == self.packer.open_id())
        return self.rows()


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    limits: Limits | None = None,
    end_id: int | None = 2,
    between: str = "<|startoftext|>",
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text and pack it, cut where that saves padding, into sequences within `limits`.

    With `prompt_col` a row is an instruction example: the prompt's tokens come first and bear no loss; else all tokens
    do. Returns a row for each piece: doc_id, start (its document's ids before it), length, ids_crc32 (of little-endian
    unsigned 32-bit ids), doc_tokens, sequence_id, offset (in the sequence, without gaps from 0), loss_tokens, and ids if
    `with_ids`.

    Each task packs the rows that it reads; ids of sequences hold the task's partition, so tasks never share one. Only
    the sequence that a task leaves unfilled is packed again, with those of up to GATHERED_OPEN - 1 other tasks, and so on
    until one is left in all: padding doesn't grow with the number of tasks, and no text is shuffled.

    A null or empty text has the end id alone (without one: no piece). Repeated rows and null ids are packed as rows of
    their own. An empty table gives an empty result. Other columns are ignored. A tokenizer that is not known to part
    texts as this does is refused.
    """
    bound = limits or Limits()
    _tokenizer(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, made = _tokenizer(tokenizer_path), None
        for batch in slices(batches):
            made = made or Pieces(batch.schema.field(0).type, Packer(bound, TaskContext.get().partitionId() << 33), with_ids)
            texts = text_ids(tokenizer, text_array(batch.column(1)), between, end_id)
            prompts = text_ids(tokenizer, text_array(batch.column(2)), between, None) if prompt_col else repeat(np.zeros(0, np.uint32))
            for doc, own, prompt in zip(batch.column(0).to_pylist(), texts, prompts, strict=False):
                made.add(doc, np.concatenate([prompt, own]) if prompt_col else own, prompt.size)
            yield made.rows()
        if made:
            yield made.finish()

    def again(level: int):
        def lot(key: tuple, t: pa.Table) -> pa.Table:
            made = Pieces(t.schema.field("doc_id").type, Packer(bound, (level << 58) + (key[0].as_py() << 33)), with_ids)
            for r in sorted(t.drop_columns(["lot", *["ids"] * with_ids]).to_pylist(), key=lambda r: (r["sequence_id"], r["offset"])):
                loss_from = r["start"] + r["length"] - r["loss_tokens"]
                made.add(r["doc_id"], np.frombuffer(r["held"], "<u4"), loss_from, start=r["start"], doc_tokens=r["doc_tokens"])
            return pa.Table.from_batches([made.finish()])

        return lot

    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *([F.col(prompt_col).alias("prompt")] if prompt_col else []))
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, {PIECE}, held binary" + ", ids array<long>" * with_ids
    rows = stored(rows_in.mapInArrow(run, shape), "packing")
    placed = rows.filter("held is null")
    left = rows.filter("held is not null")
    for level in range(1, 16):
        n = left.select("sequence_id").distinct().count()
        if n < 2:
            break
        lots = -(-n // GATHERED_OPEN)

        lot = F.pmod(F.xxhash64("sequence_id"), F.lit(lots)).cast("int")
        rows = stored(left.withColumn("lot", lot).groupBy("lot").applyInArrow(again(level), shape), "packing")
        placed = placed.unionByName(rows.filter("held is null"))
        left = rows.filter("held is not null")
    return placed.unionByName(left).drop("held")
