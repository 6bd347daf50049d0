"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy, over windows of words."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .segments import Parts, code_points, slices, text_array, trim, whitespace_parts

#: Words of a window, and from one window's start to the next's.
WINDOW, STRIDE = 32, 24
#: Buckets of words and of character n-grams, and the n-grams' lengths; words are taken with a mark at both ends.
BUCKETS, GRAMS = 1 << 18, (4, 5, 6)
#: Units of the network in each direction.
UNITS = 8
#: Words whose n-grams are looked at together.
LOT = 32_768
#: Windows that are scored at once.
AT_ONCE = 2048
#: Labelled texts that the model is fitted on at most, of either label, and the longest of them in characters.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 2500, 20_000
FOLDS = 5
PAD_FEATURES = (0.0, 0.0, 0.0, 0.0, 1.0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(27))) & np.uint64(BUCKETS - 1)


def lowered_parts(texts: pa.Array) -> Parts:
    return whitespace_parts(pc.utf8_lower(texts))


def _hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word's letters and digits, buckets of its character n-grams with their bounds, and its length."""
    bare = pc.replace_substring_regex(words, r"[^\pL\pN]+", "")
    begin, end, between = (pa.scalar(c, pa.large_string()) for c in ("^", "$", ""))
    marked = pc.binary_join_element_wise(begin, bare, end, between)
    points, bounds = code_points(marked)
    powers = np.cumprod(np.full(points.size + 1, 0x100000001B3, np.uint64)) if points.size else np.ones(1, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[: points.size])])
    # an odd base can be divided by: spans are hashed as if all stood at the beginning
    inverse = np.uint64(pow(0x100000001B3, -1, 1 << 64))
    lift = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(points.size, inverse, np.uint64)]))
    span = lambda a, b: (sums[b] - sums[a]) * lift[a]
    lengths = np.diff(bounds)
    word = _mixed(span(bounds[:-1], bounds[1:])).astype(np.int64)
    own = np.repeat(np.arange(lengths.size), lengths)
    ends = np.repeat(bounds[1:], lengths)
    at = np.arange(points.size)
    grams, owners = [], []
    for n in GRAMS:
        good = at + n <= ends
        grams.append(_mixed(span(at[good], at[good] + n) + np.uint64(n)).astype(np.int64))
        owners.append(own[good])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return word.astype(np.int32), gram[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=lengths.size))]), lengths - 2


def hashed(words: pa.Array) -> Iterator[tuple]:
    """What _hashed() gives, for lots of words: the n-grams of all at once would take too much room."""
    for first in range(0, len(words), LOT):
        yield _hashed(words.slice(first, LOT))


def word_inputs(lots: Iterator[tuple], word_odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
    """Inputs for each word, and a last row for padding."""
    rows = [_inputs(lot, word_odds, gram_odds) for lot in lots]
    return np.concatenate([*rows, np.array([PAD_FEATURES], np.float32)])


def _inputs(lot: tuple, word_odds: np.ndarray, gram_odds: np.ndarray) -> np.ndarray:
    """Learned odds of the word, the largest and the mean of its n-grams, its length; the last input marks padding."""
    word, gram, bounds, length = lot
    odds = gram_odds[gram]
    some = np.flatnonzero(np.diff(bounds))
    most, mean = np.zeros(len(word), np.float32), np.zeros(len(word), np.float32)
    if some.size:
        most[some] = np.maximum.reduceat(odds, bounds[:-1][some])
        mean[some] = np.add.reduceat(odds, bounds[:-1][some]) / np.diff(bounds)[some]
    return np.stack([word_odds[word], most, mean, np.minimum(length, 20) / 20 - 0.3, np.zeros(len(word))], 1).astype(np.float32)


def windows(parts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all windows (-1: padding), and each window's text. Every text has one window at least."""
    lengths = np.diff(parts.bounds)
    count = 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE))
    text = np.repeat(np.arange(lengths.size), count)
    nth = np.arange(text.size) - np.repeat(np.cumsum(count) - count, count)
    at = (nth * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < lengths[text][:, None]
    place = np.where(inside, parts.bounds[:-1][text][:, None] + at, 0)
    return np.where(inside, parts.codes[place] if parts.codes.size else -1, -1).astype(np.int32), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Two gated recurrent layers, one in each direction, attention over their states, and a logit."""

    def __init__(self, inputs: int, units: int = UNITS, seed: int = 1):
        r = np.random.default_rng(seed)
        w = lambda a, b: (r.normal(size=(a, b)) / np.sqrt(a)).astype(np.float32)
        self.units = units
        self.p = {"v": w(2 * units, 1), "o": w(2 * units, 1), "b": np.full(1, -2, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": w(inputs, 3 * units), f"U{d}": w(units, 3 * units), f"c{d}": np.zeros(3 * units, np.float32)}

    def gates(self, x: np.ndarray, d: str) -> np.ndarray:
        """What the inputs add to the gates: taken once for each distinct word when texts are scored."""
        return x @ self.p[f"W{d}"] + self.p[f"c{d}"]

    def _states(self, gates: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """gates: (time, windows, 3 * units), in the order of the direction."""
        k, u = self.units, self.p[f"U{d}"]
        h = np.zeros((gates.shape[1], k), np.float32)
        out, kept = np.empty((*gates.shape[:2], k), np.float32), []
        for t in range(len(gates)):
            a = h @ u
            zr = 1 / (1 + np.exp(-(gates[t, :, : 2 * k] + a[:, : 2 * k])))
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(gates[t, :, 2 * k :] + r * a[:, 2 * k :])
            if keep:
                kept.append((h, z, r, n, a[:, 2 * k :]))
            h = n + z * (h - n)
            out[t] = h
        return out, kept

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, keep: bool = False):
        f, kf = self._states(gates_f, "f", keep)
        b, kb = self._states(gates_b[::-1], "b", keep)
        h = np.concatenate([f, b[::-1]], 2)
        score = (h @ self.p["v"])[:, :, 0]
        e = np.exp(score - score.max(0))
        weight = e / e.sum(0)
        pooled = np.einsum("tw,twk->wk", weight, h)
        logit = (pooled @ self.p["o"])[:, 0] + self.p["b"][0]
        return (logit, h, weight, pooled, kf, kb) if keep else logit

    def gradients(self, x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients of the mean log loss; x: (time, windows, inputs)."""
        k = self.units
        logit, h, weight, pooled, kf, kb = self.logits(self.gates(x, "f"), self.gates(x, "b"), keep=True)
        p = _sigmoid(logit)
        total = importance.sum()
        loss = float((importance * -(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum() / total)
        dl = (importance * (p - y) / total).astype(np.float32)
        g = {"o": pooled.T @ dl[:, None], "b": np.array([dl.sum()], np.float32)}
        dp = dl[:, None] * self.p["o"][:, 0]
        dw = np.einsum("wk,twk->tw", dp, h)
        ds = weight * (dw - (weight * dw).sum(0))
        g["v"] = np.einsum("tw,twk->k", ds, h)[:, None]
        dh = weight[:, :, None] * dp + ds[:, :, None] * self.p["v"][:, 0]
        for d, own, kept, steps in (("f", dh[:, :, :k], kf, x), ("b", dh[::-1, :, k:], kb, x[::-1])):
            u = self.p[f"U{d}"]
            back = np.zeros_like(own[0])
            dg = np.empty((*own.shape[:2], 3 * k), np.float32)
            du = np.zeros_like(u)
            for t in range(len(own) - 1, -1, -1):
                before, z, r, n, an = kept[t]
                d_h = own[t] + back
                dn = d_h * (1 - z) * (1 - n * n)
                dz = d_h * (before - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                dg[t] = np.concatenate([dz, dr, dn], 1)
                da = np.concatenate([dz, dr, dn * r], 1)
                du += before.T @ da
                back = d_h * z + da @ u.T
            g |= {f"W{d}": np.einsum("twi,twk->ik", steps, dg), f"c{d}": dg.sum((0, 1)), f"U{d}": du}
        return loss, g


class Adam:
    def __init__(self, params: dict, rate: float = 0.02):
        self.params, self.rate, self.t = params, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in params.items()} for _ in range(2))

    def step(self, g: dict) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x**2).sum()) for x in g.values()))
        for k, x in g.items():
            x = x * min(1, 5 / (norm + 1e-9))
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)


@dataclass
class Model:
    network: Network
    word_odds: np.ndarray
    gram_odds: np.ndarray
    slope: float
    shift: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Score of each text: that of its window with the largest logit."""
        parts = lowered_parts(texts)
        inputs = word_inputs(hashed(parts.words), self.word_odds, self.gram_odds)
        gates = [self.network.gates(inputs, d) for d in "fb"]
        codes, text = windows(parts)
        best = np.full(len(texts), -np.inf)
        for a in range(0, len(codes), AT_ONCE):
            own = codes[a : a + AT_ONCE].T
            np.maximum.at(best, text[a : a + AT_ONCE], self.network.logits(gates[0][own], gates[1][own]))
        return _sigmoid(self.slope * best + self.shift)


def _counts(texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """In how many of the texts each word bucket and each n-gram bucket occurs."""
    out = (np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32))
    for own in texts:
        for total, found in zip(out, own, strict=True):
            total[found] += 1
    return out


def _odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Smoothed log odds, nearer to 0 the fewer texts there are; 0 for what was never seen."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return (np.clip(odds * (toxic + clean) / (toxic + clean + 2), -8, 8) / 4).astype(np.float32)


def fit(texts: list[str], labels: list[int], *, steps: int = 400, seed: int = 1) -> Model:
    """Fit on texts with labels 0 and 1. Repeated texts count once, as toxic if they have both labels. With one label
    alone, all texts have it; without any text, none is held to be toxic.

    Odds of words and n-grams are learned first. The inputs of a training text come from odds of the other folds, so
    that the network sees what it will see of new texts. A toxic text is toxic because of some window: the network is
    trained on the window of each toxic text that looks worst so far, against all windows of clean ones; what looks
    worst is looked up again as training goes on. Last, a text's largest logit is calibrated.
    """
    known: dict[str, int] = {}
    for text, label in zip(texts, labels, strict=True):
        known[text] = max(label, known.get(text, 0))
    texts, y = list(known), np.array(list(known.values()), float)
    if not texts or y.min() == y.max():
        flat = np.zeros(BUCKETS, np.float32)
        return Model(Network(len(PAD_FEATURES), seed=seed), flat, flat, 0.0, 3.0 if texts and y[0] else -3.0)
    parts = lowered_parts(text_array(pa.array(texts, pa.string())))
    lots = list(hashed(parts.words))

    def occurring(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words and of the n-grams of one text."""
        own = np.unique(parts.codes[a:b])
        words, grams = [], []
        for k in np.unique(own // LOT):
            word, gram, gram_bounds, _ = lots[k]
            at = own[own // LOT == k] - k * LOT
            words.append(word[at])
            grams += [gram[gram_bounds[c] : gram_bounds[c + 1]] for c in at]
        return tuple(np.unique(np.concatenate(x)) if x else np.zeros(0, np.int32) for x in (words, grams))

    found = [occurring(a, b) for a, b in zip(parts.bounds[:-1], parts.bounds[1:], strict=True)]
    fold = np.array([zlib.crc32(t[:64].encode("utf-8", "replace")) % FOLDS for t in texts])
    by_fold = {(k, c): _counts([found[i] for i in np.flatnonzero((fold == k) & (y == c))]) for k in range(FOLDS) for c in (0, 1)}

    def odds(folds: list[int]) -> list[np.ndarray]:
        n = [int(((y == c) & np.isin(fold, folds)).sum()) for c in (1, 0)]
        sums = [[sum(by_fold[k, c][kind] for k in folds) for c in (1, 0)] for kind in (0, 1)]
        return [_odds(s[0], s[1], *n) for s in sums]

    codes, text = windows(parts)
    x = np.empty((len(codes), WINDOW, len(PAD_FEATURES)), np.float32)
    for k in range(FOLDS):
        table = word_inputs(lots, *odds([j for j in range(FOLDS) if j != k]))
        own = fold[text] == k
        x[own] = table[codes[own]]
    network, r = Network(len(PAD_FEATURES), seed=seed), np.random.default_rng(seed)
    adam = Adam(network.p)

    def logits(at: np.ndarray) -> np.ndarray:
        return np.concatenate([network.logits(*(network.gates(x[at[a : a + AT_ONCE]].transpose(1, 0, 2), d) for d in "fb")) for a in range(0, len(at), AT_ONCE)])

    toxic, clean = np.flatnonzero(y[text] == 1), np.flatnonzero(y[text] == 0)
    look = x[toxic][:, :, :2].max(1).sum(1)
    for part in range(4):
        order = np.lexsort((-look, text[toxic]))
        worst = toxic[order[np.concatenate([[True], np.diff(text[toxic][order]) > 0])]]
        # clean windows that look worst are taken as often as all others together
        pool = clean[r.permutation(len(clean))[: 8 * AT_ONCE]]
        hard = pool[np.argsort(-(logits(pool) if part else x[pool][:, :, :2].max(1).sum(1)))[: max(256, len(worst))]]
        for _ in range(steps // 4):
            at = np.concatenate([r.choice(worst, 128), r.choice(clean, 128), r.choice(hard, 128)])
            adam.step(network.gradients(x[at].transpose(1, 0, 2), y[text[at]], np.ones(len(at)))[1])
        adam.rate *= 0.6
        look = logits(toxic)
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, text, logits(np.arange(len(codes))))
    slope, shift = _calibrated(best, y)
    return Model(network, *odds(list(range(FOLDS))), slope, shift)


def _calibrated(best: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method on the log loss with both labels of equal weight, and a light penalty."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    middle, spread = best.mean(), best.std() + 1e-6
    a = np.stack([(best - middle) / spread, np.ones_like(best)], 1)
    w = np.zeros(2)
    for _ in range(25):
        p = _sigmoid(a @ w)
        w -= np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + 0.05 * np.eye(2), a.T @ (weight * (p - y)) + 0.05 * w)
    return float(max(w[0], 1e-3) / spread), float(w[1] - max(w[0], 1e-3) * middle / spread)


def learned(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out_of: int = 5) -> Model:
    """Fit on a bounded sample of labelled rows that are not held out: those whose ids have the least hashes, up to
    SAMPLE_TOXIC and SAMPLE_CLEAN, with texts of at most SAMPLE_CHARS characters. Null labels and texts are left out;
    an id with both labels counts as toxic."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("label in (0, 1) and doc_id is not null")
    known = known.filter(~held_out(F.col("doc_id"), held_out_of)).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = id_text(docs, id_col, text_col).filter(F.length("text") <= SAMPLE_CHARS)
    ids = rows.select("doc_id", F.length("text").alias("size"))
    parts = [known.filter(F.col("label") == c).join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))]
    # 4,000 ids at most: a bound that doesn't grow
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    sample = rows.join(chosen, "doc_id").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The sample has a fixed size, so one task fits the model; the driver only passes it on."""
        own = pd.concat([*batches, pd.DataFrame({"doc_id": [], "text": [], "label": []})]).sort_values("doc_id")
        yield pd.DataFrame({"model": [pickle.dumps(fit(own["text"].tolist(), own["label"].astype(int).tolist()))]})
        trim()

    made = sample.repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(made["model"]) if made else fit([], [])


def held_out(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo `of`, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == 0, F.lit(False))


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", held_out_of: int = 5) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text, from all its windows; ids and labels are no inputs.

    A null or empty text has one window of padding. Rows are independent: repeated ones get equal scores. Null ids
    are kept and not held out. An empty table gives an empty result. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size: two tables of BUCKETS and the network

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=8 << 20):
            score = sent.value.scores(text_array(batch.column(1)))
            yield pa.record_batch([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    rows = id_text(docs, id_col, text_col)
    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), held_out_of).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose text scores below `least`, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column=at, most_bytes=8 << 20):
            yield batch.filter(pa.array(sent.value.scores(text_array(batch.column(at))) < least))

    return docs.mapInArrow(run, docs.schema)
