"""Near-duplicate vectors: a navigable small-world graph for each shard, asked by every shard."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import stored
from .vectors import id_vectors, matrix

#: Vectors of a shard; below that, so many shards as give the tasks work.
SHARD_ROWS, LEAST_SHARDS, SMALL = 50_000, 8, 1024
#: Links of a node on the ground layer and above it, width of the beam while building.
GROUND, UPPER, BUILD_BEAM = 24, 12, 48
#: Queries searched together, nodes opened at once, first beam, and the beam beyond which a query scans the shard.
BATCH, OPENED, BEAM, WIDEST = 512, 4, 32, 256
#: Queries of each batch that are held against the whole shard, and what share of their neighbours must be found.
AUDITED, RECALL = 16, 0.999


def _dots(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of each row's vectors with the row's query."""
    return (vectors @ queries[:, :, None])[:, :, 0]


class SmallWorld:
    """Layers of links over unit vectors; layer 0 holds all nodes, each further one about a twelfth of the one below."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], members: list[np.ndarray]):
        self.vectors, self.links, self.members = vectors.astype(np.float32), links, members

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 5) -> SmallWorld:
        n = len(vectors)
        level = np.minimum(np.random.default_rng(seed).geometric(1 - 1 / UPPER, n) - 1, 6)
        order = np.argsort(-level, kind="stable")
        world = cls(vectors, [], [])
        layers = [order[level[order] >= k] for k in range(int(level.max(initial=0)) + 1)]
        for k in range(len(layers) - 1, -1, -1):
            world._layer(layers[k], GROUND if k == 0 else UPPER)
        return world

    def _layer(self, nodes: np.ndarray, width: int) -> None:
        """Put a layer below those there are; nodes that are in the one above come first."""
        links = np.full((len(self.vectors), width), -1, np.int32)
        first = min(len(nodes), max(64, len(self.members[0]) if self.members else 0, 2 * width))
        first = min(first, BATCH * 2)
        self.links.insert(0, links)
        self.members.insert(0, nodes)
        own = self.vectors[nodes[:first]]
        sims = own @ own.T
        np.fill_diagonal(sims, -np.inf)
        near = np.argsort(-sims, 1)[:, : min(first - 1, 2 * width)]
        if near.shape[1]:
            self._connect(nodes[:first], nodes[near], np.take_along_axis(sims, near, 1), width)
        at = first
        while at < len(nodes):
            new = nodes[at : at + min(at, BATCH)]
            ids, sims = self.search(self.vectors[new], BUILD_BEAM, inside=nodes[:at])
            own = self.vectors[new] @ self.vectors[new].T
            np.fill_diagonal(own, -np.inf)
            near = np.argsort(-own, 1)[:, : min(len(new) - 1, width)]
            ids, sims = np.concatenate([ids, new[near].astype(np.int32)], 1), np.concatenate([sims, np.take_along_axis(own, near, 1)], 1)
            sort = np.argsort(-sims, 1, kind="stable")
            self._connect(new, np.take_along_axis(ids, sort, 1), np.take_along_axis(sims, sort, 1), width)
            at += len(new)

    def _chosen(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of candidates by falling similarity, first those that are nearer to the node than to any chosen before, then the nearest others."""
        rows, count = ids.shape
        taken = np.zeros((rows, count), bool)
        vectors = self.vectors[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        open_ = np.isfinite(sims) & (ids >= 0)
        for j in range(count):
            shadowed = (between[:, j, :j] > sims[:, j, None]) & taken[:, :j]
            taken[:, j] = open_[:, j] & ~shadowed.any(1) & (taken.sum(1) < width * 2 // 3)
        rank = np.where(taken, 0, np.where(open_, 1, 2))
        pick = np.argsort(rank, 1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(open_, pick, 1), np.take_along_axis(ids, pick, 1), -1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int) -> None:
        links = self.links[0]
        for a in range(0, len(nodes), 256):
            links[nodes[a : a + 256]] = self._chosen(ids[a : a + 256], sims[a : a + 256], width)
        source, target = np.repeat(nodes, width), links[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        uniq, begin, size = np.unique(target, return_index=True, return_counts=True)
        extra = np.minimum(size, 2 * width)
        # the latest nodes stand for all that point to one of the shared targets; each of them keeps its own link to it
        cand = np.full((len(uniq), 2 * width), -1, np.int32)
        for j in range(2 * width):
            live = extra > j
            cand[live, j] = source[begin[live] + j]
        for a in range(0, len(uniq), 256):
            t = uniq[a : a + 256]
            both = np.sort(np.concatenate([links[t], cand[a : a + 256]], 1), 1)
            again = np.concatenate([np.zeros((len(t), 1), bool), both[:, 1:] == both[:, :-1]], 1) | (both == t[:, None])
            s = _dots(self.vectors[np.maximum(both, 0)], self.vectors[t])
            s[again | (both < 0)] = -np.inf
            sort = np.argsort(-s, 1, kind="stable")[:, : 3 * width]
            links[t] = self._chosen(np.take_along_axis(both, sort, 1), np.take_along_axis(s, sort, 1), width)

    def search(self, queries: np.ndarray, beam: int, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the best that a beam finds, from the top layer down to the ground (or the layer being built)."""
        queries = queries.astype(np.float32)
        start = self.members[-1][:1] if inside is None or len(self.members) > 1 else inside[:1]
        entry = np.repeat(start[None, :], len(queries), 0).astype(np.int32)
        for k in range(len(self.members) - 1, 0, -1):
            entry = self._beam(self.links[k], queries, entry, 4)[0]
        return self._beam(self.links[0], queries, entry, beam)

    def _beam(self, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        count, n = len(queries), len(self.vectors)
        beam = max(beam, entry.shape[1])
        ids = np.full((count, beam), -1, np.int32)
        sims = np.full((count, beam), -np.inf, np.float32)
        ids[:, : entry.shape[1]] = entry
        sims[:, : entry.shape[1]] = np.where(entry >= 0, _dots(self.vectors[np.maximum(entry, 0)], queries), -np.inf)
        closed = sims == -np.inf
        seen = np.zeros((count, n + 1), bool)
        np.put_along_axis(seen, np.where(entry >= 0, entry, n), True, 1)
        rows = np.arange(count)
        while rows.size:
            pick = np.argsort(closed[rows], 1, kind="stable")[:, :OPENED]  # the beam is kept by falling similarity
            near = ids[rows[:, None], pick]
            near = np.where(closed[rows[:, None], pick], -1, near)
            closed[rows[:, None], pick] = True
            near = np.where((near >= 0)[:, :, None], links[np.maximum(near, 0)], -1).reshape(len(rows), -1)
            near = np.sort(near, 1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[rows[:, None], np.where(near >= 0, near, n)] | (near < 0)] = -1
            seen[rows[:, None], np.where(near >= 0, near, n)] = True
            found = _dots(self.vectors[np.maximum(near, 0)], queries[rows])
            found[near < 0] = -np.inf
            both = np.concatenate([sims[rows], found], 1)
            sort = np.argsort(-both, 1, kind="stable")[:, :beam]
            sims[rows] = np.take_along_axis(both, sort, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], near.astype(np.int32)], 1), sort, 1)
            closed[rows] = np.take_along_axis(np.concatenate([closed[rows], found == -np.inf], 1), sort, 1)
            rows = rows[~closed[rows].all(1)]
        return ids, sims

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, **{f"links{k}": x for k, x in enumerate(self.links)}, **{f"members{k}": x for k, x in enumerate(self.members)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> SmallWorld:
        with np.load(io.BytesIO(data)) as f:
            k = sum(x.startswith("links") for x in f.files)
            return cls(f["vectors"], [f[f"links{i}"] for i in range(k)], [f[f"members{i}"] for i in range(k)])


def _united(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Give all that links join the least label among them."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            again = labels[labels]
            if (again == labels).all():
                break
            labels[:] = again


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no length overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def linked(world: SmallWorld, whole: np.ndarray, queries: np.ndarray, least: float, batch: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of all pairs found whose cosine, in doubles, is `least` or more, a batch of queries at a time.

    The beam is doubled for a batch until its audited queries have found RECALL of what a scan of the shard finds, and
    for a query until the beam holds something below `least`; beyond WIDEST, and in small shards, the query scans the
    shard. The beam that an audit asked for is the first one of the next batch.
    """
    beam = BEAM
    loose = least - 1e-4
    for first in range(0, len(queries), batch):
        own = queries[first : first + batch]
        open_ = np.arange(len(own))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        own_beam = beam
        while open_.size and own_beam <= WIDEST and len(whole) > 4 * own_beam:
            ids, sims = world.search(own[open_], own_beam)
            hit = (sims >= loose) & (ids >= 0)
            full = hit.all(1)
            # a beam full of neighbours is widened in any case
            audit = np.flatnonzero(~full)
            audit = audit[np.linspace(0, len(audit) - 1, min(AUDITED, len(audit))).astype(int)]
            true = whole @ own[open_[audit]].T >= least
            got = sum(true[ids[a][hit[a]], k].sum() for k, a in enumerate(audit))
            if got < RECALL * true.sum():
                own_beam *= 2
                beam = max(beam, own_beam)
                continue
            q, j = np.nonzero(hit & ~full[:, None])
            found.append((open_[q], ids[q, j]))
            open_ = open_[full]
            own_beam *= 2
        for a in range(0, len(open_), 64):
            q, j = np.nonzero(own[open_[a : a + 64]] @ whole.T >= loose)
            found.append((open_[a : a + 64][q], j))
        q, j = (np.concatenate(x) for x in zip(*found, strict=True))
        exact = np.concatenate([np.einsum("rd,rd->r", own[q[a : a + 65536]], whole[j[a : a + 65536]]) for a in range(0, len(q), 65536)] or [np.zeros(0)]) >= least
        yield first + q[exact], j[exact]


def near_vectors(df: DataFrame, least: float = 0.95, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row: how many others its vector has a cosine of `least` or more with, and its component.

    Equal vectors are one class that counts as many times as it has rows. Classes are dealt to shards of a fixed size;
    each has its graph, and each shard's vectors are searched in every shard's graph up to its own. A task gives back
    counts and a spanning forest of what it found, never pairs, so that large groups don't grow quadratically on the way.

    Returns vec_id, n_links, component_id (smallest vec_id reachable, itself included), kept (vec_id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Rows without an id have
    no links and no component and are kept. Rows that share an id and a vector count as rows; they share a component.
    Vectors of different width never link. An empty table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    every = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = id_vectors(df, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0))
    rows = stored(rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))), "near-rows")
    classes = stored(rows.groupBy("vector").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.first("width").alias("width")), "near-classes")
    total = classes.count()
    n_shards = 1 if total <= SMALL else max(LEAST_SHARDS, -(-total // SHARD_ROWS))

    def build(key: tuple, t: pa.Table) -> pa.Table:
        ids, copies, vectors = t["class_id"].to_numpy(), t["copies"].to_numpy(), matrix(t["vector"])
        order = np.argsort(ids, kind="stable")
        whole = unit(vectors[order])
        small = lambda x: pa.array([x], pa.int32())
        return pa.table({"shard": small(key[0].as_py()), "width": small(key[1].as_py()), "ids": [ids[order].tobytes()], "copies": [copies[order].tobytes()], "whole": [whole.tobytes()], "world": [SmallWorld.build(whole).to_bytes()]})

    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("class_id"), F.lit(n_shards)).cast("int"))
    shards = stored(dealt.groupBy("shard", "width").applyInArrow(build, "shard int, width int, ids binary, copies binary, whole binary, world binary"), "near-shards")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                same = r.shard == r.asked
                ids, asked_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.asked_ids, np.int64)
                copies, asked_copies = np.frombuffer(r.copies, np.int64), np.frombuffer(r.asked_copies, np.int64)
                whole, asked = (np.frombuffer(x).reshape(-1, r.width) for x in (r.whole, r.asked_whole))
                labels = np.arange(len(ids) + len(asked_ids))
                links, asked_links = np.zeros(len(ids), np.int64), np.zeros(len(asked_ids), np.int64)
                for q, j in linked(SmallWorld.from_bytes(r.world), whole, asked, least):
                    if same:
                        q, j = q[q != j], j[q != j]
                    np.add.at(asked_links, q, copies[j])
                    if not same:
                        np.add.at(links, j, asked_copies[q])
                    _united(labels, j, q if same else len(ids) + q)
                both = np.concatenate([ids, asked_ids])
                hung = np.flatnonzero(labels != np.arange(len(labels)))
                counted = np.concatenate([links, asked_links])
                some = np.flatnonzero(counted)
                yield pd.DataFrame({"class_id": both[some], "other": pd.array([None] * len(some), "Int64"), "links": counted[some]})
                yield pd.DataFrame({"class_id": both[hung], "other": pd.array(both[labels[hung]], "Int64"), "links": np.zeros(len(hung), np.int64)})

    own = shards.select("shard", "width", "ids", "copies", "whole", "world")
    asked = shards.select(F.col("shard").alias("asked"), "width", F.col("ids").alias("asked_ids"), F.col("copies").alias("asked_copies"), F.col("whole").alias("asked_whole"))
    # every shard is asked about every other one once: rows are shards here, not vectors
    pairs = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("asked")))).join(own, ["shard", "width"])
    found = stored(pairs.repartition(n_shards * (n_shards + 1) // 2, "shard", "asked").mapInPandas(search, "class_id long, other long, links long"), "near-found")

    parts = connected_components(found.filter("other is not null"), lambda x: stored(x, "near-parts"), src="class_id", dst="other")
    counts = found.filter("other is null").groupBy("class_id").agg(F.sum("links").alias("links"))
    known = classes.join(counts, "class_id", "left").join(parts.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = known.select("vector", F.coalesce("component", "class_id").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    key = F.transform(F.col("vector").cast("array<double>"), lambda x: x + F.lit(0.0))
    out = every.withColumn("vector", F.when(F.col("vec_id").isNotNull(), key)).join(known, "vector", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
