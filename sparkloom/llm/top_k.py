"""Exact top-k by inner product: ball trees over shards, searched by branch and bound."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, partitions, read_file, stored, write_file
from .vectors import id_vectors, matrix

#: Vectors of a shard, of a leaf, and queries that are searched together.
SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS = 16_384, 128, 1024
#: Trees that a task holds at once.
HELD = 8
#: Exact in doubles, and in 64 bits, below these.
EXACT, WHOLE = float(1 << 53), float(1 << 63)
#: The range of a score; what lies beyond counts as its end. Below any score.
LONG, LEAST = (1 << 63) - 1, -(1 << 63)


def quantised(vectors: np.ndarray, levels: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(vectors * levels)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers that are given as doubles, exactly."""
    with np.errstate(over="ignore"):
        size = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if size < EXACT:
        return (a @ b.T).astype(np.int64)
    if size < WHOLE:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = np.frompyfunc(int, 1, 1)
    return np.clip(exact(a).dot(exact(b).T), -LONG, LONG).astype(np.int64)


class BallTree:
    """Nodes with centre and radius over vectors that are split at the median along the line between two far points."""

    FIELDS = ("begin", "end", "left", "right", "centres", "radii", "ids", "vectors")

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)
        self.opened = 0  # leaves whose vectors were multiplied

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> BallTree:
        order = np.arange(len(ids))
        begin, end, left, right = [0], [len(ids)], [-1], [-1]
        todo = [0]
        while todo:
            k = todo.pop()
            a, b = begin[k], end[k]
            if b - a <= LEAF_ROWS:  # ids rise within a leaf, so that a stable sort by score breaks ties
                order[a:b] = order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
                continue
            own = vectors[order[a:b]]
            own = own / max(1.0, np.abs(own).max())  # only the direction matters here
            far = own[np.argmax(((own - own[0]) ** 2).sum(1))]
            other = own[np.argmax(((own - far) ** 2).sum(1))]
            split = np.argsort(own @ (other - far), kind="stable")
            order[a:b] = order[a:b][split]
            left[k], right[k] = len(begin), len(begin) + 1
            for x, y in ((a, (a + b) // 2), ((a + b) // 2, b)):
                begin.append(x)
                end.append(y)
                left.append(-1)
                right.append(-1)
            todo += [left[k], right[k]]
        ids, vectors = ids[order], vectors[order]
        spans = [vectors[a:b] for a, b in zip(begin, end, strict=True)]
        with np.errstate(over="ignore", invalid="ignore"):
            centres = np.array([x.mean(0) for x in spans])
            radii = np.array([np.sqrt(((x - c) ** 2).sum(1).max()) for x, c in zip(spans, centres, strict=True)])
        whole = lambda x: np.array(x, np.int64)
        return cls(begin=whole(begin), end=whole(end), left=whole(left), right=whole(right), centres=centres, radii=radii, ids=ids, vectors=vectors)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> BallTree:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{k: held[k] for k in cls.FIELDS})

    def bound(self, node: int, queries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """What no inner product of a query with a vector below the node exceeds, with room for rounding."""
        centre, radius = self.centres[node], self.radii[node]
        with np.errstate(over="ignore", invalid="ignore"):
            found = queries @ centre + lengths * radius
            found += 1e-9 * (np.abs(found) + lengths * (np.sqrt((centre**2).sum()) + radius)) + 1e-6
        return np.where(np.isnan(found), np.inf, found)


class Best:
    """The k best of each query so far; their last score is what a node must reach to be searched at all.

    kth: what is known of it beforehand, from other shards.
    """

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, *, kth: np.ndarray | None = None):
        self.query_ids, self.queries = query_ids, queries
        self.scores = np.full((len(queries), k), LEAST, np.int64)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.least = np.full(len(queries), LEAST, np.int64) if kth is None else kth
        with np.errstate(over="ignore"):
            self.lengths = np.sqrt((queries**2).sum(1))

    def kth(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.scores[rows, -1], self.least[rows])

    def search(self, tree: BallTree) -> None:
        """From the root down, the node with the largest bound first. A node is opened for those queries alone whose kth
        score its bound reaches; where it is opened for none, all below it is left."""
        every = np.arange(len(self.queries))
        heap = []

        def push(node: int, rows: np.ndarray) -> None:
            bound = tree.bound(node, self.queries[rows], self.lengths[rows])
            good = bound >= self.kth(rows)
            if good.any():
                heapq.heappush(heap, (-float(bound[good].max()), node, rows[good], bound[good]))

        push(0, every)
        while heap:
            _, node, rows, bound = heapq.heappop(heap)
            rows = rows[bound >= self.kth(rows)]  # the kth scores may have risen since
            if not rows.size:
                continue
            if tree.left[node] < 0:
                self._leaf(tree, node, rows)
            else:
                push(tree.left[node], rows)
                push(tree.right[node], rows)

    def _leaf(self, tree: BallTree, node: int, rows: np.ndarray) -> None:
        tree.opened += 1
        ids = tree.ids[tree.begin[node] : tree.end[node]]
        scores = products(self.queries[rows], tree.vectors[tree.begin[node] : tree.end[node]])
        scores[ids[None, :] == self.query_ids[rows][:, None]] = LEAST
        better = scores.max(1) >= self.kth(rows)
        rows, scores = rows[better], scores[better]
        if not rows.size:
            return
        k = self.scores.shape[1]
        top = np.argsort(~scores, axis=1, kind="stable")[:, :k]  # ~x falls as x rises, without overflow
        scores = np.concatenate([self.scores[rows], np.take_along_axis(scores, top, 1)], 1)
        ids = np.concatenate([self.ids[rows], ids[top]], 1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        scores, ids = np.take_along_axis(scores, by_id, 1), np.take_along_axis(ids, by_id, 1)
        pick = np.argsort(~scores, axis=1, kind="stable")[:, :k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, pick, 1), np.take_along_axis(ids, pick, 1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query_id, vec_id and score of what can be among the k best."""
        good = (self.scores > LEAST) & (self.scores >= self.least[:, None])
        return np.repeat(self.query_ids, good.sum(1)), self.ids[good], self.scores[good]


def top_inner_products(df: DataFrame, k: int = 5, *, every: int = 50, levels: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by `every`: the k other rows of largest inner product, after floor(levels * x).

    Every shard's ball tree is built once and kept as a file of the shared folder; tasks are dealt numbers of trees and
    of blocks of queries, never vectors. Each block first searches one shard; the kth scores found there go to all other
    shards, and a task that takes a block through several trees raises them on the way. Trees and blocks have a fixed
    size, so memory doesn't grow with the table. Returns query_id, rank, vec_id, score.

    Scores are exact whole numbers up to 64 bits, beyond the 53 of a double too; what lies beyond counts as the largest
    or smallest long, in ranks as well. Vectors that are null, empty or hold null or non-finite components take no part, nor do those where
    levels * x is beyond a double, nor rows without an id. Ties go to the smaller vec_id. Rows that share an id are one
    row's copies: a query never finds its own id, and each copy of another id is found on its own; a query id that occurs
    more than once is asked once (its least vector). Vectors of another width than the query's are no candidates. An empty
    table gives an empty result. Other columns are ignored.
    """
    spark = df.sparkSession
    finite = F.forall("vector", lambda x: F.abs(x * float(levels)) < float("inf"))
    rows = stored(id_vectors(df, id_col, vector_col).filter(finite), "top-rows")
    n_rows = rows.count()
    n_shards = max(1, -(-n_rows // SHARD_ROWS))
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min_by("vector", F.col("vector")).alias("vector")).withColumn("width", F.size("vector"))
    n_blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    folder = new_folder(spark, "top-files")

    def packed(rows: DataFrame, count: int, name: str) -> DataFrame:
        """Rows dealt by a hash of the id to `count` files of one width each: name, width, file."""

        def pack(key: tuple, t: pa.Table) -> pa.Table:
            ids, vectors = t["vec_id"].to_numpy(), quantised(matrix(t["vector"]), levels)
            order = np.argsort(ids, kind="stable")
            if name == "shard":
                data = BallTree.build(ids[order], vectors[order]).to_bytes()
            else:
                data = ids[order].tobytes() + vectors[order].tobytes()
            small = lambda x: pa.array([x], pa.int32())
            return pa.table({name: small(key[0].as_py()), "width": small(key[1].as_py()), "file": [write_file(folder, data)], "n": small(len(ids))})

        dealt = rows.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
        return stored(dealt.groupBy(name, "width").applyInArrow(pack, f"{name} int, width int, file string, n int"), f"top-{name}s")

    shards, blocks = packed(rows, n_shards, "shard"), packed(queries, n_blocks, "block")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[str, BallTree] = {}
        for batch in batches:
            for block, width, n, file, known, files in zip(*(batch[c] for c in ("block", "width", "n", "file", "known", "files")), strict=True):
                data = read_file(folder, file)
                ids, vectors = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.float64, offset=8 * n).reshape(n, width)
                kth = None
                if known is not None and len(known):
                    by_id = {x["query_id"]: x["kth"] for x in known}
                    kth = np.array([by_id.get(i, LEAST) for i in ids.tolist()], np.int64)
                best = Best(ids, vectors, k, kth=kth)
                for name in files:
                    if name not in trees:
                        if len(trees) >= HELD:
                            trees.clear()
                        trees[name] = BallTree.from_bytes(read_file(folder, name))
                    best.search(trees[name])
                query_id, vec_id, score = best.found()
                yield pd.DataFrame({"block": np.int32(block), "width": np.int32(width), "query_id": query_id, "vec_id": vec_id, "score": score})

    kind = "block int, width int, query_id long, vec_id long, score long"
    ask = ["block", "width", "n", "file", "known", "files"]
    none = F.lit(None).cast("array<struct<query_id:long,kth:long>>")
    # each block in one shard at first
    home = shards.select("width", "shard", F.array("file").alias("files"))
    first = blocks.withColumn("known", none).withColumn("shard", F.col("block") % n_shards).join(home, ["width", "shard"])
    first = stored(first.repartition(min(n_blocks, 8 * partitions(spark)), "shard", "block").select(*ask).mapInPandas(search, kind), "top-first")
    # then, a stated set of queries against all other rows, in blocks: a row for each block and group of shards
    kth = first.groupBy("block", "width", "query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n")).filter(F.col("n") >= k)
    kth = kth.groupBy("block", "width").agg(F.collect_list(F.struct("query_id", "kth")).alias("known"))
    held = max(1, min(HELD, n_shards * n_blocks // (2 * partitions(spark)), n_shards))
    n_groups = -(-n_shards // held)
    groups = shards.groupBy((F.col("shard") % n_groups).alias("group"), "width").agg(F.array_sort(F.collect_list(F.struct("shard", F.col("file").alias("name")))).alias("own"))
    pairs = blocks.join(kth, ["block", "width"], "left").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).join(groups, ["group", "width"])
    others = F.transform(F.filter("own", lambda x: x["shard"] != F.col("block") % n_shards), lambda x: x["name"])
    pairs = pairs.withColumn("files", others).filter(F.size("files") > 0)
    tasks = min(n_blocks * n_groups, 8 * partitions(spark))
    rest = pairs.repartition(tasks, "group", F.col("block") % max(1, tasks // n_groups)).sortWithinPartitions("group", "block").select(*ask).mapInPandas(search, kind)
    hits = first.unionByName(rest) if n_shards > 1 else first
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
