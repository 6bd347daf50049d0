"""Jaccard join of word shingles: signature trees over groups that share a shingle, walked in pairs of nodes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import discarded, id_text, partitions, stored
from .segments import slices, text_array, trim
from .shingles import mixed, shingle_sets

#: Share of all hashes whose shingles are compared across documents at first.
SHARE = 0.3
#: Bytes of such shingles that one task takes.
BUCKET_BYTES = 24 << 20
#: Permutations; sets group by the least hash under each, before the exact step.
ROUNDS = 3
#: Documents of a leaf; of a group that one task takes, in the rounds of least hashes and in the exact one.
LEAF, LEAST_BLOCK, BLOCK = 32, 500, 2000
#: Rows of ids and keys up to which a table is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 300_000
#: Bytes of text that are taken at once.
SLICE = 8 << 20
#: Bits of a signature at most.
WIDEST = 1 << 14


def _salted(tokens: np.ndarray, k: int) -> np.ndarray:
    return mixed(tokens ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


class SignatureTree:
    """Documents in leaves of up to LEAF; a node has the OR of their bitmaps, the range of their sizes, and the most
    shingles of one document that share bits with others of it."""

    def __init__(self, sets: list[np.ndarray], order: np.ndarray, bits: int):
        self.order = order
        words = bits // 64
        self.maps = np.zeros((len(order), words), np.uint64)
        self.sizes = np.array([sets[i].size for i in order])
        for row, i in zip(self.maps, order, strict=True):
            at = sets[i] & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.shared = self.sizes - np.bitwise_count(self.maps).sum(1)
        self.begin, self.end, self.left, self.right = [], [], [], []
        self._node(0, len(order))
        spans = list(zip(self.begin, self.end, strict=True))
        self.node_maps = [np.bitwise_or.reduce(self.maps[a:b], 0) for a, b in spans]
        self.least = [int(self.sizes[a:b].min()) for a, b in spans]
        self.most = [int(self.sizes[a:b].max()) for a, b in spans]
        self.node_shared = [int(self.shared[a:b].max()) for a, b in spans]

    def _node(self, a: int, b: int) -> int:
        k = len(self.begin)
        self.begin.append(a)
        self.end.append(b)
        self.left.append(-1)
        self.right.append(-1)
        if b - a > LEAF:
            self.left[k] = self._node(a, (a + b) // 2)
            self.right[k] = self._node((a + b) // 2, b)
        return k


class Links:
    """Joins what the trees find; documents that are known to be of one component are not compared again."""

    def __init__(self, sets: list[np.ndarray], parts: np.ndarray, percent: int):
        self.sets, self.percent = sets, percent
        self.ids, local = np.unique(parts, return_inverse=True)
        self.root = local.ravel().astype(np.int64).copy()  # component of each document, as a place in ids
        self.edges: list[tuple[int, int]] = []

    def _join(self, i: int, j: int) -> None:
        a, b = sorted((self.root[i], self.root[j]))
        self.edges.append((int(self.ids[a]), int(self.ids[b])))
        self.root[self.root == b] = a

    def compare(self, s: SignatureTree, t: SignatureTree) -> None:
        """Walk pairs of nodes, from the roots down. A pair is left if no two documents below it can be similar: their
        sizes are too far apart, or the bits they share, with those that stand for several shingles, are too few."""
        same = s is t
        stack = [(0, 0)]
        while stack:
            a, b = stack.pop()
            if not self._possible(s.least[a], s.most[a], t.least[b], t.most[b], s.node_maps[a], t.node_maps[b], min(s.node_shared[a], t.node_shared[b])):
                continue
            below = np.concatenate([self.root[s.order[s.begin[a] : s.end[a]]], self.root[t.order[t.begin[b] : t.end[b]]]])
            if (below == below[0]).all():
                continue
            if s.left[a] < 0 and t.left[b] < 0:
                self._leaves(s, t, a, b)
            elif same and a == b:
                stack += [(s.left[a], s.right[a]), (s.right[a], s.right[a]), (s.left[a], s.left[a])]
            elif t.left[b] < 0 or (s.left[a] >= 0 and s.end[a] - s.begin[a] >= t.end[b] - t.begin[b]):
                stack += [(s.right[a], b), (s.left[a], b)]
            else:
                stack += [(a, t.right[b]), (a, t.left[b])]

    def _possible(self, s_least: int, s_most: int, t_least: int, t_most: int, s_map: np.ndarray, t_map: np.ndarray, shared: int) -> bool:
        if 100 * s_most < self.percent * t_least or 100 * t_most < self.percent * s_least:
            return False
        overlap = min(int(np.bitwise_count(s_map & t_map).sum()) + shared, s_most, t_most)
        return (100 + self.percent) * overlap >= self.percent * (s_least + t_least)

    def _leaves(self, s: SignatureTree, t: SignatureTree, a: int, b: int) -> None:
        x, y = slice(s.begin[a], s.end[a]), slice(t.begin[b], t.end[b])
        overlap = np.bitwise_count(s.maps[x][:, None, :] & t.maps[y][None, :, :]).sum(2, dtype=np.int64) + np.minimum(s.shared[x][:, None], t.shared[y])
        n, m = s.sizes[x][:, None], t.sizes[y]
        overlap = np.minimum(overlap, np.minimum(n, m))
        good = (100 + self.percent) * overlap >= self.percent * (n + m)
        for i, j in zip(*np.nonzero(good), strict=True):
            p, q = s.order[s.begin[a] + i], t.order[t.begin[b] + j]
            if self.root[p] != self.root[q]:
                common = np.intersect1d(self.sets[p], self.sets[q], assume_unique=True).size
                if 100 * common >= self.percent * (self.sets[p].size + self.sets[q].size - common):
                    self._join(p, q)


def tree_links(sets: list[np.ndarray], parts: np.ndarray, sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of components that some link of two documents joins. sides: 0 or 1 where only pairs across are asked for,
    all 2 where all pairs are."""
    links = Links(sets, parts, percent)
    largest = max(s.size for s in sets)
    bits = 64
    while bits < min(4 * largest, WIDEST):
        bits *= 2
    # documents with the same least hashes stand close together, so that nodes hold similar ones
    look = np.array([_salted(s, 101).min() for s in sets], np.uint64)
    sizes = np.array([s.size for s in sets])
    trees = []
    for side in np.unique(sides):
        own = np.flatnonzero(sides == side)
        trees.append(SignatureTree(sets, own[np.lexsort((sizes[own], look[own]))], bits))
    if len(trees) == 1:
        links.compare(trees[0], trees[0])
    else:
        links.compare(trees[0], trees[1])
    return links.edges


LIMIT = np.uint64(int(SHARE * (1 << 64)))


def _key(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set; 0 stands for no set at all."""
    a, b = (int(_salted(s, k).sum(dtype=np.uint64)) for k in (50, 51))
    return (a or 1) - (1 << 64) * ((a or 1) >> 63), b - (1 << 64) * (b >> 63)


def _read(docs: DataFrame, width: int) -> DataFrame:
    """One pass over all texts. A row for each document: doc_id, n_shingles, two hashes of the set (key, key2) and
    shared_part, how many of its shingles are within SHARE. A row for each slice of texts, where `slice` is not null: its
    distinct sets (keys), its distinct shingles within SHARE in order (tokens), for each the place of the set that holds it
    from 1 on, or 0 if several do (holders), and how many of each set's shingles several of the slice hold (known)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE):
            sets = shingle_sets(text_array(batch.column(1)), width)
            keys = np.array([_key(s) for s in sets], np.int64).reshape(-1, 2)
            within = [int(np.searchsorted(s, LIMIT)) for s in sets]
            numbers = [pa.array([s.size for s in sets], pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(within, pa.int64())]
            yield pa.record_batch([batch.column(0), *numbers, pa.nulls(len(sets), pa.int64()), *[pa.nulls(len(sets), pa.binary())] * 4], names=names)
            own = {k: s[:n] for k, s, n in zip(keys[:, 0].tolist(), sets, within, strict=True) if n}
            if own:
                number = pa.array([uuid.uuid4().int >> 65], pa.int64())  # fixed once the rows are stored
                yield pa.record_batch([pa.nulls(1, batch.schema.field(0).type), *[pa.nulls(1, pa.int64())] * 4, number, *(pa.array([x.tobytes()], pa.binary()) for x in _postings(own))], names=names)

    names = ["doc_id", "n_shingles", "key", "key2", "shared_part", "slice", "keys", "tokens", "holders", "known"]
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles long, key long, key2 long, shared_part long, slice long, keys binary, tokens binary, holders binary, known binary")


def _postings(own: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """keys, tokens, holders and known of a slice, from the shingles of its distinct sets."""
    places = np.repeat(np.arange(1, len(own) + 1, dtype=np.int32), [s.size for s in own.values()])
    tokens = np.concatenate(list(own.values()))
    order = np.argsort(tokens, kind="stable")
    tokens, places = tokens[order], places[order]
    first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    alone = first & np.concatenate([first[1:], [True]])
    known = np.bincount(places[~alone], minlength=len(own) + 1)[1:].astype(np.int32)
    return np.array(list(own), np.int64), tokens[first], np.where(alone, places, 0)[first], known


def _repeated(read: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """key and repeated: how many shingles within SHARE of a set also occur in other sets.

    Ranges of shingles are buckets; a task takes one bucket after the other. A slice sends each of its shingles once, with
    its set, so that one of a third of all documents is sent once a slice, and is told in a bit for each whether other
    sets have it. A slice knows all shingles of its sets, so each of them is counted there, in one row.
    """
    bit = "slice long, bucket int, tokens binary, holders binary, keys binary, known binary"

    def row(number: int, bucket: int, tokens: bytes = b"", holders: bytes = b"", keys: bytes = b"", known: bytes = b"") -> list:
        return [pa.array([number], pa.int64()), pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in (tokens, holders, keys, known))]

    names = [x.split()[0] for x in bit.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *parts in zip(batch.column("slice").to_pylist(), *(batch.column(c) for c in ("tokens", "holders", "keys")), strict=True):
                tokens, holders, keys = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(parts, (np.uint64, np.int32, np.int64), strict=True))
                sets = np.concatenate([[0], keys])[holders]
                bucket = (tokens.astype(np.float64) * (buckets / float(LIMIT))).astype(np.int64).clip(0, buckets - 1)
                edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = row(number, int(bucket[a]), tokens[a:b].tobytes(), sets[a:b].tobytes())
                    yield pa.record_batch([pa.array([int(bucket[a]) * tasks // buckets], pa.int32()), *own], names=["task", *names])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for number, bucket, tokens, sets in zip(*(batch.column(c).to_pylist() for c in ("slice", "bucket")), *(batch.column(c) for c in ("tokens", "holders")), strict=True):
                if bucket != now and held:
                    yield from told(now, held)
                    held = []
                now = bucket
                held.append((number, np.frombuffer(tokens.as_py(), np.uint64), np.frombuffer(sets.as_py(), np.int64)))
        if held:
            yield from told(now, held)
        trim()

    def told(bucket: int, held: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        several = _several(np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]))
        ends = np.cumsum([x[1].size for x in held]).tolist()
        for (number, own, _), end in zip(held, ends, strict=True):
            yield pa.record_batch(row(number, bucket, holders=np.packbits(several[end - own.size : end]).tobytes(), known=np.int64(own.size).tobytes()), names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at, flags = None, 0, None
        for batch in batches:
            for bucket, holders, keys, known in zip(batch.column("bucket").to_pylist(), *(batch.column(c) for c in ("holders", "keys", "known")), strict=True):
                if bucket < 0:  # the slice itself comes before the bits of its shingles
                    if head is not None:
                        yield counted(*head, flags)
                    head = tuple(np.frombuffer(x.as_py(), kind) for x, kind in ((holders, np.int32), (keys, np.int64), (known, np.int32)))
                    at, flags = 0, np.zeros(head[0].size, bool)
                else:
                    size = int(np.frombuffer(known.as_py(), np.int64)[0])
                    flags[at : at + size] = np.unpackbits(np.frombuffer(holders.as_py(), np.uint8), count=size)
                    at += size
        if head is not None:
            yield counted(*head, flags)
        trim()

    def counted(holders: np.ndarray, keys: np.ndarray, known: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
        found = known + np.bincount(holders[flags & (holders > 0)], minlength=keys.size + 1)[1:]
        return pa.record_batch([pa.array(keys), pa.array(found.astype(np.int64))], names=["key", "repeated"])

    slices_ = read.filter("slice is not null").select("slice", F.lit(-1).alias("bucket"), F.lit(b"").alias("tokens"), "holders", "keys", "known")
    posted = read.filter("slice is not null").select("slice", "tokens", "holders", "keys").mapInArrow(cut, f"task int, {bit}")
    bits = posted.repartitionById(tasks, F.col("task")).sortWithinPartitions("bucket").drop("task").mapInArrow(tell, bit)
    rows = slices_.unionByName(bits).repartition(tasks, "slice").sortWithinPartitions("slice", "bucket").mapInArrow(count, "key long, repeated long")
    # equal sets of several slices have equal counts
    return rows.groupBy("key").agg(F.max("repeated").alias("repeated"))


def _several(tokens: np.ndarray, holders: np.ndarray) -> np.ndarray:
    """For each posting of a bucket, whether more than one set has its shingle. holders: hashes of sets, 0 for several."""
    order = np.lexsort((holders, tokens))
    tokens, holders = tokens[order], holders[order]
    start = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    group = np.cumsum(start) - 1
    several = np.zeros(group[-1] + 1, bool)
    several[group[holders == 0]] = True
    several[group[~start & np.concatenate([[False], holders[1:] != holders[:-1]])]] = True
    out = np.zeros(tokens.size, bool)
    out[order] = several[group]
    return out


def _sets(docs: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """class_id, set (bytes), its size, how much of it is within SHARE, and its least hashes under ROUNDS permutations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE):
            sets = shingle_sets(text_array(batch.column(1)), width)
            keys = np.array([_key(s) for s in sets], np.int64).reshape(-1, 2)
            least = [np.array([_salted(s, k).min() if s.size else 0 for s in sets], np.uint64).view(np.int64) for k in range(ROUNDS)]
            yield pa.record_batch([batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([s.size for s in sets], pa.int64()), pa.array([int(np.searchsorted(s, LIMIT)) for s in sets], pa.int64()), *map(pa.array, least)], names=names)

    names = ["first_id", "key", "key2", "set", "n", "within", *(f"least_{k}" for k in range(ROUNDS))]
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.join(_small(chosen.select(F.col("first_id").alias("doc_id")).distinct()), "doc_id", "left_semi")
    made = rows.mapInArrow(run, f"first_id {kind}, key long, key2 long, set binary, n long, within long, " + ", ".join(f"least_{k} long" for k in range(ROUNDS)))
    made = made.join(_small(chosen.select("class_id", "first_id", "key", "key2")), ["first_id", "key", "key2"])
    return made.dropDuplicates(["class_id"]).select("class_id", "set", "n", "within", *(f"least_{k}" for k in range(ROUNDS)))


def _small(rows: DataFrame) -> DataFrame:
    """Broadcast where the rows (of a few numbers each) are few enough; they have been stored, so counting is cheap."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _merged(rows: DataFrame, keyed: DataFrame, parts: DataFrame, percent: int, *, exact: bool) -> DataFrame:
    """parts (class_id, part) after the links within groups of equal keys.

    keyed: class_id, group_key and seed. Only keys with several components are looked at, and one of those with the same
    sets. A larger group than a task takes is dealt to blocks by a hash with the seed; all pairs of blocks are compared if
    `exact`, else each block alone (groups of other permutations have other blocks, and what still lacks is left to the
    exact step).
    """
    size = BLOCK if exact else LEAST_BLOCK
    own = keyed.join(parts, "class_id")
    members = [F.bit_xor(F.xxhash64("class_id", F.lit(k))).alias(f"members_{k}") for k in (0, 1)]
    groups = own.groupBy("group_key").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("n"), *members).filter("a <> b")
    groups = groups.groupBy("n", "members_0", "members_1").agg(F.min("group_key").alias("group_key")).select("group_key", F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    dealt = own.join(groups, "group_key").withColumn("block", F.pmod(F.xxhash64("class_id", "seed"), F.col("blocks")).cast("int"))
    if exact:
        others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("x"), F.greatest(k, F.col("block")).alias("y")))
        dealt = dealt.withColumn("pair", F.explode(others))
    else:
        dealt = dealt.withColumn("pair", F.struct(F.col("block").alias("x"), F.col("block").alias("y")))
    dealt = dealt.select("class_id", "part", "group_key", "pair.x", "pair.y", F.when(F.col("pair.x") == F.col("pair.y"), 2).otherwise((F.col("block") == F.col("pair.y")).cast("int")).alias("side"))

    dealt = stored(dealt, "jaccard-dealt")

    def link(t: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in t["set"].to_pylist()]
        edges = tree_links(sets, t["part"].to_numpy(), t["side"].to_numpy(), percent)
        return pa.table({"src": pa.array([a for a, _ in edges], pa.int64()), "dst": pa.array([b for _, b in edges], pa.int64())})

    edges = rows.select("class_id", "set").join(_small(dealt), "class_id").groupBy("group_key", "x", "y").applyInArrow(link, "src long, dst long")
    edges = stored(edges, "jaccard-edges")
    discarded(dealt)
    if edges.isEmpty():
        return parts
    joined = connected_components(edges, lambda x: stored(x, "jaccard-parts"))
    return stored(parts.join(joined.withColumnRenamed("node", "part"), "part", "left").select("class_id", F.coalesce("component", "part").alias("part")), "jaccard-parts")


def _tokens(rows: DataFrame, *, within: bool) -> DataFrame:
    """class_id, part and token of all shingles, or of those within SHARE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(2).to_pylist()]
            for a in range(0, len(sets), 64):
                part = [s[: np.searchsorted(s, LIMIT)] if within else s for s in sets[a : a + 64]]
                at = pa.array(np.repeat(np.arange(a, a + len(part)), [s.size for s in part]))
                yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(part).view(np.int64))], names=["class_id", "part", "token"])
        trim()

    return rows.select("class_id", "part", "set").mapInArrow(run, "class_id long, part long, token long")


def _across(tokens: DataFrame) -> DataFrame:
    """token and often, of those that occur in several components."""
    often = tokens.groupBy("token").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("often"))
    return often.filter("a <> b").select("token", "often")


def _prefixes(rows: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """class_id and group_key of the shingles that decide.

    Two sets that link share one of the first n - ceil(percent * n / 100) + 1 shingles of each, whatever order all sets
    follow. Here, those that occur in one component alone come first (they lead to no other, but take their places),
    then the others by how often they occur, then by hash. Sets of two components that link lack few shingles of each
    other, and all they share occur in both: so a set with too many that occur in its own component alone is left out
    before, by its shingles within SHARE.
    """
    lacking = f"(n - ({percent} * n + 99) div 100)"
    own = rows.join(_small(parts), "class_id")
    some = _tokens(own, within=True)
    hits = some.join(_across(some).select("token"), "token").groupBy("class_id").agg(F.count("*").alias("hits"))
    kept = own.select("class_id", "n", "within").join(hits, "class_id", "left").filter(f"coalesce(hits, 0) >= within - {lacking}")
    kept = stored(kept.select("class_id"), "jaccard-kept")
    every = stored(_tokens(own.join(_small(kept), "class_id"), within=False), "jaccard-tokens")
    shared = every.join(_across(every), "token")
    have = shared.groupBy("class_id").agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("tokens")).join(rows.select("class_id", "n"), "class_id")
    left = F.expr(f"cast({lacking} + 1 - (n - size(tokens)) as int)")
    first = have.withColumn("left", left).filter("left > 0").select("class_id", F.explode(F.slice("tokens", 1, F.col("left"))).alias("t"))
    out = stored(first.select("class_id", F.col("t.token").alias("group_key"), F.lit(0).alias("seed")), "jaccard-prefixes")
    discarded(every, kept)
    return out


def jaccard_components(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Link documents whose sets of distinct word shingles have 100 * intersection >= percent * union.

    Returns doc_id (long), n_shingles and component_id: the smallest doc_id reachable by links, itself included.

    Shingles are compared by 64-bit hashes and sets by 128-bit hashes, never by their words. Equal sets are one class.
    First, a class is left out if more of its shingles than a linked one can lack occur in no other set: exact, and
    linear. Groups of classes with an equal least hash, under several permutations, are joined by signature trees; then
    those that share a shingle of the prefix that any linked pair must share. Only groups of several components are
    looked at, and a tree stops below nodes that are known to be of one.

    A null or empty text, or one without words, has an empty set and links with nothing. Rows with a null id have
    their n_shingles, no component, and take no part. Repeated rows are all returned; of rows that share an id but not
    the text, each has the component of its own text. An empty table gives an empty result. Other columns are ignored.
    """
    return _components(docs, percent, width, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """What jaccard_components() returns, the keys of the set, and `part`: a number of the component, also where two have
    the same smallest id."""
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    read = stored(_read(texts, width), "jaccard-read")
    known = stored(read.filter("slice is null").select("doc_id", "n_shingles", "key", "key2", "shared_part"), "jaccard-docs")
    valid = known.filter("n_shingles > 0 and doc_id is not null")
    classes = valid.groupBy("key", "key2").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("shared_part").alias("part"))
    # several classes may have one smallest id; the numbers are fixed once they are stored
    classes = stored(classes.withColumn("class_id", F.monotonically_increasing_id()), "jaccard-classes")
    load = classes.agg(F.sum("part")).first()[0] or 0
    tasks = partitions(spark)
    buckets = tasks * max(1, -(-16 * load // (tasks * BUCKET_BYTES)))
    lacking = F.expr(f"n - ({percent} * n + 99) div 100")
    chosen = classes.join(_repeated(read, buckets, tasks), "key", "left").filter(F.coalesce("repeated", F.lit(0)) >= F.col("part") - lacking)
    chosen = stored(chosen.select("class_id", "first_id", "key", "key2"), "jaccard-chosen")
    discarded(read)
    rows = stored(_sets(texts, chosen, width), "jaccard-sets")
    parts = rows.select("class_id", F.col("class_id").alias("part"))
    least = F.array(*(F.struct(F.lit(k).alias("seed"), F.xxhash64(F.lit(k), f"least_{k}").alias("group_key")) for k in range(ROUNDS)))
    parts = _merged(rows, rows.select("class_id", F.explode(least).alias("x")).select("class_id", "x.group_key", "x.seed"), parts, percent, exact=False)
    prefixes = _prefixes(rows, parts, percent)
    parts = stored(_merged(rows, prefixes, parts, percent, exact=True), "jaccard-parts")
    discarded(rows, prefixes)
    firsts = parts.join(chosen.select("class_id", "first_id"), "class_id").groupBy("part").agg(F.min("first_id").alias("least"))
    parts = parts.join(firsts, "part")
    of_class = known.join(classes.select("key", "key2", "class_id", "first_id"), ["key", "key2"], "left").join(parts, "class_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "first_id", "doc_id"))
    return of_class.select("doc_id", "n_shingles", component.alias("component_id"), "key", "key2", F.coalesce("part", "class_id").alias("part"))


def _with_keys(docs: DataFrame, width: int, text_col: str) -> DataFrame:
    """row_ (the whole row) and the keys of its set."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row_"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most_bytes=SLICE):
            keys = np.array([_key(s) for s in shingle_sets(text_array(batch.column(1)), width)], np.int64).reshape(-1, 2)
            yield pa.record_batch([batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["row_", "key", "key2"])

    return rows.mapInArrow(run, f"row_ {rows.schema['row_'].dataType.simpleString()}, key long, key2 long")


def one_of_each(docs: DataFrame, *, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that have the smallest id of their component; of rows that repeat an id, one a component.

    So only rows go whose text is equal or linked to that of a row that stays, or of the component. Rows with a null id stay.
    """
    found = stored(_components(docs, percent, width, id_col, text_col), "jaccard-result")
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    again = stored(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(id_col)), "jaccard-again")
    if again.isEmpty():
        return docs.join(gone, id_col, "left_anti").select(*docs.columns)
    once = docs.join(gone.unionByName(again).distinct(), id_col, "left_anti").select(*docs.columns)
    # an id on several rows says nothing of their texts: each row is looked up by its id and its set
    stay = found.join(again.select(F.col(id_col).alias("doc_id")), "doc_id", "left_semi").filter("component_id = doc_id").select("doc_id", "key", "key2", "part").distinct()
    rows = _with_keys(docs.join(again, id_col, "left_semi").select(*docs.columns), width, text_col)
    rows = rows.withColumn("doc_id", F.col("row_").getField(id_col).cast("long")).join(stay, ["doc_id", "key", "key2"]).dropDuplicates(["doc_id", "part"])
    return once.unionByName(rows.select(*(F.col("row_").getField(c).alias(c) for c in docs.columns)))
