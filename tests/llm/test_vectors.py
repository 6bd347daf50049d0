"""Operators on vectors and pages against brute force."""

import gzip
import hashlib
import io
import math
import os

import numpy as np
from pyspark.sql import functions as F

from sparkloom.llm import neighbours, top_k, warc
from sparkloom.llm.common import shared_dir

KIND = "vec_id long, embedding array<float>"


def vectors(spark, rows):
    clash = ["shard", "block", "n", "width", "ids", "vector", "links", "class_id", "lane", "rank"]
    table = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], KIND)
    return table.select("*", *(F.lit("clash").alias(c) for c in clash))


def test_top_k_is_that_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 300)
    monkeypatch.setattr(top_k, "LEAF_ROWS", 16)
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 8)
    r = np.random.default_rng(1)
    rows = [(i, (r.normal(size=8) * (3 if i % 9 == 0 else 0.2)).round(2)) for i in range(1000)] + [(2000 + i, np.ones(8)) for i in range(30)]
    made = sorted(tuple(x) for x in top_k.top_inner_products(vectors(spark, rows)).select("query_id", "rank", "vec_id", "score").collect())
    ids = np.array([i for i, _ in rows])
    q = np.floor(256 * np.array([v for _, v in rows]).astype(np.float32).astype(float))
    want = []
    for k in np.flatnonzero(ids % 50 == 0):
        s = q @ q[k]
        s[k] = -np.inf
        want += [(int(ids[k]), n + 1, int(ids[j]), int(s[j])) for n, j in enumerate(np.lexsort((ids, -s))[:5])]
    assert made == sorted(want)


def test_top_k_on_odd_rows(spark):
    rows = [(0, [1, 0]), (50, None), (100, [None, 1]), (150, [float("nan"), 1]), (200, []), (7, [1, 1]), (8, [1, 1]), (8, [1, 1]), (None, [9, 9]), (300, [1, 2, 3]), (9, [1e12, 0])]
    made = [tuple(x) for x in top_k.top_inner_products(vectors(spark, rows)).select("query_id", "rank", "vec_id").orderBy("query_id", "rank").collect()]
    assert made == [(0, 1, 9), (0, 2, 7), (0, 3, 8), (0, 4, 8)]
    assert top_k.top_inner_products(vectors(spark, rows).limit(0)).count() == 0


def test_top_k_scores_are_exact_whatever_their_size(spark, monkeypatch):
    monkeypatch.setattr(top_k, "SHARD_ROWS", 4)
    for scale in (500_000.0, 1e9, 1e14):
        r = np.random.default_rng(3)
        rows = [(i, (r.normal(size=3) * scale).astype(np.float32)) for i in range(20)] + [(100, [scale, 1.0, 2.0]), (50, [1.0, scale, -scale])]
        exact = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
        want = []
        for i, q in exact:
            if i % 50 == 0:
                scores = sorted((-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j) for j, v in exact if j != i)
                want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:5])]
        made = [tuple(x) for x in top_k.top_inner_products(vectors(spark, rows)).select("query_id", "rank", "vec_id", "score").collect()]
        assert sorted(made) == sorted(want)  # beyond 64 bits, scores stand at the end of their range


def test_a_known_kth_score_opens_fewer_leaves():
    r = np.random.default_rng(7)
    centres = r.normal(size=(40, 16)) * 200
    v = np.floor(centres[r.integers(0, 40, 8000)] + r.normal(size=(8000, 16)) * 20)
    ids = np.arange(8000)
    a, b = (top_k.BallTree.from_bytes(top_k.BallTree.build(ids[k::2], v[k::2]).to_bytes()) for k in (0, 1))
    first = top_k.Best(ids[:1], v[:1], 5)
    first.search(a)
    alone, told = top_k.Best(ids[:1], v[:1], 5), top_k.Best(ids[:1], v[:1], 5, kth=first.scores[:, -1])
    alone.search(b)
    plain, b.opened = b.opened, 0
    told.search(b)
    assert b.opened <= plain < len(b.left) // 2 and a.opened < (a.left < 0).sum()
    best = sorted(zip(-(v[1:] @ v[0]), ids[1:], strict=True))[:5]
    both = sorted((-int(s), int(j)) for x in (first, told) for _, j, s in zip(*x.found(), strict=True))[:5]
    assert both == [(int(s), int(j)) for s, j in best]


def linked(rows, least):
    ids = [i for i, _ in rows]
    v = np.array([x for _, x in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1)[:, None]
    close = v @ v.T >= least
    np.fill_diagonal(close, False)
    label = list(ids)
    for _ in ids:
        new = [min([label[i], *(label[j] for j in np.flatnonzero(close[i]))]) for i in range(len(ids))]
        if new == label:
            break
        label = new
    return {i: (int(close[k].sum()), label[k], label[k] == i) for k, i in enumerate(ids)}


def test_neighbours_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SMALL", 10)
    monkeypatch.setattr(neighbours, "LEAST_SHARDS", 3)
    monkeypatch.setattr(neighbours, "BEAM", 8)
    monkeypatch.setattr(neighbours, "WIDEST", 32)
    r = np.random.default_rng(2)
    base = r.normal(size=(150, 12))
    rows = [(i, base[i % 150] + r.normal(size=12) * r.choice([0, 0.1, 0.25])) for i in range(900)] + [(1000 + i, base[0] + r.normal(size=12) * 0.05) for i in range(200)]
    made = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in neighbours.near_vectors(vectors(spark, rows)).collect()}
    want = linked(rows, 0.95)
    found, true = sum(x[0] for x in made.values()), sum(x[0] for x in want.values())
    assert 0.98 * true <= found <= true
    assert sum(made[i][1] == want[i][1] for i in want) >= 0.99 * len(want)
    assert all(k == (i == c) for i, (_, c, k) in made.items())


def test_a_graph_finds_what_a_scan_finds():
    r = np.random.default_rng(4)
    v = neighbours.unit(r.normal(size=(3000, 16)))
    world = neighbours.SmallWorld.from_bytes(neighbours.SmallWorld.build(v).to_bytes())
    ids, _ = world.search(v[:300], 48)
    true = np.argsort(-(v[:300] @ v.T), 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids[:, :20], true, strict=True)]) > 0.9


def test_neighbours_on_odd_rows(spark):
    rows = [(1, [1, 0]), (2, [2, 0]), (3, [1, 0]), (3, [1, 0]), (4, None), (5, [0, 0]), (6, [None, 1]), (7, [float("inf"), 1]), (8, []), (None, [1, 0]), (9, [1, 0, 0]), (10, [-0.0, 1])]
    made = sorted((x["vec_id"] or -1, x["n_links"], x["component_id"] or -1, x["kept"]) for x in neighbours.near_vectors(vectors(spark, rows)).collect())
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10)]
    assert made == sorted([(-1, 0, -1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (3, 3, 1, False), *alone])
    assert neighbours.near_vectors(vectors(spark, rows).limit(0)).count() == 0


PAGES = [(1, "http://a/1", "x" * 2000), (2, "http://a/2", "x" * 2000), (9, "http://a/é \r\nX: y", "x" * 2000), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "n", "x" * 2000), (7, "v", "é" * 500), (8, "v", "é" * 500), (8, "v", "é" * 500), (10, "w", "z" * 3_000_000)]


def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("offset", F.lit("clash")).withColumn("payload", F.lit(1))


def test_archives_give_back_every_record(spark):
    made = sorted(tuple(r) for r in warc.archived(pages(spark)).select(F.coalesce("page_id", F.lit(-1)), "payload_bytes", "payload_digest", "record_type", F.coalesce("refers_to", F.lit(-1))).collect())
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        heads = [j for j, _, h in PAGES if (h or "").encode() == data and j is not None]
        revisit = len(data) >= 1000 and i != max(heads)
        want.append((-1 if i is None else i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(heads) if revisit else -1))
    assert made == sorted(want)
    assert warc.archived(pages(spark)).filter("record_type = 'response' and not digest_holds").count() == 0
    assert warc.archived(pages(spark).limit(0)).count() == 0


def test_an_index_reads_only_what_is_selected(spark):
    folder = f"{shared_dir(spark)}/archive"
    index = warc.write_archives(warc.with_roles(pages(spark)), folder, archive_bytes=3000)
    assert index.select("archive").distinct().count() > 1
    made = warc.read_archives(spark, folder, index.filter("page_id in (7, 8, 5)")).collect()
    assert sorted((r["page_id"], r["payload"] is None) for r in made) == [(5, False), (7, True), (8, False), (8, False)]
    for name in os.listdir(folder):
        with open(f"{folder}/{name}", "rb") as f:
            text = gzip.decompress(f.read())
        assert io.BytesIO(text).readline() == b"WARC/1.1\r\n" and b"\r\nX: y" not in text
