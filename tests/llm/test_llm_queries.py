"""The registered queries give what their contracts and SQL say; the pipeline's stages do what they are for."""

import glob
import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkloom.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    told = con.sql(ORACLE_SQL[name])
    made = QUERIES[name](spark, FOLDER).select(*told.columns)
    assert plain(made.collect()) == plain(told.fetchall())


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def by_doc(made):
    out = defaultdict(list)
    for r in made.collect():
        out[r["doc_id"]].append(r)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op3_gives_the_ids_and_texts_of_the_library(spark, documents):
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    made = by_doc(QUERIES["op3_pieces"](spark, FOLDER))
    assert made.keys() == documents.keys()
    for i, d in documents.items():
        ids, (r,) = own.encode(d["text"] or ""), made[i]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids)))


def test_op4_scores_every_row(spark, documents):
    made = by_doc(QUERIES["op4_toxicity"](spark, FOLDER))
    assert made.keys() == documents.keys()
    for i, (r,) in made.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)


def test_op5_gives_the_base_spans(spark, documents):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, match):
        digits = [int(c) for c in match if c in "0123456789"]
        luhn = sum(x * (1 + i % 2) // 10 + x * (1 + i % 2) % 10 for i, x in enumerate(reversed(digits)))
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in match.split(".")), "card": 12 <= len(digits) <= 19 and luhn % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]

    made = by_doc(QUERIES["op5_pii"](spark, FOLDER))
    assert made.keys() == documents.keys()
    for i, d in documents.items():
        spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, d["text"] or "") if passes(kind, m[0]))
        told, (r,) = [f"{kind}:{a}:{b}" for a, _, b, kind in spans], made[i]
        assert r["base_sha256"] == sha(",".join(told)) and [r[f"n_{k}"] for k in patterns] == [sum(s[3] == k for s in spans) for k in patterns]
        assert set(told) <= set(r["spans"].split(",")) and r["n_added"] == len([x for x in r["spans"].split(",") if x]) - len(told)


def test_op8_counts_every_row(spark, documents):
    made = by_doc(QUERIES["op8_token_counts"](spark, FOLDER))
    assert made.keys() == documents.keys() and all((r["n_tokens"] > 0) == bool(documents[i]["text"]) for i, (r,) in made.items())


def test_op9_deals_rows_evenly(spark, documents):
    made, slots = by_doc(QUERIES["op9_sharding"](spark, FOLDER)), defaultdict(list)
    assert made.keys() == documents.keys()
    for i, (r,) in made.items():
        data = (documents[i]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(40)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots[k]) for k in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_op10_holds_every_id_once(spark, documents):
    own = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made, sequences = by_doc(QUERIES["op10_packing"](spark, FOLDER)), defaultdict(list)
    assert made.keys() == documents.keys()
    for i, d in documents.items():
        ids, at = own.encode(d["text"] or "", add_special_tokens=False).ids + [2], 0
        for r in sorted(made[i], key=lambda r: r["start"]):
            piece = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece.tobytes()))
            at += r["length"]
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert at == len(ids)
    for rows in sequences.values():
        rows.sort()
        assert [a for a, _ in rows] == [0, *np.cumsum([n for _, n in rows])[:-1]] and sum(n for _, n in rows) <= 4096
    tokens = sum(n for rows in sequences.values() for _, n in rows)
    assert len(sequences) * 4096 < 1.01 * tokens + 2 * 4096


def test_the_pipeline_on_odd_and_empty_tables(spark, odd, tmp_path):
    for name, docs in (("odd", odd), ("none", odd.limit(0))):
        odd_docs = docs.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
        odd_docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    made = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {r["doc_id"] for r in made} >= {2, 3, 4, 7, 8, 9, None} and corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_the_stages_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, before, "/root/testdata/sf0.01").cache()
        if name in ("toxicity", "jaccard"):
            assert made.columns == docs.columns and 0 < made.count() < before.count()
        if name == "pii":
            assert made.columns == docs.columns and made.count() == before.count() and made.filter("text rlike '[a-z0-9.]+@[a-z0-9]+[.]'").count() == 0
        if name == "packing":
            assert made.select("doc_id").distinct().count() == before.count()
        before = made
