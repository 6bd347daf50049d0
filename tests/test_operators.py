"""Small cases with known results."""

import io
import tarfile
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import scalars as S
from sparkloom.operators import catalog, entities, exports, graph, images, labels, layout, measures, near, tasks, texts
from sparkloom.plans import stages, training
from sparkloom.operators.keeping import kept
from sparkloom.sources import files


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("a", "b", "d"), [("0", "f", 4), ("00", "ff", 8), ("0" * 16, "f" * 16, 64), ("0" * 16, "1" + "0" * 15, 1), ("zzzz", "0000", 16)])
def test_hex_hamming(spark, a, b, d):
    assert one(spark, S.hex_hamming(F.col("a"), F.col("b")), a=a, b=b) == d


def test_chunks(spark):
    rows = spark.createDataFrame([(1, "x" * 500), (2, ""), (3, None), (4, "short")], "file_pk long, text string")
    made = [tuple(r) for r in texts.chunks(rows, 200, 50).orderBy("file_pk", "chunk_id").select("file_pk", "char_start", "char_end").collect()]
    assert made == [(1, 0, 200), (1, 150, 350), (1, 300, 500), (4, 0, 5)]
    with pytest.raises(ValueError, match="overlap"):
        texts.chunks(rows, 10, 10)


def test_percentiles_and_medians(spark):
    rows = spark.range(1, 101).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("v"))
    assert tuple(measures.percentiles(rows, ["k"], "v", [50, 95, 99, 100]).first())[1:] == (50.0, 95.0, 99.0, 100.0)
    three = spark.createDataFrame([(1, 10.0), (1, 20.0), (1, 30.0)], "k int, v double")
    assert measures.upper_median(three, ["k"], "v").first()["upper_median"] == 20.0


def test_rates(spark):
    fills = spark.createDataFrame([(5, 10), (8, 10), (1, 0)], "actual int, size int")
    assert measures.batch_efficiency(fills).first()[0] == 65.0 and measures.batch_efficiency(fills.limit(0)).first()[0] == 0.0
    made = spark.createDataFrame([("a", 100, 10.0), ("b", 0, 3.0), ("c", 30, 0.0)], "k string, completion_tokens long, generation_s double")
    assert {r["k"]: r["tokens_per_second"] for r in measures.token_rates(made, ["k"], wall_seconds=60).collect()} == {"a": 10.0, "b": None, "c": 0.5}


def test_histogram(spark):
    same = spark.createDataFrame([(100.0,)] * 3, "v double")
    assert [(r["bin"], r["low"], r["n"]) for r in measures.histogram(same, "v", 5).collect()] == [(0, 100.0, 3)]
    five = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5)], "v double")
    made = measures.histogram(five, "v", 5).collect()
    assert len(made) == 5 and sum(r["n"] for r in made) == 5
    assert measures.histogram(same.limit(0), "v", 5).count() == 0


def test_replies(spark):
    raw = ['{"subject":"a","summary":"s","entities":["x"],"tags":["t"]}', '```json\n{"subject":"b"}\n```', "nonsense", "", '{"tags":[]}']
    rows = spark.createDataFrame(list(enumerate(raw)), "i int, raw string").select("i", texts.parsed_reply(F.col("raw")).alias("p")).orderBy("i").collect()
    assert tuple(rows[0]["p"]) == ("a", "s", "t", '["x"]', '["t"]')
    assert tuple(rows[1]["p"]) == ("b", None, None, None, None)
    assert all(v is None for r in (rows[2], rows[3]) for v in r["p"])
    assert rows[4]["p"]["tags_json"] == "[]" and rows[4]["p"]["doc_type"] is None


def test_label_payloads(spark):
    raw = ['{"labels":[3,1,1]}', '{"labels":["x"]}', "{}", '{"labels":[]}', '{"labels":[7]}']
    made = [r["p"] for r in spark.createDataFrame(list(enumerate(raw)), "i int, raw string").orderBy("i").select(labels.checked_labels(F.col("raw"), [7]).alias("p")).collect()]
    assert made[0]["labels"] == [1, 3] and made[3]["labels"] == []
    assert made[1]["error"] and made[2]["error"] and made[4]["error"] == "uncertain_label_ids=[7]"


def test_stride_sampling(spark):
    rows = spark.range(1, 41).select(F.col("id").alias("file_pk"))
    assert [r[0] for r in tasks.sampled(rows, "file_pk", 10).select("file_pk").orderBy("file_pk").collect()] == [10, 20, 30, 40]
    with pytest.raises(ValueError, match="pool"):
        tasks.sampled(rows, "file_pk", 0)


def test_claim_and_results(spark):
    q = spark.createDataFrame([(1, "b", "pending", 0, None), (2, "a", "pending", 1, None), (3, "c", "done", 1, None)], "file_pk long, path string, status string, attempt int, next_run_at timestamp_ntz")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    claims = tasks.claimed(q, now, 5)
    assert [tuple(r) for r in claims.collect()] == [(2, "a", 2), (1, "b", 1)]
    assert tasks.claimed(q, now, 0).count() == 0
    busy = tasks.after_claim(q, claims)
    done = spark.createDataFrame([(1, False, "e"), (2, False, "e")], "file_pk long, ok boolean, error string").withColumn("finished_at", now)
    after = {r["file_pk"]: r for r in tasks.after_results(busy, done, attempts=2, base=1, factor=2, most=9).collect()}
    assert (after[1]["status"], after[2]["status"], after[3]["status"]) == ("pending", "error", "done")
    assert after[1]["next_run_us"] and after[2]["next_run_us"] is None


def test_near_duplicates_are_not_transitive(spark):
    rows = spark.createDataFrame([(1, 0b0), (2, 0b1111), (3, 0b11111111), (4, 0b0)], "file_pk long, hash long")
    made = {r["file_pk"]: r["dupe_of"] for r in near.marked_near(rows, 4).collect()}
    assert made == {1: None, 2: 1, 3: 2, 4: 1}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (7, 7), (None, 1)], "src long, dst long")
    made = {r["node"]: r["component"] for r in graph.connected_components(edges, kept).collect()}
    assert made == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}
    assert graph.connected_components(edges.limit(0), kept).count() == 0


def test_layout_grid(spark):
    rows = [(1, 10 * r + c, 200.0 * c, 100.0 * r, 50.0, 20.0) for r in range(2) for c in range(3)] + [(1, 99, 5000.0, 5000.0, 5.0, 5.0)]
    blocks = spark.createDataFrame(rows, "page long, block long, x double, y double, w double, h double")
    relations = layout.block_relations(blocks, 20, 20)
    assert {(r["a"], r["b"]): r["relation"] for r in relations.collect()}[(0, 1)] == "left_of"
    parts = layout.regions(relations, kept)
    assert parts.count() == 6 and parts.filter("block = 99").count() == 0
    assert layout.tables(blocks, relations, 20, kept).count() == 0  # rows are regions of their own: none has two row keys
    order = spark.createDataFrame([(1, 1, 5.0, -15.0), (1, 2, 1.0, 15.0)], "page long, block long, x double, y double")
    assert [r["block"] for r in layout.reading_order(order, 20).orderBy("place").collect()] == [2, 1]


def test_repeated_entities(spark):
    rows = spark.createDataFrame([(1, "a", 0, 0.5, "t"), (1, "a", 1, 0.2, "u"), (1, "b", 2, 0.9, "t")], "image long, entity string, pos int, confidence double, type string")
    assert {r["entity"]: r["confidence"] for r in entities.contains(rows).collect()} == {"a": 0.2, "b": 0.9}
    assert {(r["a"], r["b"]): r["weight"] for r in entities.co_occurrences(rows).collect()} == {("a", "a"): 1, ("a", "b"): 2}
    assert {r["entity"]: (r["type"], r["confidence"]) for r in entities.entity_nodes(rows).collect()} == {"a": ("t", 0.5), "b": ("t", 0.9)}


def test_graphml_is_xml(spark):
    import xml.etree.ElementTree as ET

    nodes = spark.createDataFrame([("a<b>", "image"), ('"q"&', "entity")], "id string, kind string")
    edges = spark.createDataFrame([("a<b>", '"q"&', "contains", 1.0)], "src string, dst string, relation string, weight double")
    text = "\n".join(r["line"] for r in exports.graphml(nodes, edges).orderBy("part", "sort").collect())
    found = ET.fromstring(text)
    assert [n.attrib["id"] for n in found.iter() if n.tag.endswith("node")] == ['"q"&', "a<b>"]


def test_report(spark):
    pairs = spark.createDataFrame([(1, "cat", True, True), (1, "dog", False, True)], "sample int, label string, truth boolean, predicted boolean")
    text = exports.evaluation_report("Run", labels.multilabel(pairs), labels.per_label(pairs))
    assert "| cat | 1.0000 | 1.0000 | 1.0000 | 1 |" in text


def test_files_and_changes(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, data in (("a.jpg", b"1"), ("sub/b.PNG", b"22"), ("c.txt", b"1"), ("d.txt", b"caf\xff")):
        (tmp_path / "in" / name).write_bytes(data)
    seen = files.listing(spark, str(tmp_path / "in"))
    assert seen.count() == 4 and files.listing(spark, str(tmp_path / "in"), suffixes=[".jpg", ".png"]).count() == 2
    empty = spark.createDataFrame([], "file_pk long, path string, size long, mtime long, status int, content_hash string")
    first = catalog.merged_catalog(seen, empty)
    assert sorted(r["file_pk"] for r in first.collect()) == [1, 2, 3, 4]
    hashed = files.digests(spark, str(tmp_path / "in")).withColumn("file_pk", F.xxhash64("path"))
    assert tuple(catalog.duplicate_totals(catalog.exact_duplicates(hashed)).first()) == (4, 3, 1)
    old = first.withColumn("size", F.when(F.col("path").endswith("a.jpg"), 9).otherwise(F.col("size"))).withColumn("status", F.lit(1)).withColumn("content_hash", F.lit("h"))
    again = {r["path"][-5:]: r for r in catalog.merged_catalog(seen, old).collect()}
    assert again["a.jpg"]["status"] == 0 and again["a.jpg"]["content_hash"] is None and again["c.txt"]["content_hash"] == "h"
    assert {r["stem"]: r["text"] for r in files.text_files(spark, str(tmp_path / "in")).collect()}["d"] == "caf�"


def test_urls(spark, tmp_path):
    (tmp_path / "u.txt").write_text("http://a/x\n\n# no\n  http://b  \n")
    assert [r[0] for r in files.url_lines(spark, str(tmp_path / "u.txt")).collect()] == ["http://a/x", "http://b"]
    (tmp_path / "u.csv").write_text("name,Link\nx,http://a\ny,\nz,#q\n")
    assert [r[0] for r in files.url_table(spark, str(tmp_path / "u.csv")).collect()] == ["http://a"]
    (tmp_path / "v.csv").write_text("http://a,1\nhttp://b,2\n")
    assert files.url_table(spark, str(tmp_path / "v.csv")).count() == 2
    assert one(spark, S.download_name(F.col("u")), u="http://h/p/file.zip?x=1").startswith("file.zip__")
    assert one(spark, S.download_name(F.col("u")), u="http://h/").startswith("h__") and one(spark, S.download_name(F.col("u")), u="?a").startswith("download.bin__")


def test_archives(spark):
    z, t = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("in/ok.txt", "1")
        f.writestr("../bad.txt", "2")
    with tarfile.open(fileobj=t, mode="w") as f:
        info = tarfile.TarInfo("x.txt")
        info.size = 1
        f.addfile(info, io.BytesIO(b"3"))
    rows = spark.createDataFrame([("a.zip", z.getvalue()), ("b.tar", t.getvalue()), ("c.zip", b"no"), ("d.txt", b"x")], "path string, content binary")
    made = {(r["path"], r["member"]): (r["content"], bool(r["error"])) for r in files.archive_members(rows).collect()}
    assert made == {("a.zip", "in/ok.txt"): (b"1", False), ("a.zip", "../bad.txt"): (None, True), ("b.tar", "x.txt"): (b"3", False), ("c.zip", None): (None, True)}


def test_vocabulary(spark, tmp_path):
    (tmp_path / "v.json").write_text('[{"id": 2, "name": " a  b ", "description": "x"}, {"id": 1, "name": "c", "description": "y"}]')
    assert [tuple(r) for r in files.vocabulary(spark, str(tmp_path / "v.json")).collect()] == [(1, "c", "y"), (2, "a b", "x")]
    for bad in ('{"id": 0, "name": "a", "description": "x"}', '{"id": 1, "name": "a", "description": " "}', '{"id": 1, "name": "a"}'):
        (tmp_path / "w.json").write_text(f"[{bad}]")
        with pytest.raises(ValueError, match="ids"):
            files.vocabulary(spark, str(tmp_path / "w.json"))


def test_images():
    image = np.zeros((3, 64, 64), np.uint8)
    image[:, 16:48, 8:56] = 200
    assert images.grey(image).shape == (1, 64, 64) and images.resized(image, 32, 16).shape == (3, 16, 32)
    assert images.perceptual_hash(image) == images.perceptual_hash(images.resized(image, 64, 64)) and len(images.perceptual_hash(image)) == 16
    assert images.content_box(image, least_side=8, least_area=0.1, most_margin=0.4)[0] == (7, 15, 57, 49)
    lines = np.full((1, 101, 101), 255, np.uint8)
    lines[:, 10:90:8, 10:90] = 0
    assert images.skew(images.rotated(lines, 1.5))[0] == pytest.approx(-1.5)


def test_image_source(spark, tmp_path):
    import struct
    import zlib

    def png(w, h, rgb):
        part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(b"".join(b"\0" + bytes(rgb) * w for _ in range(h)))) + part(b"IEND", b"")

    (tmp_path / "a.png").write_bytes(png(40, 30, (10, 200, 30)))
    (tmp_path / "b.png").write_bytes(b"no image")
    made = {r["origin"][-5:]: r for r in images.described(spark.read.format("image").load(str(tmp_path))).collect()}
    assert (made["a.png"]["width"], made["a.png"]["height"]) == (40, 30) and made["b.png"]["error"]


def test_stage_plans():
    assert stages.picked(["train", "ingest"]) == ["ingest", "train"]
    assert stages.generations(["preprocess", "train"]) == [["preprocess", "train"]]
    assert stages.generations(stages.STAGES)[0] == ["ingest"]
    with pytest.raises(ValueError, match="unknown"):
        stages.picked(["x"])
    tries = []

    def flaky():
        tries.append(1)
        if len(tries) < 2:
            raise RuntimeError("once")
        return "ok"

    assert stages.run(["ingest", "preprocess"], {"ingest": flaky, "preprocess": lambda: 2}, retries={"ingest": 1}, done={"preprocess": 1}) == {"preprocess": 1, "ingest": "ok"}
    failed = stages.run(["label", "train"], {"label": lambda: 1 / 0, "train": lambda: "t"}, parallel=True, go_on={"label"})
    assert failed["train"] == "t" and isinstance(failed["label"], ZeroDivisionError)


def test_training(spark):
    rows = spark.createDataFrame([(i, [float(i % 3 == k) for k in range(3)], i % 3) for i in range(60)], "k long, v array<double>, y int")
    model = training.fit_one_vs_rest(rows, "v", "y")
    assert training.predicted(model, rows, "v", "k").join(rows, "k").filter("label = y").count() == 60


def test_stream_merge(spark, tmp_path):
    from sparkloom.streaming.ingest import Snapshots, merge_stream, windowed_counts

    schema = "k long, v string, ts long"
    table = Snapshots(spark, str(tmp_path / "table"), schema)
    for part in ([(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (1, "old", 0), (3, "d", 1)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        merge_stream(spark.readStream.schema(schema).json(str(tmp_path / "in")), table, ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "c", 2), (2, "b", 1), (3, "d", 1)]
    (tmp_path / "ev").mkdir()
    events = spark.readStream.schema("ts timestamp, event_type string").json(str(tmp_path / "ev"))
    query = windowed_counts(events).writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.sql("select * from w").count() == 0
