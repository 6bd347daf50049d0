"""Derivatives from images to files and rows, and the labelling loop over several turns."""

import numpy as np
from pyspark.sql import functions as F

from sparkloom.functions import scalars
from sparkloom.operators import calls, derivatives, images, lookups
from sparkloom.sources import files

DERIVATIVE = "deriv_pk long, file_pk long, preset string, transform_cfg_id int, run_id long, out_rel string, width int, height int, fmt string, status int, error string"
IMAGE = "file_pk long, image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"


def test_encoded_images_are_read_back(spark, tmp_path):
    rng = np.random.default_rng(1)
    for c in (1, 3):
        (tmp_path / f"{c}.png").write_bytes(derivatives.png(rng.integers(0, 256, (c, 5, 7), dtype=np.uint8)))
    made = {r["nChannels"]: r for r in spark.read.format("image").load(str(tmp_path)).select("image.*").collect()}
    rng = np.random.default_rng(1)
    for c in (1, 3):
        assert (images.pixels(made[c]["data"], made[c]["height"], made[c]["width"], c) == rng.integers(0, 256, (c, 5, 7), dtype=np.uint8)).all()


def test_a_pass_of_derivatives_and_a_second_one(spark, tmp_path):
    data = bytes(range(48))
    pictures = spark.createDataFrame([(1, ("a", 4, 4, 3, 16, data)), (2, ("b", 4, 4, 3, 16, data[:5])), (3, None)], IMAGE)
    files = spark.createDataFrame([(1,), (2,), (3,), (4,)], "file_pk long")
    presets = spark.createDataFrame([("big", 8, 6), ("small", 2, 2)], "preset string, width int, height int")
    old = spark.createDataFrame([(9, 1, "small", 0, 1, "x", 2, 2, "png", 2, "boom"), (4, 4, "big", 0, 1, "x", 8, 6, "png", 1, None)], DERIVATIVE)
    once = derivatives.derived(old, files, pictures, presets, str(tmp_path))
    rows = {(r["file_pk"], r["preset"]): r for r in once.collect()}
    assert {k: r["status"] for k, r in rows.items()} == {(1, "big"): 1, (1, "small"): 1, (2, "big"): 2, (2, "small"): 2, (3, "big"): 2, (3, "small"): 2, (4, "big"): 1, (4, "small"): 2}
    assert rows[1, "small"]["deriv_pk"] == 9 and rows[1, "small"]["error"] is None and rows[3, "big"]["error"] == "ValueError: no image"
    assert sorted(r["deriv_pk"] for r in rows.values()) == [4, 9, 10, 11, 12, 13, 14, 15]
    shapes = {(r["width"], r["height"]) for r in spark.read.format("image").load(f"{tmp_path}/*/1.png").select("image.*").collect()}
    assert shapes == {(8, 6), (2, 2)}
    again = {(r["file_pk"], r["preset"]): r["deriv_pk"] for r in derivatives.derived(once, files, pictures, presets, str(tmp_path)).collect()}
    assert again == {k: r["deriv_pk"] for k, r in rows.items()}
    assert derivatives.derived(old.limit(0), files.limit(0), pictures, presets, str(tmp_path)).count() == 0


def test_paths_that_are_no_text(spark):
    rows = spark.createDataFrame([(bytearray(b"a/\xc3\xa9"),), (bytearray(b"\xff"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(scalars.path_text(F.col("b"))).collect()] == ["a/é", None, None]


def test_the_labelling_loop_ends_when_nothing_can_be_claimed(spark):
    q = spark.createDataFrame([(i, f"p{i}", "pending", 0, None, None) for i in range(5)], "file_pk long, path string, status string, attempt int, next_run_at timestamp_ntz, last_error string")
    hours = iter(range(24))

    def now():
        return F.lit(f"2024-01-01 {next(hours):02d}:00:00").cast("timestamp_ntz")

    def call(paths):
        return ['{"labels":[1]}' if p != "p3" else "what" for p in paths]

    tasks, done = calls.dispatched_until_done(q, now, 2, call, [], attempts=2, base=1, factor=2, most=9)
    made = {r["file_pk"]: r for r in tasks.collect()}
    assert {k: r["status"] for k, r in made.items()} == {0: "done", 1: "done", 2: "done", 3: "error", 4: "done"}
    assert made[3]["attempt"] == 2 and "labels must be" in made[3]["last_error"]
    assert sorted(r["file_pk"] for r in done.collect()) == [0, 1, 2, 4]
    none, nothing = calls.dispatched_until_done(q.filter("false"), now, 2, call, [], attempts=2, base=1, factor=2, most=9)
    assert none.count() == nothing.count() == 0


def test_url_columns(spark, tmp_path):
    cases = {
        "named": ('n, Link ,x\n1,http://a,2\n2,"http://b?q=""1"",2",3\n3\n\n4,#no,5\n5, Link ,x\n', ["http://a", 'http://b?q="1",2', "Link"]),
        "bare": ("http://a,1\nhttp://a,1\nhttp://b\n", ["http://a", "http://a", "http://b"]),
        "headed": ("place,n\nhttp://a,1\nplace,n\n", ["http://a", "place"]),
        "empty": ("", []),
    }
    for name, (text, told) in cases.items():
        (tmp_path / name).write_text(text)
        assert sorted(r["url"] for r in files.url_table(spark, str(tmp_path / name)).collect()) == sorted(told), name


def test_targets_of_odd_names(spark):
    rows = spark.createDataFrame([(k, r, None) for k, r in enumerate(["a/.b", "a/.b", "a.tar.gz", "c", "c"])], "n long, rel string, hint string")
    made = {r["n"]: r["target"] for r in lookups.free_targets(rows, rows.filter("n = 2"), "n").collect()}
    assert made[0] == "a/.b" and made[1].startswith("a/.b__") and made[2].startswith("a.tar__") and made[2].endswith(".gz") and made[3] == "c" and len(made[4]) == 13
