"""Regions and tables from runs of blocks: the same as from all pairs, without making them."""

import math
import random

import pytest

from sparkloom.operators import layout
from sparkloom.operators.keeping import kept
from sparkloom.plans import queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page long, block long, x double, y double, w double, h double"


def expected(rows, row_tolerance, column_tolerance):
    """(page, block): region, of all pairs of a page; None as column tolerance: in a row alone."""
    below = lambda a, b: not (math.isnan(a) or a >= b)
    known = lambda *v: None not in v
    up = {}

    def root(n):
        while up.setdefault(n, n) != n:
            n = up[n]
        return n

    linked = set()
    for p, a, xa, ya, wa, ha in rows:
        side = max((v for v in (wa, ha) if v is not None), default=None)
        for q, b, xb, yb, _, _ in rows:
            if not known(p, q, a, b) or p != q or a >= b:
                continue
            link = known(ya, yb) and below(abs(yb - ya), row_tolerance)
            if column_tolerance is not None:
                link = link or (known(xa, xb) and below(abs(xb - xa), column_tolerance))
                link = link or (known(xa, xb, ya, yb, side) and below(math.sqrt((xb - xa) ** 2 + (yb - ya) ** 2), 2 * side))
            if link:
                linked |= {(p, a), (p, b)}
                low, high = sorted((root((p, a)), root((p, b))))
                up[high] = low
    return {n: root(n)[1] for n in linked}


def odd_blocks(seed):
    """Sparse and dense pages, negative ids, ids on several rows, unknown and boundless places, sizes from none to huge."""
    r = random.Random(seed)
    place = lambda wide: r.choice([None, math.nan, math.inf, -math.inf]) if r.random() < 0.06 else r.choice([float(r.randint(-wide, wide)), r.uniform(-wide, wide)])
    rows = []
    for page in (-3, 0, 1, 2, 3, 4, 5, 6):
        wide = r.choice([60, 300, 900, 3000])
        for _ in range(r.randint(1, 28)):
            size = lambda: r.choice([None, 0.0, -4.0, 7.0, 30.0, 30.0, float(wide) if r.random() < 0.2 else 12.0])
            rows.append((page, r.randint(-20, 400), place(wide), place(wide), size(), size()))
        rows.append((page, rows[-1][1], place(wide), place(wide), 5.0, 5.0))
    return rows + [(None, 1, 0.0, 0.0, 9.0, 9.0), (0, None, 0.0, 0.0, 9.0, 9.0), (None, 2, 0.0, 0.0, 9.0, 9.0)]


@pytest.mark.parametrize("seed", range(4))
def test_regions_are_those_of_all_pairs(spark, seed):
    rows = odd_blocks(seed)
    blocks = spark.createDataFrame(rows, SCHEMA)
    for column_tolerance in (50.0, None):
        made = layout.block_regions(blocks, 20.0, column_tolerance, kept).collect()
        told = expected(rows, 20.0, column_tolerance)
        assert len(made) == len(told) and {(r["page"], r["block"]): r["region"] for r in made} == told


def test_near_blocks_join_what_no_run_joins(spark):
    steps = [(1, k, 55.0 * k, 25.0 * k, 31.0, 5.0) for k in range(30)]  # each in a row and a column of its own, 60.4 apart
    short = [(2, k, 55.0 * k, 25.0 * k, 30.0, 5.0) for k in range(30)]
    late = [(3, 1, 0.0, 0.0, 5.0, 5.0), (3, 2, 55.0, 25.0, 90.0, 90.0)]  # the sizes of the first block count, not the second's
    made = layout.block_regions(spark.createDataFrame(steps + short + late, SCHEMA), 20.0, 50.0, kept).collect()
    assert {(r["page"], r["block"], r["region"]) for r in made} == {(1, k, 0) for k in range(30)}


def test_tables_are_those_of_all_pairs(spark):
    rows = [r for seed in range(3) for r in odd_blocks(seed) if r[2] is not None and r[3] is not None and math.isfinite(r[3]) and r[1] is not None and r[1] >= 0 and r[0] is not None and r[0] >= 0]
    rows = list({r[:2]: r for r in rows}.values())
    blocks = spark.createDataFrame(rows, SCHEMA)
    told = layout.tables(blocks, layout.block_relations(blocks, 20.0, 50.0), 20.0, kept).collect()
    made = layout.tables(blocks, None, 20.0, kept).collect()
    assert told and sorted(made) == sorted(told)


def test_empty_blocks(spark):
    blocks = spark.createDataFrame([], SCHEMA)
    assert layout.block_regions(blocks, 20.0, 50.0, kept).count() == 0
    assert layout.tables(blocks, None, 20.0, kept).count() == 0


@pytest.mark.parametrize("name", ["layout_regions", "layout_tables"])
def test_no_step_has_more_rows_than_blocks(spark, monkeypatch, name):
    sizes = []

    def counted(df):
        out = kept(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(queries, "kept", counted)
    queries.QUERIES[name](spark, FOLDER).count()
    assert sizes and max(sizes) <= spark.read.parquet(f"{FOLDER}/events.parquet").count()
