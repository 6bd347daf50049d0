"""Layout of pages: relations of blocks, reading order, regions and tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected_components


def block_relations(blocks: DataFrame, row_tolerance: float, column_tolerance: float) -> DataFrame:
    """page, a, b, relation, weight for pairs a < b of blocks of a page.

    blocks: page, block, x, y (centre), w, h. The later rule wins: left_of / right_of for equal rows, above / below for
    equal columns, near for a distance under twice the larger side of the first block (a), weighted by 1 / max(distance, 1).
    """
    a = blocks.select("page", *(F.col(c).alias(f"{c}_a") for c in ("block", "x", "y", "w", "h")))
    b = blocks.select("page", *(F.col(c).alias(f"{c}_b") for c in ("block", "x", "y", "w", "h")))
    dx, dy, gap = _distance()
    near = gap < 2 * F.greatest("w_a", "h_a")
    row, column = F.abs(dy) < row_tolerance, F.abs(dx) < column_tolerance
    relation = F.when(near, "near").when(column, F.when(dy > 0, "above").otherwise("below")).when(row, F.when(dx > 0, "left_of").otherwise("right_of"))
    pairs = a.join(b, "page").filter("block_a < block_b").withColumn("relation", relation).filter("relation is not null")
    return pairs.select("page", F.col("block_a").alias("a"), F.col("block_b").alias("b"), "relation", F.when(near, 1 / F.greatest(gap, F.lit(1.0))).otherwise(1.0).alias("weight"), row.alias("same_row"), column.alias("same_column"))


def _distance() -> tuple[Column, Column, Column]:
    dx, dy = F.col("x_b") - F.col("x_a"), F.col("y_b") - F.col("y_a")
    return dx, dy, F.sqrt(dx * dx + dy * dy)


def reading_order(blocks: DataFrame, row_tolerance: float) -> DataFrame:
    """page, block, place: by row (y over the tolerance, cut towards zero), then x, then block."""
    w = Window.partitionBy("page").orderBy((F.col("y") / row_tolerance).cast("int"), "x", "block")
    return blocks.select("page", "block", (F.row_number().over(w) - 1).cast("int").alias("place"))


def regions(relations: DataFrame, keep: Callable[[DataFrame], DataFrame], *, rows_only: bool = False) -> DataFrame:
    """page, block, region: components of blocks that are related (in a row, if `rows_only`); single blocks are left out."""
    own = relations.filter("same_row") if rows_only else relations.filter("relation = 'near' or same_row or same_column")
    node = lambda c: F.format_string("%020d/%020d", F.col("page"), F.col(c))
    parts = connected_components(own.select(node("a").alias("src"), node("b").alias("dst")), keep)
    number = lambda c, k: F.split(c, "/")[k].cast("long")
    return parts.select(number("node", 0).alias("page"), number("node", 1).alias("block"), number("component", 1).alias("region"))


def _runs(blocks: DataFrame, place: str, tolerance: float) -> DataFrame:
    """blocks and `{place}_run`, a number within the page: sorted by `place`, a run ends where the gap to the next block is
    not below the tolerance. Blocks of a run are those that pairs below the tolerance connect. Null where `place` is not
    finite."""
    along = Window.partitionBy("page").orderBy("_at")
    own = blocks.withColumn("_at", F.when(F.abs(place) < math.inf, F.col(place)))
    own = own.withColumn("_gap", F.col("_at") - F.lag("_at").over(along))
    run = F.count(F.when(F.col("_gap") >= tolerance, 1)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return own.withColumn(f"{place}_run", F.when(F.col("_at").isNotNull(), run)).drop("_at", "_gap")


def _near_parts(open_blocks: DataFrame) -> DataFrame:
    """page, piece_a, piece_b of near blocks, from equal or neighbouring cells that are wider than any block of the page reaches."""
    width = 1.01 * F.greatest("reach", F.lit(1.0))  # the hundredth, and the bound below, keep rounded quotients within a cell
    cell = lambda c: F.floor(F.least(F.greatest(F.col(c) / width, F.lit(-(2.0**40))), F.lit(2.0**40)))
    celled = open_blocks.withColumn("cx", cell("x")).withColumn("cy", cell("y"))
    side = lambda k: celled.select("page", "cx", "cy", *(F.col(c).alias(f"{c}_{k}") for c in ("block", "piece", "x", "y", "w", "h")))
    around = side("a")
    for c in ("cx", "cy"):
        around = around.withColumn(c, F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)))
    pairs = around.join(side("b"), ["page", "cx", "cy"]).filter("block_a < block_b and piece_a <> piece_b")
    return pairs.filter(_distance()[2] < 2 * F.greatest("w_a", "h_a")).select("page", "piece_a", "piece_b").distinct()


def _labelled(blocks: DataFrame, row_tolerance: float, column_tolerance: float | None, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """page, block, y, region (the smallest block reachable), first (one row for each block), alone (no block is related) for
    every row of `blocks`, by the relations of block_relations(); by those in a row alone, if `column_tolerance` is None.

    The pairs are not made. Blocks of a run (in a row, in a column) are connected, so what is joined is runs: `part` is the
    least block of a first run, `hung` the least part of the other one, `same` the least part of the rows with that block,
    `piece` the least `hung` of the first run. Near blocks are looked for on pages with several pieces. Pages where nothing is to be joined, most as a
    rule, are not shuffled again.
    """
    page = lambda *c: Window.partitionBy("page", *c)
    over = lambda f, what, run: F.when(F.col(run).isNull(), F.col(what)).otherwise(f(what).over(page(run)))
    own = _runs(blocks.select("page", "block", "x", "y", "w", "h").filter("page is not null and block is not null"), "y", row_tolerance)
    if column_tolerance is None:
        own = own.withColumn("part", over(F.min, "block", "y_run")).withColumn("last", over(F.max, "block", "y_run")).withColumn("hung", F.col("part"))
        own = own.withColumn("several", F.lit(False))
    else:
        own = _runs(own, "x", column_tolerance).withColumn("part", over(F.min, "block", "x_run")).withColumn("last", over(F.max, "block", "x_run")).withColumn("hung", over(F.min, "part", "y_run"))
        own = own.withColumn("reach", F.max(2 * F.greatest("w", "h")).over(page())).withColumn("piece", over(F.min, "hung", "x_run"))
        own = own.withColumn("several", F.min("piece").over(page()) < F.max("piece").over(page()))
    own = own.withColumn("same", F.min("part").over(page("block"))).withColumn("last", F.max("last").over(page("block"))).withColumn("first", F.row_number().over(page("block").orderBy("part")) == 1)
    own = own.withColumn("joins", F.col("several") | F.max((F.col("part") != F.col("hung")) | (F.col("part") != F.col("same"))).over(page()))
    own = keep(own.drop("x_run", "y_run"))
    edges = own.select("page", F.col("part").alias("a"), F.explode(F.array("hung", "same")).alias("b")).filter("a <> b")
    if column_tolerance is not None:
        edges = edges.union(_near_parts(own.filter("several")))
    node = lambda c: F.struct("page", F.col(c).alias("block"))
    joined = connected_components(edges.select(node("a").alias("src"), node("b").alias("dst")), keep)
    joined = joined.select("node.page", F.col("node.block").alias("part"), F.col("component.block").alias("region"))
    done = own.filter("not joins").withColumn("region", F.lit(None).cast(own.schema["part"].dataType)).unionByName(own.filter("joins").join(joined, ["page", "part"], "left"))
    return done.select("page", "block", "y", F.coalesce("region", "part").alias("region"), "first", F.expr("region is null and last = part").alias("alone"))


def block_regions(blocks: DataFrame, row_tolerance: float, column_tolerance: float | None, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What regions() gives for the relations of `blocks`, in a row alone if `column_tolerance` is None, without all pairs."""
    return _labelled(blocks, row_tolerance, column_tolerance, keep).filter("first and not alone").select("page", "block", "region")


def tables(blocks: DataFrame, relations: DataFrame | None, row_tolerance: float, keep: Callable[[DataFrame], DataFrame], *, least_rows: int = 2, least_columns: int = 2) -> DataFrame:
    """page, region, n_blocks, n_rows of regions with at least `least_rows` rows and `least_columns` blocks. Without
    `relations`, the regions are those of blocks in a row by `row_tolerance`, and pairs are not made."""
    if relations is None:
        own = _labelled(blocks, row_tolerance, None, keep).filter("not alone")
    else:
        own = regions(relations, keep, rows_only=True).join(blocks, ["page", "block"])
    found = own.groupBy("page", "region").agg(F.count("*").alias("n_blocks"), F.count_distinct((F.col("y") / row_tolerance).cast("int")).alias("n_rows"))
    return found.filter((F.col("n_rows") >= least_rows) & (F.col("n_blocks") >= least_columns))


def summary(blocks: DataFrame, relations: DataFrame) -> DataFrame:
    """page, n_blocks, n_relations and how many of each kind."""
    kinds = ["near", "above", "below", "left_of", "right_of"]
    n = relations.groupBy("page").agg(F.count("*").alias("n_relations"), *(F.count(F.when(F.col("relation") == k, 1)).alias(f"n_{k}") for k in kinds))
    out = blocks.groupBy("page").agg(F.count("*").alias("n_blocks")).join(n, "page", "left")
    return out.select("page", "n_blocks", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_relations", *(f"n_{k}" for k in kinds))))
