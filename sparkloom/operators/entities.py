"""The graph of images, entities and concepts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contains(rows: DataFrame) -> DataFrame:
    """image, entity, confidence (of the last mention), n of (image, entity, pos, confidence) rows."""
    return rows.groupBy("image", "entity").agg(F.max_by("confidence", F.struct("pos", "confidence")).alias("confidence"), F.count("*").alias("n"))


def entity_nodes(rows: DataFrame) -> DataFrame:
    """entity, type (of the first mention), confidence (the largest), images."""
    return rows.groupBy("entity").agg(F.min_by("type", F.struct("image", "pos", "type")).alias("type"), F.max("confidence").alias("confidence"), F.count_distinct("image").alias("images"))


def co_occurrences(rows: DataFrame) -> DataFrame:
    """a, b, weight, first_image: ordered pairs of mentions in an image, earlier one first. An image's list is short;
    pairs are made within images only."""
    x = rows.select("image", F.col("entity").alias("a"), F.col("pos").alias("pos_a"))
    y = rows.select("image", F.col("entity").alias("b"), F.col("pos").alias("pos_b"))
    return x.join(y, "image").filter("pos_a < pos_b").groupBy("a", "b").agg(F.count("*").alias("weight"), F.min("image").alias("first_image"))


def similar_images(rows: DataFrame, image: object, *, least_shared: int = 1, top: int = 10) -> DataFrame:
    """Other images that share entities with one: image, shared, jaccard (4 digits), the most similar first."""
    sets = rows.select("image", "entity").distinct()
    own = sets.filter(F.col("image") == image).select("entity")
    sizes = sets.groupBy("image").agg(F.count("*").alias("size"))
    n = own.agg(F.count("*").alias("own"))  # one row
    shared = sets.filter(F.col("image") != image).join(own, "entity").groupBy("image").agg(F.count("*").alias("shared")).filter(F.col("shared") >= least_shared)
    scored = shared.join(sizes, "image").crossJoin(F.broadcast(n)).select("image", "shared", F.round(F.col("shared") / (F.col("size") + F.col("own") - F.col("shared")), 4).alias("jaccard"))
    return scored.orderBy(F.desc("jaccard"), "image").limit(top)


def connections(edges: DataFrame, node: object) -> DataFrame:
    """other, direction and weight (1 if there is none) of the edges at a node."""
    weight = F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight")
    out = edges.filter(F.col("a") == node).select(F.col("b").alias("other"), F.lit("out").alias("direction"), weight)
    return out.unionByName(edges.filter(F.col("b") == node).select(F.col("a").alias("other"), F.lit("in").alias("direction"), weight))


def co_occurring(edges: DataFrame, entity: object, *, least: int = 1, top: int = 20) -> DataFrame:
    return edges.filter((F.col("a") == entity) & (F.col("weight") >= least)).select(F.col("b").alias("entity"), "weight").orderBy(F.desc("weight"), "entity").limit(top)


def images_of(rows: DataFrame, entity: object) -> DataFrame:
    return rows.filter(F.col("entity") == entity).select("image").distinct()


def frequent(rows: DataFrame, top: int) -> DataFrame:
    return rows.groupBy("entity").agg(F.count_distinct("image").alias("images")).orderBy(F.desc("images"), "entity").limit(top)


def statistics(rows: DataFrame, concepts: DataFrame) -> DataFrame:
    """One row: nodes, edges, images, entities, concepts."""
    a = rows.agg(F.count_distinct("image").alias("images"), F.count_distinct("entity").alias("entities"))
    b = rows.select("image", "entity").distinct().agg(F.count("*").alias("held"))
    c = co_occurrences(rows).agg(F.count("*").alias("paired"))
    d = concepts.agg(F.count_distinct("name").alias("concepts"), F.count("parent").alias("is_a"))
    one = a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c)).crossJoin(F.broadcast(d))
    return one.select((F.col("images") + F.col("entities") + F.col("concepts")).alias("nodes"), (F.col("held") + F.col("paired") + F.col("is_a")).alias("edges"), "images", "entities", "concepts")


def instances(links: DataFrame) -> DataFrame:
    """a, b, relation 'instance_of', weight 1 of (entity, concept) links, each once: edges of the graph beside is_a."""
    return links.filter("entity is not null and concept is not null").select(F.col("entity").alias("a"), F.col("concept").alias("b")).distinct().select("a", "b", F.lit("instance_of").alias("relation"), F.lit(1.0).alias("weight"))


def hierarchy(concepts: DataFrame) -> DataFrame:
    """name, parent (the last given), children (sorted) of every concept, parents that were never added included."""
    names = concepts.select("name").union(concepts.filter("parent is not null").select(F.col("parent").alias("name"))).distinct()
    parents = concepts.filter("parent is not null").groupBy("name").agg(F.max_by("parent", "pos").alias("parent"))
    children = concepts.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.array_sort(F.collect_set("name")).alias("children"))
    return names.join(parents, "name", "left").join(children, "name", "left").select("name", "parent", F.coalesce("children", F.array().cast("array<string>")).alias("children"))
