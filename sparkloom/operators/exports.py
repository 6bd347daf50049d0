"""Files for other tools: graphs as GraphML, evaluation as Markdown, predictions as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _escaped(x: Column) -> Column:
    for raw, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(raw), F.lit(mark))
    return x


def graphml(nodes: DataFrame, edges: DataFrame, *, directed: bool = True) -> DataFrame:
    """Lines of a GraphML document with their order: nodes (id, kind), edges (src, dst, relation, weight)."""
    q = lambda c: _escaped(F.coalesce(F.col(c).cast("string"), F.lit("")))
    head = [
        '<?xml version="1.0" encoding="UTF-8"?>', '<graphml xmlns="http://graphml.graphdrawing.org/xmlns">', '<key id="kind" for="node" attr.name="kind" attr.type="string"/>',
        '<key id="relation" for="edge" attr.name="relation" attr.type="string"/>', '<key id="weight" for="edge" attr.name="weight" attr.type="double"/>', f'<graph edgedefault="{"directed" if directed else "undirected"}">',
    ]
    spark = nodes.sparkSession
    top = spark.createDataFrame([(0, f"{i:02d}", x) for i, x in enumerate(head)] + [(3, "", "</graph></graphml>")], "part int, sort string, line string")
    n = nodes.select(F.lit(1).alias("part"), F.col("id").cast("string").alias("sort"), F.concat(F.lit('<node id="'), q("id"), F.lit('"><data key="kind">'), q("kind"), F.lit("</data></node>")).alias("line"))
    e = edges.select(
        F.lit(2).alias("part"), F.concat_ws(" ", "src", "dst").alias("sort"),
        F.concat(F.lit('<edge source="'), q("src"), F.lit('" target="'), q("dst"), F.lit('"><data key="relation">'), q("relation"), F.lit('</data><data key="weight">'), q("weight"), F.lit("</data></edge>")).alias("line"),
    )
    return top.unionByName(n).unionByName(e)


def evaluation_report(title: str, totals: DataFrame, labels: DataFrame) -> str:
    """Markdown of one row of measures and a table of labels (a vocabulary: short)."""
    row = totals.first().asDict()
    lines = [f"# {title}", "", "| measure | value |", "| - | - |", *(f"| {k} | {v:.4f} |" for k, v in row.items()), "", "| label | precision | recall | f1 | support |", "| - | - | - | - | - |"]
    lines += [f"| {r['label']} | {r['precision']:.4f} | {r['recall']:.4f} | {r['f1']:.4f} | {r['support']} |" for r in labels.orderBy("label").toLocalIterator()]
    return "\n".join(lines) + "\n"


def write_predictions(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
