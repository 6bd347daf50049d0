import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """A table of documents with everything odd: nulls, empty and long texts, repeated rows, columns whose names operators use inside."""
    rows = [
        (0, "one two three four five six seven eight nine ten", "a"),
        (1, "one two three four five six seven eight nine ten", "a"),
        (1, "one two three four five six seven eight nine ten", "a"),
        (2, None, None),
        (3, "", "b"),
        (4, " \t\n ", "b"),
        (None, "one two three four five six seven eight nine ten", "a"),
        (5, "short text", "a"),
        (6, "short  TEXT", None),
        (7, "x" * 5000 + " " + "long word " * 3000, "a"),
        (8, "mail me at who@example.com or 4111 1111 1111 1111 🙂 10.0.0.1", "b"),
        (9, "é́ ▁ 🙂\u0000 <|startoftext|> ﬁ İ", "c"),
    ]
    clash = ["rank", "slice", "shard", "score", "key", "part", "n", "class_id", "label", "row_number_", "candidates", "base", "added", "kind", "size"]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from pyspark.sql import functions as F

    return table.select("*", *(F.lit("clash").alias(c) for c in clash))
