"""From documents to packed training sequences: each stage takes all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import jaccard, packing, pii, toxicity
from sparkloom.llm.common import stored, table
from sparkloom.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on labelled rows of the input and drop the documents whose text is scored as toxic."""
    return toxicity.without_toxic(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by their word shingles, keep the one with the smallest id."""
    return jaccard.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of personal data in the place of the data."""
    return pii.without_personal_data(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all texts, packed into sequences; a row for each piece."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack),
]

#: A learned score decides in the first stage; SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each to what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs, f"pipeline-{name}") if k < len(STAGES) - 1 else docs
    return docs
