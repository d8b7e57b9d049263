"""A training-text pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on.  Results are
written as Parquet and reread as the next stage's documents.  Every stage works on all
rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.common import read_table
from tidewell.llm.decontaminate import drop_contaminated
from tidewell.llm.near_duplicates import drop_near_duplicates
from tidewell.llm.pii import fit_pii, redact_documents
from tidewell.llm.sentencepiece import encode_documents
from tidewell.llm.toxicity import drop_toxic, fit_toxicity
from tidewell.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the sentence model, learned from the labels, does not reject."""
    return drop_toxic(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced in their text."""
    return redact_documents(docs, fit_pii(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens and the text that these decode to."""
    made = ("doc_id", "tokens", "n_tokens", "decoded")
    return encode_documents(docs, keep=[c for c in docs.columns if c not in made])


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("tokenize", tokenize),
]

# The stages fit models and follow links; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each one's rows stored in between."""
    docs = read_table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
