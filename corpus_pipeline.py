"""From raw documents to packed training sequences: five stages, each writing its rows before the next one reads them.

Every stage but the last returns the columns of documents: doc_id, text, lang, source, n_chars. Rows are told apart by all their
columns, never by doc_id alone: rows without a doc_id stay unless a near duplicate with one is there, texts that share a
doc_id are documents each, and equal rows leave one at the near-duplicate stage and are counted one by one at all others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm import mixing, neardup, packing, secrets, toxicity
from sylvan.llm.work import Workspace, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. The model learns from the labelled rows of the stage's input."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, carry=COLUMNS[1:]).filter("predicted = 0").select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return neardup.representatives(docs.select(*COLUMNS))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    clean = secrets.redact(secrets.scan(docs, carry=COLUMNS[1:]))
    return clean.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document."""
    return mixing.mixture(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; repeated copies are packed one by one."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL can express neither the toxicity network nor dependent rounding nor tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"{i}-{name.replace(' ', '-')}")
    return docs
