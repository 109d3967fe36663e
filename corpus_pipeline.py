"""The corpus pipeline: toxicity, quality rules, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents, whatever further columns those have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from placelink.llm import neardup, packing, rules, secret_scan, toxicity
from placelink.llm.bpe import default_vocabulary
from placelink.llm.storage import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labelled rows of documents; what it rejects goes."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept_only(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of five words, similarity 0.8 or more; the smallest id of a group stays."""
    return neardup.one_of_each(docs, neardup.Plan(shingle=5, percent=80))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific credentials are masked in the text; n_chars follows."""
    return secret_scan.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, default_vocabulary()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_rules),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: A trained classifier and a genetic algorithm are beyond SQL; tests/llm/test_pipeline.py holds each stage against brute force on planted and odd rows.
ORACLE_SQL: str | None = None
