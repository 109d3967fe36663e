"""Operator 1, toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Defined cases: a text without any word, null or empty, scores ``EMPTY``; rows with a null id are scored as any other; repeated rows are
scored each; without any labelled row every text scores ``EMPTY``; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ftrl import Ftrl, Grams, Model, scored, scores_only, train, verdict
from .storage import fold, table

#: Words, bigrams and skip-grams with one word between; words backed off to their first 4, 5 and 6 bytes.
GRAMS = Grams(offsets=((0,), (0, 1), (0, 2)), prefixes=(4, 5, 6))
#: Of eleven settings the one with the least log loss over four folds of the training rows of sf0.1.
FTRL = Ftrl(alpha=1.0, l1=8.0, l2=0.1, passes=8)
EMPTY = 0.0
THRESHOLD = 0.5


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 8000) -> Model:
    """Learns only from labels outside the held-out fold."""
    return train(docs, labels.where(fold(id_col) != 0), id_col, text_col, label_col, GRAMS, FTRL, EMPTY, max_rows)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    return scored(docs, model, text_col, "score")


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that are not toxic, with the columns they came with."""
    out = scored(docs, model, text_col, "__toxicity")
    name = out.columns[-1]
    return out.where(F.col(name) < threshold).drop(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scores_only(docs, fit(docs, table(spark, sf_dir, "labels")), "doc_id", "text")
    return out.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", verdict(F.col("score"), THRESHOLD).alias("predicted"))


QUERIES = {"op1_toxicity": op1_toxicity}
ORACLES: dict[str, str] = {}
