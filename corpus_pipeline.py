"""A training corpus from `documents`: toxic texts and copies out, personal data masked, the rest packed.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept; `run` writes each stage's rows
as Parquet in the shared folder and reads them again for the next. All stages but the last return the columns of
`docs` unchanged, the text of the PII stage and its n_chars excepted.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bvengine.llm import exact_dedup, order_minhash, packing, pii, toxicity
from bvengine.llm.common import stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below 0.5; the grammar is learned from `labels`."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, the one with the smallest doc_id; null ids come last."""
    return exact_dedup.keep_first(docs, keep_null_ids=False)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the row with the smallest doc_id; null ids come last."""
    return order_minhash.keep_first(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind; n_chars follows the text."""
    masked = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL can express neither the learned grammar nor the near duplicates; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; returns the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
