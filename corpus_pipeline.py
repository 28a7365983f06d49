"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Stages keep the columns of ``documents``; the last returns the pieces of the packed sequences. ``run`` returns these rows.

Defined results, in all stages: a null or empty text has no words and goes with the first stage, which asks for twenty. Null ids take part in every stage. Rows that repeat one are judged alike by the first
stage, and the second keeps one row of each text; of texts that tie there, the one with the largest id. Long texts are whole in every stage. Extra columns are carried along, whatever their names, up to the
last stage. An empty table gives empty tables and no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import exact_dedup, packing, pii, quality, simhash
from tributary.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without their lines above the limit."""
    return quality.cleaned(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest doc_id of each text."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies: five-word shingles, a similarity of 0.8."""
    return simhash.keep_one(docs, simhash.WIDE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities replaced by their kinds, disclosing terms generalised."""
    return pii.sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve, with their ids and the CRC-32 of these."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, made = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = made = materialise(stage(spark, docs, sf_dir), name, replaces=made)  # a stage's rows go once the next one's are written
    return docs
