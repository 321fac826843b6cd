"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir), works on all of ``docs`` and
returns a frame, which ``run`` writes as Parquet to the shared folder and reads again for the next one.
All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm import line_dedup, mixing, pieces, quality, simhash
from txlake.llm.common import bound_batches, table
from txlake.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the smallest id only."""
    return line_dedup.drop_repeated_lines(docs).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: its id, source and ids, the number of ids, and hashes of ids and decoded text."""
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    bound_batches(spark)
    both = docs.select("doc_id", "source", pieces.round_trip(F.col("text"), model).alias("r"))
    return both.select(
        "doc_id", "source", F.col("r.ids").alias("ids"), pieces.n_ids(F.col("r.ids")).alias("n_tokens"),
        F.sha2("r.ids", 256).alias("ids_sha256"), F.sha2("r.text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: The fingerprints of the third stage and the ids of the last have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
