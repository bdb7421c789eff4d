"""From raw documents to token ids.

``STAGES`` are applied in order; each gets the documents its predecessor
kept, written as Parquet and read again.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm import bpe, decontamination, language_id, line_dedup, near_dedup
from driftwood.llm.components import discard, stored
from driftwood.llm.queries import RANKS, held_out
from driftwood.session import read_test_table

# No stage but the fourth can be said in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected."""
    learned = language_id.learn(docs, ~held_out() & F.col("doc_id").isNotNull(), F.col("doc_id"))
    return language_id.identify(docs, learned).where(~F.col("rejected")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those of which
    nothing is left go."""
    out = line_dedup.dedup_lines(docs).where("n_removed = 0 or text rlike '[^ \\t\\r\\n]'")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.drop_contaminated(docs, read_test_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document, with digests of the ids and of what they decode to."""
    return bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = read_test_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(*before)                     # what the stage has read is no longer needed
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
