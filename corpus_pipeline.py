"""A training-corpus pipeline over the table ``documents``, in five stages.

Each stage takes the documents its predecessor kept and applies one operator of ``gaugeworks.llm``
to all of them. All but the last return the columns of ``documents``; the last returns the places
of the remaining documents in training sequences. In between the documents are written as Parquet
in the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gaugeworks.llm import (  # noqa: E402
    best_fit_packing,
    decontamination,
    kneser_ney,
    line_dedup,
    simhash_dedup,
)
from gaugeworks.llm.common import Work, documents, ship  # noqa: E402
from gaugeworks.llm.queries import trusted_ids  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above the threshold of their language go. Nulls, empty texts and
    repeated rows: see ``kneser_ney.perplexities``."""
    ship(spark)
    return kneser_ney.keep_good(docs, trusted_ids(spark, sf_dir))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them; ``n_chars`` follows the text. Every
    document stays, if need be with an empty text; null texts become empty."""
    ship(spark)
    kept = line_dedup.clean(docs, min_docs=10)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash (shingles of four words, at most four differing bits) the
    document with the smallest id stays. Rows without an id are in no group and stay; of several
    rows with one id one stays."""
    ship(spark)
    return simhash_dedup.keep_one(docs, shingle_words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none."""
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences; a null or empty text is an end mark alone."""
    ship(spark)
    return best_fit_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: Neither the language model nor the packing can be expressed in SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = work.stage(stage(spark, docs, sf_dir), name)
    return docs
