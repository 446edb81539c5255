"""From raw documents to packed training sequences: language, quality, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's
`docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import copies, language_id, packing, quality
from sensorloom.llm.common import split_number, table, written
from sensorloom.llm.queries import send_by_value, vocabulary

#: A document is rejected below these: share of its main language among its words (short texts of one language may have little more
#: than an even share); quality score.
LEAST_LANGUAGE, LEAST_QUALITY = 0.3, 0.3
#: Fingerprints of distinct words within 6 bits, for `simhash`.
NEAR = {"shingle": 1, "distinct": True, "max_distance": 6, "blocks": 9}
#: Near-duplicates: five-word shingles similar by 80 hundredths. Candidates are texts of which one of four fingerprints of distinct words is within 5 bits.
SIMILAR = {"shingle": 5, "percent": 80, "many": 4, "max_distance": 5, "blocks": 8}


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language or mostly mixed. An empty table and rows of null text give no rows."""
    model = language_id.fit(docs, split_number("doc_id", 4) != 2)
    return language_id.annotate(docs, model).where((F.col("__lang_pred") != "und") & (F.col("__lang_score") >= LEAST_LANGUAGE)).drop(
        "__lang_pred", "__lang_score", "__n_words")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of low quality."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.training_rows())
    return quality.annotate(docs, model).where(F.col("__quality_score") >= LEAST_QUALITY).drop("__quality_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, linked by pairs of confirmed similarity."""
    return copies.keep_one(docs, **SIMILAR)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates), ("packing", pack),
]

#: No stage can be expressed in SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    send_by_value()
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
