"""The operators bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import host_rules, language_id, licenses, lm, media, packing, pages, periods, pieces, quality, simhash, token_spans, topk
from .common import split_number, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = table(spark, sf_dir, "documents"), split_number("doc_id", 4)
    found = language_id.predict(docs, language_id.fit(docs, rest != 2))
    return found.select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score")


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, rest = table(spark, sf_dir, "documents"), split_number("doc_id", 5)
    found = quality.predict(docs, quality.fit(docs, table(spark, sf_dir, "labels"), rest != 0))
    return found.select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op4_pack_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled("embedding", 256).alias("scaled"))
    return topk.best_scores(rows, 5, "vec_id", "scaled", F.col("vec_id") % 50 == 0)


def op6_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segment(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), 4)


def op7_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op8_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = split_number("doc_id", 7)
    found = lm.score_texts(table(spark, sf_dir, "documents"), rest != 2, vocabulary("word_bpe_49k.json"))
    return found.withColumn("held_out", ~F.col("training")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(periods.periodic_runs(periods.planted(table(spark, sf_dir, "documents"))))


def op12_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = host_rules.judged(table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.digest(token_spans.align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_language_crf, op2_quality_nbsvm, op3_license_scan, op4_pack_sum_of_squares, op5_exact_topk, op6_piece_nbest, op7_site_templates, op8_attention_lm, op9_simhash,
             op10_media_columns, op11_periodic_runs, op12_host_rules, op13_token_spans]
    return {f.__name__: f for f in found}


OP5_SQL = """
WITH e AS (
    SELECT row_number() OVER () AS row, vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM e q JOIN e c ON q.row <> c.row WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    """Only the search and the host rules can be written in SQL; the tests hold the others against brute force, round trips or held-out labels."""
    return {"op5_exact_topk": OP5_SQL, "op12_host_rules": host_rules.SQL}


def send_by_value() -> None:
    """Ship the operators' code with the tasks, so that executors need no copy of this package."""
    import importlib
    import pkgutil

    from pyspark import cloudpickle

    from .. import llm

    for found in pkgutil.iter_modules(llm.__path__):
        cloudpickle.register_pickle_by_value(importlib.import_module(f"{llm.__name__}.{found.name}"))
