"""The named queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import language_id, oracles
from isobar.llm.clustering import cluster_vectors
from isobar.llm.decontamination import contamination
from isobar.llm.exact_dedup import exact_groups
from isobar.llm.hard_negatives import hard_negatives
from isobar.llm.html_extraction import main_text
from isobar.llm.lm_scoring import pseudo_likelihood
from isobar.llm.ngram_join import near_duplicates
from isobar.llm.packing import pack
from isobar.llm.pii import pii_digest
from isobar.llm.quality import quality_scores
from isobar.llm.secret_scan import secret_digest
from isobar.llm.token_counts import token_counts
from isobar.llm.vectors import integers, usable
from isobar.sources.tables import table

Run = Callable[[SparkSession, str], DataFrame]


def _part(of: int) -> Column:
    """A document's fold: the checksum of its id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def learned_labels() -> Column:
    """Labels that the quality classifier may learn from."""
    return _part(4) != 2


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = language_id.fit(docs, _part(3) != 1)
    found = language_id.identify(docs, models)
    held_out = F.coalesce(_part(3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "cross_entropy", "rejected")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def packed(docs: DataFrame) -> DataFrame:
    """The pieces of packed sequences, their ids as a checksum."""
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learned_labels())
    held_out = F.coalesce(_part(4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(usable("embedding"))
    # Every seventh label is wrong on purpose.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select("vec_id", label.alias("label"), integers("embedding").alias("vector"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


_ALL = (
    op1_language_id,
    op2_html_extraction,
    op3_pii,
    op4_decontamination,
    op5_packing,
    op6_ngram_join,
    op7_quality,
    op8_exact_dedup,
    op9_lm_score,
    op10_token_counts,
    op11_secret_scan,
    op12_hard_negatives,
    op13_centroid_clustering,
)
_SQL = {
    "op3_pii": oracles.PII,
    "op4_decontamination": oracles.contamination(),
    "op8_exact_dedup": oracles.EXACT_DEDUP,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_centroid_clustering": oracles.clustering(),
}


def queries() -> dict[str, Run]:
    return {run.__name__: run for run in _ALL}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
