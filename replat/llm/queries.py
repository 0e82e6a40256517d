"""The registered queries of this subpackage, with production parameters, and their SQL restatements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replat.llm import (
    hard_negatives,
    jaccard_join,
    line_runs,
    packing,
    phrases,
    piece_bpe,
    posting_lists,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    url_rules,
    vector_links,
)
from replat.llm.common import table

#: How many tokens a document may have before it counts as over the limit.
TOKEN_LIMIT = 512


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counted.selectExpr("*", f"n_tokens > {TOKEN_LIMIT} as over_limit")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.vector_links(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), whole_characters=False)
    return made.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_runs.line_dedup(table(spark, sf_dir, "documents"))
    return made.select("row.doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged_urls(table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return piece_bpe.coded_digests(documents, tokenizer("byte_bpe_50k.tiktoken"), pattern())


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_quality_rules, op2_token_counts, op3_ngram_jaccard, op4_embedding_links, op5_best_fit_packing, op6_suffix_dedup,
        op7_line_dedup, op8_url_filters, op9_quality_classifier, op10_byte_bpe, op11_phrases, op12_nearest_vectors,
        op13_hard_negatives, pipeline,
    )
    return {f.__name__: f for f in own}


def statements() -> dict[str, str]:
    return {
        "op8_url_filters": url_rules.oracle(),
        "op11_phrases": phrases.oracle(),
        "op13_hard_negatives": hard_negatives.oracle(),
    }
