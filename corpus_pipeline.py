"""From raw documents to packed sequences: five stages, each one of the numbered operators.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents``, works on all of them and returns
what it keeps, in the same columns; the last returns where each piece of a document is packed. ``run`` writes
each stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replat.llm import edits, jaccard_join, line_runs, packing, quality_classifier, suffix_dedup
from replat.llm.common import staged, table
from replat.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (operator 9); without labels to learn from, none."""
    scores = quality_classifier.fitted(docs, table(spark, sf_dir, "labels"))
    return scores.filter("predicted = 1 or not modelled").select("row.*")


def rewritten(made: DataFrame, columns: list[str]) -> DataFrame:
    """Documents with their new texts. One whose every word went is a copy as a whole, and goes as well."""
    word = line_runs.WORD.pattern
    emptied = (F.col("n_removed") > 0) & ~F.col("kept_text").rlike(word)
    return edits.replaced(made.filter(~emptied), columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated runs of lines (operator 7)."""
    return rewritten(line_runs.line_dedup(docs), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest key (operator 3)."""
    groups = jaccard_join.jaccard_components(docs)
    kept = groups.filter("component_id is null or doc_id = component_id").select("doc_id").distinct()
    same = docs["doc_id"].eqNullSafe(kept["doc_id"])
    return docs.join(kept, same, "left_semi")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 bytes and more that an earlier document has (operator 6)."""
    return rewritten(suffix_dedup.suffix_dedup(docs), docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens (operator 5)."""
    return packing.packed(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", passages),
    ("best-fit packing", sequences),
]

#: Compression, shingle sets and suffix order have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
