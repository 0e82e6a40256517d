"""Quality rules by distribution divergence, in column expressions only (operator 1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.llm.common import staged

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]+"

# The most frequent short words of each language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "was", "on", "are"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "des", "auf", "ist"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"),
}
OTHER = "other"
#: Runs of characters taken out of a text one after the other; what is left is the last class.
CLASSES = (r"\p{Ll}+", SPACE, "[0-9]+", r"[\x21-\x7E&&[^0-9A-Za-z]]+", r"\p{Lu}+")
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """A text is judged by its character classes from ``min_chars`` characters on, and by its common
    words from ``min_words`` words on; shorter ones pass. Distances run from 0 to 1."""

    min_words: int = 50
    min_chars: int = 200
    max_classes: float = 0.25
    max_common: float = 0.3


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(words: Column) -> Column:
    """Sorted (hash, position) of all 5-word windows; null if there are fewer than two."""
    starts = F.when(F.size(words) > WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
    hashed = F.transform(
        starts, lambda i: F.struct(F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))).alias("h"), i.alias("i"))
    )
    return F.sort_array(hashed)


def repeated(ordered: Column) -> Column:
    """Positions, in order, of the windows that equal a neighbour among the sorted ones."""
    twice = F.filter(
        ordered, lambda w, k: (w["h"] == F.get(ordered, k - 1)["h"]) | (w["h"] == F.get(ordered, k + 1)["h"])
    )
    return F.sort_array(F.transform(twice, lambda w: w["i"]))


def covered(at: Column) -> Column:
    """Words in windows at these positions: each adds the words up to the next one, five at most."""
    steps = F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda total, s: total + s), F.lit(0).cast("long"))


def summed(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda total, c: total + c)


def shares(counts: Column) -> Column:
    return F.transform(counts, lambda c: c / F.greatest(summed(counts), F.lit(1.0)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, the root of the divergence) of two share arrays of one length."""

    def against(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: against(x, y) + against(y, x))
    return F.sqrt(F.greatest(summed(terms) / 2, F.lit(0.0)))


def measured(docs: DataFrame) -> DataFrame:
    """One narrow row for each document: its counts and its two histograms. The text is read once.

    Each step is a column of its own that later steps use twice, so that Spark computes it once.
    """
    everyone = sorted({w for words in COMMON_WORDS.values() for w in words})
    lists = F.create_map(*(x for name, words in COMMON_WORDS.items() for x in (F.lit(name), F.array(*map(F.lit, words)))))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("lang").isin(*COMMON_WORDS), F.col("lang")).otherwise(F.lit(OTHER)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\f\r"))
    # characters: what is left after each class is taken out
    left = rows.withColumn("left1", F.regexp_replace("text", CLASSES[0], ""))
    left = left.withColumn("n_dup_lines", dup_lines(F.col("text"))).select(
        "doc_id", "lang", "left1", "n_dup_lines",
        F.char_length("text").alias("left0"),
        F.when(trimmed != "", F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>")).alias("words"),
        (F.char_length("left1") - F.char_length(F.regexp_replace("left1", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    for k, run in enumerate(CLASSES[1:], start=2):
        left = left.withColumn(f"left{k}", F.regexp_replace(f"left{k - 1}", run, ""))
    sizes = [F.col("left0")] + [F.char_length(f"left{k}") for k in range(1, len(CLASSES) + 1)]
    classes = [(a - b).cast("double") for a, b in zip(sizes, sizes[1:], strict=False)] + [sizes[-1].cast("double")]
    counted = left.select(
        "doc_id", "lang", "n_dup_lines", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        sizes[0].cast("long").alias("n_chars"),
        (sizes[0] - sizes[1] + sizes[2]).cast("long").alias("word_chars"),
        F.array(*classes).alias("classes"),
        windows(F.col("words")).alias("ordered"),
        F.filter("words", lambda w: w.isin(everyone)).alias("common"),
    )
    counted = counted.withColumn("at", repeated(F.col("ordered")))
    own = F.coalesce(F.element_at(lists, F.col("lang")), F.array().cast("array<string>"))
    hits = F.transform(
        F.when(F.size("common") >= 0, own),
        lambda w: F.size(F.filter("common", lambda c: c == w)).cast("double"),
    )
    counted = counted.withColumn("hits", hits).withColumn("n_repeat_words", covered(F.col("at")))
    counted = counted.withColumn("common_counts", F.concat("hits", F.array(F.col("n_words") - summed(F.col("hits")))))
    return counted.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
        shares(F.col("classes")).alias("classes"),
        shares(F.col("common_counts")).alias("common"),
    )


def references(rows: DataFrame, limits: Limits) -> DataFrame:
    """Mean histograms of each language over all its documents that pass the base rules and are long
    enough to be judged. One row for each language named above and one for the others."""
    usable = rows.filter(~F.col("base_failed") & (F.col("n_words") >= limits.min_words))
    longest = max(map(len, COMMON_WORDS.values())) + 1

    def mean(column: str, n: int) -> Column:
        # a language's own word list may be shorter than the longest; positions beyond it are null
        return F.filter(F.array(*(F.avg(F.get(column, F.lit(i))) for i in range(n))), lambda x: x.isNotNull())

    return usable.groupBy("lang").agg(mean("classes", len(CLASSES) + 1).alias("ref_classes"), mean("common", longest).alias("ref_common"))


def quality_rules(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Counts, base verdict, divergences and verdict of every row with ``doc_id``, ``text``, ``lang``.

    Base rules: at least 10 words, and at most a fifth of the words in 5-word windows that occur twice.
    Then the text's character classes and common words are held against the mean of its language (unknown
    or null languages share one reference and have no word list); a text too short for a comparison
    passes it. Null and empty texts have no words and fail. Repeated rows are judged one by one.
    """
    limits = limits or Limits()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = staged(measured(docs).withColumn("base_failed", failed))
    judged = rows.join(F.broadcast(references(rows, limits)), "lang", "left")  # at most five rows
    judged = judged.withColumns(
        {
            "class_distance": distance(F.col("classes"), F.col("ref_classes")),
            "common_distance": distance(F.col("common"), F.col("ref_common")),
        }
    )
    far = (F.col("n_chars") >= limits.min_chars) & (F.col("class_distance") > limits.max_classes)
    far = far | (F.col("n_words") >= limits.min_words) & (F.col("common_distance") > limits.max_common)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "common_distance",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )
