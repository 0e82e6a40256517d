"""Reading an extraction cache file: one JSON document with an ``entries`` list.

The cache itself is a Parquet table (see ``plans.rebuild``); this brings an existing file into it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replat.config import DEFAULT_RULES, Rules
from replat.operators.extraction import EXTRACTION_COLUMNS, STRUCTURE_TYPE

_FILE = "prompt_version bigint, entries array<variant>"


def _whole_number(value: Column) -> Column:
    """Integer of a JSON number or of text that is one; null for anything else."""
    kind = F.coalesce(F.schema_of_variant(value), F.lit(""))
    text = F.trim(F.try_variant_get(value, "$", "string"))
    return (
        F.when(kind == "STRING", F.when(text.rlike(r"\A[+-]?\d+\z"), text.try_cast("bigint")))
        .when(kind == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .otherwise(F.try_variant_get(value, "$", "double").try_cast("bigint"))
    )


def _is_empty(value: Column) -> Column:
    """Absent, null, or one of the empty JSON values."""
    text = F.try_variant_get(value, "$", "string")
    return text.isNull() | text.isin("", "0", "0.0", "false", "[]", "{}")


def _structure(item: Column) -> Column:
    def member(name: str, dtype: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", dtype)

    area = member("sqft", "variant")
    no_area = F.coalesce(F.schema_of_variant(area), F.lit("VOID")) == "VOID"
    evidence = F.coalesce(
        member("evidence_case_numbers", "array<string>"), F.array().cast("array<string>")
    )
    fields = F.struct(
        member("struct_type", "string").alias("struct_type"),
        _whole_number(area).alias("sqft"),
        F.coalesce(F.nullif(member("confidence", "string"), F.lit("")), F.lit("low")).alias("confidence"),
        evidence.alias("evidence_case_numbers"),
        F.nullif(member("notes", "string"), F.lit("")).alias("notes"),
    )
    good = member("struct_type", "variant").isNotNull() & (no_area | _whole_number(area).isNotNull())
    return F.struct(fields.alias("fields"), F.coalesce(good, F.lit(False)).alias("good"))


def cache_entries(entries: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Typed cache rows of a (pos, entry VARIANT) table.

    An entry of the wrong shape is dropped as a whole; of two with one key the later stays.
    """

    def member(name: str, dtype: str) -> Column:
        return F.try_variant_get("entry", f"$.{name}", dtype)

    def text(name: str) -> Column:
        return F.coalesce(member(name, "string"), F.lit(""))

    def number(name: str, default: int) -> Column:
        value = member(name, "variant")
        return F.when(_is_empty(value), F.lit(default).cast("bigint")).otherwise(_whole_number(value))

    listed = member("structures", "variant")
    items = F.transform(member("structures", "array<variant>"), _structure)
    none = F.array().cast(f"array<{STRUCTURE_TYPE}>")
    usable = F.when(_is_empty(listed), F.lit(True)).otherwise(
        F.coalesce(F.forall(items, lambda s: s["good"]), F.lit(False))
    )
    typed = entries.select(
        "pos",
        member("key", "string").alias("key"),
        member("ain", "string").alias("ain"),
        text("extracted_at").alias("extracted_at"),
        text("model").alias("model"),
        number("prompt_version", rules.prompt_version).alias("prompt_version"),
        F.when(_is_empty(listed), none)
        .otherwise(F.transform(items, lambda s: s["fields"]))
        .cast(f"array<{STRUCTURE_TYPE}>")
        .alias("structures"),
        text("reasoning").alias("reasoning"),
        number("input_tokens", 0).alias("input_tokens"),
        number("output_tokens", 0).alias("output_tokens"),
        usable.alias("usable"),
    )
    counted = ("prompt_version", "input_tokens", "output_tokens")
    whole = F.col("usable") & F.col("ain").isNotNull() & F.col("key").isNotNull()
    for name in counted:
        whole = whole & F.col(name).isNotNull()
    rest = [c for c in EXTRACTION_COLUMNS if c != "key"]
    latest = typed.filter(whole).groupBy("key").agg(F.max_by(F.struct(*rest), "pos").alias("entry"))
    return latest.select("key", "entry.*").select(*EXTRACTION_COLUMNS)


def read_cache(spark: SparkSession, path: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Cache rows of a file; a missing or unreadable file is an empty cache."""
    try:
        raw = spark.read.option("multiLine", True).schema(_FILE).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], _FILE)
    return cache_entries(raw.select(F.posexplode("entries").alias("pos", "entry")), rules)
