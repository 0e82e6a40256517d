"""The text sent to a model for each parcel: its context and its qualifying records in date order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES, Rules
from replat.functions import scalars
from replat.functions.scalars import column_or_null, epoch_ms_date, lookup
from replat.functions.text import split_lines
from replat.operators.cases import POST_FIELDS
from replat.operators.parcels import pre_state
from replat.operators.ranking import position_in_group

def _or(value: Column, fallback: str) -> Column:
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit(fallback))


def record_blocks(records: DataFrame) -> DataFrame:
    """One text block per record, all but its number; ``sort_date`` and ``seq`` give the order."""

    def own(name: str) -> Column:
        return column_or_null(records, name, "string")

    num = F.col("rebuild_progress_num").try_cast("bigint")
    label = lookup(num.cast("int"), config.PROMPT_PROGRESS_LABELS)
    progress = (
        F.when(num.isNull(), F.lit("(unknown)"))
        .when(label.isNull(), num.cast("string"))
        .otherwise(F.concat(num.cast("string"), F.lit(" ("), label, F.lit(")")))
    )
    names = F.coalesce(
        F.nullif(own("project_name"), F.lit("")), F.nullif(own("projectname"), F.lit("")), F.lit("(none)")
    )
    description = _or(F.col("description"), "(blank)")
    indented = F.array_join(
        F.transform(split_lines(description), lambda s: F.concat(F.lit("      "), s)), "\n"
    )
    lines = [
        F.concat(F.lit("CASENUMBER:     "), _or(own("casenumber"), "(unknown)")),
        F.concat(F.lit("    MODULENAME:     "), _or(F.col("modulename"), "(unknown)")),
        F.concat(F.lit("    WORKCLASS:      "), _or(own("workclass_name"), "(unknown)")),
        F.concat(F.lit("    PROJECT_NUMBER: "), _or(own("project_number"), "(none)")),
        F.concat(F.lit("    PROJECT_NAME:   "), names),
        F.concat(F.lit("    STATUS:         "), _or(own("status"), "(unknown)")),
        F.concat(F.lit("    PROGRESS:       "), progress),
        F.concat(F.lit("    APPLY_DATE:     "), epoch_ms_date(F.col("apply_date"))),
        F.lit("    DESCRIPTION:"),
        indented,
        F.lit(""),
    ]
    return records.select(
        "main_ain",
        F.coalesce(F.col("apply_date").cast("double"), F.lit(0.0)).alias("sort_date"),
        F.col("seq").cast("bigint").alias("seq"),
        F.concat_ws("\n", *lines).alias("block"),
    )


def _numbered(index: Column, block: Column) -> Column:
    return F.concat(F.lit("["), index.cast("string"), F.lit("] "), block)


def user_prompts(parcels: DataFrame, records: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """(parcel_seq, ain, part, user_prompt) for every parcel row with a qualifying record.

    Part 0 is the context with the number of records, part i the i-th record; the parts in order, joined by
    line breaks, are the prompt. So a row holds one record however many a parcel has.
    """
    ranked = position_in_group(record_blocks(records), "main_ain", "sort_date", "seq", "part")
    bodies = ranked.select("main_ain", F.col("part").cast("bigint").alias("part"), _numbered(F.col("part"), F.col("block")).alias("body"))
    sizes = records.groupBy("main_ain").agg(F.count(F.lit(1)).alias("records"))

    pre = {f: F.col(f"pre.{f}").try_cast("bigint") for f in POST_FIELDS}
    summary = scalars.pre_state_text(
        {t: pre[f"{t}_count"] for t in config.DWELLING_TYPES},
        {t: pre[f"{t}_sqft"] for t in config.DWELLING_TYPES},
    )
    address = scalars.first_non_empty(
        column_or_null(parcels, "situsfulladdress", "string"),
        column_or_null(parcels, "situsaddress", "string"),
    )
    context = parcels.withColumn("pre", pre_state(parcels, rules)).select(
        F.col("seq").alias("parcel_seq"),
        F.col("ain_1").alias("ain"),
        F.coalesce(address, F.lit("(unknown)")).alias("address"),
        scalars.damage_level(F.col("damage_1")).alias("damage"),
        summary.alias("summary"),
    )
    header = F.concat_ws(
        "\n",
        F.lit("PARCEL CONTEXT"),
        F.concat(F.lit("AIN: "), F.col("ain")),
        F.concat(F.lit("Address: "), F.col("address")),
        F.concat(F.lit("DAMAGE: "), F.col("damage")),
        F.concat(F.lit("Pre-fire structures (from DINS): "), F.col("summary")),
        F.lit(""),
        F.concat(F.lit("RECORDS ("), F.col("records"), F.lit(" qualifying, sorted by APPLY_DATE):")),
        F.lit(""),
    )
    same = F.col("ain") == F.col("main_ain")
    first = context.join(sizes, same).select(
        "parcel_seq", "ain", F.lit(0).cast("bigint").alias("part"), header.alias("user_prompt")
    )
    others = context.select("parcel_seq", "ain").join(bodies, same)
    return first.union(others.select("parcel_seq", "ain", "part", F.col("body").alias("user_prompt")))
