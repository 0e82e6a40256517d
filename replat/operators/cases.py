"""Permit cases: one narrow fact row per case, then one roll-up row per parcel key.

Texts are read and parsed once, in the scan stage. What is shuffled is the fact row: flags and six
numbers. Every aggregate is algebraic, so a key that holds a third of all cases is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES, Rules
from replat.functions import text
from replat.functions.ordering import first_of_largest
from replat.functions.scalars import column_or_null

POST_FIELDS = tuple(f"{t}_{m}" for t in config.DWELLING_TYPES for m in ("count", "sqft"))


def is_event_case(df: DataFrame, rules: Rules = DEFAULT_RULES) -> Column:
    """Case belongs to the event: by its label, or because the description names the event."""
    labelled = F.coalesce(column_or_null(df, "disaster_type", "string") == rules.event_label, F.lit(False))
    return labelled | text.matches(F.col("description"), rules.event_text)


def is_permit(rules: Rules = DEFAULT_RULES) -> Column:
    return F.coalesce(F.col("modulename") == rules.permit_module, F.lit(False))


def is_primary_candidate(df: DataFrame, rules: Rules = DEFAULT_RULES) -> Column:
    work = column_or_null(df, "workclass_name", "string")
    return is_permit(rules) & F.coalesce(work.isin(*rules.permit_work_classes), F.lit(False))


def is_qualifying(df: DataFrame, rules: Rules = DEFAULT_RULES) -> Column:
    work = column_or_null(df, "workclass_name", "string")
    plan = (F.col("modulename") == rules.plan_module) & (work == rules.plan_work_class)
    return is_primary_candidate(df, rules) | F.coalesce(plan, F.lit(False))


def case_structures(cases: DataFrame) -> DataFrame:
    """One row per structure named in a case description."""
    return cases.select(
        "seq", "main_ain", F.inline(text.structures(F.col("description")))
    )


def case_facts(cases: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Row-local facts of each case. Only permit texts are parsed: no rule reads a plan's structures."""
    desc, name = F.col("description"), column_or_null(cases, "project_name", "string")
    other_name = column_or_null(cases, "projectname", "string")
    progress = F.col("rebuild_progress_num").try_cast("double")
    return cases.select(
        F.col("seq").cast("bigint").alias("seq"),
        "main_ain",
        is_event_case(cases, rules).alias("is_event"),
        is_permit(rules).alias("is_permit"),
        is_primary_candidate(cases, rules).alias("is_primary"),
        is_qualifying(cases, rules).alias("is_qualifying"),
        column_or_null(cases, "casenumber", "string").alias("casenumber"),
        F.sha2(F.coalesce(desc, F.lit("")), 256).alias("digest"),
        (F.length(desc) > 0).alias("has_text"),
        progress.alias("progress"),
        column_or_null(cases, "apply_date", "double").cast("double").alias("apply_date"),
        text.claim_signal(desc).alias("desc_signal"),
        text.claim_signal(name).alias("name_signal"),
        (
            text.mentions_pathway(desc) | text.mentions_pathway(name) | text.mentions_pathway(other_name)
        ).alias("mentions_pathway"),
        F.coalesce(column_or_null(cases, "new_dwelling_units", "double") > 0, F.lit(False)).alias("adds_units"),
        (
            text.matches(desc, config.PROBE_SFR) & text.matches(desc, config.PROBE_AREA)
        ).alias("names_sfr_area"),
        F.when(is_permit(rules), text.structure_totals(text.structures(desc))).alias("parsed"),
    )


def case_rollup(facts: DataFrame) -> DataFrame:
    """One row per parcel key: every ordered pick and flag in a single aggregation."""
    event = F.col("is_event")
    # One number says value and position, so that every pick is a maximum of fixed width: such aggregates
    # are hashed, while picks by a struct would sort all rows by parcel first.
    by_progress = first_of_largest(F.coalesce(F.col("progress"), F.lit(0.0)), F.col("seq"))
    by_date = first_of_largest(F.coalesce(F.col("apply_date"), F.lit(0.0)), F.col("seq"))
    signal = F.coalesce(F.col("desc_signal"), F.col("name_signal"))
    # columns of their own, so that each is computed once for all picks that go by it
    facts = facts.withColumns({
        "_primary": F.when(event & F.col("is_primary"), by_progress),
        "_claim": F.when(event & signal.isNotNull(), by_date),
    })
    primary = F.col("_primary")
    has_units = F.col("is_permit") & F.col("adds_units")
    parse_probe = event & F.col("is_permit") & F.col("has_text")
    area_probe = F.col("is_permit") & F.col("names_sfr_area")

    def any_signal(value: bool) -> Column:
        hit = (F.col("desc_signal") == value) | (F.col("name_signal") == value)
        return F.bool_or(event & F.coalesce(hit, F.lit(False)))

    def tally(condition: Column) -> Column:
        return F.count_if(condition).cast("bigint")

    rolled = facts.groupBy("main_ain").agg(
        F.count(F.lit(1)).alias("case_count"),
        F.max(F.when(event, F.col("progress").try_cast("bigint"))).alias("max_progress"),
        *[F.max_by(F.col(f"parsed.{f}"), primary).alias(f"_{f}") for f in POST_FIELDS],
        F.max_by(F.col("seq"), primary).alias("primary_seq"),
        F.max_by(signal, F.col("_claim")).alias("claim"),
        (any_signal(True) & any_signal(False)).alias("claim_conflict"),
        F.bool_or(event & F.col("mentions_pathway")).alias("mentions_pathway"),
        F.bool_or(event & F.col("is_qualifying")).alias("has_qualifying"),
        F.bool_or(event & F.col("is_qualifying") & F.col("is_permit")).alias("has_qualifying_permit"),
        F.min_by(
            (F.col("parsed.segments") > 0) & F.col("parsed.all_unknown"),
            F.when(has_units, F.col("seq")),
        ).alias("units_unknown"),
        tally(parse_probe).alias("parse_candidates"),
        tally(parse_probe & F.col("parsed.any_parsed")).alias("parse_hits"),
        tally(area_probe).alias("area_candidates"),
        tally(area_probe & F.col("parsed.any_sfr_area")).alias("area_hits"),
    )
    post = F.when(F.col("primary_seq").isNotNull(), F.struct(*[F.col(f"_{f}").alias(f) for f in POST_FIELDS]))
    return rolled.withColumn("post", post).drop(*[f"_{f}" for f in POST_FIELDS])
