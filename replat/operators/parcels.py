"""Parcels: pre-event state from the slots, the left join with the case roll-up, the result row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES, Rules
from replat.functions import scalars
from replat.functions.scalars import column_or_null
from replat.functions.text import strip
from replat.operators.cases import POST_FIELDS
from replat.operators.combine import with_one_row


def pre_state(parcels: DataFrame, rules: Rules = DEFAULT_RULES) -> Column:
    """Count and area per dwelling type over the structure slots, in one pass over the row.

    A further single-family slot on a ``single`` use is an accessory unit. A missing area adds nothing,
    so a type that has slots but no areas sums to 0, and only a type without slots is null.
    """
    single = F.coalesce(
        F.lower(strip(column_or_null(parcels, "usedescription", "string"))) == "single", F.lit(False)
    )
    slots = []
    for slot in range(1, rules.slots + 1):
        design = column_or_null(parcels, f"designtype{slot}", "string").cast("string")
        area = column_or_null(parcels, f"sqftmain{slot}", "double").try_cast("double")
        family = F.substring(design, 1, 2)
        home = F.lit("sfr") if slot == 1 else F.when(single, F.lit("adu")).otherwise(F.lit("sfr"))
        label = F.when(family == "01", home).when(family.isin("02", "03", "04", "05"), F.lit("mfr"))
        slots.append(F.struct(label.alias("label"), F.coalesce(area, F.lit(0.0)).alias("area")))

    zero = []
    for label in config.DWELLING_TYPES:
        zero += [F.lit(0).cast("bigint").alias(f"{label}_count")]
        zero += [F.lit(None).cast("double").alias(f"{label}_sqft")]

    def step(acc: Column, s: Column) -> Column:
        fields = []
        for label in config.DWELLING_TYPES:
            here = F.coalesce(s["label"] == label, F.lit(False))
            count, area = acc[f"{label}_count"], acc[f"{label}_sqft"]
            fields.append(F.when(here, count + 1).otherwise(count).alias(f"{label}_count"))
            total = F.coalesce(area, F.lit(0.0)) + s["area"]
            fields.append(F.when(here, total).otherwise(area).alias(f"{label}_sqft"))
        return F.struct(*fields)

    return F.aggregate(F.array(*slots), F.struct(*zero), step)


def join_rollup(parcels: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every parcel row once, with its key's roll-up; two rows with one key both receive it."""
    joined = parcels.join(rollup, parcels["ain_1"] == rollup["main_ain"], "left")
    flags = ["claim_conflict", "mentions_pathway", "has_qualifying", "has_qualifying_permit"]
    tallies = ["case_count", "parse_candidates", "parse_hits", "area_candidates", "area_hits"]
    return joined.drop("main_ain").fillna(False, subset=flags).fillna(0, subset=tallies)


def orphan_keys(parcels: DataFrame, cases: DataFrame) -> DataFrame:
    """Case keys no parcel carries, with their case counts (keys are aggregated before the join)."""
    keys = cases.groupBy("main_ain").agg(F.count(F.lit(1)).alias("case_count"))
    known = parcels.select(F.col("ain_1").alias("main_ain")).distinct()
    return keys.join(known, "main_ain", "left_anti")


def match_counts(joined: DataFrame, orphans: DataFrame) -> DataFrame:
    with_case = F.count_if(F.col("case_count") > 0)
    left = joined.agg(
        F.count(F.lit(1)).alias("parcels"),
        with_case.alias("parcels_with_case"),
        (F.count(F.lit(1)) - with_case).alias("parcels_without_case"),
    )
    right = orphans.agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("case_count"), F.lit(0)).alias("orphan_cases"),
    )
    return with_one_row(left, right)


def parcel_analysis(
    parcels: DataFrame, rollup: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Result columns from the text path, followed by the working columns later steps read."""
    passed = ["geometry", "cx", "cy"]
    src = parcels.withColumn("pre", pre_state(parcels, rules))
    joined = join_rollup(src, rollup)

    def own(name: str, dtype: str = "string") -> Column:
        return column_or_null(parcels, name, dtype)

    pre = {f: F.col(f"pre.{f}").try_cast("bigint") for f in POST_FIELDS}
    post = {f: F.col(f"post.{f}").try_cast("bigint") for f in POST_FIELDS}
    fields = {
        "ain": F.col("ain_1"),
        "apn": scalars.first_non_empty(own("apn_1"), F.col("ain_1")),
        "address": F.coalesce(
            scalars.first_non_empty(own("situsfulladdress"), own("situsaddress")), F.lit("")
        ),
        "damage": scalars.damage_level(F.col("damage_1")),
        "bsd_status": scalars.safety_tag(own("bsd_tag")),
        **{f"pre_{f}": c for f, c in pre.items()},
        **{f"post_{f}": c for f, c in post.items()},
        "lfl_claimed": F.col("claim"),
        "lfl_conflict": F.col("claim_conflict"),
        "sfr_size_comparison": scalars.size_comparison(
            pre["sfr_sqft"], post["sfr_sqft"], rules.size_tolerance
        ),
        "adds_sb9": F.col("mentions_pathway"),
        "added_adu_count": scalars.added_units(pre["adu_count"], post["adu_count"]),
        "rebuild_progress_num": F.col("max_progress"),
        "rebuild_progress": scalars.progress_label(F.col("max_progress")),
        "permit_status": scalars.stripped_or_null(own("permit_status")),
        "roe_status": scalars.stripped_or_null(own("roe_status")),
        "debris_cleared": scalars.stripped_or_null(own("debris_cleared")),
        "dins_count": scalars.int_or_zero(own("dins_count")),
    }
    working = [
        F.col("seq").alias("parcel_seq"),
        *[F.col(c) for c in passed if c in parcels.columns],
        *[
            F.col(c)
            for c in (
                "case_count", "has_qualifying", "has_qualifying_permit", "units_unknown",
                "parse_candidates", "parse_hits", "area_candidates", "area_hits",
            )
        ],
    ]
    return joined.select(*[fields[n].alias(n) for n in config.RESULT_FIELDS], *working)


def results(analysis: DataFrame) -> DataFrame:
    """Only the published parcel fields, in their order."""
    return analysis.select(*config.RESULT_FIELDS)
