"""Tables behind the published page: shares, rollups, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.config import DEFAULT_RULES, Rules
from replat.functions.scalars import is_stale

# Fixed labels of the published charts.
SIZE_BUCKETS = (
    (">30% smaller", "sfr_size_pct_smaller_over_30"),
    ("10–30% smaller", "sfr_size_pct_smaller_10_to_30"),
    ("±10%", "sfr_size_pct_within_10"),
    ("10–30% larger", "sfr_size_pct_larger_10_to_30"),
    (">30% larger", "sfr_size_pct_larger_over_30"),
)
ADDED_BUCKETS = (
    ("+1 ADU", "adu_added_1_count"),
    ("+2 ADUs", "adu_added_2_count"),
    ("+3 or more", "adu_added_3_plus_count"),
)
CLAIM_SLICES = (
    ("Like-for-like", "lfl_count"),
    ("Not like-for-like", "nlfl_count"),
    ("Not specified", "lfl_unknown_count"),
)


def _stacked(summary: DataFrame, rows: tuple, *extra: Column) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(label).alias("label"), F.col(c).alias("value")) for label, c in rows]
    )
    return summary.select(*extra, F.posexplode(pairs).alias("position", "pair")).select(
        *[c for c in ("denominator",) if extra], "position", "pair.label", "pair.value"
    )


def bucket_shares(summary: DataFrame) -> DataFrame:
    """Size and added-unit buckets as percent of rebuilt dwellings; null without any.

    The ``+3 or more`` row appears only when it counts something.
    """
    base = F.col("dwelling_rebuild_count").alias("denominator")
    sizes = _stacked(summary, SIZE_BUCKETS, base).withColumn("chart", F.lit("size"))
    added = _stacked(summary, ADDED_BUCKETS, base).withColumn("chart", F.lit("added_units"))
    rows = sizes.unionByName(added.filter((F.col("position") < 2) | (F.col("value") > 0)))
    share = F.round(
        F.col("value") / F.nullif(F.col("denominator"), F.lit(0)).cast("double") * 100, 1
    )
    return rows.select("chart", "position", "label", "value", share.alias("share_pct"))


def claim_shares(summary: DataFrame) -> DataFrame:
    """The three claim slices in whole percent of their own total; 0 when that is empty."""
    total = sum((F.col(c) for _, c in CLAIM_SLICES), F.lit(0))
    rows = _stacked(summary, CLAIM_SLICES, total.alias("denominator"))
    share = F.round(
        F.col("value") / F.nullif(F.col("denominator"), F.lit(0)).cast("double") * 100, 0
    )
    return rows.select("position", "label", "value", F.coalesce(share, F.lit(0.0)).alias("share_pct"))


def warning_rollup(warning_rows: DataFrame) -> DataFrame:
    return (
        warning_rows.groupBy("code")
        .agg(F.count(F.lit(1)).alias("warning_count"))
        .orderBy(F.desc("warning_count"), "code")
    )


def warning_table(
    warning_rows: DataFrame, severity: str | None = None, sort_key: str = "code"
) -> DataFrame:
    """Warnings of one severity (or all), sorted by ain, code or severity; ties in report order."""
    if sort_key not in ("ain", "code", "severity"):
        raise ValueError(f"cannot sort warnings by {sort_key!r}")
    rows = warning_rows if severity is None else warning_rows.filter(F.col("severity") == severity)
    return rows.orderBy(sort_key, "phase", "parcel_seq", "code_ord").select(
        "ain", "code", "detail", "severity"
    )


def freshness(runs: DataFrame, as_of: Column, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``is_stale`` per run of a table with ``generated_at``, against a given point in time."""
    return runs.withColumn(
        "is_stale", is_stale(F.col("generated_at"), as_of, rules.stale_after_hours)
    )
