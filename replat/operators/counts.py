"""The published counts: one list of conditions, used for the whole area and for every region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.functions.scalars import size_bucket


def _conditions() -> dict[str, Column]:
    damage, tag, progress = F.col("damage"), F.col("bsd_status"), F.col("rebuild_progress_num")
    claim, added = F.col("lfl_claimed"), F.col("added_adu_count")
    bucket = size_bucket(F.col("pre_sfr_sqft"), F.col("post_sfr_sqft"))
    sizes = (
        "smaller_over_30", "smaller_10_to_30", "within_10", "larger_10_to_30", "larger_over_30", "unknown",
    )
    return {
        "total_parcels": F.lit(True),
        "damaged_parcels": damage.isin("affected", "minor", "major", "destroyed"),
        "destroyed_parcels": damage == "destroyed",
        "bsd_red_count": tag == "red",
        "bsd_yellow_count": tag == "yellow",
        "bsd_green_count": tag == "green",
        "bsd_red_or_yellow_count": tag.isin("red", "yellow"),
        "no_permit_count": progress.isNull(),
        "permit_in_review_count": progress.between(1, 4),
        "permit_issued_count": progress == 5,
        "construction_count": progress == 6,
        "completed_count": progress == 7,
        "lfl_count": claim,
        "nlfl_count": ~claim,
        "lfl_unknown_count": claim.isNull() & progress.isNotNull(),
        **{f"sfr_size_pct_{name}": bucket == name for name in sizes},
        "sb9_count": F.col("adds_sb9"),
        "adu_added_1_count": added == 1,
        "adu_added_2_count": added == 2,
        "adu_added_3_plus_count": added >= 3,
        "dwelling_rebuild_count": (F.coalesce(F.col("post_sfr_count"), F.lit(0)) > 0)
        | (F.coalesce(F.col("post_adu_count"), F.lit(0)) > 0),
    }


COUNT_FIELDS = (
    "total_parcels", "damaged_parcels", "destroyed_parcels",
    "bsd_red_count", "bsd_yellow_count", "bsd_green_count", "bsd_red_or_yellow_count",
    "no_permit_count", "permit_in_review_count", "permit_issued_count", "construction_count",
    "completed_count", "lfl_count", "nlfl_count", "lfl_unknown_count",
    "sfr_size_pct_smaller_over_30", "sfr_size_pct_smaller_10_to_30", "sfr_size_pct_within_10",
    "sfr_size_pct_larger_10_to_30", "sfr_size_pct_larger_over_30", "sfr_size_pct_unknown",
    "sb9_count", "adu_added_1_count", "adu_added_2_count", "adu_added_3_plus_count",
    "dwelling_rebuild_count",
)


def count_columns() -> list[Column]:
    conditions = _conditions()
    return [F.count_if(conditions[n]).cast("bigint").alias(n) for n in COUNT_FIELDS]


def count_cells(assigned: DataFrame, layers: list[str]) -> DataFrame:
    """All counts per combination of assigned regions: the one pass every total is added up from.

    There are about as many cells as regions of the finest layer; parcels outside every region share
    the cell of nulls.
    """
    return assigned.groupBy(*layers).agg(*count_columns())


def _added_up() -> list[Column]:
    return [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in COUNT_FIELDS]


def summary_counts(results: DataFrame) -> DataFrame:
    """One row with the 26 counts of the whole area."""
    return results.agg(*count_columns())


def summary_of(cells: DataFrame) -> DataFrame:
    """The same row, added up from :func:`count_cells`."""
    return cells.agg(*_added_up())


def region_counts(
    cells: DataFrame, regions: DataFrame, key: str, assigned: str, id_fields: list[str]
) -> DataFrame:
    """One row per region, zero-filled; ``assigned`` is the cell column naming the region.

    Region rows that share a key receive the same counts.
    """
    per_key = cells.filter(F.col(assigned).isNotNull()).groupBy(assigned).agg(*_added_up())
    kept = [c for c in ("region_idx", "geometry") if c in regions.columns]
    ids = [F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f.lower()) for f in id_fields]
    framed = regions.select(*ids, *kept, F.col(key).cast("string").alias("_key"))
    return (
        framed.join(per_key, F.col("_key") == F.col(assigned), "left")
        .drop("_key", assigned)
        .fillna(0, subset=list(COUNT_FIELDS))
    )
