"""Data-quality warnings, dataset gates, and the stop before publishing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replat.config import DEFAULT_RULES, Rules
from replat.operators.combine import with_one_row

_WARNING_FIELDS = ("ain", "code", "detail", "severity")

# Report order: model warnings, the run-wide notice, the parcel's own, the spatial one.
_PHASES = {"model": 0, "run": 1, "parcel": 2, "spatial": 3}


def _warning(phase: str, order: int, code: str, severity: str, detail: Column) -> Column:
    return F.struct(
        F.lit(_PHASES[phase]).alias("phase"),
        F.lit(order).alias("code_ord"),
        F.lit(code).alias("code"),
        detail.alias("detail"),
        F.lit(severity).alias("severity"),
    )


def _parcel_warnings(rules: Rules) -> list[Column]:
    area, claim = F.col("post_sfr_sqft"), F.col("lfl_claimed")
    compared = F.col("sfr_size_comparison")
    return [
        F.when(
            (F.col("damage") == "destroyed") & (F.col("case_count") == 0),
            _warning(
                "parcel", 0, "destroyed_no_epicla", "info",
                F.lit("parcel marked DESTROYED but has no EPIC-LA cases"),
            ),
        ),
        F.when(
            (area < rules.min_area) | (area > rules.max_area),
            _warning(
                "parcel", 1, "implausible_post_sfr_sqft", "data", F.concat(F.lit("post_sfr_sqft="), area)
            ),
        ),
        F.when(
            F.col("units_unknown"),
            _warning(
                "parcel", 2, "permit_all_unknown_structures", "data",
                F.lit("NEW_DWELLING_UNITS > 0 but description parsed as unknown"),
            ),
        ),
        F.when(
            compared.isNotNull() & claim.isNull(),
            _warning(
                "parcel", 3, "size_compared_without_lfl_signal", "info",
                F.concat(
                    F.lit("sfr_size_comparison="), compared, F.lit(" but no source states LFL/Custom")
                ),
            ),
        ),
        F.when(
            F.col("lfl_conflict"),
            _warning(
                "parcel", 4, "lfl_conflict", "data",
                F.lit(
                    "LFL/Custom signals disagreed across PROJECT_NAME / "
                    "DESCRIPTION fields; most-recent case's signal won"
                ),
            ),
        ),
    ]


def with_warnings(
    assigned: DataFrame, layer: str | None = None, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Adds ``warnings``, the list of a parcel row's warnings, without leaving the row.

    ``layer`` is the region column whose absence is worth a warning. Model warnings come first when the
    rows carry ``model_issues``.
    """
    items = _parcel_warnings(rules)
    if layer is not None:
        lost = _warning(
            "spatial", 0, "parcel_outside_census_tracts", "data",
            F.lit("parcel centroid did not fall inside any fetched census tract"),
        )
        items.append(F.when(F.col(layer).isNull(), lost))
    found = F.filter(F.array(*items), lambda w: w.isNotNull())
    if "model_issues" in assigned.columns:
        found = F.concat(
            F.transform(
                "model_issues",
                lambda m, i: F.struct(
                    F.lit(_PHASES["model"]).alias("phase"),
                    i.alias("code_ord"),
                    m["code"].alias("code"),
                    m["detail"].alias("detail"),
                    m["severity"].alias("severity"),
                ),
            ),
            found,
        )
    return assigned.withColumn("warnings", found)


def warnings(warned: DataFrame, disabled_reason: str | None = None) -> DataFrame:
    """All warnings, one row each. ``disabled_reason`` adds the notice that the model step was off."""
    out = warned.select("ain", "parcel_seq", F.inline("warnings"))
    if disabled_reason is not None:
        notice = warned.sparkSession.range(1).select(
            F.lit("*").alias("ain"),
            F.lit(None).cast("bigint").alias("parcel_seq"),
            F.inline(F.array(_warning("run", 0, "llm_disabled", "info", F.lit(disabled_reason)))),
        )
        out = out.unionByName(notice)
    return out


def report_order(rows: DataFrame) -> DataFrame:
    """Warnings in report order, with the published fields only."""
    return rows.orderBy("phase", "parcel_seq", "code_ord").select(*_WARNING_FIELDS)


# ---------------------------------------------------------------- gates


def _check(
    name: str, actual: Column, threshold: float, passed: Column, detail: Column
) -> list[Column]:
    return [
        F.lit(name).alias("name"),
        actual.cast("double").alias("actual"),
        F.lit(float(threshold)).alias("threshold"),
        passed.alias("passed"),
        detail.alias("detail"),
    ]


def _ratio(hits: Column, total: Column) -> Column:
    """Share of hits; 1.0 when there is nothing to count."""
    return F.coalesce(hits.cast("double") / F.nullif(total, F.lit(0)).cast("double"), F.lit(1.0))


def _as_rows(one: DataFrame, checks: list[list[Column]]) -> DataFrame:
    return one.select(F.inline(F.array(*[F.struct(*c) for c in checks])))


def _parcel_gates(rules: Rules) -> list[list[Column]]:
    parse = _ratio(F.col("parse_hits"), F.col("parse_candidates"))
    area = _ratio(F.col("area_hits"), F.col("area_candidates"))
    total = F.greatest(F.col("total"), F.lit(1))
    rate = F.col("flagged").cast("double") / total.cast("double")
    done = F.col("completed")
    return [
        _check(
            "description_parse_rate", parse, rules.min_parse_rate, parse >= rules.min_parse_rate,
            F.concat(
                F.col("parse_hits"), F.lit("/"), F.col("parse_candidates"),
                F.lit(" fire permits parsed to a structure"),
            ),
        ),
        _check(
            "sfr_sqft_extraction_rate", area, rules.min_area_rate, area >= rules.min_area_rate,
            F.concat(
                F.col("area_hits"), F.lit("/"), F.col("area_candidates"),
                F.lit(
                    " permits whose DESCRIPTION mentions SFR/SFD/SINGLE-FAMILY + sqft "
                    "were parsed as sfr+sqft"
                ),
            ),
        ),
        _check(
            "warning_rate", rate, rules.max_warning_rate, rate <= rules.max_warning_rate,
            F.concat(
                F.col("flagged"), F.lit("/"), total,
                F.lit(
                    " parcels raised at least one data-severity warning "
                    "(info-severity warnings excluded)"
                ),
            ),
        ),
        _check(
            "min_completed_rebuilds", done, rules.min_completed, done >= rules.min_completed,
            F.concat(done, F.lit(" parcels reported Construction Completed")),
        ),
    ]


def parcel_checks(warned: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The four gates on parcels, cases and warnings, from one aggregation over the parcel rows.

    The case tallies sit on the parcel rows, so a key that two parcels share counts twice.
    """
    has_data = F.exists("warnings", lambda w: w["severity"] == "data")
    one = warned.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("rebuild_progress_num") == 7).alias("completed"),
        F.countDistinct(F.when(has_data, F.col("ain"))).alias("flagged"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("parse_candidates", "parse_hits", "area_candidates", "area_hits")
        ],
    )
    return _as_rows(one, _parcel_gates(rules))


def region_total_check(cells: DataFrame, layer: str, region_rows: DataFrame) -> DataFrame:
    """Parcels in regions plus unassigned ones must be all parcels."""
    lost = F.when(F.col(layer).isNull(), F.col("total_parcels"))
    parcels = cells.agg(
        F.coalesce(F.sum("total_parcels"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(lost), F.lit(0)).alias("unassigned"),
    )
    regions = region_rows.agg(F.coalesce(F.sum("total_parcels"), F.lit(0)).alias("in_regions"))
    return _as_rows(with_one_row(parcels, regions), [_total_gate()])


def _total_gate() -> list[Column]:
    diff = F.col("total") - (F.col("in_regions") + F.col("unassigned"))
    return _check(
        "tract_total_matches_summary", diff, 0.0, diff == 0,
        F.concat(
            F.lit("sum(tract.total_parcels)="), F.col("in_regions"), F.lit(" + unassigned="),
            F.col("unassigned"), F.lit(" vs. burn-area total="), F.col("total"),
            F.lit(" (diff="), diff, F.lit(")"),
        ),
    )


def partition_totals(parents: DataFrame, children: DataFrame, key: str = "ct20") -> DataFrame:
    """Every parent region's total beside the sum of its children's; a parent without any gets 0."""
    sums = children.groupBy(key).agg(F.sum("total_parcels").alias("child_sum"))
    totals = parents.select(key, "region_idx", "total_parcels")
    return totals.join(sums, key, "left").fillna(0, ["child_sum"])


def partition_check(parents: DataFrame, children: DataFrame, key: str = "ct20") -> DataFrame:
    """Gate on :func:`partition_totals`: no parent may differ; the first three that do are named."""
    bad = partition_totals(parents, children, key).filter(F.col("total_parcels") != F.col("child_sum"))
    count = bad.agg(F.count(F.lit(1)).alias("bad"))
    text = _difference(key)
    first = (
        bad.orderBy("region_idx", key)
        .limit(3)
        .agg(F.sort_array(F.collect_list(F.struct("region_idx", text.alias("text")))).alias("first"))
    )
    return _as_rows(with_one_row(count, first), [_partition_gate()])


def _difference(key: str) -> Column:
    return F.concat(
        F.lit(f"{key}="), F.col(key), F.lit(" tract="), F.col("total_parcels"),
        F.lit(" bg_sum="), F.col("child_sum"),
    )


def _partition_gate() -> list[Column]:
    named = F.array_join(F.transform("first", lambda m: m["text"]), "; ")
    detail = F.concat(
        F.col("bad"), F.lit(" tract(s) disagree with their block-groups"),
        F.when(F.col("bad") > 0, F.concat(F.lit(": "), named)).otherwise(F.lit("")),
    )
    return _check("tract_partitions_into_block_groups", F.col("bad"), 0.0, F.col("bad") == 0, detail)


_TALLIES = ("total", "completed", "parse_candidates", "parse_hits", "area_candidates", "area_hits", "flagged")


def gate_cells(warned: DataFrame, parent: str, child: str) -> DataFrame:
    """What the gates count, for each pair of regions (``parent``, ``child``), in sums that add up.

    A parcel key may be flagged in several rows and regions. Rows are combined by flagged key and region first;
    of a key's regions the first one counts it, so that adding the cells up counts distinct keys.
    """
    data = F.exists("warnings", lambda w: w["severity"] == "data")
    by = [F.when(data, F.col("ain")).alias("_key"), F.col(parent).alias("parent"), F.col(child).alias("child")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TALLIES[2:-1]]
    some = warned.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("rebuild_progress_num") == 7).alias("completed"), *sums
    )
    place = F.row_number().over(Window.partitionBy("_key").orderBy("parent", "child"))
    counted = some.withColumn("flagged", (F.col("_key").isNotNull() & (place == 1)).cast("bigint"))
    return counted.groupBy("parent", "child").agg(*[F.sum(t).alias(t) for t in _TALLIES])


def gates(
    warned: DataFrame, layers: tuple[str, str], regions: DataFrame, subregions: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """The gates of :func:`quality_checks` from one pass over the parcel rows, each step reading only the one before.

    Cells meet the finer regions by key, then the coarser ones, as rows of one table that is added up by
    key, in place of a join for each question. ``layers`` names the columns of the regions (``ct20``) and of their
    parts (``bg20``). What is listed for a key is the cells and rows of one region.
    """
    zero = F.lit(0).cast("bigint")
    cells = gate_cells(warned, *layers)
    cell = F.struct("parent", *_TALLIES)
    no_cell, no_text = F.lit(None).cast(cells.select(cell.alias("c")).schema["c"].dataType), F.lit(None).cast("string")
    parts = cells.select("child", cell.alias("cell"), no_text.alias("of")).unionByName(
        subregions.select(F.col("bg20").cast("string").alias("child"), no_cell.alias("cell"), F.col("ct20").cast("string").alias("of"))
    )
    by_child = parts.groupBy("child").agg(F.collect_list("cell").alias("cells"), F.collect_list("of").alias("parents"))
    total = F.aggregate("cells", zero, lambda n, c: n + c["total"])
    own = F.when(F.col("child").isNotNull(), total).otherwise(zero)
    counted = F.transform("cells", lambda c: F.struct(
        c["parent"].alias("ct20"), *[c[t].alias(t) for t in _TALLIES], zero.alias("child_sum"), F.lit(None).cast("bigint").alias("idx"),
    ))
    summed = F.transform("parents", lambda p: F.struct(
        p.alias("ct20"), *[zero.alias(t) for t in _TALLIES], own.alias("child_sum"), F.lit(None).cast("bigint").alias("idx"),
    ))
    listed = regions.select(
        F.col("ct20").cast("string").alias("ct20"), *[zero.alias(t) for t in _TALLIES], zero.alias("child_sum"),
        F.col("region_idx").cast("bigint").alias("idx"),
    )
    rows = by_child.select(F.inline(F.concat(counted, summed))).unionByName(listed)
    by_parent = rows.groupBy("ct20").agg(*[F.sum(t).alias(t) for t in (*_TALLIES, "child_sum")], F.collect_list("idx").alias("idx"))
    by_parent = by_parent.withColumn("total_parcels", F.col("total"))
    known = F.col("ct20").isNotNull()
    wrong = F.when(known & (F.col("total") != F.col("child_sum")), F.size("idx")).otherwise(F.lit(0))
    named = F.transform("idx", lambda i: F.struct(i.alias("region_idx"), F.col("ct20"), _difference("ct20").alias("text")))
    one = by_parent.agg(
        *[F.coalesce(F.sum(t), zero).alias(t) for t in _TALLIES],
        F.coalesce(F.sum(F.when(~known, F.col("total"))), zero).alias("unassigned"),
        F.coalesce(F.sum(F.when(known, F.col("total") * F.size("idx"))), zero).alias("in_regions"),
        F.coalesce(F.sum(wrong), F.lit(0)).cast("bigint").alias("bad"),
        F.slice(F.sort_array(F.flatten(F.collect_list(F.when(wrong > 0, named)))), 1, 3).alias("first"),
    )
    return _as_rows(one, [*_parcel_gates(rules), _total_gate(), _partition_gate()])


def quality_checks(
    warned: DataFrame,
    layer: str | None = None,
    cells: DataFrame | None = None,
    region_rows: DataFrame | None = None,
    subregion_rows: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Every gate, one row each. Region gates need the region counts and are left out without them."""
    checks = [parcel_checks(warned, rules)]
    if layer is not None and cells is not None and region_rows is not None:
        checks.append(region_total_check(cells, layer, region_rows))
        if subregion_rows is not None:
            checks.append(partition_check(region_rows, subregion_rows))
    return reduce(DataFrame.unionByName, checks)


class QualityGateError(RuntimeError):
    """One or more gates failed; ``failed`` names them."""

    def __init__(self, failed: list[str]) -> None:
        self.failed = failed
        super().__init__("quality gate(s) failed: " + ", ".join(failed))


def failed_checks(checks: DataFrame) -> DataFrame:
    return checks.filter(~F.col("passed")).select("name")


def enforce(checks: DataFrame) -> None:
    """Raise when a gate failed. The check table has a handful of rows."""
    failed = [r["name"] for r in failed_checks(checks).collect()]
    if failed:
        raise QualityGateError(failed)
