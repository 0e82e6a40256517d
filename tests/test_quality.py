from __future__ import annotations

import random

import pytest
from builders import CASE, PARCEL, case, frame, parcel
from pyspark.sql import functions as F

from replat.operators import cases, parcels, quality, reports
from replat.operators.counts import COUNT_FIELDS


def warned(spark, parcel_rows, case_rows):
    p, c = frame(spark, PARCEL, parcel_rows), frame(spark, CASE, case_rows)
    analysis = parcels.parcel_analysis(p, cases.case_rollup(cases.case_facts(c)))
    return quality.with_warnings(analysis)


def codes(spark, *case_rows, **more):
    rows = warned(spark, [parcel(0, "A", **more)], [case(i, "A", **r) for i, r in enumerate(case_rows)])
    return [(r["code"], r["severity"]) for r in quality.report_order(quality.warnings(rows)).collect()]


LFL = {"project_name": "like for like"}


@pytest.mark.parametrize(
    ("case_rows", "more", "want"),
    [
        ([], {}, [("destroyed_no_epicla", "info")]),
        ([], {"damage_1": "Major (26-50%)"}, []),
        ([{"disaster_type": "other"}], {}, []),
        ([{"description": "199 SF SFR", **LFL}], {}, [("implausible_post_sfr_sqft", "data")]),
        ([{"description": "200 SF SFR", **LFL}], {}, []),
        ([{"description": "20,000 SF SFR", **LFL}], {}, []),
        ([{"description": "20,001 SF SFR", **LFL}], {}, [("implausible_post_sfr_sqft", "data")]),
        ([{"description": "1500 SF SFR"}], {}, [("size_compared_without_lfl_signal", "info")]),
        ([{"description": "rebuild", "new_dwelling_units": 1.0}], {}, [("permit_all_unknown_structures", "data")]),
        ([{"description": "rebuild", "new_dwelling_units": 0.0}], {}, []),
        ([{"description": " ", "new_dwelling_units": 1.0}], {}, []),
        # the first permit with units decides, whatever its event
        ([{"description": "GARAGE", "new_dwelling_units": 1.0, "disaster_type": "x"},
          {"description": "rebuild", "new_dwelling_units": 1.0}], {}, []),
        ([{"description": "rebuild", "new_dwelling_units": 1.0, "modulename": "PlanManagement"}], {}, []),
        ([{"description": "non-like-for-like", **LFL}], {}, [("lfl_conflict", "data")]),
    ],
)
def test_parcel_warnings(spark, case_rows, more, want):
    assert codes(spark, *case_rows, **more) == want


def checks(df):
    return {r["name"]: r for r in df.collect()}


def test_rates_and_thresholds(spark):
    texts = ["900 SF SFR", "ADU 800 SF SFD", "rebuild", None, ""]
    rows = [case(i, "A", description=t, project_name="like for like") for i, t in enumerate(texts)]
    rows += [case(9, "A", description="900 SF SFR", disaster_type="x"), case(10, "ORPHAN", description="rebuild")]
    rows += [case(11, "A", description="900 SF SFR", modulename="PlanManagement")]
    # two parcel rows with one key: its cases count twice
    got = checks(quality.quality_checks(warned(spark, [parcel(0, "A"), parcel(1, "A")], rows)))
    assert got["description_parse_rate"]["actual"] == 4 / 6
    assert got["description_parse_rate"]["detail"] == "4/6 fire permits parsed to a structure"
    assert got["sfr_sqft_extraction_rate"]["actual"] == 4 / 6
    assert got["warning_rate"]["actual"] == 0.0
    assert (got["min_completed_rebuilds"]["actual"], got["min_completed_rebuilds"]["passed"]) == (0.0, False)


def test_empty_denominators_pass(spark):
    got = checks(quality.quality_checks(warned(spark, [parcel(0, "A")], [case(0, "Z")])))
    assert got["description_parse_rate"]["actual"] == got["sfr_sqft_extraction_rate"]["actual"] == 1.0
    assert got["warning_rate"]["detail"].startswith("0/1 parcels")


def test_flagged_parcels_count_once(spark):
    rows = [case(0, "A", description="100 SF SFR non-like-for-like", project_name="like for like")]
    got = checks(quality.quality_checks(warned(spark, [parcel(0, "A"), parcel(1, "A"), parcel(2, "B")], rows)))
    assert got["warning_rate"]["actual"] == 1 / 3
    assert not got["warning_rate"]["passed"]


def regional(spark, rows, *keys):
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in keys) + ", region_idx int, total_parcels bigint")
    return df


def test_region_gates(spark):
    tracts = regional(spark, [("1", 0, 5), ("2", 1, 7), ("3", 2, 1), ("4", 3, 1), ("5", 4, 2)], "ct20")
    groups = regional(spark, [("1", "1a", 0, 2), ("1", "1b", 1, 3), ("2", "2a", 2, 6), ("9", "9a", 3, 4)], "ct20", "bg20")
    cells = spark.createDataFrame([("1", 16), (None, 2)], "tract string, total_parcels bigint")
    total = quality.region_total_check(cells, "tract", tracts).first()
    assert (total["actual"], total["passed"]) == (0.0, True)
    assert total["detail"] == "sum(tract.total_parcels)=16 + unassigned=2 vs. burn-area total=18 (diff=0)"
    lost = quality.region_total_check(cells, "tract", tracts.filter("ct20 <> '5'")).first()
    assert (lost["actual"], lost["passed"]) == (2.0, False)
    bad = quality.partition_check(tracts, groups).first()
    assert (bad["actual"], bad["passed"]) == (4.0, False)
    assert bad["detail"] == (
        "4 tract(s) disagree with their block-groups: ct20=2 tract=7 bg_sum=6; ct20=3 tract=1 bg_sum=0; "
        "ct20=4 tract=1 bg_sum=0"
    )
    good = quality.partition_check(tracts.filter("ct20 = '1'"), groups).first()
    assert (good["passed"], good["detail"]) == (True, "0 tract(s) disagree with their block-groups")


def test_failed_gate_raises_with_its_name(spark):
    df = spark.createDataFrame([("a", True), ("b", False)], "name string, passed boolean")
    with pytest.raises(quality.QualityGateError) as caught:
        quality.enforce(df)
    assert caught.value.failed == ["b"]
    quality.enforce(df.filter("passed"))


def summary(spark, **values):
    row = {n: 0 for n in COUNT_FIELDS} | values
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} bigint" for n in row))


def test_shares(spark):
    s = summary(spark, sfr_size_pct_within_10=1, adu_added_1_count=2, dwelling_rebuild_count=3, lfl_count=1, nlfl_count=2)
    got = {(r["chart"], r["label"]): r["share_pct"] for r in reports.bucket_shares(s).collect()}
    assert got["size", "±10%"] == 33.3
    assert got["added_units", "+1 ADU"] == 66.7
    assert ("added_units", "+3 or more") not in got
    assert len(got) == 7
    more = reports.bucket_shares(summary(spark, adu_added_3_plus_count=1)).collect()
    assert {r["share_pct"] for r in more} == {None}
    assert len(more) == 8
    claims = {r["label"]: r["share_pct"] for r in reports.claim_shares(s).collect()}
    assert claims == {"Like-for-like": 33.0, "Not like-for-like": 67.0, "Not specified": 0.0}
    assert {r["share_pct"] for r in reports.claim_shares(summary(spark)).collect()} == {0.0}


def test_warning_tables(spark):
    rows = spark.createDataFrame(
        [("B", "x", "data", 2, 1, 0), ("A", "y", "info", 2, 0, 0), ("A", "x", "data", 2, 0, 1)],
        "ain string, code string, severity string, phase int, parcel_seq bigint, code_ord int",
    ).withColumn("detail", F.lit(""))
    assert [tuple(r) for r in reports.warning_rollup(rows).collect()] == [("x", 2), ("y", 1)]
    by_ain = reports.warning_table(rows, None, "ain").collect()
    assert [(r["ain"], r["code"]) for r in by_ain] == [("A", "y"), ("A", "x"), ("B", "x")]
    assert reports.warning_table(rows, "info").count() == 1
    with pytest.raises(ValueError, match="cannot sort"):
        reports.warning_table(rows, None, "detail")


def test_freshness(spark):
    runs = spark.createDataFrame([("2025-01-01T00:00:00+00:00",), ("2025-01-04T23:00:00Z",)], "generated_at string")
    as_of = F.lit("2025-01-05T00:00:01Z")
    assert [r["is_stale"] for r in reports.freshness(runs, as_of).collect()] == [True, False]


def test_gates_in_one_pass_equal_the_separate_ones(spark):
    rng = random.Random(6)
    tracts, groups = ["1", "2", "3", "4"], ["1a", "1b", "2a", "3a", "9a"]
    rows = []
    for i in range(300):
        # keys come back in other regions; some parts lie in another tract than their own
        child = rng.choice([*groups, None])
        parent = rng.choice([child[0] if child and rng.random() < 0.8 else rng.choice(tracts), None if rng.random() < 0.2 else "2"])
        severity = rng.choice(["data", "info"])
        rows.append((f"P{rng.randrange(40)}", parent, child, rng.choice([7, 6, None]), [(severity,)] * rng.randrange(2), rng.randrange(3), 0, 4, 3))
    shape = (
        "ain string, tract string, block_group string, rebuild_progress_num int, warnings array<struct<severity:string>>, "
        "parse_candidates long, parse_hits long, area_candidates long, area_hits long"
    )
    for some in (rows, rows[:1], []):
        df = spark.createDataFrame(some, shape).repartition(3)
        regions = spark.createDataFrame([(t, i) for i, t in enumerate([*tracts, "7", "2"])], "ct20 string, region_idx int")
        parts = spark.createDataFrame([("1a", "1", 0), ("1b", "1", 1), ("2a", "2", 2), ("3a", "3", 3), ("3a", "4", 4), ("5a", "8", 5)], "bg20 string, ct20 string, region_idx int")
        by_region = [df.groupBy(c).agg(F.count(F.lit(1)).alias("total_parcels")) for c in ("tract", "block_group")]
        cells = df.groupBy("tract", "block_group").agg(F.count(F.lit(1)).alias("total_parcels"))
        per_tract = regions.join(by_region[0], F.col("ct20") == F.col("tract"), "left").fillna(0, ["total_parcels"])
        per_part = parts.join(by_region[1], F.col("bg20") == F.col("block_group"), "left").fillna(0, ["total_parcels"])
        want = quality.quality_checks(df, "tract", cells, per_tract, per_part).collect()
        got = quality.gates(df, ("tract", "block_group"), regions, parts)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want]
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") <= 7  # one of them deals the test rows
