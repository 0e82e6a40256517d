from __future__ import annotations

import dataclasses

import pytest
from builders import CASE, PARCEL, case, frame, parcel

from replat import config
from replat.config import DEFAULT_RULES
from replat.operators import cases, counts, parcels


def analyse(spark, parcel_rows, case_rows, partitions=None):
    p, c = frame(spark, PARCEL, parcel_rows), frame(spark, CASE, case_rows)
    if partitions:
        p, c = p.repartition(partitions), c.repartition(partitions)
    out = parcels.parcel_analysis(p, cases.case_rollup(cases.case_facts(c)))
    return {r["parcel_seq"]: r for r in out.collect()}


# (slot, cases, expected) of four checked parcels; places are left out of the texts
CHECKED = [
    (
        ("0120", 1232.0),
        [
            case(0, "A", modulename="PlanManagement", workclass_name="Rebuild", rebuild_progress_num=2.0,
                 apply_date=1752134400000.0, project_name="Non-like-for-like rebuild",
                 description="(EATON FIRE NON LIKE FOR LIKE) CONSTRUCTION OF NEW 1509 SQ. FT. SINGLE FAMILY DWELLING "
                             "TO REPLACE EXISTING SINGLE FAMILY DWELLING WITH ATTACHED 539 SQ. FT. GARAGE"),
            case(1, "A", rebuild_progress_num=6.0, apply_date=1756281600000.0, project_name="Non-like-for-like rebuild",
                 description="Eaton Non-Fire Like-for-Like Rebuild. Construction of a 1,680-square-foot single-family "
                             "residence with covered 90 sf front porch and attached 539-square-foot \ngarage"),
        ],
        {"pre_sfr_sqft": 1232, "post_sfr_sqft": 1680, "adds_sb9": False, "added_adu_count": 0,
         "rebuild_progress_num": 6, "lfl_claimed": True, "lfl_conflict": True, "sfr_size_comparison": "larger"},
    ),
    (
        ("0130", 1136.0),
        [
            case(0, "A", workclass_name="Rebuild Project", rebuild_progress_num=4.0,
                 description="1. NEW 2-STORY 1107 SF SB9 (2 BEDROOMS) WITH 464 SF ATTACHED GARAGE\n"
                             "2. NEW 2-STORY 1115 SF SFR WITH 50 SF PORCH\n3. NEW 1110 SF ADU \n4. NEW 1110 SF ADU "),
        ],
        {"pre_sfr_sqft": 1136, "post_sfr_sqft": 2222, "adds_sb9": True, "added_adu_count": 2,
         "rebuild_progress_num": 4, "lfl_claimed": None, "lfl_conflict": False, "sfr_size_comparison": "larger"},
    ),
    (
        ("0130", 2012.0),
        [
            case(0, "A", modulename="PlanManagement", workclass_name="Rebuild", rebuild_progress_num=2.0,
                 apply_date=1748937600000.0, project_name="Like-for-Like SFR Rebuild",
                 description="(EATON FIRE LIKE FOR LIKE) New single family home, 2,135 SF."),
            case(1, "A", rebuild_progress_num=6.0, apply_date=1753776000000.0, project_name="Like-for-Like SFR Rebuild",
                 description="EATON FIRE REBUILD - (N) 2,140 SF SFD WITH 413 SF ATTACHED GARAGE, 40 SF PORCH"),
        ],
        {"pre_sfr_sqft": 2012, "post_sfr_sqft": 2140, "adds_sb9": False, "added_adu_count": 0,
         "rebuild_progress_num": 6, "lfl_claimed": True, "lfl_conflict": False, "sfr_size_comparison": "larger"},
    ),
    (
        ("0130", 3062.0),
        [
            case(0, "A", rebuild_progress_num=7.0, project_name="Like-for-Like",
                 description="NEW 1-STORY 3,218 S.F. SINGLE FAMILY RESIDENCE WITH 102 S.F. PORCH"),
            case(1, "A", modulename="PlanManagement", workclass_name="Rebuild", rebuild_progress_num=2.0,
                 project_name="Like-for-Like", description="plan"),
        ],
        {"pre_sfr_sqft": 3062, "post_sfr_sqft": 3218, "adds_sb9": False, "added_adu_count": 0,
         "rebuild_progress_num": 7, "lfl_claimed": True, "lfl_conflict": False, "sfr_size_comparison": "larger"},
    ),
]


@pytest.mark.parametrize(("slot", "case_rows", "want"), CHECKED)
def test_checked_parcels(spark, slot, case_rows, want):
    row = analyse(spark, [parcel(0, "A", designtype1=slot[0], sqftmain1=slot[1])], case_rows)[0]
    assert {k: row[k] for k in want} == want


def claim(spark, *rows):
    r = analyse(spark, [parcel(0, "A")], [case(i, "A", **row) for i, row in enumerate(rows)])[0]
    return r["lfl_claimed"], r["lfl_conflict"]


OLD, NEW = 1.7e12, 1.75e12
YES, NO, SILENT = "LIKE-FOR-LIKE REBUILD", "NON-LIKE-FOR-LIKE REBUILD", "REBUILD"


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([{"project_name": NO, "description": YES}], (True, True)),
        ([{"project_name": YES, "description": SILENT}], (True, False)),
        ([{"apply_date": OLD, "description": NO}, {"apply_date": NEW, "description": YES}], (True, True)),
        ([{"apply_date": NEW, "description": SILENT}, {"apply_date": OLD, "description": NO}], (False, False)),
        ([{"description": SILENT}], (None, False)),
        ([{"apply_date": NEW, "description": YES}, {"apply_date": None, "description": NO}], (True, True)),
        ([{"apply_date": NEW, "description": NO}, {"apply_date": NEW, "description": YES}], (False, True)),
        ([{"description": YES}, {"description": NO, "disaster_type": "other"}], (True, False)),
    ],
)
def test_latest_claim(spark, rows, want):
    assert claim(spark, *rows) == want


def test_event_filter_accepts_label_or_text(spark):
    rows = [
        case(0, "A", disaster_type=None, description="eaton fire rebuild 900 SF SFR", rebuild_progress_num=3.0),
        case(1, "B", disaster_type=None, description=None, rebuild_progress_num=3.0),
        case(2, "C", disaster_type="other", description="900 SF SFR", rebuild_progress_num=3.0),
    ]
    got = analyse(spark, [parcel(0, "A"), parcel(1, "B"), parcel(2, "C")], rows)
    assert [got[i]["rebuild_progress_num"] for i in range(3)] == [3, None, None]
    assert [got[i]["case_count"] for i in range(3)] == [1, 1, 1]


def test_primary_pick_order_and_ties(spark):
    rows = [
        case(0, "A", rebuild_progress_num=None, description="100 SF SFR"),
        case(1, "A", rebuild_progress_num=5.0, description="200 SF SFR"),
        case(2, "A", rebuild_progress_num=5.0, description="300 SF SFR"),
        case(3, "A", rebuild_progress_num=7.0, workclass_name="Repair", description="400 SF SFR"),
        case(4, "B", rebuild_progress_num=None, description=None),
    ]
    got = analyse(spark, [parcel(0, "A"), parcel(1, "B"), parcel(2, "C")], rows)
    assert got[0]["post_sfr_sqft"] == 200
    assert got[0]["rebuild_progress_num"] == 7
    # a primary without text counts zero structures; no primary counts nothing
    assert (got[1]["post_sfr_count"], got[1]["post_sfr_sqft"]) == (0, None)
    assert (got[2]["post_sfr_count"], got[2]["lfl_claimed"], got[2]["adds_sb9"]) == (None, None, False)


def test_slots(spark):
    rows = [
        parcel(0, "A", designtype2="0120", sqftmain2=None),
        parcel(1, "B", usedescription=" SINGLE ", designtype1=None, designtype2="0110", sqftmain2=300.7),
        parcel(2, "C", usedescription="Multiple", designtype2="0110", sqftmain2=300.7),
        parcel(3, "D", designtype1="0210", designtype2="0300", sqftmain2=10.0, designtype3="0601", sqftmain3=9.0),
        parcel(4, "E", designtype1="", sqftmain1=77.0),
        parcel(5, "F", designtype1="0100", sqftmain1=None),
    ]
    got = analyse(spark, rows, [case(0, "Z")])
    want = {
        0: (1, 1500, 1, 0, 0, None), 1: (0, None, 1, 300, 0, None), 2: (2, 1800, 0, None, 0, None),
        3: (0, None, 0, None, 2, 1510), 4: (0, None, 0, None, 0, None), 5: (1, 0, 0, None, 0, None),
    }
    fields = [f"pre_{f}" for f in cases.POST_FIELDS]
    assert {i: tuple(r[f] for f in fields) for i, r in got.items()} == want


def test_added_units_never_negative(spark):
    rows = [parcel(0, "A", designtype2="0120", sqftmain2=100.0), parcel(1, "B")]
    texts = [case(0, "A", description="900 SF SFR"), case(1, "B", description="1. 9 SF ADU\n2. 8 SF ADU\n3. 7 SF JADU")]
    got = analyse(spark, rows, texts)
    assert [got[i]["added_adu_count"] for i in (0, 1)] == [0, 2]


def test_duplicate_parcel_keys_each_receive_the_cases(spark):
    rows = [case(0, "A", description="900 SF SFR"), case(1, "Z"), case(2, "Z"), case(3, " A")]
    p = frame(spark, PARCEL, [parcel(0, "A"), parcel(1, "A"), parcel(2, "B")])
    c = frame(spark, CASE, rows)
    joined = parcels.join_rollup(p, cases.case_rollup(cases.case_facts(c)))
    assert sorted((r["seq"], r["case_count"]) for r in joined.collect()) == [(0, 1), (1, 1), (2, 0)]
    orphans = parcels.orphan_keys(p, c)
    assert sorted((r["main_ain"], r["case_count"]) for r in orphans.collect()) == [(" A", 1), ("Z", 2)]
    got = parcels.match_counts(joined, orphans).first().asDict()
    assert got == {
        "parcels": 3, "parcels_with_case": 2, "parcels_without_case": 1, "orphan_keys": 2, "orphan_cases": 3,
    }


def test_one_key_with_most_cases_is_independent_of_partitions(spark):
    rows = [
        case(i, "HOT" if i % 3 else f"K{i}", rebuild_progress_num=float(i % 6), apply_date=float(i % 11),
             description=[f"{500 + i} SF SFR", YES, NO, None][i % 4])
        for i in range(600)
    ]
    ps = [parcel(0, "HOT"), parcel(1, "K3"), parcel(2, "HOT")]
    got = [analyse(spark, ps, rows, n) for n in (1, 8)]
    assert {k: r.asDict() for k, r in got[0].items()} == {k: r.asDict() for k, r in got[1].items()}
    assert got[0][0]["case_count"] == 400


def test_result_has_the_28_fields_in_order(spark):
    p, c = frame(spark, PARCEL, [parcel(0, "A")]), frame(spark, CASE, [case(0, "A")])
    out = parcels.results(parcels.parcel_analysis(p, cases.case_rollup(cases.case_facts(c))))
    assert out.columns == list(config.RESULT_FIELDS)
    assert len(out.columns) == 28


def test_other_event_is_a_parameter(spark):
    rules = dataclasses.replace(DEFAULT_RULES, event_label="Flood", event_text="flood")
    c = frame(spark, CASE, [case(0, "A", disaster_type="Flood"), case(1, "A")])
    flags = [r["is_event"] for r in cases.case_facts(c, rules).orderBy("seq").collect()]
    assert flags == [True, False]


RESULT = (
    "damage string, bsd_status string, rebuild_progress_num bigint, lfl_claimed boolean, pre_sfr_sqft bigint, "
    "post_sfr_sqft bigint, adds_sb9 boolean, added_adu_count bigint, post_sfr_count bigint, post_adu_count bigint"
)


def test_counts(spark):
    rows = [
        ("destroyed", "red", 7, True, 1000, 1100, True, 3, 1, 0),
        ("major", "yellow", 5, False, 1000, 699, False, 1, 1, 1),
        ("no_damage", "green", None, None, None, 900, False, 0, None, None),
        ("no_data", "none", 2, None, 0, 900, False, 2, 0, 2),
        ("minor", "none", 6, None, 1000, 1301, False, 5, 0, 0),
    ]
    got = counts.summary_counts(spark.createDataFrame(rows, RESULT)).first().asDict()
    assert got == {
        "total_parcels": 5, "damaged_parcels": 3, "destroyed_parcels": 1, "bsd_red_count": 1, "bsd_yellow_count": 1,
        "bsd_green_count": 1, "bsd_red_or_yellow_count": 2, "no_permit_count": 1, "permit_in_review_count": 1,
        "permit_issued_count": 1, "construction_count": 1, "completed_count": 1, "lfl_count": 1, "nlfl_count": 1,
        "lfl_unknown_count": 2, "sfr_size_pct_smaller_over_30": 1, "sfr_size_pct_smaller_10_to_30": 0,
        "sfr_size_pct_within_10": 1, "sfr_size_pct_larger_10_to_30": 0, "sfr_size_pct_larger_over_30": 1,
        "sfr_size_pct_unknown": 2, "sb9_count": 1, "adu_added_1_count": 1, "adu_added_2_count": 1,
        "adu_added_3_plus_count": 2, "dwelling_rebuild_count": 3,
    }
    assert list(got) == list(counts.COUNT_FIELDS)
    empty = counts.summary_counts(spark.createDataFrame([], RESULT)).first()
    assert set(empty) == {0}


def test_the_scan_reads_only_what_it_needs(spark, tmp_path):
    frame(spark, CASE, [case(0, "A")]).write.parquet(str(tmp_path / "c"))
    facts = cases.case_facts(spark.read.parquet(str(tmp_path / "c")))
    plan = cases.case_rollup(facts).select("main_ain", "max_progress")._jdf.queryExecution().toString()
    schema = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "casenumber" not in schema
    assert "project_name" not in schema
    assert "PythonUDF" not in plan
