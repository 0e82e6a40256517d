from __future__ import annotations

import dataclasses
import hashlib
import json

import pytest
from builders import CASE, PARCEL, case, frame, parcel
from pyspark.sql import functions as F

from replat.config import DEFAULT_RULES
from replat.operators import cases, extraction, parcels, prompts, quality, ranking

RULES = dataclasses.replace(DEFAULT_RULES, model="m")


def key_of(ain, records, model="m", version=2):
    hashes = []
    for number, text in records:
        pair = json.dumps([number or "", hashlib.sha256((text or "").encode()).hexdigest()])
        hashes.append(hashlib.sha256(pair.encode()).hexdigest())
    sums = [sum(int(h[i : i + 15], 16) for h in hashes) for i in (0, 15, 30, 45)]
    body = json.dumps({"ain": ain, "model": model, "prompt_version": version, "records": len(records), "sums": sums})
    return "sha256:" + hashlib.sha256(body.encode()).hexdigest()


def keys(spark, rows, rules=RULES):
    out = extraction.content_keys(frame(spark, CASE, rows), rules).collect()
    assert len({r["main_ain"] for r in out}) == len(out)
    return {r["main_ain"]: r["key"] for r in out}


def test_content_key_format(spark):
    rows = [
        case(0, "A", casenumber="C2", description="é text"), case(1, "A", casenumber=None, description=None),
        case(2, "A", casenumber="C2", description="é text"), case(3, 'B"é', casenumber="x\\", description="d"),
    ]
    got = keys(spark, rows)
    assert got["A"] == key_of("A", [("C2", "é text"), (None, None), ("C2", "é text")])
    assert got['B"é'] == key_of('B"é', [("x\\", "d")])


def test_content_key_ignores_order_and_status(spark):
    a = [case(0, "A", casenumber="1", description="x"), case(1, "A", casenumber="2", description="y")]
    b = [dict(a[1], status="Issued", rebuild_progress_num=7.0), a[0]]
    assert keys(spark, a) == keys(spark, b)
    assert keys(spark, a) != keys(spark, [a[0], dict(a[1], description="z")])
    assert keys(spark, a) != keys(spark, a, dataclasses.replace(RULES, model="other"))
    assert keys(spark, a) != keys(spark, a, dataclasses.replace(RULES, prompt_version=3))


def test_one_rule_for_keys_of_any_size(spark):
    """One key holds a third of all rows; any order and any partitioning give the same keys."""
    hot = [case(i, "HOT", casenumber=f"C{i}", description=f"d{i}") for i in range(400)]
    rows = [*hot, *[case(1000 + i, f"k{i % 200}", casenumber=f"C{i}", description="same") for i in range(800)]]
    got = keys(spark, rows)
    assert got["HOT"] == key_of("HOT", [(r["casenumber"], r["description"]) for r in hot])
    assert keys(spark, list(reversed(rows))) == got
    assert keys(spark, rows[1:])["HOT"] != got["HOT"]
    assert keys(spark, [*rows, rows[0]])["HOT"] != got["HOT"]
    plan = extraction.content_keys(frame(spark, CASE, rows), RULES)._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "collect_list" not in plan


def brute_prompt(ain, rows):
    lines = [
        "PARCEL CONTEXT", f"AIN: {ain}", "Address: (unknown)", "DAMAGE: destroyed",
        "Pre-fire structures (from DINS): 1 SFR (1500 SF total)", "",
        f"RECORDS ({len(rows)} qualifying, sorted by APPLY_DATE):", "",
    ]
    for i, r in enumerate(sorted(rows, key=lambda r: (r["apply_date"] or 0, r["seq"])), 1):
        text = r.get("description") or "(blank)"
        lines += [
            f"[{i}] CASENUMBER:     {r['casenumber']}", "    MODULENAME:     PermitManagement",
            "    WORKCLASS:      New", "    PROJECT_NUMBER: (none)", "    PROJECT_NAME:   (none)",
            "    STATUS:         (unknown)", "    PROGRESS:       5 (Construction Started)",
            "    APPLY_DATE:     2023-11-14" if r["apply_date"] else "    APPLY_DATE:     (unknown)",
            "    DESCRIPTION:", *["      " + s for s in text.splitlines()], "",
        ]
    return "\n".join(lines)


def test_prompts_in_parts(spark):
    hot = [case(i, "HOT", apply_date=None if i % 3 else 1.7e12, description=f"a\nb{i}") for i in range(30)]
    few = [case(100, "A", description=None), case(101, "A", apply_date=None, description="x\r\ny")]
    p = frame(spark, PARCEL, [parcel(0, "HOT"), parcel(1, "A"), parcel(2, "HOT"), parcel(3, "NONE")])
    out = prompts.user_prompts(p, frame(spark, CASE, hot + few), RULES).collect()
    texts = {}
    for r in sorted(out, key=lambda r: (r["parcel_seq"], r["part"])):
        texts.setdefault(r["parcel_seq"], []).append(r["user_prompt"])
    assert {k: len(v) for k, v in texts.items()} == {0: 31, 1: 3, 2: 31}
    assert "\n".join(texts[0]) == "\n".join(texts[2]) == brute_prompt("HOT", hot)
    assert "\n".join(texts[1]) == brute_prompt("A", few)


def test_positions_in_groups_of_any_size(spark):
    day = ranking.DAY_MS
    rows = [(("HOT" if i % 3 else f"k{i % 7}"), float((i * 37) % 11 * day // 3), i * (1 + i % 2 * 5000)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, d double, seq long").repartition(5)
    got = {(r["k"], r["d"], r["seq"]): r["position"] for r in ranking.position_in_group(df, "k", "d", "seq").collect()}
    for key in {r[0] for r in rows}:
        ordered = sorted(r for r in rows if r[0] == key)
        assert [got[r] for r in ordered] == list(range(1, len(ordered) + 1))


def parsed(spark, contents):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(contents)], "i int, content string")
    return [r for r in extraction.parse_replies(df).orderBy("i").collect()]


def test_reply_forms(spark):
    whole = '{"structures": [{"struct_type": "sfr", "sqft": 10, "confidence": "high"}], "reasoning": "r"}'
    got = parsed(
        spark,
        [
            whole, f"```json\n{whole}\n```", f"text\n```JSON {whole}```tail", f"{whole} x", "[1]", "null", "5", "", None,
            "```json\n{bad}\n```", '{"reasoning": 5}', f"  {whole}\n", '{"a":1},{"b":2}',
        ],
    )
    assert [r["ok"] for r in got] == [
        True, True, True, False, False, False, False, False, False, False, True, True, False,
    ]
    assert all(got[i]["structures"][0]["sqft"] == 10 for i in (0, 1, 2, 11))
    assert got[10]["structures"] == []
    assert got[10]["reasoning"] == "5"
    assert got[3]["structures"] is None


def test_structure_coercion(spark):
    items = [
        {"struct_type": "Barn", "sqft": "900", "confidence": "sure", "evidence_case_numbers": "C1", "notes": ""},
        {"struct_type": "ADU", "sqft": 1200.9, "confidence": "HIGH", "evidence_case_numbers": ["C1", "", 5, None, 0, "0"]},
        7, "x", None, [], {"sqft": True}, {"struct_type": None, "sqft": None, "notes": "n"}, {"sqft": -3.7},
    ]
    row = parsed(spark, [json.dumps({"structures": items})])[0]
    got = [tuple(s) for s in row["structures"]]
    assert got == [
        ("other", None, "low", [], None),
        ("adu", 1200, "high", ["C1", "5", "0"], None),
        ("other", 1, "low", [], None),
        ("other", None, "low", [], "n"),
        ("other", -3, "low", [], None),
    ]
    assert row["reasoning"] == ""


def overlay(spark, case_rows, replies, parcel_rows=None):
    p = frame(spark, PARCEL, parcel_rows or [parcel(0, "A")])
    analysis = parcels.parcel_analysis(p, cases.case_rollup(cases.case_facts(frame(spark, CASE, case_rows))))
    df = spark.createDataFrame(replies, "ain string, content string")
    given = extraction.parse_replies(df).filter("ok")
    return extraction.apply_extractions(analysis, given, RULES)


def reply(*structures, reasoning="why"):
    keyed = [dict(zip(("struct_type", "sqft", "confidence"), s, strict=True)) for s in structures]
    return json.dumps({"structures": keyed, "reasoning": reasoning})


def codes(row):
    return [i["code"] for i in row["model_issues"]]


@pytest.mark.parametrize(
    ("text", "answer", "want"),
    [
        ("1500 SF SFR", reply(("sfr", 1575, "high")), []),
        ("1000 SF SFR", reply(("sfr", 1500, "high")), ["extraction_sqft_disagreement"]),
        ("1000 SF SFR", reply(("sfr", None, "high")), []),
        ("1000 SF SFR", reply(("sfr", 1100, "high")), []),
        ("1000 SF SFR", reply(("sfr", 1000, "high"), ("adu", 5, "low")),
         ["extraction_count_disagreement", "extraction_low_confidence"]),
        ("1000 SF JADU", reply(("jadu", 1000, "high")), ["extraction_count_disagreement"]),
        ("1000 SF SFR", "nothing", ["llm_extraction_failed"]),
        ("GARAGE", reply(("garage", 100, "high")), []),
    ],
)
def test_comparison_codes(spark, text, answer, want):
    row = overlay(spark, [case(0, "A", description=text)], [("A", answer)]).first()
    assert codes(row) == want


def test_override_recomputes_only_what_depends_on_it(spark):
    rows = [case(0, "A", description="SB9 LIKE FOR LIKE 1000 SF SFR", rebuild_progress_num=6.0)]
    row = overlay(spark, rows, [("A", reply(("sfr", 1505, "high"), ("adu", 300, "high"), ("jadu", 200, "high")))]).first()
    assert (row["post_sfr_sqft"], row["post_adu_count"], row["post_adu_sqft"], row["post_mfr_count"]) == (1505, 2, 500, 0)
    assert (row["added_adu_count"], row["sfr_size_comparison"]) == (2, "identical")
    assert (row["adds_sb9"], row["lfl_claimed"], row["rebuild_progress_num"]) == (True, True, 6)


def test_routing_of_plan_only_skipped_and_failed_parcels(spark):
    plan = {"modulename": "PlanManagement", "workclass_name": "Rebuild"}
    rows = [
        case(0, "PLAN", description="900 SF SFR", **plan), case(1, "SKIP", workclass_name="Repair"),
        case(2, "FAIL", description="900 SF SFR"), case(3, "OTHER", disaster_type="x", **plan),
        case(4, "EMPTY", **plan),
    ]
    ps = [parcel(i, a) for i, a in enumerate(["PLAN", "SKIP", "FAIL", "OTHER", "EMPTY", "NOCASE"])]
    answers = [("PLAN", reply(("sfr", 900, "high"))), ("SKIP", reply(("sfr", 1, "high"))), ("EMPTY", reply())]
    got = {r["ain"]: r for r in overlay(spark, rows, answers, ps).collect()}
    status = {a: r["model_status"] for a, r in got.items()}
    assert status == {
        "PLAN": "extracted", "SKIP": "skipped", "FAIL": "failed", "OTHER": "skipped", "EMPTY": "extracted",
        "NOCASE": "skipped",
    }
    assert codes(got["PLAN"]) == ["extraction_only_llm"]
    assert (codes(got["EMPTY"]), codes(got["SKIP"])) == ([], [])
    assert got["FAIL"]["post_sfr_sqft"] == 900
    assert (got["SKIP"]["post_sfr_count"], got["EMPTY"]["post_sfr_count"]) == (None, 0)


def test_long_reasoning_is_cut_in_details(spark):
    rows = [case(0, "A", description="900 SF SFR")]
    row = overlay(spark, rows, [("A", reply(reasoning="x" * 500))]).first()
    assert row["model_issues"][0]["detail"] == "sfr: regex=1, llm=0; reasoning: " + "x" * 160


def test_metrics_count_parcels_once_per_code(spark):
    info = spark.createDataFrame(
        [(True, "m", 2, 9, 8, 1, 2, 3, 5)],
        "enabled boolean, model string, prompt_version bigint, parcels_attempted bigint, parcels_extracted bigint, "
        "parcels_failed bigint, plan_only_parcels bigint, cache_hits bigint, cache_misses bigint",
    )
    c, s, low, f = (
        "extraction_count_disagreement", "extraction_sqft_disagreement", "extraction_low_confidence",
        "llm_extraction_failed",
    )
    rows = [("A", c), ("A", c), ("B", c), ("A", s), ("A", low), ("Z", f), ("Q", "lfl_conflict")]
    got = extraction.extraction_metrics(info, spark.createDataFrame(rows, "ain string, code string")).first()
    assert got["agreement_rate"] == 0.625
    assert [got[n] for n in ("count_disagreements", "sqft_disagreements", "low_confidence_parcels", "extraction_failures")] == [2, 1, 1, 1]
    none = extraction.extraction_metrics(
        info.withColumn("parcels_extracted", F.lit(0)), spark.createDataFrame([], "ain string, code string")
    )
    assert none.first()["agreement_rate"] == 1.0


def test_cache_reuse_and_prune(spark):
    rows = frame(spark, CASE, [case(0, "A", description="x"), case(1, "B", description="y"), case(2, "GONE")])
    k = extraction.content_keys(rows, RULES)
    stored = k.filter("main_ain <> 'B'").select("key", F.col("main_ain").alias("ain"))
    assert [r["main_ain"] for r in extraction.cache_misses(k, stored).collect()] == ["B"]
    p = frame(spark, PARCEL, [parcel(0, "A"), parcel(1, "B"), parcel(2, "A")])
    assert [r["ain"] for r in extraction.prune_cache(stored, p).collect()] == ["A"]
    inputs = extraction.extraction_inputs(rows, k).collect()
    assert sorted((r["seq"], r["case_number"]) for r in inputs) == [(0, "C0"), (1, "C1"), (2, "C2")]


def test_no_model_warning_leaks_without_the_model(spark):
    p = frame(spark, PARCEL, [parcel(0, "A")])
    analysis = parcels.parcel_analysis(p, cases.case_rollup(cases.case_facts(frame(spark, CASE, [case(0, "B")]))))
    rows = quality.warnings(quality.with_warnings(analysis), "switched off")
    got = [tuple(r) for r in quality.report_order(rows).collect()]
    assert got == [
        ("*", "llm_disabled", "switched off", "info"),
        ("A", "destroyed_no_epicla", "parcel marked DESTROYED but has no EPIC-LA cases", "info"),
    ]
