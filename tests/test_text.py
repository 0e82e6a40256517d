from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from replat import config
from replat.functions import scalars, text


def parse(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: [(s["struct_type"], s["sqft"]) for s in r["s"]] for r in
           rows.select("i", text.structures(F.col("t")).alias("s")).collect()}
    return [got[i] for i in range(len(texts))]


CASES = {
    "NEW 1-STORY 3,218 S.F. SINGLE FAMILY RESIDENCE WITH 102 S.F. PORCH": [("sfr", 3218.0)],
    "(N) 2,140 SF SFD (4 BED)": [("sfr", 2140.0)],
    "New single family home, 2,135 SF. text": [("sfr", 2135.0)],
    "1. NEW 800 SF SFR\n2. NEW 500 SF JADU": [("sfr", 800.0), ("jadu", 500.0)],
    "NEW 2,400 SF DUPLEX": [("mfr", 2400.0)],
    "NEW 1-STORY 1,705 SFR (3 BED)": [("sfr", 1705.0)],
    "1. ONE STORY SFD 1412 SF\n2. NEW - 1 STORY ADU 735 SF": [("sfr", 1412.0), ("adu", 735.0)],
    "710 S.F. SB9 SFR (2 BEDROOMS)": [("sfr", 710.0)],
    "2-STORY 1107 SF SB9 (2 BEDROOMS) WITH 464 SF ATTACHED GARAGE": [("sfr", 1107.0)],
    "NEW 800 SF SB9 ADU": [("adu", 800.0)],
    "Placement of motor home on the lot": [("temporary_housing", None)],
    "Temp. Housing": [("temporary_housing", None)],
    "REPAIR AND ALTERATION": [("repair", None)],
    "VOLUNTARY SEISMIC RETROFIT": [("seismic", None)],
    "DAMAGED REPAIR EXISTING SFR 746 SF": [("sfr", 746.0)],
    "NEW RETAINING WALL, HEIGHT 5'": [("retaining_wall", None)],
    "a 1,680-square-foot single-family residence, 90 sf porch, 539-square-foot garage": [("sfr", 1680.0)],
    "NEW 1,200 SQUARE FOOT SFR": [("sfr", 1200.0)],
    "NEW 850 sq. ft. ADU": [("adu", 850.0)],
    "3,218 SQFT SFR": [("sfr", 3218.0)],
    "JUNIOR ADU 400 SF": [("jadu", 400.0)],
    "GARAGE REPAIR 200 SF": [("garage", 200.0)],
    "rebuild project": [("unknown", None)],
    "something of 300 SF, or 500 SF": [("unknown", 300.0)],
    "100 SF SFR 100 SF": [("sfr", 100.0)],
    "ADU IN PLACE OF SFR": [("adu", None)],
    "": [],
    "   \t\n": [],
    None: [],
    "1.\nSFR": [("sfr", 1.0)],
    "1. ": [],
    "1. SFR\r\n2. ADU": [("sfr", None), ("adu", None)],
    "A\r1. SFR": [("sfr", 1.0)],
    "1. SFR\r2. ADU": [("sfr", None), ("adu", None)],
    "PRE\n 1. SFR\n\n2. ADU\nmore ADU": [("unknown", None), ("sfr", None), ("adu", None)],
    "naïve 12 SF café SFR 900 SF": [("sfr", 900.0)],
    "ümlautSFR 900 SF": [("unknown", 900.0)],
    "SFR\x00 700 SF \x02 ADU": [("sfr", 700.0)],
    "😀😀 100 SF 😀😀😀😀 SFR 😀 300 SF": [("sfr", 300.0)],
}


def test_structures_of_known_texts(spark):
    got = parse(spark, list(CASES))
    for (given_text, want), have in zip(CASES.items(), got, strict=True):
        assert have == want, given_text


def test_tier_patterns_start_at_a_word_boundary():
    """The shared boundary in front of a tier's alternation is only right if each alternative has it."""
    for tier in config.TYPE_TIERS:
        for _, pattern in tier:
            bare = re.sub(r"\((?:[^()]|\([^()]*\))*\)", "", pattern)
            assert all(part.startswith(r"\b") for part in bare.split("|")), pattern


def brute_force(segment):
    """Position-by-position reading of one segment, for comparison on random word sequences."""
    areas = [(m.start(), float(m.group(1).replace(",", ""))) for m in re.finditer(config.AREA, segment, re.I)]
    for tier in config.TYPE_TIERS:
        hits = [(m.start(), label) for label, rx in tier for m in re.finditer(rx, segment, re.I)]
        if hits:
            at, label = sorted(hits)[0]
            best = sorted((abs(pos - at), i) for i, (pos, _) in enumerate(areas))
            return label, areas[best[0][1]][1] if best else None
    return "unknown", areas[0][1] if areas else None


WORDS = [
    "SFR", "SFD", "ADU", "ADUS", "JADU", "DUPLEX", "SB9", "SB-9", "GARAGE", "RV", "REPAIR", "GRADING", "900 SF",
    "1,200 S.F.", "300-square-foot", "45", "SF", "é", "NEW", "JUNIOR ADU", "TEMP. HOUSING", "single family", "-", ",",
]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=9), min_size=20, max_size=40))
def test_structures_equal_brute_force(spark, sentences):
    texts = [" ".join(s) for s in sentences]
    for given_text, have in zip(texts, parse(spark, texts), strict=True):
        assert have == [brute_force(given_text)], given_text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("given_text", "want"),
    [
        ("Like-for-Like SFR Rebuild", True),
        ("like for like", True),
        ("Non-Like-for-Like rebuild", False),
        ("non like for like, like for like", False),
        ("Rebuild @ 1 Some St", None),
        ("", None),
        (None, None),
    ],
)
def test_claim_signal(spark, given_text, want):
    assert one(spark, text.claim_signal(F.lit(given_text).cast("string"))) is want


@pytest.mark.parametrize(
    ("given_text", "want"),
    [("1107 SF SB9 unit", True), ("SB-9", True), ("sb 9 lot", True), ("Senate Bill 9", True), ("XSB9", False), (None, False)],
)
def test_pathway_mentions(spark, given_text, want):
    assert one(spark, text.mentions_pathway(F.lit(given_text).cast("string"))) is want


def test_totals_distinguish_zero_and_null(spark):
    rows = spark.createDataFrame([("1. NEW SFR\n2. 500 SF ADU\n3. 250.5 SF ADU",)], "t string")
    got = rows.select(text.structure_totals(text.structures(F.col("t"))).alias("x")).first()["x"]
    assert (got["sfr_count"], got["sfr_sqft"]) == (1, None)
    assert (got["adu_count"], got["adu_sqft"]) == (2, 750.5)
    assert (got["mfr_count"], got["mfr_sqft"]) == (0, None)


@pytest.mark.parametrize(
    ("pre", "post", "want"),
    [
        (1000, 699, "smaller_over_30"), (1000, 700, "smaller_10_to_30"), (1000, 899, "smaller_10_to_30"),
        (1000, 900, "within_10"), (1000, 1100, "within_10"), (1000, 1101, "larger_10_to_30"),
        (1000, 1300, "larger_10_to_30"), (1000, 1301, "larger_over_30"), (0, 900, "unknown"),
        (None, 900, "unknown"), (900, None, "unknown"),
    ],
)
def test_size_buckets(spark, pre, post, want):
    args = [F.lit(v).cast("bigint") for v in (pre, post)]
    assert one(spark, scalars.size_bucket(*args)) == want


@pytest.mark.parametrize(
    ("ms", "want"),
    [
        (0.0, "1970-01-01"), (-1.0, "1969-12-31"), (1752134400000.0, "2025-07-10"), (86399999.0, "1970-01-01"),
        (None, "(unknown)"), (1e18, "(invalid)"),
    ],
)
def test_epoch_days_ignore_the_session_zone(spark, ms, want):
    assert one(spark, scalars.epoch_ms_date(F.lit(ms).cast("double"))) == want


@pytest.mark.parametrize("value", ["plain", 'q"uote', "back\\slash", "tab\t", "é", "😀", "\x01", ""])
def test_json_strings_equal_the_standard_encoder(spark, value):
    import json

    rows = spark.createDataFrame([(value,)], "t string")
    assert rows.select(scalars.json_string(F.col("t")).alias("v")).first()["v"] == json.dumps(value)


def test_trim_and_lookup_rules(spark):
    assert one(spark, scalars.safety_tag(F.lit(" Red\t"))) == "red"
    assert one(spark, scalars.safety_tag(F.lit("Blue"))) == "none"
    assert one(spark, scalars.damage_level(F.lit("Destroyed (>50%) "))) == "no_data"
    assert one(spark, scalars.damage_level(F.lit(None).cast("string"))) == "no_data"
    assert one(spark, scalars.progress_label(F.lit(8).cast("bigint"))) is None
    assert one(spark, scalars.stripped_or_null(F.lit(" \n"))) is None
    assert one(spark, scalars.int_or_zero(F.lit("x"))) == 0
