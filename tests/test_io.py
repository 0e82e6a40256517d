from __future__ import annotations

import csv
import dataclasses
import json
import pathlib
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pytest
from builders import EVENT
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES
from replat.operators import extraction, quality
from replat.plans import rebuild
from replat.sinks import tables
from replat.sources import cache, documents, snapshots, validation
from replat.streaming import intake

RULES = dataclasses.replace(
    DEFAULT_RULES, model="m", min_parse_rate=0.0, min_area_rate=0.0, max_warning_rate=1.0, min_completed=0
)


def ring(x, y, half):
    return [[[x - half, y - half], [x + half, y - half], [x + half, y + half], [x - half, y + half], [x - half, y - half]]]


def parcel(ain, x, y, **more):
    return {
        "AIN_1": ain, "DAMAGE_1": "Destroyed (>50%)", "SQFTmain1": 1500, "DesignType1": "0130", "COMMUNITY": "Altadena",
        "UseDescription": "Single", "BSD_Tag": "Red", "SitusFullAddress": 'A, "quoted" St', "_geometry": {"rings": ring(x, y, 0.1)},
        **more,
    }


def case(ain, text, **more):
    return {
        "MAIN_AIN": ain, "MODULENAME": "PermitManagement", "WORKCLASS_NAME": "New", "REBUILD_PROGRESS_NUM": 7,
        "DESCRIPTION": text, "DISASTER_TYPE": EVENT, "CASENUMBER": f"C-{ain}", "APPLY_DATE": 1752134400000,
        "_geometry": {"x": 0, "y": 0}, **more,
    }


def snapshot(path, records):
    body = {"source": "s", "fetched_at": "t", "record_count": len(records), "records": records}
    path.write_text(json.dumps(body, indent=1))
    return str(path)


def test_snapshot_keeps_order_and_types(spark, tmp_path):
    rows = [parcel(f"P{i}", i, i, DINS_Count=2) for i in range(5)]
    raw = snapshots.read_snapshot(spark, snapshot(tmp_path / "p.json", rows))
    out = snapshots.typed(raw, snapshots.PARCEL_FIELDS).orderBy("seq").collect()
    assert [(r["seq"], r["ain_1"], r["sqftmain1"], r["dins_count"]) for r in out] == [
        (i, f"P{i}", 1500.0, "2") for i in range(5)
    ]
    assert out[3]["geometry"]["rings"][0][0] == [2.9, 2.9]


NASTY = [
    {"AIN_1": "a{b}c[", "x": {"records": [{"y": [1, {"z": "}]"}]}, 2]}}, {"AIN_1": 'q"\\"}, {"records": ['}, {},
    {"AIN_1": "\\", "e": ["\\\\", "\\\\\"", "]"], "records": [{"records": []}]}, {"AIN_1": "é}😀{\u2028\n"}, {"AIN_1": None},
]


def envelope(records, indent):
    around = {"source": 's}"{', "first": {"records": [{"no": 1}, 2]}, "records": records, "more": {"records": [3, {"no": 4}]}, "fetched_at": "t]"}
    return json.dumps(around, indent=indent, ensure_ascii=indent is None)


@pytest.mark.parametrize("indent", [None, 1])
def test_records_are_found_wherever_a_document_is_cut(spark, indent):
    """A chunk can end after any closing brace, in a string or not; here all lengths from one byte on are tried."""
    text = envelope(NASTY, indent)
    for records in (NASTY, []):
        body = envelope(records, indent)
        lines = [("f", 0, x) for x in body.split("}")]
        for size in (1, 7, 40, 100_000):
            found = {}
            reports, places = [], []
            for file, start, no, chunk in documents.chunks(iter([pa.RecordBatch.from_pylist([dict(zip(("file", "start", "value"), x, strict=True)) for x in lines])]), size):
                raw = np.frombuffer(chunk.encode(), np.uint8)
                quotes = documents.unescaped_quotes(raw)
                both = [documents.report(documents.scanned(raw, quotes, i), chunk.encode(), quotes, i, "records") for i in (False, True)]
                sides = [{**b, "commas": dict(b["commas"])} for b in both]
                reports.append((file, start, no, int(quotes.sum()), *sides))
                places.append(chunk)
            known = documents.starts(spark.createDataFrame(reports, documents._REPORT)).orderBy("start", "no").collect()
            for row, chunk in zip(known, places, strict=True):
                for pos, part, piece in documents.cut(chunk, row["in_string"], row["depth"], row["phase"], row["first"], "records"):
                    found.setdefault(pos, []).append((row["no"], part, piece))
            whole = {pos: "".join(x[-1] for x in sorted(parts)).strip() for pos, parts in found.items()}
            assert [json.loads(whole[i]) for i in range(len(records))] == records, (size, indent)
            assert sorted(p for p, t in whole.items() if t) == [-1, *range(len(records))]
            assert json.JSONDecoder().raw_decode(whole[-1])[0] == {**json.loads(text), "records": []}


@pytest.mark.parametrize("indent", [None, 1])
def test_one_file_is_read_by_several_tasks(spark, tmp_path, indent):
    rows = [{**r, "n": i} for i in range(4) for r in NASTY]
    (tmp_path / "s-2.json").write_text(envelope(rows, indent) + "\n")
    (tmp_path / "s-10.json").write_text(envelope(NASTY, indent))
    (tmp_path / "s-11.json").write_text(envelope([], indent))
    (tmp_path / "s-12.json").write_text("{not json")
    wanted = [(i, r) for i, r in enumerate(rows)] + [((1 << 32) + i, r) for i, r in enumerate(NASTY)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (40, 1 << 20):
            for k in before:
                spark.conf.set(k, str(size) if "max" in k else "0")
            lines = documents.split_lines(spark, str(tmp_path / "s-2.json"))
            assert lines.select("start").distinct().count() >= min(20, 2000 // size)
            out = snapshots.read_snapshot(spark, str(tmp_path)).select("source", "fetched_at", "seq", F.to_json("attributes").alias("a")).collect()
            assert sorted((r["seq"], json.loads(r["a"])) for r in out) == wanted
            assert {(r["source"], r["fetched_at"]) for r in out} == {('s}"{', "t]")}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_two_writers_of_one_version_both_count(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in ("a", "b"):
        spark.range(3 if name == "a" else 5).write.parquet(tables.attempt_path(path, "2025-01-01", name))
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: tables.record_version(spark, path, "2025-01-01", "ab"[i % 2]), range(16)))
    assert sorted(made) == list(range(1, 17))
    listed = {r["version"]: r["attempt"] for r in tables.versions(spark, path).collect()}
    assert listed == {v: "ab"[i % 2] for i, v in enumerate(made)}
    assert {tables.read_version(spark, path, v).count() for v in made} == {3, 5}
    assert tables.latest(spark, path).count() == {"a": 3, "b": 5}[listed[16]]
    assert not tables.put_if_absent(spark, f"{path}/_versions/{16:020d}.json", "x")
    assert not [p.name for p in (tmp_path / "t" / "_versions").iterdir() if p.name.startswith(".")]
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, path, 99)


def page(path, number, features):
    (path / f"page-{number}.json").write_text(json.dumps({"features": features, "exceededTransferLimit": True}))


def test_pages_flatten_in_order_and_drop_bare_features(spark, tmp_path):
    bare = {"attributes": {"N": "bare"}, "geometry": None}
    full = [{"attributes": {"N": f"{i}"}, "geometry": {"x": 1.0, "y": 2}} for i in range(4)]
    page(tmp_path, 10, [full[3]])
    page(tmp_path, 2, [full[2], bare, {"attributes": {"N": "missing"}}])
    page(tmp_path, 0, full[:2])
    features = snapshots.read_pages(spark, str(tmp_path))
    kept, dropped = snapshots.drop_without_geometry(features)
    assert dropped.first()["dropped"] == 2
    out = snapshots.typed(kept, {"N": "string"}).orderBy("seq").collect()
    assert [r["n"] for r in out] == ["0", "1", "2", "3"]
    assert (out[0]["geometry"]["x"], out[0]["geometry"]["rings"]) == (1.0, None)


def test_positions_are_unique_whatever_the_file_names(spark, tmp_path):
    feature = {"attributes": {"N": "x"}, "geometry": {"x": 1, "y": 1}}
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        page(tmp_path / folder, 0, [feature] * 3)
        (tmp_path / folder / "plain.json").write_text(json.dumps({"features": [feature] * 2}))
    seqs = [r["seq"] for r in snapshots.read_pages(spark, f"{tmp_path}/*/*.json").select("seq").collect()]
    assert len(seqs) == 10 == len(set(seqs))
    assert sorted(s >> 32 for s in seqs) == [0, 0, 1, 1, 2, 2, 2, 3, 3, 3]
    for n in (1, 2):
        snapshot(tmp_path / f"s{n}.json", [parcel("P", 0, 0)] * 2)
    assert snapshots.read_snapshot(spark, f"{tmp_path}/s*.json").select("seq").distinct().count() == 4


@pytest.mark.parametrize(
    ("change", "field"),
    [
        ({"AIN_1": ""}, "AIN_1"), ({"AIN_1": 5}, "AIN_1"), ({"AIN_1": None}, "AIN_1"), ({"DAMAGE_1": 1}, "DAMAGE_1"),
        ({"SQFTmain1": "12"}, "SQFTmain1"), ({"COMMUNITY": ["x"]}, "COMMUNITY"), ({"COMMUNITY": ...}, "COMMUNITY"),
        ({"DAMAGE_1": None, "SQFTmain1": None}, None), ({"SQFTmain1": 1.5}, None),
    ],
)
def test_contracts_tell_missing_null_and_mistyped_apart(spark, tmp_path, change, field):
    bad = {k: v for k, v in (parcel("P1", 0, 0) | change).items() if v is not ...}
    raw = snapshots.read_snapshot(spark, snapshot(tmp_path / "p.json", [parcel("P0", 0, 0), bad]))
    if field is None:
        validation.validate(raw, validation.PARCEL_CONTRACT, "parcels")
        return
    with pytest.raises(validation.SchemaError) as caught:
        validation.validate(raw, validation.PARCEL_CONTRACT, "parcels")
    assert caught.value.field == field
    assert "record 1" in str(caught.value)


def test_empty_source_and_bare_perimeter(spark, tmp_path):
    empty = snapshots.read_snapshot(spark, snapshot(tmp_path / "e.json", []))
    with pytest.raises(validation.SchemaError, match="no rows"):
        validation.validate(empty, validation.CASE_CONTRACT, "cases")
    bare = snapshots.read_snapshot(spark, snapshot(tmp_path / "b.json", [{"OBJECTID": 1, "_geometry": None}]))
    with pytest.raises(validation.SchemaError, match="without geometry"):
        validation.validate_geometry(bare, "perimeter")


def test_bronze_history_and_pruning(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for day, n in (("2025-01-01", 2), ("2025-01-02", 3), ("2025-01-02", 1)):
        raw = snapshots.read_snapshot(spark, snapshot(tmp_path / f"{n}.json", [parcel(f"P{i}", i, i) for i in range(n)]))
        snapshots.land_bronze(raw.drop("source", "fetched_at"), path, "parcels", "t", day)
    assert snapshots.read_bronze(spark, path).count() == 1
    old = snapshots.read_bronze(spark, path, "2025-01-01")
    assert old.count() == 2
    assert len(old.inputFiles()) and all("snapshot_date=2025-01-01" in name for name in old.inputFiles())
    with pytest.raises(FileNotFoundError):
        snapshots.read_bronze(spark, path, "2030-01-01")
    typed = snapshots.typed(old, snapshots.PARCEL_FIELDS)
    assert snapshots.only_event_area(typed, "Altadena").count() == 2
    typed.write.parquet(str(tmp_path / "silver"))
    silver = snapshots.only_event_area(spark.read.parquet(str(tmp_path / "silver")), "Altadena")
    assert "EqualTo(community,Altadena)" in silver._jdf.queryExecution().toString()


def test_streams_read_each_file_once(spark, tmp_path):
    answers = tmp_path / "answers"
    answers.mkdir()
    (answers / "1.json").write_text(json.dumps({"key": "k", "content": "{}", "input_tokens": 1, "output_tokens": 2}))
    for _ in range(2):
        intake.land_new_replies(spark, str(answers), str(tmp_path / "replies"), str(tmp_path / "mark2"))
    assert spark.read.parquet(str(tmp_path / "replies")).count() == 1


def test_cache_file_drops_bad_entries(spark, tmp_path):
    good = {"key": "k1", "ain": "A", "structures": [{"struct_type": "sfr", "sqft": 10}], "reasoning": "r", "prompt_version": 3}
    entries = [
        good, {"key": "k2", "ain": "B"}, {"ain": "C"}, {"key": "k3"}, dict(good, reasoning="later"),
        {"key": "k4", "ain": "D", "structures": [{"sqft": 1}]}, {"key": "k5", "ain": "E", "structures": [{"struct_type": "x", "sqft": "z"}]},
        {"key": "k6", "ain": "F", "structures": ["x"]}, {"key": "k7", "ain": "G", "input_tokens": "many"}, 5,
    ]
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({"prompt_version": 2, "entries": entries}, indent=1))
    got = {r["key"]: r for r in cache.read_cache(spark, str(path)).collect()}
    assert sorted(got) == ["k1", "k2"]
    assert (got["k1"]["reasoning"], got["k1"]["prompt_version"], got["k1"]["structures"][0]["confidence"]) == ("later", 3, "low")
    assert (got["k2"]["prompt_version"], got["k2"]["structures"], got["k2"]["input_tokens"]) == (2, [], 0)
    path.write_text("{not json")
    assert cache.read_cache(spark, str(path)).count() == 0
    assert cache.read_cache(spark, str(tmp_path / "absent.json")).count() == 0


def sources(spark, tmp_path, case_rows, **model):
    parcels = [parcel("A", 1, 1), parcel("B", 5, 5), parcel("C", 99, 99), parcel("D", 1.5, 1)]
    tracts = [{"CT20": "1", "LABEL": "T1", "_geometry": {"rings": ring(1, 1, 2)}}, {"CT20": "2", "_geometry": {"rings": ring(5, 5, 2)}}]
    groups = [
        {"BG20": "1a", "CT20": "1", "LABEL": "G", "_geometry": {"rings": ring(1, 1, 2)}},
        {"BG20": "2a", "CT20": "2", "LABEL": None, "_geometry": {"rings": ring(5, 5, 2)}},
    ]

    def read(name, rows, fields, as_region=False):
        df = snapshots.typed(snapshots.read_snapshot(spark, snapshot(tmp_path / f"{name}.json", rows)), fields)
        return df.withColumnRenamed("seq", "region_idx") if as_region else df

    return rebuild.Sources(
        read("parcels", parcels, snapshots.PARCEL_FIELDS),
        read("cases", case_rows, snapshots.CASE_FIELDS),
        read("tracts", tracts, snapshots.TRACT_FIELDS, True),
        read("groups", groups, snapshots.BLOCK_GROUP_FIELDS, True),
        **model,
    )


CASES = [case("A", "1. 1,600 SF SFR\n2. 500 SF ADU"), case("B", "900 SF DUPLEX"), case("Z", "orphan")]


def lines(spark, run, name):
    return [json.loads(r["value"]) for r in spark.read.text(run.path(name)).collect()]


def test_whole_run_from_files_to_files(spark, tmp_path):
    run = rebuild.Run(str(tmp_path / "out"), "2025-03-01", "2025-03-01T00:00:00+00:00")
    checks = rebuild.run_all(spark, sources(spark, tmp_path, CASES), run, RULES, "disabled by flag")
    assert {r["name"]: r["passed"] for r in checks.collect()} == {
        "description_parse_rate": True, "sfr_sqft_extraction_rate": True, "warning_rate": True,
        "min_completed_rebuilds": True, "tract_total_matches_summary": True, "tract_partitions_into_block_groups": True,
    }
    summary = json.loads(spark.read.text(run.path("summary")).first()["value"])
    assert list(summary)[:2] == ["generated_at", "total_parcels"]
    assert (summary["total_parcels"], summary["adu_added_1_count"], summary["dwelling_rebuild_count"]) == (4, 1, 1)

    files = [p for p in pathlib.Path(run.path("parcels_csv")).iterdir() if p.suffix == ".csv"]
    rows = [r for f in files for r in csv.DictReader(f.open())]
    assert list(rows[0]) == list(config.RESULT_FIELDS)
    by_ain = {r["ain"]: r for r in rows}
    assert (by_ain["A"]["post_sfr_sqft"], by_ain["A"]["adds_sb9"], by_ain["C"]["post_sfr_sqft"]) == ("1600", "false", "")
    assert by_ain["A"]["address"] == 'A, "quoted" St'

    features = {f["properties"]["ain"]: f for f in lines(spark, run, "parcels_geojson")}
    assert features["C"]["properties"]["post_sfr_sqft"] is None
    assert list(features["A"]["properties"]) == list(config.RESULT_FIELDS)
    assert features["A"]["geometry"]["type"] == "Polygon"
    tracts = {f["properties"]["ct20"]: f["properties"] for f in lines(spark, run, "tracts_geojson")}
    assert (tracts["1"]["total_parcels"], tracts["2"]["total_parcels"], tracts["2"]["label"]) == (2, 1, "")
    groups = {f["properties"]["bg20"]: f["properties"] for f in lines(spark, run, "block_groups_geojson")}
    assert list(groups["1a"])[:3] == ["bg20", "ct20", "label"]
    codes = {(r["ain"], r["code"]) for r in spark.read.parquet(run.path("warnings")).collect()}
    assert codes == {
        ("*", "llm_disabled"), ("C", "destroyed_no_epicla"), ("D", "destroyed_no_epicla"),
        ("C", "parcel_outside_census_tracts"), ("A", "size_compared_without_lfl_signal"),
    }
    head = spark.read.parquet(run.path("report")).first()
    assert (head["passed"], head["total_parcels"]) == (True, 4)
    metrics = spark.read.parquet(run.path("extraction_metrics")).first()
    assert (metrics["enabled"], metrics["model"], metrics["agreement_rate"], metrics["cache_hits"]) == (False, "", 1.0, 0)
    assert tables.latest(spark, str(tmp_path / "out" / "parcels")).count() == 4


def test_failed_gate_leaves_the_report_and_publishes_nothing(spark, tmp_path):
    run = rebuild.Run(str(tmp_path / "out"), "2025-03-01", "t")
    strict = dataclasses.replace(RULES, min_completed=5)
    with pytest.raises(quality.QualityGateError, match="min_completed_rebuilds"):
        rebuild.run_all(spark, sources(spark, tmp_path, CASES), run, strict)
    written = {p.name for p in (tmp_path / "out").iterdir()}
    assert {"report", "checks", "warnings"} <= written
    assert not {"summary", "parcels", "parcels_csv", "parcels_geojson"} & written
    assert spark.read.parquet(run.path("report")).first()["passed"] is False


def test_model_run_reuses_its_cache(spark, tmp_path):
    empty = spark.createDataFrame(
        [],
        "key string, ain string, extracted_at string, model string, prompt_version int, "
        f"structures array<{extraction.STRUCTURE_TYPE}>, reasoning string, input_tokens bigint, output_tokens bigint",
    )
    src = sources(spark, tmp_path, CASES)
    keys = {r["main_ain"]: r["key"] for r in extraction.content_keys(extraction.qualifying_records(src.cases, RULES), RULES).collect()}
    answer = json.dumps({"structures": [{"struct_type": "sfr", "sqft": 2000, "confidence": "high"}], "reasoning": "r"})
    replies = spark.createDataFrame(
        [(keys["A"], answer, 1, 2), (keys["Z"], answer, 1, 2), (keys["B"], "no json", 1, 2)],
        "key string, content string, input_tokens bigint, output_tokens bigint",
    )
    first = rebuild.Run(str(tmp_path / "out"), "2025-03-01", "t1")
    src = dataclasses.replace(src, cache=empty, replies=replies)
    assert {r["ain"] for r in rebuild.pending_prompts(src, first, RULES).collect()} == {"A", "B"}
    rebuild.run_all(spark, src, first, RULES)
    staged = {r["ain"]: r for r in spark.read.parquet(first.path("staged_parcels")).collect()}
    assert (staged["A"]["post_sfr_sqft"], staged["A"]["post_adu_count"]) == (2000, 0)
    assert staged["B"]["model_status"] == "failed"
    got = spark.read.parquet(first.path("extraction_metrics")).first()
    assert [got[n] for n in ("parcels_attempted", "parcels_extracted", "parcels_failed", "cache_hits", "cache_misses")] == [2, 1, 1, 0, 1]
    cache = spark.read.parquet(first.path("cache"))
    assert [(r["ain"], r["extracted_at"]) for r in cache.collect()] == [("A", "t1")]

    second = rebuild.Run(str(tmp_path / "out"), "2025-03-02", "t2")
    src = dataclasses.replace(src, cache=cache, replies=replies.limit(0))
    assert {r["ain"] for r in rebuild.pending_prompts(src, second, RULES).collect()} == {"B"}
    rebuild.run_all(spark, src, second, RULES)
    got = spark.read.parquet(second.path("extraction_metrics")).first()
    assert [got[n] for n in ("parcels_extracted", "cache_hits", "cache_misses")] == [1, 1, 0]
    assert spark.read.parquet(second.path("cache")).count() == 1
    assert tables.latest(spark, str(tmp_path / "out" / "parcels")).select("snapshot_date").distinct().count() == 1


def test_a_retry_after_a_failed_gate_keeps_the_cache(spark, tmp_path):
    schema = (
        "key string, ain string, extracted_at string, model string, prompt_version int, "
        f"structures array<{extraction.STRUCTURE_TYPE}>, reasoning string, input_tokens bigint, output_tokens bigint"
    )
    src = sources(spark, tmp_path, CASES)
    keys = {r["main_ain"]: r["key"] for r in extraction.content_keys(extraction.qualifying_records(src.cases, RULES), RULES).collect()}
    answer = json.dumps({"structures": [], "reasoning": "first"})
    later = json.dumps({"structures": [], "reasoning": "a later one"})
    replies = spark.createDataFrame(
        [(keys["A"], answer, 1, 1, 2), (keys["A"], later, 2, 1, 2)],
        "key string, content string, arrived int, input_tokens bigint, output_tokens bigint",
    )
    src = dataclasses.replace(src, cache=spark.createDataFrame([], schema), replies=replies)
    out = str(tmp_path / "out")
    with pytest.raises(quality.QualityGateError):
        rebuild.run_all(spark, src, rebuild.Run(out, "2025-03-01", "t1"), dataclasses.replace(RULES, min_completed=5))
    kept = tables.latest(spark, f"{out}/cache")
    assert [(r["ain"], r["reasoning"]) for r in kept.collect()] == [("A", "first")]
    retry = rebuild.Run(out, "2025-03-01", "t2")
    rebuild.run_all(spark, dataclasses.replace(src, cache=kept, replies=replies.limit(0)), retry, RULES)
    again = tables.latest(spark, f"{out}/cache")
    assert [(r["ain"], r["extracted_at"]) for r in again.collect()] == [("A", "t1")]
    assert kept.count() == 1
    assert {name.split("/attempt=")[1][:32] for name in again.inputFiles()} == {retry.attempt}
    inputs = tables.latest(spark, f"{out}/extraction_inputs").filter(f"key = '{keys['A']}'")
    assert [r["case_number"] for r in inputs.collect()] == ["C-A"]


def test_run_from_raw_files(spark, tmp_path):
    """Raw snapshots in, published tables out: contracts, source filters and region choice included."""
    other = parcel("X", 1, 1, COMMUNITY="Elsewhere")
    shapes = {
        "parcels": [parcel("A", 1, 1), parcel("B", 5, 5), other],
        "cases": [*CASES, case("A", "9,000 SF SFR", DISASTER_TYPE="Other")],
        "tracts": [
            {"CT20": "1", "LABEL": "T1", "_geometry": {"rings": ring(1, 1, 2)}},
            {"CT20": "9", "LABEL": "far", "_geometry": {"rings": ring(500, 500, 2)}},
        ],
        "block_groups": [
            {"BG20": "1a", "CT20": "1", "LABEL": "G", "_geometry": {"rings": ring(1, 1, 2)}},
            {"BG20": "9a", "CT20": "9", "LABEL": "G", "_geometry": {"rings": ring(500, 500, 2)}},
        ],
        "perimeter": [{"OBJECTID": 1, "_geometry": {"rings": ring(3, 3, 4)}}],
    }
    files = rebuild.Files(**{n: snapshot(tmp_path / f"{n}.json", rows) for n, rows in shapes.items()})
    run = rebuild.Run(str(tmp_path / "out"), "2025-03-01", "t")
    rebuild.run_files(spark, files, run, dataclasses.replace(RULES, min_completed=0))
    rows = {r["ain"]: r for r in tables.latest(spark, f"{run.out}/parcels").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["post_sfr_sqft"] == 1600 and rows["A"]["tract"] == "1"
    assert [f["properties"]["ct20"] for f in lines(spark, run, "tracts_geojson")] == ["1"]
    assert [f["properties"]["bg20"] for f in lines(spark, run, "block_groups_geojson")] == ["1a"]
    with pytest.raises(validation.SchemaError, match="no rows"):
        empty = dataclasses.replace(files, cases=snapshot(tmp_path / "none.json", []))
        rebuild.run_files(spark, empty, rebuild.Run(run.out, "2025-03-02", "t"), RULES)
