from __future__ import annotations

import os

import pytest
import samples

import corpus_pipeline
from replat.llm import common, line_runs, packing, queries
from replat.llm.common import table

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with odd documents and labels, for runs that need no driver tables."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = samples.mixed_rows(60) + samples.odd_rows()
    samples.docs(spark, rows).select(*COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_take_each_others_rows(spark, folder):
    docs = table(spark, folder, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # one label is not enough to learn from: the stage rejects nothing
    assert corpus_pipeline.quality(spark, docs, folder).count() == docs.count()
    lines = corpus_pipeline.lines(spark, docs, folder)
    assert lines.columns == COLUMNS
    kept = {r["doc_id"]: r for r in lines.collect()}
    assert kept[13]["text"] == rows[13] and kept[14]["text"] == "z"
    assert kept[14]["n_chars"] == 1
    near = corpus_pipeline.near_copies(spark, lines, folder)
    assert near.columns == COLUMNS
    groups = {r["doc_id"]: r["component_id"] for r in corpus_pipeline.jaccard_join.jaccard_components(lines).collect()}
    assert {r["doc_id"] for r in near.collect()} == {k for k, c in groups.items() if k == c}
    passages = corpus_pipeline.passages(spark, near, folder)
    assert passages.columns == COLUMNS
    assert passages.agg({"n_chars": "sum"}).first()[0] < near.agg({"n_chars": "sum"}).first()[0]
    packed = corpus_pipeline.sequences(spark, passages, folder)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in passages.collect()}


@pytest.mark.parametrize("stage", [s[1] for s in corpus_pipeline.STAGES], ids=[s[0] for s in corpus_pipeline.STAGES])
def test_stages_take_no_rows(spark, folder, stage):
    assert stage(spark, table(spark, folder, "documents").limit(0), folder).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")
def test_registered_queries_have_the_columns_of_their_contract(spark):
    want = {
        "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op2_token_counts": "doc_id n_bytes n_tokens over_limit",
        "op3_ngram_jaccard": "doc_id n_shingles component_id",
        "op4_embedding_links": "vec_id n_links component_id kept",
        "op5_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op6_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op7_line_dedup": "doc_id n_lines n_removed",
        "op8_url_filters": "page_id host path rule verdict",
        "op9_quality_classifier": "doc_id held_out score predicted",
        "op10_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op11_phrases": "lang rank phrase a l r n score",
        "op12_nearest_vectors": "query_id rank vec_id score",
        "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    }
    fewer = ("op5_best_fit_packing", "op11_phrases", "op12_nearest_vectors", "op13_hard_negatives")
    sizes = {"op4_embedding_links": "embeddings", "op8_url_filters": "pages"}
    for name, query in queries.registered().items():
        out = query(spark, FOLDER)
        if name == "pipeline":
            assert 0 < out.count() < 400
            continue
        assert set(want[name].split()) <= set(out.columns)
        if name not in fewer:
            assert out.count() == table(spark, FOLDER, sizes.get(name, "documents")).count()


def test_a_worker_keeps_what_its_operator_made_and_nothing_of_others():
    state = common._worker_state()
    before = dict(state)
    try:
        common.new_task("one")
        common.once("cache", dict)["word"] = 1
        common.new_task("one")
        assert common.once("cache", dict) == {"word": 1}
        common.new_task("two")
        assert common.once("cache", dict) == {}
    finally:
        state.clear()
        state.update(before)


def test_a_stage_leaves_nothing_to_the_workers_of_the_next(spark):
    docs = samples.docs(spark, samples.mixed_rows(60)).repartition(8)
    packing.pieces(docs, queries.tokenizer("word_bpe_49k.json"), 4096, 1).collect()
    line_runs.line_ids(docs, 3, True, "doc_id", "text").collect()

    def kept(batches):
        import sys

        import pyarrow as pa

        for batch in batches:
            names = ",".join(f"{k}={v}" if k == "operator" else k for k, v in vars(sys.modules["replat_worker_state"]).items() if k[:2] != "__") if "replat_worker_state" in sys.modules else ""
            yield pa.RecordBatch.from_arrays([pa.array([names] * batch.num_rows)], ["names"])

    found = {r["names"] for r in spark.range(0, 8, 1, 8).mapInArrow(kept, "names string").collect()}
    assert "operator=line_runs" in found
    assert not any("line_runs" in names and "words:" in names for names in found)
