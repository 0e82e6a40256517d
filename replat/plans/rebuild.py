"""One run: sources to the staged parcel table, the report, the gates, and then the published tables.

The staged table is written once and read back by everything after it: counts, warnings, gates and
files. The report is written before the gates are enforced; nothing is published when one fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replat import config, session
from replat.config import DEFAULT_RULES, Rules
from replat.operators import cases, counts, extraction, parcels, prompts, quality, spatial
from replat.sinks import tables
from replat.sources import perimeter, snapshots, validation

LAYERS = ("tract", "block_group")
PUBLISHED = ("summary", "parcels_csv", "parcels_geojson", "tracts_geojson", "block_groups_geojson", "parcels")
REGION_IDS = ["CT20", "LABEL"]
SUBREGION_IDS = ["BG20", "CT20", "LABEL"]


@dataclass(frozen=True)
class Sources:
    """Typed source tables. ``cache`` and ``replies`` are null when the model step is off."""

    parcels: DataFrame
    cases: DataFrame
    regions: DataFrame
    subregions: DataFrame
    cache: DataFrame | None = None
    replies: DataFrame | None = None


@dataclass(frozen=True)
class Run:
    """Where one run's tables are, and its stamp. Each ``Run`` is an attempt with folders of its own."""

    out: str
    snapshot_date: str
    generated_at: str
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex)

    def path(self, name: str) -> str:
        return tables.attempt_path(f"{self.out}/{name}", self.snapshot_date, self.attempt)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of this attempt and return the written rows."""
        df.write.parquet(self.path(name))
        return df.sparkSession.read.parquet(self.path(name))

    def record(self, spark: SparkSession, name: str) -> None:
        """From now on readers of the table's newest version get this attempt."""
        tables.record_version(spark, f"{self.out}/{name}", self.snapshot_date, self.attempt)


def extract(
    src: Sources, facts: DataFrame, analysis: DataFrame, run: Run, rules: Rules
) -> tuple[DataFrame, DataFrame]:
    """(rows with the model's results laid over, new cache entries). Writes the next cache version.

    Its entries cost model calls, so the version counts at once, whatever becomes of the run. Which cases went
    into a key is a table of its own, ``extraction_inputs``.
    """
    spark = analysis.sparkSession
    records = extraction.qualifying_facts(facts)
    keys = run.write(extraction.content_keys(records, rules), "content_keys")
    misses = extraction.cache_misses(keys, src.cache)
    new = extraction.new_extractions(misses, src.replies, run.generated_at, rules)
    # keys of parcels that are gone stay out of the next version
    added = run.write(extraction.prune_cache(new, src.parcels), "new_extractions")
    cache = run.write(extraction.next_cache(src.cache, added, src.parcels), "cache")
    run.record(spark, "cache")
    run.write(extraction.extraction_inputs(records, keys), "extraction_inputs")
    run.record(spark, "extraction_inputs")
    given = keys.join(cache, "key").select(F.col("main_ain").alias("ain"), "structures", "reasoning")
    return extraction.apply_extractions(analysis, given, rules), added


def pending_prompts(src: Sources, run: Run, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Prompts of the parcels whose content key is not in the cache: what to send to a model."""
    records = extraction.qualifying_records(src.cases, rules)
    misses = extraction.cache_misses(extraction.content_keys(records, rules), src.cache)
    wanted = run.write(records.join(misses.select("main_ain"), "main_ain", "left_semi"), "prompt_records")
    texts = prompts.user_prompts(src.parcels, wanted, rules)
    return run.write(
        texts.join(misses, texts["ain"] == misses["main_ain"]).drop("main_ain"), "prompts"
    )


def stage(src: Sources, run: Run, rules: Rules = DEFAULT_RULES) -> tuple[DataFrame, DataFrame | None]:
    """Compute and write the parcel table with regions and warnings; also the model run's counters.

    The case texts are scanned and parsed once: with the model step on, the narrow fact rows are written
    first, since both the roll-up and the content keys read them.
    """
    model_on = src.replies is not None and src.cache is not None
    facts = cases.case_facts(src.cases, rules)
    if model_on:
        facts = run.write(facts, "case_facts")
    analysis = parcels.parcel_analysis(src.parcels, cases.case_rollup(facts), rules)
    new = None
    if model_on:
        analysis, new = extract(src, facts, analysis, run, rules)
    layers = {"tract": (src.regions, "ct20"), "block_group": (src.subregions, "bg20")}
    assigned = spatial.with_regions(analysis, spatial.assign_regions(src.parcels, layers))
    staged = run.write(quality.with_warnings(assigned, "tract", rules), "staged_parcels")
    info = None if new is None else extraction.run_info(staged, new, rules)
    return staged, info


def publish(run: Run, staged: DataFrame, cells: DataFrame, regions: DataFrame, subregions: DataFrame) -> None:
    """The tables readers see. Called only after the gates passed."""
    tables.write_summary(counts.summary_of(cells), run.path("summary"), run.generated_at)
    tables.write_parcel_csv(staged, run.path("parcels_csv"))
    tables.write_lines(tables.parcel_features(staged), run.path("parcels_geojson"))
    tables.write_lines(tables.region_features(regions, REGION_IDS), run.path("tracts_geojson"))
    tables.write_lines(tables.region_features(subregions, SUBREGION_IDS), run.path("block_groups_geojson"))
    run.write(staged.select(*config.RESULT_FIELDS, *LAYERS), "parcels")
    for name in PUBLISHED:
        run.record(staged.sparkSession, name)


def run_all(
    spark: SparkSession,
    src: Sources,
    run: Run,
    rules: Rules = DEFAULT_RULES,
    disabled_reason: str | None = None,
) -> DataFrame:
    """The whole run; returns the gates. Raises :class:`quality.QualityGateError` before publishing.

    ``disabled_reason`` says that the model step was switched off on purpose, and why.
    """
    session.configure(spark)
    staged, info = stage(src, run, rules)
    cells = run.write(counts.count_cells(staged, list(LAYERS)), "cells")
    regions = counts.region_counts(cells, src.regions, "ct20", "tract", REGION_IDS)
    subregions = counts.region_counts(cells, src.subregions, "bg20", "block_group", SUBREGION_IDS)

    warning_rows = run.write(quality.warnings(staged, disabled_reason), "warnings")
    checks = run.write(quality.gates(staged, LAYERS, src.regions, src.subregions, rules), "checks")
    totals = cells.agg(F.sum("total_parcels").alias("total_parcels"))
    run.write(tables.report_head(checks, totals, run.generated_at), "report")
    if info is None:
        info = extraction.no_run_info(spark, rules)
    run.write(extraction.extraction_metrics(info, warning_rows), "extraction_metrics")

    quality.enforce(checks)
    publish(run, staged, cells, regions, subregions)
    return checks


@dataclass(frozen=True)
class Files:
    """Raw snapshot files of the five layers."""

    parcels: str
    cases: str
    tracts: str
    block_groups: str
    perimeter: str


LAYER_FIELDS = {
    "parcels": (snapshots.PARCEL_FIELDS, validation.PARCEL_CONTRACT),
    "cases": (snapshots.CASE_FIELDS, validation.CASE_CONTRACT),
    "tracts": (snapshots.TRACT_FIELDS, validation.TRACT_CONTRACT),
    "block_groups": (snapshots.BLOCK_GROUP_FIELDS, validation.BLOCK_GROUP_CONTRACT),
}


def typed_sources(spark: SparkSession, files: Files, run: Run, rules: Rules = DEFAULT_RULES) -> Sources:
    """Raw files to the tables of a run: kept as they came, checked, cut down to the event's area, and typed.

    Each file is parsed once; checks and tables read the kept rows. Raises ``validation.SchemaError`` on a record
    that breaks its contract and on a source without rows.
    """
    frames = {}
    for name, (fields, contract) in LAYER_FIELDS.items():
        raw = run.write(snapshots.read_snapshot(spark, getattr(files, name)), f"raw_{name}")
        validation.validate(raw, contract, name)
        frames[name] = snapshots.typed(raw, fields)
    outline = run.write(snapshots.read_snapshot(spark, files.perimeter), "raw_perimeter")
    validation.validate_geometry(outline, "perimeter")
    outline = snapshots.typed(outline, {})
    perimeter.require_envelope(outline)
    regions = {n: frames[n].withColumnRenamed("seq", "region_idx") for n in ("tracts", "block_groups")}
    tracts = run.write(perimeter.regions_in_envelope(regions["tracts"], outline), "near_tracts")
    return Sources(
        parcels=run.write(snapshots.only_event_area(frames["parcels"], rules.community), "event_parcels"),
        cases=run.write(snapshots.only_event_cases(frames["cases"], rules.event_label), "event_cases"),
        regions=tracts,
        subregions=run.write(perimeter.children_of(regions["block_groups"], tracts), "near_block_groups"),
    )


def run_files(
    spark: SparkSession,
    files: Files,
    run: Run,
    rules: Rules = DEFAULT_RULES,
    cache: DataFrame | None = None,
    replies: DataFrame | None = None,
    disabled_reason: str | None = None,
) -> DataFrame:
    """The whole run from raw files; see :func:`typed_sources` and :func:`run_all`."""
    src = typed_sources(spark, files, run, rules)
    return run_all(spark, replace(src, cache=cache, replies=replies), run, rules, disabled_reason)
