"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import cached_property, lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES
from replat.functions import scalars, text
from replat.functions.geometry import to_geojson
from replat.operators import cases, counts, extraction, parcels, prompts, quality, reports, spatial
from replat.plans import adapters
from replat.plans.oracles import MODEL
from replat.sinks import tables
from replat.sources import cache, documents, perimeter, snapshots, validation

Query = Callable[[SparkSession, str], DataFrame]
STAMP = "2026-01-01T00:00:00+00:00"
RULES = dataclasses.replace(DEFAULT_RULES, model=MODEL)


class _Frames:
    """The shared steps of one run, built once per folder. Only plans are kept, never rows."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def parcels(self) -> DataFrame:
        return adapters.parcels(self.spark, self.sf_dir)

    @cached_property
    def cases(self) -> DataFrame:
        return adapters.cases(self.spark, self.sf_dir)

    @cached_property
    def facts(self) -> DataFrame:
        return cases.case_facts(self.cases, RULES)

    @cached_property
    def rollup(self) -> DataFrame:
        return cases.case_rollup(self.facts)

    @cached_property
    def analysis(self) -> DataFrame:
        return parcels.parcel_analysis(self.parcels, self.rollup, RULES)

    @cached_property
    def regions(self) -> DataFrame:
        return adapters.regions(self.spark, self.sf_dir)

    @cached_property
    def subregions(self) -> DataFrame:
        return adapters.subregions(self.spark, self.sf_dir)

    @cached_property
    def assignment(self) -> DataFrame:
        layers = {"tract": (self.regions, "ct20"), "block_group": (self.subregions, "bg20")}
        return spatial.assign_regions(self.parcels, layers)

    @cached_property
    def assigned(self) -> DataFrame:
        return spatial.with_regions(self.analysis, self.assignment)

    @cached_property
    def cells(self) -> DataFrame:
        return counts.count_cells(self.assigned, ["tract", "block_group"])

    @cached_property
    def region_rows(self) -> DataFrame:
        return counts.region_counts(self.cells, self.regions, "ct20", "tract", ["CT20", "LABEL"])

    @cached_property
    def subregion_rows(self) -> DataFrame:
        ids = ["BG20", "CT20", "LABEL"]
        return counts.region_counts(self.cells, self.subregions, "bg20", "block_group", ids)

    @cached_property
    def warned(self) -> DataFrame:
        return quality.with_warnings(self.assigned, "tract", RULES)

    @cached_property
    def warnings(self) -> DataFrame:
        return quality.warnings(self.warned)

    @cached_property
    def summary(self) -> DataFrame:
        return counts.summary_counts(self.analysis)

    @cached_property
    def records(self) -> DataFrame:
        return extraction.qualifying_records(self.cases, RULES)

    @cached_property
    def replies(self) -> DataFrame:
        return adapters.replies(self.spark, self.sf_dir)

    @cached_property
    def parsed_replies(self) -> DataFrame:
        return extraction.parse_replies(self.replies)

    @cached_property
    def overlaid(self) -> DataFrame:
        return extraction.apply_extractions(self.assigned, self.parsed_replies.filter("ok"), RULES)

    @cached_property
    def near_regions(self) -> DataFrame:
        """Of regions stretched to twice their place and size, those that the box of all parcels meets."""
        return perimeter.regions_in_envelope(adapters.stretched(self.spark, self.sf_dir), self.parcels)


class _Keyed:
    """Steps on content keys."""

    def __init__(self, frames: _Frames) -> None:
        self.frames = frames
        self.keys = extraction.content_keys(extraction.qualifying_facts(frames.facts), RULES)

    @cached_property
    def replies(self) -> DataFrame:
        """Replies under the content key of their parcel, as they come back from a model run."""
        r, k = self.frames.replies, self.keys
        return r.join(k, r["ain"] == k["main_ain"]).select(
            "key", "form", "ain", "content", "input_tokens", "output_tokens"
        )

    @cached_property
    def stored(self) -> DataFrame:
        """Cache of an earlier run: the parcels whose replies have form 0 or 1."""
        return self.replies.filter(F.col("form").isin(0, 1)).select("key", "ain")

    @cached_property
    def misses(self) -> DataFrame:
        return extraction.cache_misses(self.keys, self.stored)

    @cached_property
    def next_cache(self) -> DataFrame:
        """The stored entries, typed as a cache, and those the other replies add."""
        none = F.array().cast(f"array<{extraction.STRUCTURE_TYPE}>")
        entries = self.stored.select(
            "key", "ain", F.lit("old").alias("extracted_at"), F.lit(MODEL).alias("model"),
            F.lit(2).cast("bigint").alias("prompt_version"), none.alias("structures"), F.lit("").alias("reasoning"),
            F.lit(0).cast("bigint").alias("input_tokens"), F.lit(0).cast("bigint").alias("output_tokens"),
        )
        new = extraction.new_extractions(self.misses, self.replies.drop("ain", "form"), "new", RULES)
        added = extraction.prune_cache(new, self.frames.parcels)
        return extraction.next_cache(entries, added, self.frames.parcels)


@lru_cache(maxsize=8)
def _frames_of(spark: SparkSession, sf_dir: str) -> _Frames:
    return _Frames(spark, sf_dir)


def _keyed(column: str) -> Query:
    return lambda spark, sf: _frames_of(spark, sf).rollup.select("main_ain", column)


def _extraction_metrics(k: _Keyed) -> DataFrame:
    overlaid = quality.with_warnings(k.frames.overlaid, "tract", RULES)
    replies = k.replies.drop("ain", "form")
    new = extraction.new_extractions(k.misses, replies, "2026-01-01T00:00:00Z", RULES)
    # orphan keys are hashed too but belong to no parcel row
    new = extraction.prune_cache(new, k.frames.parcels)
    return extraction.run_metrics(overlaid, new, RULES)


def _feature_fields(value: Column, names: tuple[str, ...], corners: int) -> list[Column]:
    """Every property of a feature text, and every ordinate of its one ring."""
    fields = [F.get_json_object(value, f"$.properties.{n}").alias(n) for n in names]
    ring = "$.geometry.coordinates[0]"
    ordinates = [
        F.get_json_object(value, f"{ring}[{i}][{j}]").cast("double").alias(f"{axis}{i}")
        for i in range(corners)
        for j, axis in enumerate("xy")
    ]
    kinds = [F.get_json_object(value, "$.type").alias("kind"), F.get_json_object(value, "$.geometry.type").alias("shape")]
    return [*kinds, *fields, *ordinates]


def _parcel_features(f: _Frames) -> DataFrame:
    out = tables.parcel_features(f.analysis)
    return out.select(*_feature_fields(F.col("value"), config.RESULT_FIELDS, 5))


def _region_features(f: _Frames) -> DataFrame:
    out = tables.region_features(f.region_rows, ["CT20", "LABEL"])
    return out.select(*_feature_fields(F.col("value"), ("ct20", "label", *counts.COUNT_FIELDS), 5))


def _shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as geometries of every kind the conversion knows."""
    k = F.col("c_custkey")
    x = k.cast("double")

    def square(side: int, at: int) -> str:
        a, b = f"(c_custkey + {at})", f"(c_custkey + {at + side})"
        points = ((a, at), (b, at), (b, at + side), (a, at + side), (a, at))
        return "array(" + ", ".join(f"array(cast({p} as double), cast({q} as double))" for p, q in points) + ")"

    rings = (
        F.when(k % 6 == 0, F.expr(f"array({square(4, 0)}, {square(1, 1)})"))  # nested
        .when(k % 6 == 1, F.expr(f"array({square(2, 5)}, {square(2, 0)})"))  # two of one area
        .when(k % 6 == 2, F.expr(f"array({square(1, 9)}, {square(3, 0)})"))
    )
    line = F.when(k % 6 == 4, F.array(F.array(F.array(x, x), F.array(x + 1, x))))
    point = F.when(k % 6 == 3, x)
    shape = F.struct(rings.alias("rings"), point.alias("x"), point.alias("y"), line.alias("paths"))
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    return rows.select(k.alias("seq"), F.when(k % 6 != 5, shape).alias("geometry"))


def _geometry_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _shapes(spark, sf)
    value = F.coalesce(to_geojson(tables.full_geometry(rows)), F.lit("null"))
    return rows.select(
        "seq", F.get_json_object(value, "$.type").alias("kind"),
        F.size(F.from_json(F.get_json_object(value, "$.coordinates"), "array<string>")).cast("bigint").alias("members"),
    )


def _customer_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as pages of at most 1,000 features, the shape a paged service returns."""
    feature = F.struct(
        F.struct(F.col("c_name").alias("NAME"), F.col("c_mktsegment").alias("SEGMENT")).alias("attributes"),
        F.when(
            F.col("c_custkey") % 37 != 0, F.struct(F.col("c_acctbal").alias("x"), F.lit(0.5).alias("y"))
        ).alias("geometry"),
    )
    page = F.floor(F.col("c_custkey") / 1000)
    grouped = (
        spark.read.parquet(f"{sf}/customer.parquet")
        .groupBy(page.alias("page_no"))
        .agg(F.sort_array(F.collect_list(F.struct("c_custkey", feature.alias("feature")))).alias("rows"))
    )
    body = F.to_json(F.transform("rows", lambda r: r["feature"]), {"ignoreNullFields": "false"})
    schema = "array<struct<attributes:variant,geometry:variant>>"
    return grouped.select(_page_name(F.col("page_no")).alias("file"), F.from_json(body, schema).alias("features"))


def _page_name(number: Column) -> Column:
    return F.lpad(number.cast("string"), 12, "0")


def _page_flatten(spark: SparkSession, sf: str) -> DataFrame:
    pages = _customer_pages(spark, sf)
    kept, _ = snapshots.drop_without_geometry(snapshots.flatten_pages(pages, snapshots.in_order(pages)))
    rows = snapshots.typed(kept, {"NAME": "string", "SEGMENT": "string"})
    return rows.select("seq", "name", "segment", F.col("geometry.x").alias("x"))


def _customer_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as snapshot documents of at most 1,000 records, with braces, quotes and the array's own name in
    strings, records below records, and an array of that name elsewhere."""
    k = F.col("c_custkey")
    odd = F.when(k % 3 == 0, F.lit('}, {"records": [')).when(k % 3 == 1, F.lit('\\" ]} \\\\')).otherwise(F.lit("[{\n\t"))
    record = F.struct(k.alias("ID"), F.concat("c_name", odd).alias("NAME"), F.array(F.struct(F.array(k, -k).alias("records"))).alias("PARTS"))
    grouped = (
        spark.read.parquet(f"{sf}/customer.parquet")
        .groupBy(F.floor(k / 1000).alias("page_no"))
        .agg(F.sort_array(F.collect_list(F.struct("c_custkey", record.alias("record")))).alias("rows"))
    )
    listed = F.to_json(F.transform("rows", lambda r: r["record"]), {"pretty": "true"})
    head = F.concat(F.lit('{"source": "s}{\\"", "note": {"records": [{}, 1]}, "fetched_at": "t'), F.col("page_no"), F.lit('", "records" :\n '))
    text = F.concat(head, listed, F.lit(', "more": {"records": [1, {"a": "]"}]}}'))
    return grouped.select(_page_name(F.col("page_no")).alias("file"), text.alias("text"))


def _snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    files = _customer_documents(spark, sf)
    rows = snapshots.snapshot_rows(documents.text_lines(files), snapshots.in_order(files))
    fields = {"id": ("ID", "bigint"), "name": ("NAME", "string"), "part": ("PARTS[0].records[1]", "bigint")}
    return rows.select("source", "fetched_at", "seq", *[F.variant_get("attributes", f"$.{n}", t).alias(c) for c, (n, t) in fields.items()])


def _latest_version(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as versions of customers' tables: which version counts for each table."""
    listed = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_custkey").alias("table"), F.col("o_orderkey").cast("bigint").alias("version"),
        F.col("o_orderdate").cast("date").cast("string").alias("snapshot_date"), F.concat(F.lit("a"), "o_orderkey").alias("attempt"),
    )
    return tables.newest(listed, "table")


def _contract_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records that break the contracts of cases and regions here and there."""
    k = F.col("c_custkey")
    number = F.when(k % 5 == 0, F.lit('"x"')).when(k % 5 == 1, F.lit("null")).otherwise(F.lit("4.0"))
    module = F.when(k % 7 == 0, F.lit("null")).otherwise(F.lit('"PermitManagement"'))
    text = F.when(k % 11 == 0, F.lit("7")).otherwise(F.lit("null"))
    ids = F.when(k % 13 == 0, F.lit('""')).otherwise(F.lit('"1"'))
    body = F.concat(
        F.lit('{"MAIN_AIN":"1","MODULENAME":'), module, F.lit(',"REBUILD_PROGRESS_NUM":'), number,
        F.lit(',"DESCRIPTION":'), text, F.lit(',"CT20":'), ids, F.when(k % 3 != 0, F.lit(',"BG20":"2"}')).otherwise(F.lit("}")),
    )
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(k.alias("seq"), F.parse_json(body).alias("attributes"))
    contracts = {"cases": validation.CASE_CONTRACT, "tracts": validation.TRACT_CONTRACT, "block_groups": validation.BLOCK_GROUP_CONTRACT}
    found = [
        validation.record_problems(rows, c).select(F.lit(n).alias("source"), "seq", "field", "problem")
        for n, c in contracts.items()
    ]
    return reduce(DataFrame.unionByName, found)


def _source_filters(f: _Frames) -> DataFrame:
    """Rows that the predicates on community and event label leave; customers' segments as communities."""
    segments = f.spark.read.parquet(f"{f.sf_dir}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("community"))
    area = snapshots.only_event_area(segments, "BUILDING").select(F.lit("area").alias("source"), F.col("c_custkey").alias("id"))
    cases_ = snapshots.only_event_cases(f.cases, RULES.event_label)
    return area.union(cases_.select(F.lit("cases").alias("source"), F.col("seq").alias("id")))


def _record_problems(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records derived from customers, some of which break the parcel contract."""
    k = F.col("c_custkey")
    key = (
        F.when(k % 41 == 0, F.lit(""))
        .when(k % 41 == 1, F.lit('"AIN_1":5,'))
        .when(k % 41 == 2, F.lit('"AIN_1":"",'))
        .otherwise(F.concat(F.lit('"AIN_1":"'), k.cast("string"), F.lit('",')))
    )
    damage = F.when(k % 43 == 0, F.lit("")).otherwise(F.lit('"DAMAGE_1":null,'))
    area = F.when(k % 47 == 0, F.lit('"SQFTmain1":"12",')).otherwise(F.lit('"SQFTmain1":12.5,'))
    community = F.when(k % 53 == 0, F.lit('"COMMUNITY":[1]')).otherwise(F.lit('"COMMUNITY":"A"'))
    body = F.concat(F.lit("{"), key, damage, area, F.lit('"DesignType1":null,'), community, F.lit("}"))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(
        k.alias("seq"), F.parse_json(body).alias("attributes")
    )
    return validation.record_problems(rows, validation.PARCEL_CONTRACT).select("seq", "field", "problem")


def _listed_structures() -> Column:
    """An entry's structures as text: their fields by ``|``, one after the other by ``;``."""
    fields = F.transform(
        "structures",
        lambda s: F.concat_ws(
            "|", s["struct_type"], F.coalesce(s["sqft"].cast("string"), F.lit("-")), s["confidence"],
            F.size(s["evidence_case_numbers"]).cast("string"), F.coalesce(s["notes"], F.lit("-")),
        ),
    )
    return F.array_join(fields, ";")


def _cache_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Cache entries derived from customers: good ones, broken ones, and two versions of one key."""
    k = F.col("c_custkey")
    key = F.when(k % 10 == 9, k - 1).otherwise(k).cast("string")
    area = (
        F.when(k % 10 == 1, F.lit('"abc"'))
        .when(k % 10 == 2, F.lit('"640"'))
        .when(k % 10 == 3, F.lit("null"))
        .otherwise(F.concat(k.cast("string"), F.lit(".5")))
    )
    kind = F.when(k % 10 == 4, F.lit('"kind"')).otherwise(F.lit('"struct_type"'))
    listed = F.when(k % 10 == 5, F.lit('"none"')).when(k % 10 == 6, F.lit("null"))
    item = F.concat(F.lit("[{"), kind, F.lit(':"sfr","sqft":'), area, F.lit(',"notes":""}]'))
    body = F.concat(
        F.lit('{"key":"k'), key, F.lit('","ain":"'), k.cast("string"), F.lit('","input_tokens":7,"structures":'),
        F.coalesce(listed, item), F.lit("}"),
    )
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(
        k.alias("pos"), F.parse_json(body).alias("entry")
    )
    entries = cache.cache_entries(rows, RULES)
    return entries.select(
        "key", "ain", "extracted_at", "model", "prompt_version", "reasoning", "input_tokens", "output_tokens",
        _listed_structures().alias("structures"),
    )


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    runs = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").alias("generated_at"))
    as_of = F.lit("2024-01-15 00:00:00").cast("timestamp")
    return reports.freshness(runs, as_of, RULES).select("event_id", "is_stale")


def _document_flags(spark: SparkSession, sf: str) -> DataFrame:
    body = F.col("text")
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id",
        text.claim_signal(body).alias("claim"),
        text.mentions_pathway(body).alias("mentions_pathway"),
    )


def _document_segments(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.posexplode(text.segments(F.col("text"))).alias("position", "segment")
    )


def _pre_state(f: _Frames) -> DataFrame:
    rows = f.parcels.withColumn("pre", parcels.pre_state(f.parcels, RULES))
    pre = {n: F.col(f"pre.{n}").cast("bigint") for n in cases.POST_FIELDS}
    summary = scalars.pre_state_text(
        {t: pre[f"{t}_count"] for t in config.DWELLING_TYPES},
        {t: pre[f"{t}_sqft"] for t in config.DWELLING_TYPES},
    )
    return rows.select(
        F.col("seq").alias("parcel_seq"), *[c.alias(f"pre_{n}") for n, c in pre.items()], summary.alias("pre_text")
    )


def _post_state(f: _Frames) -> DataFrame:
    rows = f.rollup.filter(F.col("post").isNotNull())
    return rows.select("main_ain", *[F.col(f"post.{n}").try_cast("bigint").alias(n) for n in cases.POST_FIELDS])


def _nearest(f: _Frames) -> DataFrame:
    wedges = adapters.wedges(f.spark, f.sf_dir)
    return spatial.assign_regions(f.parcels, {"wedge": (wedges, "ct20")}).select(
        "parcel_seq",
        "wedge",
        F.col("wedge_by_distance").alias("by_distance"),
        F.round("wedge_distance", 6).alias("distance"),
    )


def _structures(f: _Frames) -> DataFrame:
    return cases.case_structures(f.cases)


def _reply_structures(f: _Frames) -> DataFrame:
    rows = f.parsed_replies.select("ain", F.posexplode("structures").alias("pos", "s"))
    return rows.select(
        "ain", "pos", "s.struct_type", "s.sqft", "s.confidence", "s.notes",
        F.array_join("s.evidence_case_numbers", ",").alias("evidence"),
    )


def _issues(f: _Frames) -> DataFrame:
    return f.overlaid.select("parcel_seq", "ain", F.inline("model_issues"))


def _override(f: _Frames) -> DataFrame:
    return f.overlaid.select(
        "parcel_seq", "model_status", *[f"post_{n}" for n in cases.POST_FIELDS], "added_adu_count",
        "sfr_size_comparison",
    )


def _quality(f: _Frames) -> DataFrame:
    return quality.gates(f.warned, ("tract", "block_group"), f.regions, f.subregions, RULES)


def _flagged(f: _Frames) -> DataFrame:
    flagged = f.warnings.filter(F.col("severity") == "data").agg(F.countDistinct("ain").alias("flagged"))
    total = f.parcels.agg(F.count(F.lit(1)).alias("total"))
    return flagged.withColumn("total", total.scalar())


def _match_counts(f: _Frames) -> DataFrame:
    joined = parcels.join_rollup(f.parcels, f.rollup)
    return parcels.match_counts(joined, parcels.orphan_keys(f.parcels, f.cases))


def _case_days(f: _Frames) -> DataFrame:
    return f.cases.select("seq", scalars.epoch_ms_date(F.col("apply_date")).alias("apply_day"))


def _frames(build: Callable[[_Frames], DataFrame]) -> Query:
    return lambda spark, sf: build(_frames_of(spark, sf))


def _on_keys(build: Callable[[_Keyed], DataFrame]) -> Query:
    return lambda spark, sf: build(_Keyed(_frames_of(spark, sf)))


def registered() -> dict[str, Query]:
    flags = [
        "seq", "is_event", "is_permit", "is_primary", "is_qualifying", "desc_signal", "name_signal",
        "mentions_pathway",
    ]
    return {
        "join_cases_left": _frames(
            lambda f: parcels.join_rollup(f.parcels, f.rollup).select(
                F.col("seq").alias("parcel_seq"), F.col("ain_1").alias("ain"), "case_count"
            )
        ),
        "orphan_keys": _frames(lambda f: parcels.orphan_keys(f.parcels, f.cases)),
        "match_counts": _frames(_match_counts),
        "case_flags": _frames(lambda f: f.facts.select(*flags)),
        "case_dates": _frames(_case_days),
        "max_progress": _keyed("max_progress"),
        "primary_pick": _frames(
            lambda f: f.rollup.filter("primary_seq is not null").select("main_ain", "primary_seq")
        ),
        "latest_claim": _frames(lambda f: f.rollup.filter("claim is not null").select("main_ain", "claim")),
        "claim_conflict": _keyed("claim_conflict"),
        "pathway_mentions": _keyed("mentions_pathway"),
        "qualifying_keys": _frames(
            lambda f: f.rollup.select("main_ain", "has_qualifying", "has_qualifying_permit")
        ),
        "first_unit_permit": _frames(
            lambda f: f.rollup.filter("units_unknown is not null").select("main_ain", "units_unknown")
        ),
        "case_structures": _frames(_structures),
        "structure_totals": _frames(
            lambda f: _structures(f)
            .groupBy("struct_type")
            .agg(
                F.count(F.lit(1)).alias("structures"),
                F.count("sqft").alias("with_area"),
                F.sum("sqft").alias("area"),
            )
        ),
        "parcel_post_state": _frames(_post_state),
        "pre_state": _frames(_pre_state),
        "parcel_result": _frames(lambda f: parcels.results(f.analysis)),
        "parcel_csv_rows": _frames(lambda f: tables.parcel_rows(f.analysis)),
        "summary_counts": _frames(lambda f: f.summary),
        "region_assignment": _frames(lambda f: f.assigned.select("parcel_seq", "tract", "block_group")),
        "region_counts": _frames(lambda f: f.region_rows.drop("region_idx", "geometry")),
        "subregion_counts": _frames(lambda f: f.subregion_rows.drop("region_idx", "geometry")),
        "summary_from_cells": _frames(lambda f: counts.summary_of(f.cells)),
        "unassigned": _frames(lambda f: spatial.unassigned(f.assigned, "tract")),
        "nearest_region": _frames(_nearest),
        "parcel_features": _frames(_parcel_features),
        "region_features": _frames(_region_features),
        "warnings": _frames(lambda f: quality.report_order(f.warnings)),
        "warning_rollup": _frames(lambda f: reports.warning_rollup(f.warnings)),
        "warning_table": _frames(lambda f: reports.warning_table(f.warnings, "data", "ain")),
        "flagged_rate": _frames(_flagged),
        "partition_totals": _frames(
            lambda f: quality.partition_totals(f.region_rows, f.subregion_rows).drop("region_idx")
        ),
        "quality_checks": _frames(_quality),
        "content_keys": _on_keys(lambda k: k.keys),
        "extraction_inputs": _on_keys(
            lambda k: extraction.extraction_inputs(k.frames.records, k.keys)
        ),
        "user_prompts": _frames(lambda f: prompts.user_prompts(f.parcels, f.records, RULES)),
        "cache_misses": _on_keys(lambda k: k.misses.select("main_ain", "key")),
        "cache_prune": _on_keys(
            lambda k: extraction.prune_cache(k.keys.withColumnRenamed("main_ain", "ain"), k.frames.parcels)
        ),
        "cache_entries": _cache_entries,
        "reply_status": _frames(lambda f: f.parsed_replies.select("ain", "ok", "reasoning")),
        "reply_structures": _frames(_reply_structures),
        "extraction_issues": _frames(_issues),
        "extraction_override": _frames(_override),
        "extraction_metrics": _on_keys(_extraction_metrics),
        "bucket_shares": _frames(lambda f: reports.bucket_shares(f.summary)),
        "claim_shares": _frames(lambda f: reports.claim_shares(f.summary)),
        "envelope": _frames(lambda f: perimeter.envelope(f.parcels)),
        "regions_in_envelope": _frames(lambda f: f.near_regions.select("ct20", "label")),
        "subregions_of": _frames(
            lambda f: perimeter.children_of(f.subregions, f.near_regions).select("bg20", "ct20")
        ),
        "geometry_kinds": _geometry_texts,
        "largest_ring_centroids": lambda spark, sf: spatial.centroids(_shapes(spark, sf)).select(
            F.col("parcel_seq").alias("seq"), "px", "py"
        ),
        "summary_json": _frames(lambda f: tables.with_generated_at(f.summary, STAMP)),
        "report_head": _frames(
            lambda f: tables.report_head(_quality(f), f.cells.agg(F.sum("total_parcels").alias("total_parcels")), STAMP)
        ),
        "failed_checks": _frames(lambda f: quality.failed_checks(_quality(f))),
        "warnings_disabled": _frames(
            lambda f: quality.report_order(quality.warnings(f.warned, "switched off"))
        ),
        "cache_next": _on_keys(lambda k: k.next_cache.select("key", "ain", "extracted_at", _listed_structures().alias("structures"), "reasoning")),
        "cache_pruned": _on_keys(
            lambda k: extraction.pruned_entries(k.keys.withColumnRenamed("main_ain", "ain"), k.frames.parcels)
        ),
        "contract_problems": _contract_problems,
        "source_filters": _frames(_source_filters),
        "page_flatten": _page_flatten,
        "snapshot_rows": _snapshot_rows,
        "latest_version": _latest_version,
        "record_problems": _record_problems,
        "freshness": _freshness,
        "document_flags": _document_flags,
        "document_segments": _document_segments,
    }
