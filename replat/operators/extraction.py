"""The second, model-made extraction: content keys, reply parsing, cache, comparison, override.

Calling the model is outside. This module produces what is sent (see ``prompts``) and turns the replies,
a table of (key, content, token counts), into extractions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replat import config
from replat.config import DEFAULT_RULES, Rules
from replat.functions import scalars
from replat.functions.scalars import json_string
from replat.functions.text import strip
from replat.operators.cases import POST_FIELDS, is_event_case, is_qualifying
from replat.operators.combine import with_one_row

STRUCTURE_TYPE = (
    "struct<struct_type:string,sqft:bigint,confidence:string,"
    "evidence_case_numbers:array<string>,notes:string>"
)
EXTRACTION_COLUMNS = (
    "key", "ain", "extracted_at", "model", "prompt_version", "structures", "reasoning",
    "input_tokens", "output_tokens",
)


def qualifying_records(cases: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Event cases a model may reason about: rebuild permits and rebuild plans."""
    return cases.filter(is_event_case(cases, rules) & is_qualifying(cases, rules))


def qualifying_facts(facts: DataFrame) -> DataFrame:
    """The same records from the case facts, whose text digests stand in for the texts."""
    return facts.filter(F.col("is_event") & F.col("is_qualifying"))


# ---------------------------------------------------------------- content keys


def _pair(a: Column, b: Column) -> Column:
    return F.concat(F.lit("["), json_string(a), F.lit(", "), json_string(b), F.lit("]"))


#: Hex digits of a record's digest that go into each sum: 60 bits, so that a DECIMAL holds any number of them.
_LANE = 15
_LANES = 4


def content_keys(records: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """(main_ain, key): a hash over the parcel key, model, prompt version and the records as a multiset.

    Takes qualifying records or qualifying facts. Each record's number and text digest are hashed; the
    hashes are added up, four sums of 60 bits each, and the sums are hashed with the rest. So the key is the
    same for any order of the records, copies count, and a parcel of any size is summed map-side.
    """
    if "digest" in records.columns:
        digest = F.col("digest")
    else:
        digest = F.sha2(F.coalesce(F.col("description"), F.lit("")), 256)
    record = F.sha2(_pair(F.coalesce(F.col("casenumber"), F.lit("")), digest), 256)
    lanes = [
        F.conv(F.substring("record", 1 + _LANE * i, _LANE), 16, 10).cast("decimal(20,0)") for i in range(_LANES)
    ]
    sums = (
        records.select("main_ain", record.alias("record"))
        .groupBy("main_ain")
        .agg(F.count(F.lit(1)).alias("records"), *[F.sum(c).alias(f"sum{i}") for i, c in enumerate(lanes)])
    )
    listed = F.concat_ws(", ", *[F.col(f"sum{i}").cast("string") for i in range(_LANES)])
    body = F.concat(
        F.lit('{"ain": '), json_string(F.col("main_ain")),
        F.lit(', "model": '), json_string(F.lit(rules.model)),
        F.lit(f', "prompt_version": {rules.prompt_version}, "records": '), F.col("records").cast("string"),
        F.lit(', "sums": ['), listed, F.lit("]}"),
    )
    return sums.select("main_ain", F.concat(F.lit("sha256:"), F.sha2(body, 256)).alias("key"))


def extraction_inputs(records: DataFrame, keys: DataFrame) -> DataFrame:
    """Which cases went into which key, one row each."""
    number = F.coalesce(F.col("casenumber"), F.lit("")).alias("case_number")
    return records.select("main_ain", "seq", number).join(keys, "main_ain").drop("main_ain")


# ---------------------------------------------------------------- replies


def _type_of(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit(""))


def _document(text: Column) -> Column:
    """The text as one JSON value, null unless the whole text is one."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.when(single, F.try_variant_get(listed, "$[0]", "variant"))


def _coerce_structure(item: Column) -> Column:
    def member(name: str, dtype: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", dtype)

    kind = F.lower(member("struct_type", "string"))
    area_type = _type_of(member("sqft", "variant"))
    area = (
        F.when(area_type.isin("BIGINT", "BOOLEAN"), member("sqft", "bigint"))
        .when(area_type.rlike("^(DOUBLE|FLOAT|DECIMAL)"), member("sqft", "double").try_cast("bigint"))
    )
    confidence = F.lower(member("confidence", "string"))

    def kept(e: Column) -> Column:
        text = e.cast("string")
        empty = F.when(_type_of(e) == "STRING", text == "").otherwise(
            text.isin("0", "0.0", "false", "[]", "{}")
        )
        return text.isNotNull() & ~empty

    evidence = F.transform(
        F.filter(member("evidence_case_numbers", "array<variant>"), kept), lambda e: e.cast("string")
    )
    return F.struct(
        F.when(kind.isin(*config.RESPONSE_TYPES), kind).otherwise(F.lit("other")).alias("struct_type"),
        area.alias("sqft"),
        F.when(confidence.isin(*config.RESPONSE_CONFIDENCES), confidence)
        .otherwise(F.lit("low"))
        .alias("confidence"),
        F.coalesce(evidence, F.array().cast("array<string>")).alias("evidence_case_numbers"),
        F.nullif(member("notes", "string"), F.lit("")).alias("notes"),
    )


def parse_replies(replies: DataFrame) -> DataFrame:
    """Adds ``ok``, ``structures`` and ``reasoning`` to a table with a ``content`` column.

    The whole reply must be a JSON object, or hold one in a code fence; anything else is a failure.
    Inside it nothing fails: unknown types become ``other``, textual areas null, odd confidences low.
    """
    whole = _document(strip(F.col("content")))
    fenced = _document(F.regexp_extract("content", f"(?is){config.FENCED_JSON}", 1))
    doc = F.col("_doc")
    listed = F.try_variant_get(doc, "$.structures", "array<variant>")
    objects = F.filter(listed, lambda v: _type_of(v).startswith("OBJECT"))
    return (
        replies.withColumn("_whole", whole)
        .withColumn("_doc", F.when(F.col("_whole").isNotNull(), F.col("_whole")).otherwise(fenced))
        .withColumn("ok", _type_of(doc).startswith("OBJECT"))
        .withColumn(
            "structures",
            F.when(
                F.col("ok"),
                F.coalesce(
                    F.transform(objects, _coerce_structure), F.array().cast(f"array<{STRUCTURE_TYPE}>")
                ),
            ),
        )
        .withColumn(
            "reasoning",
            F.when(F.col("ok"), F.coalesce(F.try_variant_get(doc, "$.reasoning", "string"), F.lit(""))),
        )
        .drop("_doc", "_whole")
    )


# ---------------------------------------------------------------- cache


def cache_misses(keys: DataFrame, cache: DataFrame) -> DataFrame:
    """Parcels whose content key has no stored extraction: the ones to send out."""
    return keys.join(cache.select("key"), "key", "left_anti")


def new_extractions(
    misses: DataFrame, replies: DataFrame, extracted_at: str, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Usable replies for the missing keys, in the cache's shape. ``replies`` is keyed by ``key``.

    A column ``arrived`` orders the replies to one key.
    """
    parsed = parse_replies(replies.join(misses, "key")).filter("ok")
    entry = F.struct(
        F.col("main_ain").alias("ain"),
        F.lit(extracted_at).alias("extracted_at"),
        F.lit(rules.model).alias("model"),
        F.lit(rules.prompt_version).alias("prompt_version"),
        "structures",
        "reasoning",
        F.col("input_tokens").cast("bigint").alias("input_tokens"),
        F.col("output_tokens").cast("bigint").alias("output_tokens"),
    )
    # of several usable answers to a key the first to arrive counts; without an order, the smallest text
    order = F.struct(*[F.col(c) for c in ("arrived",) if c in parsed.columns], "content")
    return parsed.groupBy("key").agg(F.min_by(entry, order).alias("entry")).select("key", "entry.*")


def next_cache(cache: DataFrame, added: DataFrame, parcels: DataFrame) -> DataFrame:
    """The cache of the next run: entries whose parcel still exists, and the new ones."""
    return prune_cache(cache.select(*EXTRACTION_COLUMNS), parcels).unionByName(added.select(*EXTRACTION_COLUMNS))


def prune_cache(cache: DataFrame, parcels: DataFrame) -> DataFrame:
    """Entries whose parcel still exists."""
    known = parcels.select(F.col("ain_1").alias("ain")).distinct()
    return cache.join(known, "ain", "left_semi")


def pruned_entries(cache: DataFrame, parcels: DataFrame) -> DataFrame:
    """One row: how many entries belong to parcels that are gone."""
    known = parcels.select(F.col("ain_1").alias("ain")).distinct()
    return cache.join(known, "ain", "left_anti").agg(F.count(F.lit(1)).alias("pruned"))


# ---------------------------------------------------------------- comparison and override


def _of_kind(kinds: tuple[str, ...]):
    return lambda s: s["struct_type"].isin(*kinds)


def _model_post(structures: Column) -> dict[str, Column]:
    """Counts and areas per dwelling type; the junior unit counts as an accessory unit here."""
    out = {}
    for label in config.DWELLING_TYPES:
        kinds = ("adu", "jadu") if label == "adu" else (label,)
        mine = F.filter(structures, _of_kind(kinds))
        areas = F.filter(F.transform(mine, lambda s: s["sqft"]), lambda a: a.isNotNull())
        total = F.aggregate(areas, F.lit(0).cast("bigint"), lambda acc, a: acc + a)
        out[f"{label}_count"] = F.size(mine).cast("bigint")
        out[f"{label}_sqft"] = F.when(F.size(areas) > 0, total)
    return out


def _issue(code: str, detail: Column, severity: str = "info") -> Column:
    return F.struct(
        F.lit(code).alias("code"), F.lit(severity).alias("severity"), detail.alias("detail")
    )


def _issues(rules: Rules) -> Column:
    """Warnings of one parcel row that has both the text result and a model result (``model`` struct)."""
    reasoning = F.concat(F.lit("reasoning: "), F.substring(F.col("reasoning"), 1, 160))
    has_permit = F.col("has_qualifying_permit")

    def text_count(label: str) -> Column:
        return F.coalesce(F.col(f"post_{label}_count"), F.lit(0))

    found = [
        F.when(
            ~has_permit & (F.greatest(*[F.col(f"model.{t}_count") for t in config.DWELLING_TYPES]) > 0),
            _issue(
                "extraction_only_llm",
                F.lit(
                    "no qualifying PermitManagement record; structures "
                    "inferred from PlanManagement records via LLM"
                ),
            ),
        )
    ]
    for label in config.DWELLING_TYPES:
        mine, theirs = text_count(label), F.col(f"model.{label}_count")
        area, other = F.col(f"post_{label}_sqft"), F.col(f"model.{label}_sqft")
        gap = F.abs(area - other).cast("double") / F.nullif(area, F.lit(0)).cast("double")
        found += [
            F.when(
                has_permit & (mine != theirs),
                _issue(
                    "extraction_count_disagreement",
                    F.concat(F.lit(f"{label}: regex="), mine, F.lit(", llm="), theirs, F.lit("; "), reasoning),
                ),
            ),
            F.when(
                has_permit & (mine == theirs) & (area > 0) & (gap > rules.model_area_tolerance),
                _issue(
                    "extraction_sqft_disagreement",
                    F.concat(F.lit(f"{label}: regex_sqft="), area, F.lit(", llm_sqft="), other),
                ),
            ),
        ]
    low = F.exists("structures", lambda s: s["confidence"] == "low")
    found.append(
        F.when(
            low,
            _issue(
                "extraction_low_confidence",
                F.concat(F.lit("LLM marked at least one structure as low-confidence; "), reasoning),
            ),
        )
    )
    return F.filter(F.array(*found), lambda w: w.isNotNull())


def apply_extractions(
    analysis: DataFrame, extractions: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Overlay model extractions (``ain``, ``structures``, ``reasoning``) on the text results.

    Adds ``model_status`` (skipped, failed, extracted) and ``model_issues``. Parcels without a
    qualifying record are never sent; a missing extraction keeps the text result and warns.
    """
    wanted = ("parcel_seq", "has_qualifying")
    assert all(c in analysis.columns for c in wanted)
    given = extractions.select(
        F.col("ain").alias("_ain"), "structures", "reasoning", F.lit(True).alias("_given")
    )
    joined = analysis.join(given, analysis["ain"] == given["_ain"], "left").withColumn(
        "model_status",
        F.when(~F.col("has_qualifying"), "skipped")
        .when(F.col("_given").isNull(), "failed")
        .otherwise("extracted"),
    )
    used = F.col("model_status") == "extracted"
    model = _model_post(F.col("structures"))
    staged = joined.withColumn("model", F.when(used, F.struct(*[c.alias(n) for n, c in model.items()])))
    no_issue = F.array().cast("array<struct<code:string,severity:string,detail:string>>")
    failed = F.array(
        _issue("llm_extraction_failed", F.lit("LLM call failed or returned unparseable output"), "data")
    )
    staged = staged.withColumn(
        "model_issues",
        F.when(used, _issues(rules)).when(F.col("model_status") == "failed", failed).otherwise(no_issue),
    )
    replaced = {
        f"post_{f}": F.when(used, F.col(f"model.{f}")).otherwise(F.col(f"post_{f}")) for f in POST_FIELDS
    }
    replaced["added_adu_count"] = F.when(
        used, scalars.added_units(F.col("pre_adu_count"), F.col("model.adu_count"))
    ).otherwise(F.col("added_adu_count"))
    replaced["sfr_size_comparison"] = F.when(
        used,
        scalars.size_comparison(F.col("pre_sfr_sqft"), F.col("model.sfr_sqft"), rules.size_tolerance),
    ).otherwise(F.col("sfr_size_comparison"))
    return staged.withColumns(replaced).drop("_ain", "_given", "structures", "reasoning", "model")


def run_info(overlaid: DataFrame, new_entries: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row of run counters. A hit is an extracted parcel row that needed no new cache entry."""
    misses = new_entries.agg(F.countDistinct("key").alias("cache_misses"))
    return with_one_row(overlaid.agg(*_run_counts()), misses).select(*_run_columns(rules))


_RUN_COUNTS = ("parcels_attempted", "parcels_extracted", "parcels_failed", "plan_only_parcels")


def _run_counts() -> list[Column]:
    status = F.col("model_status")
    attempted = status.isin("failed", "extracted")
    found = (attempted, status == "extracted", status == "failed", attempted & ~F.col("has_qualifying_permit"))
    return [F.count_if(c).alias(n) for n, c in zip(_RUN_COUNTS, found, strict=True)]


def _run_columns(rules: Rules) -> list[Column | str]:
    return [
        F.lit(True).alias("enabled"),
        F.lit(rules.model).alias("model"),
        F.lit(rules.prompt_version).cast("bigint").alias("prompt_version"),
        *_RUN_COUNTS,
        (F.col("parcels_extracted") - F.col("cache_misses")).alias("cache_hits"),
        "cache_misses",
    ]


def no_run_info(spark: SparkSession, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The counters' row of a run without the model step."""
    zeros = (
        "parcels_attempted", "parcels_extracted", "parcels_failed", "plan_only_parcels", "cache_hits",
        "cache_misses",
    )
    return spark.range(1).select(
        F.lit(False).alias("enabled"),
        F.lit("").alias("model"),
        F.lit(rules.prompt_version).cast("bigint").alias("prompt_version"),
        *[F.lit(0).cast("bigint").alias(n) for n in zeros],
    )


#: Metric of each warning code: the parcels that carry it.
_CODE_METRICS = {
    "count_disagreements": "extraction_count_disagreement", "sqft_disagreements": "extraction_sqft_disagreement",
    "low_confidence_parcels": "extraction_low_confidence", "extraction_failures": "llm_extraction_failed",
}


def _distinct_keys(flags: dict[str, Column]) -> list[Column]:
    return [F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]


def extraction_metrics(info: DataFrame, warnings: DataFrame) -> DataFrame:
    """Run counters plus distinct parcels per warning code and the agreement rate.

    A key's rows are combined to one flag for each code first, so that flags can be counted.
    """
    per_key = warnings.groupBy("ain").agg(*_distinct_keys({n: F.col("code") == code for n, code in _CODE_METRICS.items()}))
    by_code = per_key.agg(*[F.count_if(n).alias(n) for n in _CODE_METRICS])
    return _with_rate(with_one_row(info, by_code))


def _with_rate(both: DataFrame) -> DataFrame:
    differing = F.col("count_disagreements") + F.col("sqft_disagreements")
    agreed = 1.0 - differing / F.nullif(F.col("parcels_extracted"), F.lit(0))
    return both.withColumn("agreement_rate", F.bround(F.coalesce(agreed, F.lit(1.0)), 4))


def run_metrics(warned: DataFrame, new_entries: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The row of :func:`run_info` and :func:`extraction_metrics` from one pass over rows that carry their warnings."""

    def carries(code: str) -> Column:
        return F.exists("warnings", lambda w: w["code"] == code)

    flags = {n: carries(code) for n, code in _CODE_METRICS.items()}
    per_key = warned.groupBy("ain").agg(*_run_counts(), *_distinct_keys(flags))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _RUN_COUNTS]
    counts = per_key.agg(*sums, *[F.count_if(n).alias(n) for n in _CODE_METRICS])
    both = with_one_row(counts, new_entries.agg(F.countDistinct("key").alias("cache_misses")))
    return _with_rate(both.select(*_run_columns(rules), *_CODE_METRICS))
