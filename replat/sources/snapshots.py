"""Reading raw snapshots and pages, and landing them once as bronze Parquet.

Raw records stay ``VARIANT``: a declared read schema would turn a missing field, a null and a mistyped
value into the same null, and validation has to tell them apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replat.functions.geometry import GEOMETRY_TYPE
from replat.sinks import tables
from replat.sources import documents

_ENVELOPE = "source string, fetched_at string"
_PAGE = "features array<struct<attributes:variant,geometry:variant>>"

# Fixed field names of the published layers, with the types the operators read.
PARCEL_FIELDS = {
    "AIN_1": "string", "APN_1": "string", "SitusFullAddress": "string", "SitusAddress": "string",
    "COMMUNITY": "string", "UseDescription": "string", "DAMAGE_1": "string", "BSD_Tag": "string",
    "Permit_Status": "string", "ROE_Status": "string", "Debris_Cleared": "string", "DINS_Count": "string",
    **{f"DesignType{i}": "string" for i in range(1, 6)},
    **{f"SQFTmain{i}": "double" for i in range(1, 6)},
}
CASE_FIELDS = {
    "MAIN_AIN": "string", "CASENUMBER": "string", "MODULENAME": "string", "WORKCLASS_NAME": "string",
    "REBUILD_PROGRESS_NUM": "double", "APPLY_DATE": "double", "DESCRIPTION": "string",
    "PROJECT_NAME": "string", "PROJECTNAME": "string", "PROJECT_NUMBER": "string", "STATUS": "string",
    "DISASTER_TYPE": "string", "NEW_DWELLING_UNITS": "double",
}
TRACT_FIELDS = {"CT20": "string", "LABEL": "string"}
BLOCK_GROUP_FIELDS = {"BG20": "string", "CT20": "string", "LABEL": "string"}


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """(source, fetched_at, seq, attributes, geometry) from snapshot files with a ``records`` array.

    A file is read by as many tasks as it has splits; see :mod:`replat.sources.documents`. ``seq`` is the order of file
    and record: the order that decides ties everywhere. A file without the array has no rows; a record that is not
    JSON stops the run.
    """
    return snapshot_rows(documents.split_lines(spark, path), file_places(spark, path))


def snapshot_rows(lines: DataFrame, places: DataFrame) -> DataFrame:
    """The records of documents given as lines; ``places`` has (file, place)."""
    found = documents.elements(lines, "records")
    head = F.from_json("text", _ENVELOPE)
    outside = found.filter("pos < 0").select("file", head["source"].alias("source"), head["fetched_at"].alias("fetched_at"))
    records = found.filter("pos >= 0").select("file", "pos", F.parse_json("text").alias("attributes"))
    return records.join(outside, "file").join(places, "file").select(
        "source",
        "fetched_at",
        _sequence(F.col("place"), F.col("pos")),
        "attributes",
        F.variant_get("attributes", "$._geometry", "variant").alias("geometry"),
    )


def file_places(spark: SparkSession, path: str) -> DataFrame:
    """(file, place): the files of a path in the order of the number in their name, then of the path, counted from 0.

    It comes from the listing; no file is opened.
    """
    listed = spark.read.format("binaryFile").load(path)
    return in_order(listed.select(F.col("_metadata.file_path").alias("file")), page_number(F.col("_metadata.file_name")))


def in_order(files: DataFrame, *before: Column) -> DataFrame:
    order = Window.orderBy(*before, "file")
    return files.select("file", (F.row_number().over(order) - 1).alias("place"))


def _sequence(place: Column, pos: Column) -> Column:
    """One number for (file, position), unique for any file of less than 2 ** 32 records."""
    return (F.shiftleft(place.cast("bigint"), 32) + pos).alias("seq")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Feature pages, one JSON file each, in the order of the number in the file name, then of the path.

    Pages are small and parsed in parallel, one task per file. ``seq`` is (place of the file, position in it).
    """
    raw = spark.read.option("multiLine", True).schema(_PAGE).json(path)
    return flatten_pages(raw.select(F.col("_metadata.file_path").alias("file"), "features"), file_places(spark, path))


def page_number(name: Column) -> Column:
    """Last number in a file name; null without one, which stands before all numbers."""
    return F.regexp_extract(name, r"(\d+)\D*$", 1).try_cast("bigint")


def flatten_pages(pages: DataFrame, places: DataFrame) -> DataFrame:
    """One row per feature of a (file, features) table; geometry may still be absent. ``places`` has (file, place)."""
    rows = pages.join(places, "file").select("place", F.posexplode("features").alias("pos", "feature"))
    return rows.select(
        _sequence(F.col("place"), F.col("pos")),
        F.col("feature.attributes").alias("attributes"),
        F.col("feature.geometry").alias("geometry"),
    )


def has_geometry(geometry: Column) -> Column:
    return geometry.isNotNull() & ~F.coalesce(F.is_variant_null(geometry), F.lit(True))


def drop_without_geometry(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, one-row count of the dropped ones)."""
    present = has_geometry(F.col("geometry"))
    dropped = features.agg(F.count_if(~present).alias("dropped"))
    return features.filter(present), dropped


def typed(features: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Typed columns (lower-case names) of variant rows, plus ``seq`` and the geometry struct."""
    columns = [
        F.try_variant_get("attributes", f"$.{name}", dtype).alias(name.lower())
        for name, dtype in fields.items()
    ]
    shape = F.try_variant_get("geometry", "$", GEOMETRY_TYPE).alias("geometry")
    return features.select(F.col("seq").cast("bigint").alias("seq"), *columns, shape)


def only_event_area(parcels: DataFrame, community: str) -> DataFrame:
    """Parcels of the community; on Parquet the comparison is pushed into the scan."""
    return parcels.filter(F.col("community") == community)


def only_event_cases(cases: DataFrame, label: str) -> DataFrame:
    return cases.filter(F.col("disaster_type") == label)


def land_bronze(features: DataFrame, path: str, source: str, fetched_at: str, snapshot_date: str) -> None:
    """Keep one fetch as Parquet under its date. Landing a date again adds a version, which counts from then on."""
    attempt = uuid.uuid4().hex
    stamped = features.withColumns({"source": F.lit(source), "fetched_at": F.lit(fetched_at)})
    stamped.write.parquet(tables.attempt_path(path, snapshot_date, attempt))
    tables.record_version(features.sparkSession, path, snapshot_date, attempt)


def read_bronze(spark: SparkSession, path: str, snapshot_date: str | None = None) -> DataFrame:
    """One dated fetch, the latest by default. Only its folder is listed and read."""
    return tables.latest(spark, path, snapshot_date)
