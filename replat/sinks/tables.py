"""Published tables as files: parcel CSV, feature lines, summary, report; every attempt of a run is kept."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from replat import config
from replat.functions.geometry import to_geojson
from replat.operators.combine import with_one_row
from replat.operators.counts import COUNT_FIELDS


def parcel_rows(results: DataFrame) -> DataFrame:
    """The 28 fields as text: booleans ``true``/``false``, nulls empty."""
    return results.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in config.RESULT_FIELDS]
    )


def write_parcel_csv(results: DataFrame, path: str) -> None:
    (
        parcel_rows(results)
        .write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def _feature(properties: Column, geometry: Column) -> Column:
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(properties, {"ignoreNullFields": "false"}),
        F.lit(',"geometry":'),
        F.coalesce(to_geojson(geometry), F.lit("null")),
        F.lit("}"),
    )


def full_geometry(df: DataFrame) -> Column:
    """The geometry column with every member the conversion looks at."""
    have = {f.name for f in df.schema["geometry"].dataType.fields}
    kinds = {
        "rings": "array<array<array<double>>>",
        "x": "double",
        "y": "double",
        "paths": "array<array<array<double>>>",
    }
    members = [
        (F.col(f"geometry.{n}") if n in have else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()
    ]
    return F.struct(*members)


def parcel_features(assigned: DataFrame) -> DataFrame:
    """One GeoJSON Feature text per parcel row."""
    staged = assigned.withColumn("_geometry", full_geometry(assigned))
    properties = F.struct(*config.RESULT_FIELDS)
    return staged.select("ain", _feature(properties, F.col("_geometry")).alias("value"))


def region_features(region_rows: DataFrame, id_fields: list[str]) -> DataFrame:
    """One GeoJSON Feature text per region, identifiers before counts."""
    staged = region_rows.withColumn("_geometry", full_geometry(region_rows))
    ids = [f.lower() for f in id_fields]
    properties = F.struct(*ids, *COUNT_FIELDS)
    return staged.select(ids[0], _feature(properties, F.col("_geometry")).alias("value"))


def write_lines(features: DataFrame, path: str) -> None:
    """Features as text lines (a GeoJSON text sequence), written in parallel."""
    features.select("value").write.mode("overwrite").text(path)


def with_generated_at(summary: DataFrame, generated_at: str) -> DataFrame:
    return summary.select(F.lit(generated_at).alias("generated_at"), *summary.columns)


def write_summary(summary: DataFrame, path: str, generated_at: str) -> None:
    with_generated_at(summary, generated_at).write.mode("overwrite").json(path)


def report_head(checks: DataFrame, totals: DataFrame, generated_at: str) -> DataFrame:
    """One row: when, how many parcels (``totals``, one row), and whether every gate passed."""
    passed = checks.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"))
    both = with_one_row(totals.select(F.coalesce("total_parcels", F.lit(0)).cast("bigint").alias("total_parcels")), passed)
    return both.select(F.lit(generated_at).alias("generated_at"), "total_parcels", "passed")


# ---------------------------------------------------------------- versions
#
# A table is a folder of attempts, ``snapshot_date=D/attempt=A``. An attempt is written once into a folder of its
# own and never again, so whatever still reads an older one keeps it. ``_versions`` has a file for each attempt that
# counts, named by its number. A writer takes the next number by putting that file where none is; if another
# writer was there first, it takes the one after. So numbers are unique, and no attempt is lost.

_VERSION = "version bigint, snapshot_date string, attempt string"


def attempt_path(path: str, snapshot_date: str, attempt: str) -> str:
    return f"{path}/snapshot_date={snapshot_date}/attempt={attempt}"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The list of a table's attempts; empty before the first."""
    try:
        return spark.read.schema(_VERSION).json(f"{path}/_versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSION)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file where none is; False if there is one. Of several writers exactly one gets True.

    The text is written beside it first, under a name that readers skip, and linked or renamed into place in one step.
    The rename must fail where the target exists, as it does on HDFS; on a local disk a link does that.
    """
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"._{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getScheme() == "file":
            os.link(aside.toUri().getPath(), target.toUri().getPath())
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri()).rename(aside, target, options)
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.toString():
            raise
        return False
    finally:
        files.delete(aside, False)
    return True


def record_version(spark: SparkSession, path: str, snapshot_date: str, attempt: str) -> int:
    """Make a written attempt the newest of its table; its version, which no other attempt has.

    A lost race costs one more try, at the number after, so every try follows another writer's success.
    """
    version = 1 + versions(spark, path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    while not put_if_absent(
        spark, f"{path}/_versions/{version:020d}.json",
        json.dumps({"version": version, "snapshot_date": snapshot_date, "attempt": attempt}) + "\n",
    ):
        version += 1
    return version


def newest(listed: DataFrame, *keys: str) -> DataFrame:
    """The version that counts, of each table (``keys``) among listed ones: of the newest date, the last."""
    last = F.max(F.struct("snapshot_date", "version", "attempt")).alias("last")
    return listed.groupBy(*keys).agg(last).filter(F.col("last").isNotNull()).select(*keys, "last.*")


def _read(spark: SparkSession, path: str, row: Row | None, wanted: str) -> DataFrame:
    if row is None:
        raise FileNotFoundError(f"no version of {path}{wanted}")
    folder = attempt_path(path, row["snapshot_date"], row["attempt"])
    return spark.read.option("basePath", path).parquet(folder)


def latest(spark: SparkSession, path: str, snapshot_date: str | None = None) -> DataFrame:
    """Newest attempt of the newest date, or of one date. Only its folder is listed and read."""
    listed = versions(spark, path)
    if snapshot_date is not None:
        listed = listed.filter(F.col("snapshot_date") == snapshot_date)
    return _read(spark, path, newest(listed).first(), f" for {snapshot_date}" if snapshot_date else "")


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The attempt with one version number, whatever came after it."""
    return _read(spark, path, versions(spark, path).filter(F.col("version") == version).first(), f" {version}")
