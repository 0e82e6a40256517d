"""Schema checks on raw variant records: presence, type, non-empty keys, non-empty sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat.sources.snapshots import has_geometry

_STRING = "STRING"
_NUMBER = "BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN"
_NULL = "VOID"

# Fixed contracts: field -> (accepted types, null accepted). The first field is the key, if named.
PARCEL_CONTRACT = {
    "AIN_1": (_STRING, False),
    "DAMAGE_1": (_STRING, True),
    "SQFTmain1": (_NUMBER, True),
    "DesignType1": (_STRING, True),
    "COMMUNITY": (_STRING, True),
}
CASE_CONTRACT = {
    "MAIN_AIN": (_STRING, False),
    "MODULENAME": (_STRING, False),
    "REBUILD_PROGRESS_NUM": (_NUMBER, True),
    "DESCRIPTION": (_STRING, True),
}
TRACT_CONTRACT = {"CT20": (_STRING, False)}
BLOCK_GROUP_CONTRACT = {"BG20": (_STRING, False)}


class SchemaError(ValueError):
    """A record does not match its contract; ``field`` names the offending field."""

    def __init__(self, message: str, field: str | None = None) -> None:
        super().__init__(message)
        self.field = field


def _problem(name: str, kinds: str, nullable: bool, is_key: bool) -> Column:
    """``missing``, ``mistyped``, ``empty`` or null for one field of one record."""
    value = F.try_variant_get("attributes", f"$.{name}", "variant")
    accepted = f"^({kinds}{'|' + _NULL if nullable else ''})$"
    problem = F.when(value.isNull(), "missing").when(
        ~F.schema_of_variant(value).rlike(accepted), "mistyped"
    )
    if is_key:
        problem = problem.when(F.try_variant_get("attributes", f"$.{name}", "string") == "", "empty")
    return problem


def record_problems(features: DataFrame, contract: dict[str, tuple[str, bool]]) -> DataFrame:
    """(seq, field_no, field, problem): every violation of every record, in one narrow pass."""
    key = next(iter(contract))
    found = F.array(
        *[
            F.struct(
                F.lit(i).alias("field_no"),
                F.lit(name).alias("field"),
                _problem(name, kinds, nullable, name == key).alias("problem"),
            )
            for i, (name, (kinds, nullable)) in enumerate(contract.items())
        ]
    )
    bad = F.filter(found, lambda p: p["problem"].isNotNull())
    return features.select("seq", F.inline(bad))


def validate(features: DataFrame, contract: dict[str, tuple[str, bool]], label: str) -> None:
    """Raise on the first violation in source order, or when the source has no rows. One job."""
    problems = record_problems(features, contract)
    worst = problems.agg(F.min(F.struct("seq", "field_no", "field", "problem")).alias("worst"))
    rows = features.agg(F.count(F.lit(1)).alias("rows"))
    found = rows.withColumn("worst", worst.scalar()).first()
    if found["rows"] == 0:
        raise SchemaError(f"{label}: source returned no rows")
    if found["worst"] is not None:
        bad = found["worst"]
        raise SchemaError(
            f"{label}: field {bad['field']!r} is {bad['problem']} in record {bad['seq']}", bad["field"]
        )


def validate_geometry(features: DataFrame, label: str) -> None:
    """The perimeter has no required fields, only a geometry on every record."""
    counts = features.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~has_geometry(F.col("geometry"))).alias("bare")
    ).first()
    if counts["rows"] == 0:
        raise SchemaError(f"{label}: source returned no rows")
    if counts["bare"]:
        raise SchemaError(f"{label}: record without geometry", "geometry")
