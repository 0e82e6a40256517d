"""Row-local mappings and small formatters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replat import config
from replat.functions.text import strip

_MS_PER_DAY = 86_400_000


def column_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """An optional source column: null when the source does not carry it."""
    present = {c.lower(): c for c in df.columns}
    if name.lower() in present:
        return F.col(present[name.lower()])
    return F.lit(None).cast(dtype)


def lookup(key: Column, table: dict) -> Column:
    """Exact-match lookup; null for a null or unknown key."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def damage_level(raw: Column) -> Column:
    return F.coalesce(lookup(raw, config.DAMAGE_LEVELS), F.lit("no_data"))


def safety_tag(raw: Column) -> Column:
    return F.coalesce(lookup(strip(raw), config.SAFETY_TAGS), F.lit("none"))


def progress_label(num: Column) -> Column:
    return lookup(num.cast("int"), config.PROGRESS_LABELS)


def first_non_empty(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols])


def stripped_or_null(raw: Column) -> Column:
    return F.nullif(strip(raw.cast("string")), F.lit(""))


def int_or_zero(raw: Column) -> Column:
    return F.coalesce(raw.try_cast("bigint"), F.lit(0).cast("bigint"))


def size_comparison(pre: Column, post: Column, tolerance: int) -> Column:
    diff = post - pre
    return (
        F.when(pre.isNull() | post.isNull(), F.lit(None).cast("string"))
        .when(F.abs(diff) <= tolerance, F.lit("identical"))
        .when(diff > 0, F.lit("larger"))
        .otherwise(F.lit("smaller"))
    )


def added_units(pre: Column, post: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.greatest(zero, F.coalesce(post, zero) - pre)


def size_bucket(pre: Column, post: Column) -> Column:
    ratio = post.cast("double") / F.nullif(pre, F.lit(0)).cast("double")
    return (
        F.when(pre.isNull() | post.isNull() | (pre <= 0), F.lit("unknown"))
        .when(ratio < 0.7, F.lit("smaller_over_30"))
        .when(ratio < 0.9, F.lit("smaller_10_to_30"))
        .when(ratio <= 1.10, F.lit("within_10"))
        .when(ratio <= 1.30, F.lit("larger_10_to_30"))
        .otherwise(F.lit("larger_over_30"))
    )


def pre_state_text(counts: dict[str, Column], areas: dict[str, Column]) -> Column:
    """``"1 SFR (1200 SF total), …"`` with ``?`` for an unknown or zero area."""
    parts = []
    for label in config.DWELLING_TYPES:
        area = F.coalesce(F.nullif(areas[label], F.lit(0)).cast("string"), F.lit("?"))
        text = F.concat(
            counts[label].cast("string"), F.lit(f" {label.upper()} ("), area, F.lit(" SF total)")
        )
        parts.append(F.when(counts[label] > 0, text))
    return F.coalesce(F.nullif(F.concat_ws(", ", *parts), F.lit("")), F.lit("(none recorded)"))


def epoch_ms_date(ms: Column) -> Column:
    """UTC day of an epoch-millisecond value, whatever the session time zone is."""
    days = F.floor(ms.cast("double") / _MS_PER_DAY)
    # 0001-01-01 to 9999-12-31: the days a calendar date can name
    valid = days.between(-719_162, 2_932_896)
    text = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days.try_cast("int")), "yyyy-MM-dd")
    return F.when(ms.isNull(), F.lit("(unknown)")).when(valid, text).otherwise(F.lit("(invalid)"))


def is_stale(generated_at: Column, as_of: Column, hours: int) -> Column:
    age = as_of.cast("timestamp").cast("double") - generated_at.cast("timestamp").cast("double")
    return age > hours * 3600


def json_string(text: Column) -> Column:
    """JSON string literal in ASCII: anything outside it becomes ``\\uXXXX``."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def char(c: Column) -> Column:
        code = F.ascii(c)
        high = F.lit(0xD800) + F.shiftright(code - 0x10000, 10)
        low = F.lit(0xDC00) + (code - 0x10000) % 0x400
        return (
            F.when(c == '"', F.lit('\\"'))
            .when(c == "\\", F.lit("\\\\"))
            .when(c == "\n", F.lit("\\n"))
            .when(c == "\r", F.lit("\\r"))
            .when(c == "\t", F.lit("\\t"))
            .when(c == "\b", F.lit("\\b"))
            .when(c == "\f", F.lit("\\f"))
            .when((code >= 32) & (code < 127), c)
            .when(code == 127, c)
            .when(code > 0xFFFF, F.concat(unit(high), unit(low)))
            .otherwise(unit(code))
        )

    plain = text.rlike(r'\A[\x20-\x21\x23-\x5b\x5d-\x7f]*\z')
    escaped = F.array_join(F.transform(F.split(text, ""), char), "")
    return F.concat(F.lit('"'), F.when(plain, text).otherwise(escaped), F.lit('"'))
