"""Free text to typed structures, as built-in column expressions (no Python in the tasks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replat import config

STRUCTURES_TYPE = "array<struct<seg_idx:int,struct_type:string,sqft:double,raw_segment:string>>"

_FLAGS = "(?iU)"
# White space as the source data's own tooling counts it: Unicode plus the four separators.
_BLANK = r"[\s\x1c-\x1f]"
_LINE_BREAK = r"\r\n|[\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
_LINE_BLANK = r"[\s\x1f&&[^\n]]"


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive, Unicode-aware search; null text gives false."""
    return F.coalesce(text.rlike(_FLAGS + pattern), F.lit(False))


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, rf"(?U)\A{_BLANK}+|{_BLANK}+\z", "")


def split_lines(text: Column) -> Column:
    """Text lines with every line break kind recognised; a final break opens no empty line."""
    unified = F.regexp_replace(text, _LINE_BREAK, "\n")
    return F.split(F.regexp_replace(unified, r"\n\z", ""), "\n")


def mentions_pathway(text: Column) -> Column:
    return matches(text, config.SB9)


def claim_signal(text: Column) -> Column:
    """False for a denied claim, true for a stated one, null when the text is silent."""
    return F.when(matches(text, config.CLAIM_DENIED), F.lit(False)).when(
        matches(text, config.CLAIM_MADE), F.lit(True)
    )


def segments(text: Column) -> Column:
    """Numbered-list items (with any preamble as its own item), or the whole text as one item."""
    has_list = text.rlike(r"(?U)(?:\A|\n)\s*\d+\.\s")
    unified = F.regexp_replace(text, _LINE_BREAK, "\n")
    marker = rf"{_LINE_BLANK}*\d+\.{_LINE_BLANK}"
    items = F.split(unified, rf"(?U)(?:\A|\n)(?={marker})")
    bare = F.transform(items, lambda s: strip(F.regexp_replace(s, rf"(?U)\A{marker}", "")))
    whole = F.array(strip(text))
    found = F.filter(F.when(has_list, bare).otherwise(whole), lambda s: s != "")
    return F.coalesce(found, F.array().cast("array<string>"))


# Marks put around matches so that one pattern pass yields texts and positions. The scanned copy of a
# segment never holds them: both stand for "neither letter, digit nor blank", like the mark they give way to.
_CUT, _PAIR, _PLAIN = "\x00", "\x02", "\x01"


def _scannable(segment: Column) -> Column:
    marked = segment.contains(_CUT) | segment.contains(_PAIR)
    clean = F.translate(segment, _CUT + _PAIR, _PLAIN + _PLAIN)
    return F.when(marked, clean).otherwise(segment)


def _earliest(segment: Column, tier: tuple[tuple[str, str], ...]) -> Column:
    """``struct<start, label>`` of the tier's earliest match, null without one.

    The tier runs as one alternation in label order, so that of two labels at one place the smaller wins.
    Everything from the match on is replaced by its groups; the text before them gives the start. Every
    pattern starts at a word boundary: testing it once in front skips most positions at once.
    """
    tier = tuple(sorted(tier))
    pattern = r"(?isU)\b(?:" + "|".join(f"({rx})" for _, rx in tier) + ").*"
    groups = "".join(f"{_CUT}${i + 1}" for i in range(len(tier)))
    pieces = F.split(F.regexp_replace(segment, pattern, groups), _CUT)

    def found(p: Column) -> Column:
        label = F.coalesce(
            *[F.when(F.get(p, F.lit(i + 1)) != "", F.lit(label)) for i, (label, _) in enumerate(tier)]
        )
        return F.struct(F.length(F.get(p, F.lit(0))).alias("start"), label.alias("label"))

    hit = F.get(F.transform(F.array(pieces), found), F.lit(0))
    return F.filter(F.array(hit), lambda h: h["label"].isNotNull())


def _nearest_area(segment: Column, anchor: Column) -> Column:
    """Area figure starting closest to the anchor, first on ties; without an anchor the first one.

    The marked text is cut into gaps and figures by turns; the fold keeps the running position.
    """
    marked = F.regexp_replace(segment, f"(?iU){config.AREA}", f"{_CUT}$1{_PAIR}$0{_CUT}")
    zero = F.struct(
        F.lit(0).alias("pos"),
        F.lit(False).alias("is_figure"),
        F.lit(None).cast("int").alias("dist"),
        F.lit(None).cast("string").alias("value"),
    )

    def step(acc: Column, piece: Column) -> Column:
        value = F.substring_index(piece, _PAIR, 1)
        dist = F.coalesce(F.abs(acc["pos"] - anchor), F.lit(0))
        closer = acc["is_figure"] & (acc["dist"].isNull() | (dist < acc["dist"]))
        figure_length = F.length(piece) - F.length(value) - 1
        return F.struct(
            (acc["pos"] + F.when(acc["is_figure"], figure_length).otherwise(F.length(piece))).alias("pos"),
            (~acc["is_figure"]).alias("is_figure"),
            F.when(closer, dist).otherwise(acc["dist"]).alias("dist"),
            F.when(closer, value).otherwise(acc["value"]).alias("value"),
        )

    return F.aggregate(
        F.split(marked, _CUT),
        zero,
        step,
        lambda acc: F.replace(acc["value"], F.lit(","), F.lit("")).try_cast("double"),
    )


def structures(text: Column) -> Column:
    """Typed structures of a description: ``array<struct<seg_idx, struct_type, sqft, raw_segment>>``.

    Stacked ``transform`` calls bind each intermediate once, so no pattern runs twice on a segment.
    """
    scanned = F.transform(
        F.transform(segments(text), lambda s: F.struct(s.alias("raw"), _scannable(s).alias("scan"))),
        lambda x, i: F.struct(
            i.alias("idx"),
            x["raw"].alias("raw"),
            x["scan"].alias("scan"),
            F.coalesce(*[F.get(_earliest(x["scan"], tier), F.lit(0)) for tier in config.TYPE_TIERS]).alias("hit"),
        ),
    )
    return F.transform(
        scanned,
        lambda x: F.struct(
            x["idx"].alias("seg_idx"),
            F.coalesce(x["hit"]["label"], F.lit("unknown")).alias("struct_type"),
            _nearest_area(x["scan"], x["hit"]["start"]).alias("sqft"),
            x["raw"].alias("raw_segment"),
        ),
    )


def structure_totals(items: Column) -> Column:
    """One pass over a structure array: count and area per dwelling type, plus what the gates ask."""
    no_area = F.lit(None).cast("double")
    zero = [F.lit(0).cast("bigint").alias("segments")]
    for label in config.DWELLING_TYPES:
        zero += [F.lit(0).cast("bigint").alias(f"{label}_count"), no_area.alias(f"{label}_sqft")]
    zero += [F.lit(False).alias("any_parsed"), F.lit(False).alias("any_sfr_area")]
    zero += [F.lit(True).alias("all_unknown")]

    def step(acc: Column, s: Column) -> Column:
        fields = [(acc["segments"] + 1).alias("segments")]
        for label in config.DWELLING_TYPES:
            here = s["struct_type"] == label
            count, area = acc[f"{label}_count"], acc[f"{label}_sqft"]
            fields += [
                F.when(here, count + 1).otherwise(count).alias(f"{label}_count"),
                F.when(here & s["sqft"].isNotNull(), F.coalesce(area, F.lit(0.0)) + s["sqft"])
                .otherwise(area)
                .alias(f"{label}_sqft"),
            ]
        known = s["struct_type"] != "unknown"
        sfr_area = (s["struct_type"] == "sfr") & s["sqft"].isNotNull()
        fields += [
            (acc["any_parsed"] | known | s["sqft"].isNotNull()).alias("any_parsed"),
            (acc["any_sfr_area"] | sfr_area).alias("any_sfr_area"),
            (acc["all_unknown"] & ~known).alias("all_unknown"),
        ]
        return F.struct(*fields)

    return F.aggregate(items, F.struct(*zero), step)
