"""Fixed values of the domain (labels, patterns, thresholds) and the column contract of the result."""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------------------------
# These must equal the published ones or the counts change.
# --------------------------------------------------------------------------------------------

DAMAGE_LEVELS = {
    "No Damage": "no_damage",
    "No Data/Vacant": "no_data",
    "Affected (1-9%)": "affected",
    "Minor (10-25%)": "minor",
    "Major (26-50%)": "major",
    "Destroyed (>50%)": "destroyed",
}
SAFETY_TAGS = {"Red": "red", "Yellow": "yellow", "Green": "green"}
PROGRESS_LABELS = {
    1: "Rebuild Applications Received",
    2: "Zoning Reviews Cleared",
    3: "Full Building Plans Received",
    4: "Building Plans Approved",
    5: "Building Permits Issued",
    6: "Rebuild In Construction",
    7: "Construction Completed",
}
PROMPT_PROGRESS_LABELS = {
    1: "Plans Submitted",
    2: "Plans Under Review",
    3: "Plans Approved",
    4: "Permit Issued",
    5: "Construction Started",
    6: "Issued",
    7: "Finaled",
}

# Text patterns, without flags. Spark runs them case-insensitive and Unicode-aware.
SFR = r"\bSF[RDH]\b|\bSINGLE[\s-]+FAMIL"
ADU = r"\bADUS?\b|\bACCESSORY\s+DWELL"
JADU = r"\bJADUS?\b|\bJUNIOR\s+ADU"
SB9 = r"\bSB[\- ]?9\b|\bSENATE\s+BILL\s*9"
MFR = r"\bDUPLEX\b|\bTRIPLEX\b|\bMFR\b|\bMULTI[\s-]*FAMIL|\bCONDO\s+UNIT"
GARAGE = r"\bGARAGE\b|\bCARPORT\b"
TEMPORARY_HOUSING = (
    r"\bTEMP(?:\.|ORARY)?\s+HOUSING|\b(?:RV|MOTOR\s+HOME|TRAILER|CAMPER)\b"
)
REPAIR = (
    r"\bREPAIR\b|\bALTERATION\b|\bREPLACE\b|\bRENOVAT|\bRESTORATION\b|\bREMODEL\b|\bTENANT\s+IMPROV"
)
RETAINING_WALL = r"\bRETAINING\s+WALL|\bCMU\s+WALL|\b(?:LANDSCAPING|GRADING)\b"
SEISMIC = r"\bSEISMIC\s+(?:RETROFIT|UPGRADE|REROFIT)"
AREA = (
    r"\b(\d[\d,]*\.?\d*)"
    r"(?:\s*S\.?\s*[FQ]\.?|[\s-]+(?:square|sq)\s*\.?[\s-]*(?:foot|feet|ft\.?))"
)
CLAIM_DENIED = r"non[\s-]*like[\s-]*for[\s-]*like"
CLAIM_MADE = r"like[\s-]*for[\s-]*like"
# Own patterns for the area gate: it counts texts that seem to state an area, whatever SFR and AREA find in them.
PROBE_SFR = r"\bSF[RDH]\b|\bSINGLE[\s-]+FAMIL"
PROBE_AREA = r"\b\d[\d,]*\.?\d*\s*S\.?\s*[FQ]"
FENCED_JSON = r"```(?:json)?\s*(\{.*?\})\s*```"

# (label, pattern) per tier: the first tier with a hit decides, the earliest hit wins in it.
PRIMARY_TIER = (("jadu", JADU), ("adu", ADU), ("sfr", SFR), ("mfr", MFR))
PATHWAY_TIER = (("sfr", SB9),)
SECONDARY_TIER = (("garage", GARAGE),)
NON_STRUCTURAL_TIER = (
    ("temporary_housing", TEMPORARY_HOUSING),
    ("repair", REPAIR),
    ("retaining_wall", RETAINING_WALL),
    ("seismic", SEISMIC),
)
TYPE_TIERS = (PRIMARY_TIER, PATHWAY_TIER, SECONDARY_TIER, NON_STRUCTURAL_TIER)

DWELLING_TYPES = ("sfr", "adu", "mfr")
RESPONSE_TYPES = ("sfr", "adu", "jadu", "mfr", "garage", "repair", "other")
RESPONSE_CONFIDENCES = ("high", "medium", "low")

# The 28 published parcel fields, in order.
RESULT_FIELDS = (
    "ain", "apn", "address", "damage", "bsd_status",
    "pre_sfr_count", "pre_sfr_sqft", "pre_adu_count", "pre_adu_sqft", "pre_mfr_count", "pre_mfr_sqft",
    "post_sfr_count", "post_sfr_sqft", "post_adu_count", "post_adu_sqft", "post_mfr_count",
    "post_mfr_sqft",
    "lfl_claimed", "lfl_conflict", "sfr_size_comparison", "adds_sb9", "added_adu_count",
    "rebuild_progress_num", "rebuild_progress", "permit_status", "roe_status", "debris_cleared",
    "dins_count",
)


@dataclass(frozen=True)
class Rules:
    """Everything a deployment may want to change. The defaults are the published values."""

    event_label: str = "Eaton Fire (01-2025)"
    event_text: str = "eaton fire"
    community: str = "Altadena"

    permit_module: str = "PermitManagement"
    plan_module: str = "PlanManagement"
    permit_work_classes: tuple[str, ...] = ("New", "Rebuild Project")
    plan_work_class: str = "Rebuild"

    slots: int = 5
    size_tolerance: int = 10
    model_area_tolerance: float = 0.10
    min_area: int = 200
    max_area: int = 20_000

    min_parse_rate: float = 0.90
    min_area_rate: float = 0.85
    max_warning_rate: float = 0.05
    min_completed: int = 1

    prompt_version: int = 2
    model: str = ""

    stale_after_hours: int = 96


DEFAULT_RULES = Rules()
