"""Weights, limits and batch sizes, with their production and demo values."""

from __future__ import annotations

from dataclasses import dataclass

# Similarity weights and class thresholds.
SSN4_WEIGHT = 4.595
DOB_WEIGHT = 3.892
NAME_SCALE = 2.0
MATCH_THRESHOLD = 8.0
POSSIBLE_THRESHOLD = 4.0
MATCH_CLASSES = ("match", "possible_match", "non_match")
# A text shorter than this counts as unreadable.
MIN_TEXT_LENGTH = 50
# File types taken in, files per trigger, completeness floor in percent.
INTAKE_GLOB = "*.{pdf,PDF,tiff,TIFF,tif,TIF}"
MAX_FILES_PER_TRIGGER = 100
COMPLETENESS_FLOOR = 80.0


@dataclass(frozen=True)
class MatchWeights:
    """Agreement adds the field's weight, disagreement takes it away."""

    ssn4: float = SSN4_WEIGHT
    dob: float = DOB_WEIGHT
    name_scale: float = NAME_SCALE
    match_at: float = MATCH_THRESHOLD
    possible_at: float = POSSIBLE_THRESHOLD


@dataclass(frozen=True)
class QualityLimits:
    """Highest tolerated percentages; a value above its limit is a breach."""

    pct_unreadable: float = 5.0
    pct_missing_dob: float = 20.0
    pct_missing_ssn4: float = 30.0


PRODUCTION_LIMITS = QualityLimits()
DEMO_LIMITS = QualityLimits(15.0, 95.0, 95.0)


def parse_bytes(size: int | str) -> int:
    """``"10g"`` -> 10737418240; plain numbers pass through."""
    text = str(size).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    if text and text[-1] in units:
        return int(float(text[:-1]) * (1 << units[text[-1]]))
    return int(text)
