"""Contributing factors: spelling normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadtally.functions.text import clean_text, map_values

UNSPECIFIED = "unspecified"
MISSING = "missing"
PLACEHOLDERS = (UNSPECIFIED, MISSING)

# Lower-case spelling -> label.
FACTOR_LABELS = {
    # Vehicle defects
    "accelerator defective": "vehicle defect",
    "brakes defective": "vehicle defect",
    "steering failure": "vehicle defect",
    "tire failure/inadequate": "vehicle defect",
    "headlights defective": "vehicle defect",
    "other lighting defects": "vehicle defect",
    "tow hitch defective": "vehicle defect",
    "driverless/runaway vehicle": "vehicle defect",
    "oversized vehicle": "vehicle defect",
    "other vehicular": "vehicle defect",
    # Driver behavior
    "aggressive driving/road rage": "aggressive driving",
    "unsafe lane changing": "unsafe maneuver",
    "turning improperly": "unsafe maneuver",
    "backing unsafely": "unsafe maneuver",
    "passing or lane usage improper": "unsafe maneuver",
    "passing too closely": "tailgating",
    "following too closely": "tailgating",
    "failure to yield right-of-way": "failure to yield",
    "failure to keep right": "failure to keep right",
    "unsafe speed": "speeding",
    # Distraction
    "driver inattention/distraction": "driver inattention",
    "outside car distraction": "external distraction",
    "passenger distraction": "passenger distraction",
    "cell phone (hand-held)": "cell phone use",
    "cell phone (hands-free)": "cell phone use",
    "texting": "cell phone use",
    "using on board navigation device": "cell phone use",
    "listening/using headphones": "distraction",
    "other electronic device": "distraction",
    "eating or drinking": "distraction",
    # Driver condition
    "fatigued/drowsy": "driver fatigue",
    "fell asleep": "driver fatigue",
    "driver inexperience": "driver inexperience",
    "alcohol involvement": "substance impairment",
    "drugs (illegal)": "substance impairment",
    "prescription medication": "substance impairment",
    "lost consciousness": "driver illness",
    "illness": "driver illness",
    "illnes": "driver illness",
    "physical disability": "driver illness",
    # Environmental or road factors
    "animals action": "animal on road",
    "obstruction/debris": "road obstruction",
    "pavement defective": "road defect",
    "pavement slippery": "slippery pavement",
    "lane marking improper/inadequate": "road defect",
    "shoulders defective/improper": "road defect",
    "traffic control device improper/non-working": "traffic control issue",
    "traffic control disregarded": "traffic violation",
    "view obstructed/limited": "visibility issue",
    "glare": "visibility issue",
    "windshield inadequate": "visibility issue",
    "tinted windows": "visibility issue",
    # Pedestrian or others
    "pedestrian/bicyclist/other pedestrian error/confusion": "pedestrian or bicyclist error",
    "reaction to other uninvolved vehicle": "reaction to other vehicle",
    "reaction to uninvolved vehicle": "reaction to other vehicle",
    # Miscellaneous
    "vehicle vandalism": "vandalism",
    "1": "unspecified",
    "80": "unspecified",
    "unspecified": "unspecified",
}

# The earlier, finer scheme.
FINE_FACTOR_LABELS = {
    "accelerator defective": "accelerator defective",
    "brakes defective": "brake failure",
    "steering failure": "steering failure",
    "tire failure/inadequate": "tire failure",
    "headlights defective": "vehicle defect",
    "other lighting defects": "vehicle defect",
    "tow hitch defective": "vehicle defect",
    "driverless/runaway vehicle": "vehicle defect",
    "oversized vehicle": "vehicle defect",
    "other vehicular": "vehicle defect",
    "aggressive driving/road rage": "aggressive driving",
    "unsafe lane changing": "unsafe lane change",
    "backing unsafely": "unsafe backing",
    "passing or lane usage improper": "improper lane usage",
    "passing too closely": "following too closely",
    "failure to yield right-of-way": "failure to yield",
    "failure to keep right": "failure to keep right",
    "unsafe speed": "unsafe speed",
    "driver inattention/distraction": "driver inattention",
    "outside car distraction": "outside distraction",
    "passenger distraction": "passenger distraction",
    "cell phone (hand-held)": "cell phone use",
    "cell phone (hands-free)": "cell phone use",
    "texting": "cell phone use",
    "using on board navigation device": "navigation device use",
    "listening/using headphones": "distraction",
    "fatigued/drowsy": "driver fatigue",
    "fell asleep": "driver fatigue",
    "driver inexperience": "driver inexperience",
    "alcohol involvement": "alcohol involvement",
    "drugs (illegal)": "drug involvement",
    "prescription medication": "drug involvement",
    "lost consciousness": "driver illness",
    "illness": "driver illness",
    "illnes": "driver illness",
    "physical disability": "driver illness",
    "animals action": "animal action",
    "obstruction/debris": "road obstruction",
    "pavement defective": "road defect",
    "pavement slippery": "slippery road",
    "lane marking improper/inadequate": "lane marking issue",
    "shoulders defective/improper": "road defect",
    "traffic control device improper/non-working": "traffic signal issue",
    "traffic control disregarded": "traffic violation",
    "view obstructed/limited": "visibility issue",
    "glare": "visibility issue",
    "windshield inadequate": "visibility issue",
    "tinted windows": "visibility issue",
    "pedestrian/bicyclist/other pedestrian error/confusion": "pedestrian or bicyclist error",
    "reaction to other uninvolved vehicle": "reaction to other vehicle",
    "reaction to uninvolved vehicle": "reaction to other vehicle",
    "vehicle vandalism": "vehicle vandalism",
    "1": "unspecified",
    "80": "unspecified",
    "unspecified": "unspecified",
    "unknown": "unknown",
}


def factor_labels(scheme: str = "main") -> dict[str, str]:
    """Mapping of the 'main' scheme or of the earlier 'fine' one."""
    if scheme == "main":
        return dict(FACTOR_LABELS)
    if scheme != "fine":
        raise ValueError(f"unknown factor scheme {scheme!r}")
    return dict(FINE_FACTOR_LABELS)


def normalize_factor(c: Column | str, scheme: str = "main") -> Column:
    """Stripped, lower-cased factor with known spellings mapped; others stay."""
    return map_values(clean_text(c), factor_labels(scheme))


def is_unspecified(c: Column) -> Column:
    return F.coalesce(clean_text(c) == UNSPECIFIED, F.lit(True))
