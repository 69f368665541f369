"""What one report run is parameterised by, and the values that are fixed for every run."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

# --- Fixed values -----------------------------------------------------------------------------
# They have to be exactly these for the results to be right.

SNF_LINE = "I31"
WELLNESS_HCPCS = ("G0402", "G0438", "G0439", "G0468")
HOSPICE_LINES = ("P82d", "P82e")
NON_ESRD_STATUSES = ("Aged Non-Dual", "Aged Dual", "Disabled")
LINE_PREFIXES = ("I", "I11", "P32", "O16", "P34", "P99", "P2", "P")

# Yearly expenditure limit of a full-year member, by eligibility status.
TRUNCATION_THRESHOLDS = {
    "Aged Non-Dual": 147189,
    "Aged Dual": 236991,
    "Disabled": 177548,
    "ESRD": 507077,
}
# Limit of every other status: not prorated, and not the same in the two places it is used.
UNLISTED_THRESHOLD_BASIC = 99999999
UNLISTED_THRESHOLD_SUMMARY = 99999999999

# Risk band -> closed interval of average risk scores; any other band is OPEN_RISK_BAND.
RISK_BANDS = {
    "<0.50": (-1.0, 0.499),
    "0.50-0.59": (0.5, 0.599),
    "0.60-0.69": (0.6, 0.699),
    "0.70-0.79": (0.7, 0.799),
    "0.80-0.89": (0.8, 0.899),
    "0.90-0.99": (0.9, 0.999),
    "1.00-1.09": (1.0, 1.099),
    "1.10-1.19": (1.1, 1.199),
    "1.20-1.34": (1.2, 1.349),
    "1.35-1.49": (1.35, 1.499),
    "1.50-1.74": (1.5, 1.749),
    "1.75-2.00": (1.75, 1.999),
}
OPEN_RISK_BAND = (2.0, 500.0)
# --- End of fixed values ------------------------------------------------------------------------


class Assignment(Enum):
    """Which members belong to the cohort."""

    CURRENT = "current"  # assigned now
    JULY_FIRST = "july_first"  # on the 1 July roster
    DURING_PERIOD = "during_period"  # assigned in the month in question


@dataclass(frozen=True)
class ReportConfig:
    """The switches of one report run."""

    client: str = "client"
    runout_months: int = 3
    year_to_date: bool = False
    assignment: Assignment = Assignment.DURING_PERIOD
    # One row per status for the skilled-nursing and emergency usage counts, not one per benefit type.
    consolidate_usage: bool = False
    # Leave averages and distinct counts out of the Non-ESRD roll-up, where a sum has no meaning.
    additive_rollup_only: bool = False
