"""Cost truncation at a member's yearly limit, and paid-date runout, as SQL expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.config import TRUNCATION_THRESHOLDS


def truncation_limit(unlisted: int) -> str:
    """The status's yearly limit, prorated to the member's covered months (``memmos``)."""
    whens = " ".join(f"WHEN '{status}' THEN {limit} * memmos / 12" for status, limit in TRUNCATION_THRESHOLDS.items())
    return f"CASE elig_status {whens} ELSE CAST({unlisted} AS double) END"


def truncated(cost: str, unlisted: int) -> str:
    """``cost`` or the member's limit, whichever is less; a NULL limit does not bind."""
    return f"least({truncation_limit(unlisted)}, CAST({cost} AS double))"


def cutoffs_met(paid_date: str, cutoffs: dict[str, Column]) -> Column:
    """How many cut-offs, taken from the latest to the earliest, a payment made.

    With cut-offs in ascending order this one number says for each of them whether it was met.
    """
    return reduce(
        lambda met, cutoff: met + F.when(F.col(paid_date) <= cutoff, 1).otherwise(0), cutoffs.values(), F.lit(0)
    )


def met_cutoff(met: str, cutoffs: tuple[str, ...], name: str) -> str:
    """Whether a row with this count of met cut-offs made the one called ``name``."""
    return f"{met} >= {len(cutoffs) - cutoffs.index(name)}"
