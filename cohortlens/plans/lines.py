"""Cost, use and admissions per service line and per line prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.config import LINE_PREFIXES
from cohortlens.operators.attribution import BY_STAY_DATE
from cohortlens.operators.cohort import Coverage
from cohortlens.operators.measures import Measure, evaluate
from cohortlens.operators.shared_scan import LineFamily, own_sums
from cohortlens.sources.tables import ClaimTables

SUMS = {"cost": "prm_costs", "util": "prm_util", "admits": "prm_admits"}

# Prefixes overlap, and a line code may equal a prefix: the two then report the same id separately.
PREFIX_MEASURES = [
    Measure(f"{prefix}_{name}", name, f"startswith(prm_line, '{prefix}')") for prefix in LINE_PREFIXES for name in SUMS
]
LINE_MEASURES = [Measure("", name, id_from=f"concat(prm_line, '_{name}')") for name in SUMS]


FAMILY = LineFamily(where="true", policy=BY_STAY_DATE, sums=SUMS, dims={"prm_line": "prm_line"})


def line_metrics(
    tables: ClaimTables, cohort: Coverage, measures: list[Measure] | None = None, summary: DataFrame | None = None
) -> DataFrame:
    """Every measure reads one summary by status and line, so claims are attributed once.

    ``summary`` has the family's sums where they have been taken along with those of others.
    """
    if summary is None:
        summary = own_sums(tables.outclaims, cohort, FAMILY)
    return evaluate(summary, measures or [*PREFIX_MEASURES, *LINE_MEASURES])
