"""Outpatient imaging, observation, urgent-care, office-visit and procedure measures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.operators.attribution import BY_LINE_DATE
from cohortlens.operators.cohort import Coverage
from cohortlens.operators.measures import Measure, again, dims_of, evaluate, ids_of, stack
from cohortlens.operators.risk import adjust_strict, average_risk, band_table, with_benefit_type
from cohortlens.operators.shared_scan import LineFamily, own_sums
from cohortlens.sources.tables import ClaimTables

PREFIXES = ("O14", "O10", "P57", "P59", "P33", "P32", "O12")

IMAGING_AND_VISITS = [
    Measure("high_tech_imaging", "util", "startswith(prm_line, 'O14')"),
    Measure("observation_stays", "util", "startswith(prm_line, 'O10')"),
    Measure("hi_tec_img_fop", "util", "startswith(prm_line, 'P57')"),
    Measure("hi_tec_img_office", "util", "startswith(prm_line, 'P59')"),
    Measure("urgent_care_prof", "util", "startswith(prm_line, 'P33')"),
]
OFFICE_VISITS = [Measure("office_visits", "util", "prm_line IN ('P32c', 'P32d')")]
ADJUSTED = [*IMAGING_AND_VISITS, *OFFICE_VISITS]

_PREVENTABLE = "psp IS NOT NULL AND startswith(prm_line, 'O12')"
PSP_PROCEDURES = [
    Measure("psp_procs", "cases", _PREVENTABLE, ("psp",)),
    Measure("", "cases", _PREVENTABLE, ("psp",), id_from="concat('psp_procs_', psp)"),
]


FAMILY = LineFamily(
    where=" OR ".join(f"startswith(prm_line, '{prefix}')" for prefix in PREFIXES),
    policy=BY_LINE_DATE,
    sums={"util": "prm_util", "cases": "mr_cases_admits"},
    dims={"prm_line": "prm_line", "psp": "if(psp_preventable_yn = 'Y', psp_category, NULL)"},
)


def outpatient_metrics(
    tables: ClaimTables,
    cohort: Coverage,
    adjusted: list[Measure] | None = None,
    counts: list[Measure] | None = None,
    summary: DataFrame | None = None,
) -> DataFrame:
    """All outpatient measures, or just the ones given.

    ``summary`` has the family's sums where they have been taken along with those of others.
    """
    if adjusted is None and counts is None:
        adjusted, counts = ADJUSTED, PSP_PROCEDURES
    adjusted, counts = adjusted or [], counts or []
    if summary is None:
        summary = visit_summary(tables, cohort, [*adjusted, *counts])
    typed = with_benefit_type(summary, tables.ref_link_hcg_researcher_line)
    # Both parts start from these rows and choose theirs by value, not by a filter, so that Spark computes the
    # rows once.
    rows = evaluate(typed, [*adjusted, *counts], by=("btnumber",))
    parts = []
    if adjusted:
        parts.append(risk_adjusted_usage(tables, cohort, rows, adjusted))
    if counts:
        parts.append(evaluate(rows, [again(f"NOT {ids_of(ADJUSTED)}")]))
    return stack(parts)


def visit_summary(tables: ClaimTables, cohort: Coverage, measures: list[Measure]) -> DataFrame:
    """Attributed usage and cases per status, service line and the dimensions the measures need."""
    return own_sums(tables.outclaims, cohort, FAMILY.with_dims(["prm_line", *dims_of(measures)]))


def risk_adjusted_usage(
    tables: ClaimTables, cohort: Coverage, rows: DataFrame, measures: list[Measure]
) -> DataFrame:
    """Usage with a risk band and its adjusted value; usage without a band is missing from both."""
    risk = average_risk(cohort.covered_months, digits=3, null_as_zero=True)
    banded = adjust_strict(rows, risk, band_table(tables.ref_hcg_bt), "utilfactor", "metric_value")
    mine = ids_of(measures)
    return evaluate(
        banded,
        [again(mine), Measure("", "adjusted", mine, id_from="concat(metric_id, '_riskadj')")],
    )
