"""Inpatient admission measures; every one of them leaves skilled-nursing stays out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.config import SNF_LINE
from cohortlens.operators.attribution import BY_LINE_DATE
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.measures import Measure, dims_of, evaluate, stack
from cohortlens.operators.risk import adjust_lenient, average_risk, band_table, with_benefit_type
from cohortlens.operators.shared_scan import LineFamily, own_sums
from cohortlens.sources.tables import ClaimTables

PQI = [
    Measure("pqi", "admits", "pqi <> 'none'", ("pqi",)),
    Measure("", "admits", "pqi <> 'none'", ("pqi",), id_from="concat(pqi, '_admits')"),
]
PSP_ADMITS = [
    Measure("psp_admits", "admits", "psp IS NOT NULL", ("psp",)),
    Measure("", "admits", "psp IS NOT NULL", ("psp",), id_from="concat('psp_admits_', psp)"),
]
ONE_DAY = [
    Measure("Denom_1_Day_LOS", "admits"),
    Measure("Num_1_Day_LOS", "admits", "one_day", ("one_day",)),
]
ONE_DAY_MEDICAL = [
    Measure("Num_1_Day_LOS_Medical", "admits", "one_day AND startswith(prm_line, 'I11')", ("one_day",)),
    Measure("Denom_1_Day_LOS_Medical", "admits", "startswith(prm_line, 'I11')"),
]
READMITS = [
    Measure("cnt_pot_readmits", "admits", "readmit_potential", ("readmit_potential",)),
    Measure("cnt_ip_readmits", "admits", "readmit_all_cause", ("readmit_all_cause",)),
]
SNF_DISCHARGE = [Measure("disch_snf", "admits", "to_snf", ("to_snf",))]
COUNTS = [*PQI, *PSP_ADMITS, *ONE_DAY, *ONE_DAY_MEDICAL, *READMITS, *SNF_DISCHARGE]

# Each of these is followed by its risk-adjusted twin, with the suffix _riskadj.
ACUTE = [Measure("acute", "admits")]
MEDICAL = [Measure("medical_general", "admits", "prm_line = 'I11a'")]
SURGICAL = [Measure("surgical", "admits", "prm_line = 'I12'")]
ADJUSTED = [*ACUTE, *MEDICAL, *SURGICAL]


# Leaving skilled-nursing lines out makes the claim month and the covered date the same date.
FAMILY = LineFamily(
    where=f"startswith(prm_line, 'I') AND prm_line <> '{SNF_LINE}'",
    policy=BY_LINE_DATE,
    sums={"admits": "prm_admits"},
    dims={
        "prm_line": "prm_line",
        "pqi": "prm_ahrq_pqi",
        "psp": "if(psp_preventable_yn = 'Y', psp_category, NULL)",
        "one_day": "coalesce(prm_util = 1, false)",
        "readmit_potential": "coalesce(prm_readmit_potential_yn = 'Y', false)",
        "readmit_all_cause": "coalesce(prm_readmit_all_cause_yn = 'Y', false)",
        "to_snf": "coalesce(dischargestatus = '03', false)",
    },
)


def inpatient_metrics(
    tables: ClaimTables,
    cohort: Coverage,
    counts: list[Measure] | None = None,
    adjusted: list[Measure] | None = None,
    summary: DataFrame | None = None,
) -> DataFrame:
    """All inpatient measures, or just the ones given; both parts read the same summary.

    ``summary`` has the family's sums where they have been taken along with those of others.
    """
    if counts is None and adjusted is None:
        counts, adjusted = COUNTS, ADJUSTED
    if summary is None:
        summary = admission_summary(tables, cohort, counts or [])
    summary = with_benefit_type(summary, tables.ref_link_hcg_researcher_line)
    parts = []
    if counts:
        parts.append(evaluate(summary, counts))
    if adjusted:
        parts.append(evaluate(risk_adjusted_admits(tables, cohort, summary), with_adjusted_twins(adjusted)))
    return stack(parts)


def admission_summary(tables: ClaimTables, cohort: Coverage, measures: list[Measure]) -> DataFrame:
    """Attributed admissions per status, service line and the dimensions the measures need."""
    return own_sums(tables.outclaims, cohort, FAMILY.with_dims(["prm_line", *dims_of(measures)]))


def risk_adjusted_admits(tables: ClaimTables, cohort: Coverage, summary: DataFrame) -> DataFrame:
    """Admissions per status, service line and benefit type, with the risk-adjusted count beside the raw one."""
    usage = summary.groupBy(*status_keys(summary), "prm_line", "btnumber").agg(F.sum("admits").alias("admits"))
    risk = average_risk(cohort.covered_months, digits=3, null_as_zero=True)
    return adjust_lenient(usage, risk, band_table(tables.ref_hcg_bt), "admitfactor", "admits")


def with_adjusted_twins(measures: list[Measure]) -> list[Measure]:
    return [
        twin for m in measures for twin in (m, Measure(f"{m.metric_id}_riskadj", "adjusted", m.where, m.dims))
    ]
