"""Skilled-nursing stay measures, dated by the stay's case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.config import SNF_LINE
from cohortlens.functions.numbers import exact_sum
from cohortlens.operators.attribution import BY_CASE_DATE
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.measures import Measure, dims_of, evaluate, ids_of, metric_rows, stack, usage_of
from cohortlens.operators.risk import adjust_strict, average_risk, band_table, with_benefit_type
from cohortlens.operators.shared_scan import LineFamily, own_sums
from cohortlens.sources.tables import ClaimTables

ADMITS = [Measure("SNF", "admits")]
ADJUSTED_ID = "SNF_rskadj"
LONG_STAYS = [Measure("number_SNF_over_21_days", "admits", "over_21_days", ("over_21_days",))]
ALL_CAUSE_READMITS = [Measure("number_SNF_readmits", "admits", "readmit_all_cause", ("readmit_all_cause",))]
FLAGGED_READMITS = [
    Measure("SNF_Readmits", "admits", "readmit_numer", ("readmit_numer",)),
    Measure("SNF_Readmits_denom", "admits", "readmit_denom", ("readmit_denom",)),
]
# Marks the facilities seen; they are counted, not added up.
FACILITIES = [Measure("distinct_SNFs", "1")]
MEASURES = [*ADMITS, *LONG_STAYS, *ALL_CAUSE_READMITS, *FACILITIES, *FLAGGED_READMITS]


FAMILY = LineFamily(
    where=f"startswith(prm_line, '{SNF_LINE}')",
    policy=BY_CASE_DATE,
    sums={"admits": "prm_admits"},
    dims={
        "prm_line": "prm_line",
        "providerid": "providerid",
        "over_21_days": "coalesce(prm_util > 21, false)",
        "readmit_all_cause": "coalesce(prm_readmit_all_cause_yn = 'Y', false)",
        "readmit_numer": "coalesce(snfrm_numer_yn = 'Y', false)",
        "readmit_denom": "coalesce(snfrm_denom_yn = 'Y', false)",
    },
)


def snf_metrics(
    tables: ClaimTables,
    cohort: Coverage,
    consolidate: bool = False,
    measures: list[Measure] = MEASURES,
    adjusted: bool = True,
    summary: DataFrame | None = None,
) -> DataFrame:
    """All skilled-nursing measures, or the ones given, from one pass over the stays.

    ``adjusted`` adds the risk-adjusted admits, for which the measures have to include the plain ones. ``summary`` has
    the family's sums where they have been taken along with those of others.
    """
    if summary is None:
        summary = own_sums(tables.outclaims, cohort, FAMILY.with_dims(["prm_line", "providerid", *dims_of(measures)]))
    rows = facility_rows(tables, summary, measures)
    parts = [unadjusted(rows, consolidate)]
    if adjusted:
        parts.append(adjusted_admits(tables, cohort, rows, consolidate))
    return stack(parts)


def facility_rows(tables: ClaimTables, summary: DataFrame, measures: list[Measure]) -> DataFrame:
    """The measures per status, benefit type and facility."""
    typed = with_benefit_type(summary, tables.ref_link_hcg_researcher_line)
    return evaluate(typed, measures, by=("btnumber", "providerid"))


def unadjusted(rows: DataFrame, consolidate: bool = False) -> DataFrame:
    """Admissions keep one row per benefit type unless consolidated; everything else is per status."""
    kept_apart = "false" if consolidate else ids_of(ADMITS)
    counted, keys = ids_of(FACILITIES), status_keys(rows)
    return (
        rows.withColumn("kept_type", F.expr(f"if({kept_apart}, btnumber, NULL)"))
        .groupBy(*keys, "metric_id", "kept_type")
        .agg(
            exact_sum("metric_value").alias("summed"),
            F.expr(f"count(DISTINCT if({counted}, providerid, NULL))").alias("facilities"),
        )
        .select(*keys, "metric_id", F.expr(f"if({counted}, CAST(facilities AS double), summed) AS metric_value"))
    )


def adjusted_admits(tables: ClaimTables, cohort: Coverage, rows: DataFrame, consolidate: bool = False) -> DataFrame:
    """Risk-adjusted admissions, for benefit types that have a band."""
    usage = usage_of(rows, ADMITS, "admits")
    risk = average_risk(cohort.covered_months, digits=3)
    adjusted = adjust_strict(usage, risk, band_table(tables.ref_hcg_bt), "admitfactor", "admits")
    if consolidate:
        return evaluate(adjusted, [Measure(ADJUSTED_ID, "adjusted")])
    return metric_rows(adjusted, ADJUSTED_ID, "adjusted")
