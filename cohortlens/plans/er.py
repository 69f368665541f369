"""Emergency-department measures, with the probability each visit has of being avoidable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numbers import EXACT
from cohortlens.operators.attribution import BY_LINE_DATE
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.measures import Measure, again, evaluate, ids_of, metric_rows, stack, usage_of
from cohortlens.operators.risk import adjust_strict, average_risk, band_table, with_benefit_type
from cohortlens.operators.shared_scan import LineFamily, own_sums
from cohortlens.sources.tables import NYU_PREFIX, ClaimTables

ER_PREFIX = "O11"

VISITS = [Measure("ED", "util")]
ADJUSTED_ID = "ED_rskadj"
# A NULL sum still makes a row: the visits exist, their classification does not.
CLASSIFIED = [
    Measure("ED_emer_nec", "prm_nyu_emergent_non_avoidable"),
    Measure("ED_emer_prev", "prm_nyu_emergent_avoidable"),
    Measure("ED_emer_pricare", "prm_nyu_emergent_primary_care"),
    Measure("ED_injury", "prm_nyu_injury"),
    Measure("ED_nonemer", "prm_nyu_nonemergent"),
]
MEASURES = [*VISITS, *CLASSIFIED]


# Visits are kept apart by case, since a case's classification is joined to them.
FAMILY = LineFamily(
    where=f"startswith(prm_line, '{ER_PREFIX}')",
    policy=BY_LINE_DATE,
    sums={"util": "prm_util"},
    dims={"prm_line": "prm_line", "case_member": "member_id", "caseadmitid": "caseadmitid"},
)


def er_metrics(
    tables: ClaimTables,
    cohort: Coverage,
    consolidate: bool = False,
    measures: list[Measure] = MEASURES,
    adjusted: bool = True,
    visits: DataFrame | None = None,
) -> DataFrame:
    """All emergency measures, or the ones given, from one pass over the visits.

    ``adjusted`` adds the risk-adjusted visits, for which the measures have to include the plain ones. ``visits`` has
    the family's sums where they have been taken along with those of others.
    """
    if visits is None:
        visits = own_sums(tables.outclaims, cohort, FAMILY)
    typed = with_benefit_type(visit_summary(tables, visits), tables.ref_link_hcg_researcher_line)
    rows = evaluate(typed, measures, by=("btnumber",))
    parts = [unadjusted(rows, consolidate)]
    if adjusted:
        parts.append(adjusted_visits(tables, cohort, rows, consolidate))
    return stack(parts)


def visit_summary(tables: ClaimTables, visits: DataFrame) -> DataFrame:
    """Attributed visits per status and service line, plain and weighted by each classification probability.

    A case classified twice counts its visits twice, so the classification is reduced to one row per case with its row
    count and sums.
    """
    nyu = [c for c in tables.decor_case.columns if c.startswith(NYU_PREFIX)]
    cases = tables.decor_case.groupBy(F.col("member_id").alias("case_member"), "caseadmitid").agg(
        F.count(F.lit(1)).alias("case_rows"), *[F.sum(c).alias(c) for c in nyu]
    )
    weighted = visits.join(cases.hint("merge"), ["case_member", "caseadmitid"], "left")
    return weighted.groupBy(*status_keys(visits), "prm_line").agg(
        F.sum(F.col("util") * F.coalesce("case_rows", F.lit(1))).alias("util"),
        *[F.sum((F.col("util") * F.col(c)).cast(EXACT)).alias(c) for c in nyu],
    )


def unadjusted(rows: DataFrame, consolidate: bool = False) -> DataFrame:
    """Visits keep one row per benefit type unless consolidated; everything else is per status."""
    kept_apart = "false" if consolidate else ids_of(VISITS)
    typed = rows.withColumn("kept_type", F.expr(f"if({kept_apart}, btnumber, NULL)"))
    return evaluate(typed, [again()], by=("kept_type",))


def adjusted_visits(tables: ClaimTables, cohort: Coverage, rows: DataFrame, consolidate: bool = False) -> DataFrame:
    """Risk-adjusted visits, for benefit types that have a band; risk is rounded to two digits here."""
    usage = usage_of(rows, VISITS, "visits")
    risk = average_risk(cohort.covered_months, digits=2)
    adjusted = adjust_strict(usage, risk, band_table(tables.ref_hcg_bt), "utilfactor", "visits")
    if consolidate:
        return evaluate(adjusted, [Measure(ADJUSTED_ID, "adjusted")])
    return metric_rows(adjusted, ADJUSTED_ID, "adjusted")
