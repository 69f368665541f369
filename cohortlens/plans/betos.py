"""Cost by procedure group and service line, with runout and date-basis flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.dates import month_of
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.sources.tables import ClaimTables

KEYS = [
    "prm_betos_code",
    "prm_line",
    "runout_7_yn",
    "runout_14_yn",
    "fromdate_elig_yn",
    "todate_elig_yn",
]


def _yn(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def betos_summary(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Claims that start or end in the period, in the month they start, or end if they start outside it.

    Coverage windows play no part here, and the period is never narrowed to the year to date.
    """
    period = cohort.report_period
    starts, ends = period.holds("prm_fromdate"), period.holds("prm_todate")
    claims = tables.outclaims.where(starts | ends).withColumns(
        {
            "elig_month": month_of(F.when(starts, F.col("prm_fromdate")).otherwise(F.col("prm_todate"))),
            "runout_7_yn": _yn(F.col("paiddate") <= period.after_end(days=7)),
            "runout_14_yn": _yn(F.col("paiddate") <= period.after_end(days=14)),
            "fromdate_elig_yn": _yn(starts),
            "todate_elig_yn": _yn(ends),
        }
    )
    monthly = claims.groupBy("member_id", "elig_month", *KEYS).agg(F.sum("prm_costs").alias("costs"))
    summed = (
        monthly.join(cohort.status_months.hint("merge"), ["member_id", "elig_month"])
        .groupBy(*KEYS, *cohort.status_columns)
        .agg(F.sum(F.col("costs") * F.col("copies")).alias("costs"))
    )
    rows = cohort.expanded(summed)
    return rows.groupBy(*KEYS, *status_keys(rows)).agg(F.sum("costs").cast("double").alias("costs"))
