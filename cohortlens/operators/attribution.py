"""Attribution of claim lines to the cohort by member, coverage date and month.

A line belongs to the cohort when one of the member's coverage windows holds its coverage date and the
member was covered in its month. Lines are summed per member, date and measure dimension first: attribution
reads nothing else of a line, and the sums are taken map-side, so a member with very many lines reaches the
join as a handful of rows per day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import SNF_LINE
from cohortlens.functions.dates import month_of
from cohortlens.operators.cohort import Coverage, bucketed_spans, period_bucket


def _stay_start() -> Column:
    """Skilled-nursing lines belong to the month their case began; all others to their own date."""
    return F.when(F.col("prm_line") == SNF_LINE, F.col("prm_fromdate_case")).otherwise(F.col("prm_fromdate"))


@dataclass(frozen=True)
class AttributionPolicy:
    """Which date decides a line's month, and which one has to be covered."""

    month_by: str  # "line", "case" or "stay"
    covered_on: str

    @property
    def single_date(self) -> bool:
        return self.month_by == self.covered_on

    def dated(self, claims: DataFrame) -> DataFrame:
        dates = {"line": F.col("prm_fromdate"), "case": F.col("prm_fromdate_case"), "stay": _stay_start()}
        return claims.withColumns(
            {"claim_month": month_of(dates[self.month_by]), "covered_date": dates[self.covered_on]}
        )


BY_LINE_DATE = AttributionPolicy("line", "line")
BY_CASE_DATE = AttributionPolicy("case", "case")
BY_STAY_DATE = AttributionPolicy("stay", "stay")
# The month follows the stay, while coverage is checked on the line's own date.
BY_STAY_MONTH = AttributionPolicy("stay", "line")


def can_fall_in(cohort: Coverage, policy: AttributionPolicy) -> Column:
    """Whether a line can fall in a cohort month; written on raw columns so that it reaches the scan."""
    first, last = cohort.first_day, cohort.last_day
    line, case = (F.col(c).between(first, last) for c in ("prm_fromdate", "prm_fromdate_case"))
    stay = line | ((F.col("prm_line") == SNF_LINE) & case)  # only these lines are dated by their case
    return {"line": line, "case": case, "stay": stay}[policy.month_by]


def in_cohort_months(claims: DataFrame, cohort: Coverage, policy: AttributionPolicy) -> DataFrame:
    """Drop lines that cannot fall in a cohort month."""
    return claims.where(can_fall_in(cohort, policy))


def attribute(lines: DataFrame, cohort: Coverage, policy: AttributionPolicy) -> DataFrame:
    """Match rows carrying ``claim_month`` and ``covered_date`` to the cohort.

    Adds the cohort's ``status_columns`` and ``copies``, the times that the row counts: once for each coverage window
    that holds the date, in each row that the member has of the month. A row meets one span of days, and one row of the
    calendar for each of the statuses. Months and spans are sort-merged, as they are in the calendar.
    """
    if policy.single_date:
        calendar = cohort.calendar.withColumnsRenamed({"member_id": "_member", "elig_month": "_month"})
        matched = lines.join(
            calendar,
            (F.col("member_id") == F.col("_member"))
            & (F.col("claim_month") == F.col("_month"))
            & F.col("covered_date").between(F.col("date_start"), F.col("date_end")),
        )
        return matched.drop("_member", "_month", "date_start", "date_end")

    months = cohort.status_months.withColumnsRenamed({"elig_month": "claim_month", "copies": "month_copies"})
    spans = bucketed_spans(cohort).withColumnsRenamed({"member_id": "_member", "bucket": "_bucket"})
    matched = lines.join(months.hint("merge"), ["member_id", "claim_month"]).join(
        spans.hint("merge"),
        (F.col("member_id") == F.col("_member"))
        & (period_bucket(cohort, F.col("covered_date")) == F.col("_bucket"))
        & F.col("covered_date").between(F.col("date_start"), F.col("date_end")),
    )
    return matched.withColumn("copies", F.col("copies") * F.col("month_copies")).drop(
        "_member", "_bucket", "date_start", "date_end", "month_copies"
    )


def daily_sums(
    claims: DataFrame, cohort: Coverage, policy: AttributionPolicy, dims: list[str], sums: dict[str, str]
) -> DataFrame:
    """Sum lines per member, month, coverage date and dimension, before anything is joined."""
    dated = policy.dated(in_cohort_months(claims, cohort, policy))
    return dated.groupBy("member_id", "claim_month", "covered_date", *dims).agg(
        *[F.expr(f"sum({value}) AS {name}") for name, value in sums.items()]
    )


def attributed_sums(
    claims: DataFrame,
    cohort: Coverage,
    policy: AttributionPolicy,
    dims: list[str],
    sums: dict[str, str],
    per_member: bool = False,
) -> DataFrame:
    """Sums of attributed lines by status and dimension (and member): the summary that measures read."""
    attributed = attribute(daily_sums(claims, cohort, policy, dims, sums), cohort, policy)
    keys = (["member_id"] if per_member else []) + [*cohort.status_columns, *dims]
    return attributed.groupBy(*keys).agg(*[F.expr(f"sum({name} * copies) AS {name}") for name in sums])
