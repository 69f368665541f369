"""Reporting period and calendar expressions."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReportingPeriod:
    """The incurred-date range of a report; ``period_id`` keys the risk scores that belong to it."""

    period_id: Any
    start: date
    end: date

    def year_to_date(self) -> ReportingPeriod:
        return replace(self, start=date(self.end.year, 1, 1))

    def holds(self, column: str) -> Column:
        return F.col(column).between(F.lit(self.start), F.lit(self.end))

    def after_end(self, months: int = 0, days: int = 0) -> Column:
        """A runout cut-off: months first, then days, past the last day of the period."""
        return F.date_add(F.add_months(F.lit(self.end), months), days)

    @property
    def label(self) -> str:
        first, last = ((d.year, (d.month + 2) // 3) for d in (self.start, self.end))
        return f"{first[0]}Q{first[1]}_{last[0]}Q{last[1]}"


def lookup_period(time_periods: DataFrame, runout_months: int) -> ReportingPeriod:
    """The single period with this claims runout; its dates become literals that prune every scan."""
    rows = (
        time_periods.where(F.col("months_of_claims_runout") == runout_months)
        .select("time_period_id", "reporting_date_start", "reporting_date_end")
        .take(2)
    )
    if len(rows) != 1:
        found = "no period" if not rows else "more than one period"
        raise ValueError(f"time_periods has {found} with {runout_months} months of claims runout")
    return ReportingPeriod(*rows[0])


def month_of(column: str | Column) -> Column:
    """The first day of a date's month."""
    return F.trunc(column, "month")
