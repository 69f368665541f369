"""The member-month cohort and the coverage windows that claims are matched against."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.config import Assignment, ReportConfig
from cohortlens.functions.dates import ReportingPeriod, lookup_period, month_of
from cohortlens.functions.numbers import EXACT_SHARE
from cohortlens.sources.tables import ClaimTables

UNKNOWN_STATUS = "Unknown"


@dataclass(frozen=True)
class Coverage:
    """What claims are attributed to: a range of dates, the members' coverage in it, and their status by month.

    ``period`` is the range the cohort was built for; ``report_period`` is never narrowed to the year to date.
    """

    period: ReportingPeriod
    report_period: ReportingPeriod
    spans: DataFrame

    # What tells attributed rows apart besides the dimensions of a measure.
    status_columns = ("elig_status",)

    @property
    def status_months(self) -> DataFrame:
        """A row per member, covered month and ``status_columns``, with ``copies``, the times that a line counts in it."""
        raise NotImplementedError

    @property
    def covered_months(self) -> DataFrame:
        """The member months with medical coverage, per scenario where there are several."""
        raise NotImplementedError

    def expanded(self, rows: DataFrame) -> DataFrame:
        """``rows`` by ``status_columns`` as rows by status, per scenario where there are several."""
        raise NotImplementedError

    def dying(self, members: DataFrame) -> DataFrame:
        """The members who died in the period, per scenario where there are several."""
        raise NotImplementedError

    def in_each_scenario(self, rows: DataFrame, *aggregates: Column) -> DataFrame:
        """``rows`` aggregated to a single row, or to one for each scenario, also where there are no rows."""
        raise NotImplementedError

    @cached_property
    def calendar(self) -> DataFrame:
        return coverage_calendar(self)

    @property
    def first_day(self) -> Column:
        """The first day of the earliest month that can be in the cohort."""
        return month_of(F.lit(self.period.start))

    @property
    def last_day(self) -> Column:
        return F.last_day(F.lit(self.period.end))


@dataclass(frozen=True)
class Cohort(Coverage):
    """A reporting period, its member months and the members' coverage."""

    member_months: DataFrame
    windows: DataFrame

    @cached_property
    def covered_months(self) -> DataFrame:
        return self.member_months.where(F.col("cover_medical") == "Y")

    @cached_property
    def status_months(self) -> DataFrame:
        """A member has one status in a month; a member with several risk scores has the month as many times.

        The rows are not added up: a sum by member and month would stand in the stage of the join that follows it, and
        Spark could not split the claims of a member who has very many.
        """
        return self.covered_months.select("member_id", "elig_month", "elig_status", F.lit(1).cast("bigint").alias("copies"))

    def expanded(self, rows: DataFrame) -> DataFrame:
        return rows

    def dying(self, members: DataFrame) -> DataFrame:
        return members.where(self.period.holds("death_date"))

    def in_each_scenario(self, rows: DataFrame, *aggregates: Column) -> DataFrame:
        return rows.agg(*aggregates)

    def with_member_months(self, member_months: DataFrame) -> Cohort:
        return replace(self, member_months=member_months)


@dataclass(frozen=True)
class JointCohort(Coverage):
    """Several cohorts of one report period, the scenarios, to which claims are attributed together.

    Months that scenarios have in common are one row with a mask, a bit for each of them in ``scenarios``. Sums of claims
    carry the mask, and are only expanded to rows by ``scenario`` (its number) when they have been taken.
    """

    cohorts: tuple[Cohort, ...]

    status_columns = ("scenarios", "elig_status")

    @cached_property
    def status_months(self) -> DataFrame:
        key = ["member_id", "elig_month", "elig_status"]
        bits = [c.status_months.withColumn("bit", F.lit(1 << at).cast("bigint")) for at, c in enumerate(self.cohorts)]
        each = reduce(DataFrame.unionByName, bits).groupBy(*key, "bit").agg(F.sum("copies").alias("copies"))
        return each.groupBy(*key, "copies").agg(F.bit_or("bit").alias("scenarios"))

    @cached_property
    def member_months(self) -> DataFrame:
        return self._numbered(c.member_months for c in self.cohorts)

    @cached_property
    def covered_months(self) -> DataFrame:
        return self._numbered(c.covered_months for c in self.cohorts)

    def expanded(self, rows: DataFrame) -> DataFrame:
        numbers = F.array_compact(
            F.array(*[F.when(F.col("scenarios").bitwiseAND(1 << at) != 0, at) for at in range(len(self.cohorts))])
        )
        return rows.withColumn("scenario", F.explode(numbers)).drop("scenarios")

    def dying(self, members: DataFrame) -> DataFrame:
        numbers = F.array_compact(
            F.array(*[F.when(c.period.holds("death_date"), at) for at, c in enumerate(self.cohorts)])
        )
        return members.withColumn("scenario", F.explode(numbers))

    def in_each_scenario(self, rows: DataFrame, *aggregates: Column) -> DataFrame:
        scenarios = rows.sparkSession.range(len(self.cohorts)).select(F.col("id").cast("int").alias("scenario"))
        return scenarios.join(rows.groupBy("scenario").agg(*aggregates), "scenario", "left")

    @staticmethod
    def _numbered(frames: Iterable[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, [f.withColumn("scenario", F.lit(at)) for at, f in enumerate(frames)])


def join_cohorts(cohorts: Sequence[Cohort]) -> JointCohort:
    """The cohorts have to be of one report period; their own periods may be narrower or reach further back."""
    first = cohorts[0]
    if any(c.report_period != first.report_period for c in cohorts):
        raise ValueError("cohorts of different report periods read different claims")
    start, end = min(c.period.start for c in cohorts), max(c.period.end for c in cohorts)
    return JointCohort(replace(first.period, start=start, end=end), first.report_period, first.spans, tuple(cohorts))


def status_keys(frame: DataFrame) -> list[str]:
    """The columns by which results of ``frame`` are kept apart: the status, and the scenario if there are several."""
    return [c for c in ("scenario", "elig_status") if c in frame.columns]


def build_cohort(tables: ClaimTables, config: ReportConfig) -> Cohort:
    report_period = lookup_period(tables.time_periods, config.runout_months)
    period = report_period.year_to_date() if config.year_to_date else report_period
    return Cohort(
        period=period,
        report_period=report_period,
        member_months=build_member_months(tables, period, config.assignment),
        windows=coverage_windows(tables.member_time_windows),
        spans=coverage_spans(tables.member_time_windows),
    )


def build_member_months(tables: ClaimTables, period: ReportingPeriod, assignment: Assignment) -> DataFrame:
    """One row per cohort member and month: status, covered share of the month, risk score, coverage flag.

    Members and scores are as long as the member list: Catalyst, which goes by the compressed files, would collect them on
    the driver to broadcast them. The months lie by member already, so sort-merging shuffles no more than those two.
    """
    windows = tables.member_time_windows.where(period.holds("elig_month"))
    if assignment is Assignment.DURING_PERIOD:
        windows = windows.where(F.col("assignment_indicator") == "Y")

    months = collapse_windows(windows).where(F.col("elig_status") != UNKNOWN_STATUS)
    assigned = assigned_members(tables.members, assignment)
    if assigned is not None:
        months = months.join(assigned.hint("merge"), "member_id")

    return months.join(period_risk_scores(tables.risk_scores, period).hint("merge"), "member_id", "left").select(
        "member_id",
        "elig_month",
        "elig_status",
        "memmos",
        "risk_score",
        F.when(F.col("memmos") > 0, "Y").otherwise("N").alias("cover_medical"),
    )


def collapse_windows(windows: DataFrame) -> DataFrame:
    """Windows to member months in one aggregation: summed coverage, and the status of the latest window.

    The greatest (end, start, status) triple stands in for a ranking window, so the choice is the same on every run.
    Windows are dealt out by member first: there are few of a month to collapse, and a task that reads them would sort
    all that it reads for that.
    """
    latest = F.max(F.struct("date_end", "date_start", "elig_status_1"))
    return windows.repartition("member_id").groupBy("member_id", "elig_month").agg(
        F.sum(F.col("memmos_medical").cast(EXACT_SHARE)).cast("double").alias("memmos"), latest["elig_status_1"].alias("elig_status")
    )


def assigned_members(members: DataFrame, assignment: Assignment) -> DataFrame | None:
    """Member ids the policy admits, or None when assignment was already judged month by month."""
    flag = {Assignment.CURRENT: "assignment_indicator", Assignment.JULY_FIRST: "mem_report_hier_2"}.get(assignment)
    return None if flag is None else members.where(F.col(flag) == "Y").select("member_id")


def period_risk_scores(risk_scores: DataFrame, period: ReportingPeriod) -> DataFrame:
    """Scores of the period. A member scored twice keeps both rows, and their months double."""
    return risk_scores.where(F.col("time_period_id") == F.lit(period.period_id)).select("member_id", "risk_score")


def coverage_windows(member_time_windows: DataFrame) -> DataFrame:
    """Distinct medical coverage windows; ``copies`` counts how often each one occurs.

    A claim counts once per window that holds it, so repeated windows have to keep their weight, but they
    need not be joined one by one. They are dealt out by member before they are counted, as in ``collapse_windows``.
    """
    return (
        member_time_windows.where(F.col("cover_medical") == "Y")
        .select("member_id", "date_start", "date_end")
        .repartition("member_id")
        .groupBy("member_id", "date_start", "date_end")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def coverage_spans(member_time_windows: DataFrame) -> DataFrame:
    """Disjoint spans of days with ``copies``, the number of medical coverage windows that hold each of their days.

    A claim counts once for each window that holds its day. A sweep over the days on which windows start and have ended
    keeps the running count, so a day lies in one span, however many windows overlap on it. Starts and ends are added up
    by day first: a member has at most as many rows as there are days on which a window starts or has ended. A window
    that ends before it starts, or lacks a date, holds no day.
    """
    windows = member_time_windows.where((F.col("cover_medical") == "Y") & (F.col("date_start") <= F.col("date_end")))
    changes = F.inline(
        F.array(
            F.struct(F.col("date_start").alias("day"), F.lit(1).alias("change")),
            F.struct(F.date_add("date_end", 1).alias("day"), F.lit(-1).alias("change")),
        )
    )
    by_day = Window.partitionBy("member_id").orderBy("day")
    return (
        windows.select("member_id", changes)
        .repartition("member_id")
        .groupBy("member_id", "day")
        .agg(F.sum("change").alias("change"))
        .where("change <> 0")
        .select(
            "member_id",
            F.col("day").alias("date_start"),
            F.date_sub(F.lead("day").over(by_day), 1).alias("date_end"),
            F.sum("change").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("copies"),
        )
        .where("copies > 0")
    )


def coverage_calendar(cohort: Coverage) -> DataFrame:
    """Coverage spans cut at month ends and labelled with the member's status in that month.

    This turns date-range attribution into an equi-join on (member, month) with a day check, for claims whose
    month and coverage date are the same date. Spans are clipped to the period before they are cut, so an
    open-ended one costs no more rows than the period has months.

    Catalyst does not count the rows that an explode adds, nor how well months compress in files, and would broadcast
    a side with a row for every member and month. Hence the sort-merge join.
    """
    starts = F.greatest(F.col("date_start"), cohort.first_day)
    ends = F.least(F.col("date_end"), cohort.last_day)
    by_month = (
        cohort.spans.where(starts <= ends)
        .withColumn("elig_month", F.explode(F.sequence(month_of(starts), month_of(ends), F.expr("INTERVAL 1 MONTH"))))
    )
    months = cohort.status_months.withColumnRenamed("copies", "month_copies")
    return (
        by_month.join(months.hint("merge"), ["member_id", "elig_month"])
        .withColumn("copies", F.col("copies") * F.col("month_copies"))
        .drop("month_copies")
    )


def period_bucket(cohort: Coverage, date: Column) -> Column:
    """The month of a date in the period; the month before it for all earlier dates, the one after it for all later."""
    return (
        F.when(date < cohort.first_day, F.add_months(month_of(cohort.first_day), -1))
        .when(date > cohort.last_day, F.add_months(month_of(cohort.last_day), 1))
        .otherwise(month_of(date))
    )


def bucketed_spans(cohort: Coverage) -> DataFrame:
    """Coverage spans, whole, once for each ``bucket`` of days that they touch.

    A day is in one bucket, so it meets the span that holds it once. A span has at most two rows more than the
    period has months, however long it is.
    """
    first, last = (period_bucket(cohort, F.col(c)) for c in ("date_start", "date_end"))
    touched = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    return cohort.spans.withColumn("bucket", F.explode(touched))
