import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cohortlens import Assignment, ReportConfig
from cohortlens.functions.dates import lookup_period
from cohortlens.operators.cohort import coverage_spans, join_cohorts
from helpers import CURRENT, PERIODS, claim_tables, cohort_of, frame, member, window

JAN, FEB = date(2020, 1, 1), date(2020, 2, 1)


def months(tables, config=CURRENT):
    rows = cohort_of(tables, config).member_months.collect()
    return sorted(
        (r["member_id"], r["elig_month"], r["elig_status"], r["memmos"], r["risk_score"], r["cover_medical"])
        for r in rows
    )


def test_windows_of_a_month_add_up_and_the_latest_names_the_status(spark):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[
            window(1, JAN, date(2020, 1, 14), memmos_medical=0.25),
            window(1, date(2020, 1, 15), date(2020, 1, 31), memmos_medical=0.5, elig_status_1="ESRD"),
        ],
    )
    assert months(tables) == [(1, JAN, "ESRD", 0.75, None, "Y")]


def test_windows_that_end_together_are_told_apart_by_start_then_status(spark):
    end = date(2020, 1, 31)
    tables = claim_tables(
        spark,
        members=[member(1), member(2)],
        member_time_windows=[
            window(1, JAN, end, elig_status_1="ESRD"),
            window(1, date(2020, 1, 10), end, elig_status_1="Aged Dual"),
            window(2, JAN, end, elig_status_1="Aged Dual"),
            window(2, JAN, end, elig_status_1="Disabled"),
        ],
    )
    assert [(m, status) for m, _, status, *_ in months(tables)] == [(1, "Aged Dual"), (2, "Disabled")]


def test_unknown_and_missing_statuses_vanish_and_uncovered_months_stay(spark):
    end = date(2020, 1, 31)
    tables = claim_tables(
        spark,
        members=[member(m) for m in (1, 2, 3)],
        member_time_windows=[
            window(1, JAN, end, elig_status_1="Unknown"),
            window(2, JAN, end, elig_status_1=None),
            window(3, JAN, end, memmos_medical=0.0, cover_medical="N"),
        ],
    )
    assert months(tables) == [(3, JAN, "Aged Dual", 0.0, None, "N")]
    assert cohort_of(tables).covered_months.count() == 0


def test_only_risk_scores_of_the_period_count_and_a_second_score_doubles_the_month(spark):
    end = date(2020, 1, 31)
    scores = [(1, 1, 0.5), (1, 1, 0.7), (2, 9, 3.0)]
    tables = claim_tables(
        spark,
        members=[member(1), member(2)],
        member_time_windows=[window(1, JAN, end), window(2, JAN, end)],
        risk_scores=[dict(zip(("member_id", "time_period_id", "risk_score"), s)) for s in scores],
    )
    assert [(m, risk) for m, _, _, _, risk, _ in months(tables)] == [(1, 0.5), (1, 0.7), (2, None)]


@pytest.mark.parametrize(
    ("assignment", "expected"),
    [(Assignment.CURRENT, [1]), (Assignment.JULY_FIRST, [2]), (Assignment.DURING_PERIOD, [3])],
)
def test_assignment_policies(spark, assignment, expected):
    end = date(2020, 1, 31)
    tables = claim_tables(
        spark,
        members=[
            member(1, mem_report_hier_2="N"),
            member(2, assignment_indicator="N"),
            member(3, assignment_indicator=None, mem_report_hier_2=None),
        ],
        member_time_windows=[window(m, JAN, end, assignment_indicator="Y" if m == 3 else "N") for m in (1, 2, 3)],
    )
    assert [m for m, *_ in months(tables, ReportConfig(assignment=assignment))] == expected


def test_year_to_date_starts_the_cohort_in_january_of_the_last_year(spark):
    period = {**PERIODS[0], "reporting_date_start": date(2019, 7, 1), "reporting_date_end": date(2020, 6, 30)}
    tables = claim_tables(
        spark,
        time_periods=[period],
        members=[member(1)],
        member_time_windows=[window(1, date(2019, 12, 1), date(2019, 12, 31)), window(1, JAN, date(2020, 1, 31))],
    )
    assert len(months(tables)) == 2
    narrowed = ReportConfig(assignment=Assignment.CURRENT, year_to_date=True)
    assert [m[1] for m in months(tables, narrowed)] == [JAN]
    cohort = cohort_of(tables, narrowed)
    assert cohort.report_period.label == "2019Q3_2020Q2"
    assert cohort.report_period.start == date(2019, 7, 1)


@pytest.mark.parametrize("periods", [[], PERIODS * 2])
def test_the_period_must_be_unique(spark, periods):
    with pytest.raises(ValueError, match="runout"):
        lookup_period(frame(spark, "time_periods", periods), 3)


def test_runout_dates_add_months_before_days(spark):
    tables = claim_tables(spark, time_periods=[{**PERIODS[0], "reporting_date_end": date(2020, 11, 30)}])
    period = lookup_period(tables.time_periods, 3)
    row = spark.range(1).select(
        period.after_end(days=14).alias("a"), period.after_end(months=3).alias("b"),
        period.after_end(months=3, days=7).alias("c"),
    ).first()
    assert tuple(row) == (date(2020, 12, 14), date(2021, 2, 28), date(2021, 3, 7))


def test_equal_windows_collapse_with_their_number(spark):
    end = date(2020, 1, 31)
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[window(1, JAN, end), window(1, JAN, end), window(1, FEB, FEB, cover_medical="N")],
    )
    rows = cohort_of(tables).windows.collect()
    assert [(r["date_start"], r["copies"]) for r in rows] == [(JAN, 2)]


def test_open_ended_windows_stay_within_the_period(spark):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[
            window(1, date(1900, 1, 1), date(9999, 12, 31), elig_month=JAN),
            window(1, FEB, date(2020, 2, 29)),
        ],
    )
    calendar = cohort_of(tables).calendar
    assert calendar.select("elig_month", "copies").orderBy("elig_month").collect() == [(JAN, 1), (FEB, 2)]
    assert calendar.where(F.col("date_start") > F.col("date_end")).count() == 0


def random_windows(members, seed):
    """Windows that repeat, overlap, touch, nest, are reversed, or lack a date."""
    draw, rows = random.Random(seed), []
    for m in range(1, members + 1):
        for _ in range(draw.choice([0, 1, 2, 6, 15])):
            start = JAN + timedelta(days=draw.randrange(60))
            row = window(m, start, start + timedelta(days=draw.choice([-2, 0, 0, 1, 5, 30, 45])))
            row["cover_medical"] = draw.choice("YYYYN")
            if draw.random() < 0.1:
                row[draw.choice(["date_start", "date_end"])] = None
            rows += [row] * draw.choice([1, 1, 2])
    return rows


def test_spans_count_the_windows_of_every_day(spark):
    rows = random_windows(30, 5)
    tables = claim_tables(spark, member_time_windows=rows)
    expected = Counter()
    for r in rows:
        if r["cover_medical"] == "Y" and r["date_start"] and r["date_end"]:
            for day in range((r["date_end"] - r["date_start"]).days + 1):
                expected[r["member_id"], r["date_start"] + timedelta(days=day)] += 1
    got = Counter()
    for r in coverage_spans(tables.member_time_windows).collect():
        for day in range((r["date_end"] - r["date_start"]).days + 1):
            key = r["member_id"], r["date_start"] + timedelta(days=day)
            assert key not in got  # spans are disjoint
            got[key] = r["copies"]
    assert got == expected and max(got.values()) > 3


def test_a_member_with_very_many_windows_is_a_row_for_each_day_that_something_changes(spark):
    rows = [window(1, JAN + timedelta(days=i % 20), JAN + timedelta(days=i % 20 + i % 7)) for i in range(2000)]
    spans = coverage_spans(claim_tables(spark, member_time_windows=rows).member_time_windows).collect()
    assert len(spans) <= 27 and sum(s["copies"] * ((s["date_end"] - s["date_start"]).days + 1) for s in spans) == sum(
        i % 7 + 1 for i in range(2000)
    )


def test_joint_cohorts_mark_the_months_that_scenarios_share(spark):
    tables = claim_tables(
        spark,
        time_periods=[{**PERIODS[0], "reporting_date_start": date(2019, 7, 1), "reporting_date_end": date(2020, 6, 30)}],
        members=[member(1), member(2, assignment_indicator="N")],
        member_time_windows=[window(m, d, d, elig_month=d) for m in (1, 2) for d in (date(2019, 12, 1), JAN)],
        risk_scores=[{"member_id": 2, "time_period_id": 1, "risk_score": r} for r in (0.5, 0.6)],
    )
    configs = [CURRENT, ReportConfig(assignment=Assignment.JULY_FIRST, year_to_date=True), CURRENT]
    joint = join_cohorts([cohort_of(tables, config) for config in configs])
    months = {(r["member_id"], r["elig_month"]): (r["scenarios"], r["copies"]) for r in joint.status_months.collect()}
    assert months == {(1, date(2019, 12, 1)): (0b101, 1), (1, JAN): (0b111, 1), (2, JAN): (0b010, 2)}
    assert joint.period.start == date(2019, 7, 1) and joint.period.end == date(2020, 6, 30)
    other = claim_tables(spark, time_periods=[{**PERIODS[0], "reporting_date_end": date(2020, 11, 30)}])
    with pytest.raises(ValueError, match="report periods"):
        join_cohorts([cohort_of(tables), cohort_of(other)])
