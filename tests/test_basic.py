from datetime import date, timedelta

from cohortlens.plans.basic import assigned_members, member_age, membership, wellness_visits
from helpers import claim, claim_tables, cohort_of, member, metric_list, window

JAN, FEB = date(2020, 1, 1), date(2020, 2, 1)
WELLNESS = {"hcpcs": "G0438"}


def two_months(spark, outclaims, **tables):
    windows = [
        window(m, start, end, elig_status_1="ESRD" if m == 3 else "Aged Dual")
        for m in (1, 2, 3)
        for start, end in ((JAN, date(2020, 1, 31)), (FEB, date(2020, 2, 29)))
    ]
    return claim_tables(
        spark,
        members=[member(m, dob=date(1950, 1, m)) for m in (1, 2, 3)],
        member_time_windows=windows,
        outclaims=outclaims,
        **tables,
    )


def test_no_visits_leave_two_totals_without_a_value(spark):
    tables = two_months(spark, [claim(1, JAN)])
    assert metric_list(wellness_visits(tables, cohort_of(tables))) == [
        ("All", "cnt_wellness_visits_denom", None),
        ("All", "cnt_wellness_visits_numer", None),
    ]


def test_the_report_month_is_the_last_one_with_a_visit_so_far(spark):
    tables = two_months(
        spark,
        [
            claim(1, date(2019, 3, 1), **WELLNESS),  # the oldest day that counts in February
            claim(1, date(2020, 3, 1), **WELLNESS),  # after the last month
            claim(2, date(2019, 2, 28), **WELLNESS),  # a day too old
        ],
    )
    assert metric_list(wellness_visits(tables, cohort_of(tables))) == [
        ("Aged Dual", "cnt_wellness_visits_denom", 2.0),
        ("Aged Dual", "cnt_wellness_visits_numer", 1.0),
        ("All", "cnt_wellness_visits_denom", 3.0),
        ("All", "cnt_wellness_visits_numer", 1.0),
        ("ESRD", "cnt_wellness_visits_denom", 1.0),
    ]


def test_doubled_member_months_do_not_double_visits(spark):
    scores = [{"member_id": 1, "time_period_id": 1, "risk_score": s} for s in (0.5, 0.6)]
    tables = two_months(spark, [claim(1, FEB, **WELLNESS), claim(1, JAN, **WELLNESS)], risk_scores=scores)
    rows = metric_list(wellness_visits(tables, cohort_of(tables)))
    assert ("All", "cnt_wellness_visits_numer", 1.0) in rows
    assert ("All", "cnt_wellness_visits_denom", 3.0) in rows


def test_membership_totals(spark):
    scores = [{"member_id": m, "time_period_id": 1, "risk_score": 0.5} for m in (1, 3)]
    tables = two_months(spark, [], risk_scores=scores)
    cohort = cohort_of(tables)
    assert metric_list(assigned_members(cohort)) == [
        ("Aged Dual", "cnt_assigned_mems", 2.0),
        ("All", "cnt_assigned_mems", 3.0),
        ("ESRD", "cnt_assigned_mems", 1.0),
        ("Non-ESRD", "cnt_assigned_mems_nonesrd", 2.0),
    ]
    assert metric_list(membership(cohort)) == [
        ("Aged Dual", "memmos_sum", 4.0),
        ("Aged Dual", "riskscr_1_avg", 0.25),
        ("ESRD", "memmos_sum", 2.0),
        ("ESRD", "riskscr_1_avg", 0.5),
    ]
    days = [(start - date(1950, 1, 3)) / timedelta(days=1) for start in (JAN, FEB)]
    ages = dict((status, value) for status, _, value in metric_list(member_age(tables, cohort)))
    assert abs(ages["ESRD"] - sum(days) / 365.25) < 1e-7
