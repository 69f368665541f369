from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.attribution import (
    BY_CASE_DATE,
    BY_LINE_DATE,
    BY_STAY_DATE,
    BY_STAY_MONTH,
    attribute,
    attributed_sums,
    daily_sums,
)
from helpers import claim, claim_tables, cohort_of, member, window

JAN, FEB, MAR = date(2020, 1, 1), date(2020, 2, 1), date(2020, 3, 1)
ALL = [BY_LINE_DATE, BY_CASE_DATE, BY_STAY_DATE, BY_STAY_MONTH]


def lines(tables, policy):
    """How often each claim id is attributed."""
    cohort = cohort_of(tables)
    daily = daily_sums(tables.outclaims, cohort, policy, ["claimid"], {"lines": "1"})
    found = attribute(daily, cohort, policy).groupBy("claimid").agg(F.sum(F.expr("lines * copies")).alias("n"))
    return {r["claimid"]: r["n"] for r in found.collect()}


@pytest.mark.parametrize("policy", ALL)
def test_a_claim_counts_once_for_every_window_that_holds_it(spark, policy):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[
            window(1, JAN, date(2020, 1, 31)),
            window(1, JAN, date(2020, 1, 31)),
            window(1, date(2020, 1, 10), date(2020, 2, 9)),
            window(1, FEB, date(2020, 2, 29)),
        ],
        outclaims=[
            claim(1, date(2020, 1, 5), claimid=1),
            claim(1, date(2020, 1, 10), claimid=2),
            claim(1, date(2020, 1, 31), claimid=3),
            claim(1, date(2020, 2, 9), claimid=4),
            claim(1, date(2020, 2, 10), claimid=5),
            claim(1, date(2020, 3, 1), claimid=6),
            claim(2, date(2020, 1, 5), claimid=7),
            claim(1, date(2019, 12, 31), claimid=8),
        ],
    )
    assert lines(tables, policy) == {1: 2, 2: 3, 3: 3, 4: 2, 5: 1}


@pytest.mark.parametrize("policy", ALL)
def test_the_month_has_to_be_covered_as_well_as_the_day(spark, policy):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[
            # This window reaches into February, where the member has no covered month.
            window(1, JAN, date(2020, 2, 29)),
            window(1, FEB, FEB, memmos_medical=0.0, cover_medical="N"),
            # March is a covered month by its days, but no window says so.
            window(1, MAR, date(2020, 3, 31), cover_medical="N"),
        ],
        outclaims=[claim(1, date(2020, m, 5), claimid=m) for m in (1, 2, 3)],
    )
    assert lines(tables, policy) == {1: 1}


def test_policies_date_skilled_nursing_lines_differently(spark):
    stay = {"prm_line": "I31", "prm_fromdate_case": date(2020, 1, 20)}
    variant = {"prm_line": "I31x", "prm_fromdate_case": date(2020, 1, 20)}
    tables = claim_tables(
        spark,
        members=[member(1), member(2)],
        member_time_windows=[
            window(1, JAN, date(2020, 1, 31)),
            # Covered on the line's day in February only, and in the month of January only.
            window(2, JAN, JAN),
            window(2, FEB, date(2020, 2, 29), elig_status_1="Unknown"),
        ],
        outclaims=[
            claim(1, date(2020, 2, 5), claimid=1, **stay),
            claim(1, date(2020, 2, 5), claimid=2, **variant),
            claim(2, date(2020, 2, 5), claimid=3, **stay),
        ],
    )
    assert lines(tables, BY_LINE_DATE) == {}
    assert lines(tables, BY_CASE_DATE) == {1: 1, 2: 1}
    assert lines(tables, BY_STAY_DATE) == {1: 1}
    assert lines(tables, BY_STAY_MONTH) == {3: 1}


def test_days_outside_the_period_meet_the_windows_that_hold_them(spark):
    stay = {"prm_line": "I31", "prm_fromdate_case": date(2020, 1, 20)}
    tables = claim_tables(
        spark,
        members=[member(1), member(2)],
        member_time_windows=[
            window(1, JAN, date(9999, 12, 31)),
            window(1, date(2010, 3, 5), date(2018, 6, 30)),
            window(1, date(2018, 6, 30), date(2018, 7, 1)),
            window(2, JAN, date(2020, 1, 31)),
            window(2, date(2020, 1, 9), date(2020, 1, 8)),
        ],
        outclaims=[
            claim(1, date(2035, 2, 5), claimid=1, **stay),
            claim(1, date(2018, 6, 30), claimid=2, **stay),
            claim(1, date(2018, 7, 2), claimid=3, **stay),
            claim(1, date(2010, 3, 5), claimid=4, **stay),
            claim(2, date(2035, 2, 5), claimid=5, **stay),
            claim(2, date(2020, 1, 9), claimid=6, **stay),
        ],
    )
    assert lines(tables, BY_STAY_MONTH) == {1: 1, 2: 2, 4: 1, 6: 1}


def test_a_line_without_a_code_is_dated_by_itself(spark):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[window(1, JAN, date(2020, 1, 31))],
        outclaims=[claim(1, date(2020, 1, 5), prm_line=None, prm_fromdate_case=date(2020, 2, 5))],
    )
    assert lines(tables, BY_STAY_DATE) == {1: 1}
    assert lines(tables, BY_STAY_MONTH) == {1: 1}


def test_month_of_a_doubled_member_month_doubles_its_claims(spark):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[window(1, JAN, date(2020, 1, 31))],
        risk_scores=[{"member_id": 1, "time_period_id": 1, "risk_score": r} for r in (0.5, 0.6)],
        outclaims=[claim(1, date(2020, 1, 5))],
    )
    for policy in ALL:
        assert lines(tables, policy) == {1: 2}


def test_sums_are_weighted_and_keep_null_apart_from_zero(spark):
    tables = claim_tables(
        spark,
        members=[member(1)],
        member_time_windows=[window(1, JAN, date(2020, 1, 31))] * 2,
        outclaims=[
            claim(1, date(2020, 1, 5), prm_line="I12", prm_costs="1.2345"),
            claim(1, date(2020, 1, 5), prm_line="I12", prm_costs=None),
            claim(1, date(2020, 1, 6), prm_line="P99", prm_costs=None),
        ],
    )
    summed = attributed_sums(tables.outclaims, cohort_of(tables), BY_STAY_DATE, ["prm_line"], {"costs": "prm_costs"})
    costs = {r["prm_line"]: r["costs"] for r in summed.collect()}
    assert float(costs["I12"]) == 2.469
    assert costs["P99"] is None
