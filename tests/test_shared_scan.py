"""Families and scenarios that share a scan get what each would have got alone."""

import random
from datetime import date, timedelta

import pytest

from cohortlens import Assignment, ReportConfig
from cohortlens.operators.attribution import BY_CASE_DATE, BY_LINE_DATE, BY_STAY_DATE, BY_STAY_MONTH
from cohortlens.operators.cohort import join_cohorts
from cohortlens.operators.shared_scan import LineFamily, family_sums, own_sums, shared_sums
from cohortlens.plans.report import LINE_FAMILIES
from helpers import CURRENT, claim, claim_tables, cohort_of, member, window

JAN = date(2020, 1, 1)
SUMS = {"costs": "prm_costs", "util": "prm_util"}
# Families that overlap, date lines differently and tell different things apart.
FAMILIES = (
    LineFamily("startswith(prm_line, 'I')", BY_LINE_DATE, SUMS, {"prm_line": "prm_line", "claimid": "claimid"}),
    LineFamily("prm_util > 2", BY_STAY_DATE, {"util": "prm_util"}, {"paid": "paiddate"}),
    LineFamily("true", BY_CASE_DATE, SUMS),
    LineFamily("prm_line = 'P99'", BY_LINE_DATE, {"costs": "prm_costs"}, {"prm_line": "prm_line"}),
)


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(9)

    def day(spread=120):
        return JAN + timedelta(days=draw.randrange(spread))

    claims = []
    for n in range(250):
        start = day()
        case = draw.choice([start, start, start - timedelta(days=draw.randrange(40)), None])
        claims.append(
            claim(
                draw.randrange(1, 9),
                draw.choice([start, start, start, None]),
                prm_fromdate_case=case,
                paiddate=day(20),
                claimid=draw.randrange(4),
                prm_line=draw.choice(["I11a", "I31", "I31x", "P99", "O11a", "I12", None]),
                prm_util=draw.choice([1, 2, 3, 30, None]),
                prm_costs=draw.choice(["1.25", "-3", None]),
                providerid=draw.randrange(3),
                caseadmitid=draw.choice([1, 2, None]),
            )
        )
    windows = []
    for m in range(1, 8):
        for month in range(1, 5):
            first = date(2020, month, 1)
            windows.append(
                window(
                    m, first, first + timedelta(days=draw.choice([20, 30, 50])),
                    elig_status_1=draw.choice(["ESRD", "Aged Dual"]), assignment_indicator=draw.choice("YYN"),
                )
            )
    return claim_tables(
        spark,
        members=[member(m, assignment_indicator="NY"[m % 3 > 0], mem_report_hier_2="NY"[m % 2]) for m in range(1, 9)],
        member_time_windows=windows,
        risk_scores=[{"member_id": 2, "time_period_id": 1, "risk_score": r} for r in (0.5, 0.6)],
        outclaims=claims,
    )


def rows_of(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=repr)


@pytest.mark.parametrize("families", [FAMILIES, LINE_FAMILIES, FAMILIES[1:2], FAMILIES[:1] + FAMILIES[3:]])
def test_each_family_gets_its_own_sums(tables, families):
    cohort = cohort_of(tables)
    shared = shared_sums(tables.outclaims, cohort, families)
    found = [rows_of(family_sums(shared, families, f)) for f in families]
    assert found == [rows_of(own_sums(tables.outclaims, cohort, f)) for f in families]
    assert sum(map(len, found)) > 5 * len(families)


def test_lines_that_a_family_does_not_tell_apart_are_added_up(tables):
    """A dimension of one family does not split the lines of another before the shuffle."""
    alone = shared_sums(tables.outclaims, cohort_of(tables), FAMILIES[2:3]).count()
    beside = shared_sums(tables.outclaims.where("prm_line = 'O11a'"), cohort_of(tables), FAMILIES).count()
    assert alone == 2 and beside <= 2 * (1 + 20)  # two masks; paid days where the second family reads the line


SCENARIOS = (
    CURRENT,
    ReportConfig(assignment=Assignment.JULY_FIRST),
    ReportConfig(assignment=Assignment.DURING_PERIOD, year_to_date=True),
    CURRENT,
)


def test_each_scenario_gets_its_own_sums(tables):
    cohorts = [cohort_of(tables, config) for config in SCENARIOS]
    joint = shared_sums(tables.outclaims, join_cohorts(cohorts), FAMILIES)
    for number, cohort in enumerate(cohorts):
        alone = shared_sums(tables.outclaims, cohort, FAMILIES)
        mine = joint.where(f"scenario = {number}").drop("scenario")
        for family in FAMILIES:
            assert rows_of(family_sums(mine, FAMILIES, family)) == rows_of(family_sums(alone, FAMILIES, family))


def test_what_cannot_be_shared_is_refused(tables):
    cohort = cohort_of(tables)
    with pytest.raises(ValueError, match="one date"):
        shared_sums(tables.outclaims, cohort, [LineFamily("true", BY_STAY_MONTH, SUMS)])
    other = LineFamily("true", BY_LINE_DATE, {"costs": "prm_util"})
    with pytest.raises(ValueError, match="costs is"):
        shared_sums(tables.outclaims, cohort, [FAMILIES[0], other])
