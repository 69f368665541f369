"""The derived tables hold every case that the operators tell apart, as FIXTURES.md lists them."""

import pytest

from checks import oracle
from checks.compare import duckdb_over

SF_DIR = "/root/testdata/sf0.01"
IN_PERIOD = "{} BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"
CASES = {
    "windows of several months": "member_time_windows WHERE date_end > last_day(elig_month) + 31",
    "windows that begin in the month before": "member_time_windows WHERE date_start < elig_month",
    "open windows": "member_time_windows WHERE date_end = DATE '2099-12-31'",
    "windows without an end": "member_time_windows WHERE date_end IS NULL",
    "windows that occur twice": "(SELECT 1 FROM spans GROUP BY ALL HAVING count(*) > 1)",
    "days held by overlapping windows": """(SELECT 1 FROM spans a JOIN spans b ON a.member_id = b.member_id
        AND a.date_start < b.date_start AND b.date_start <= a.date_end)""",
    "lines held by several different windows": """(SELECT o.claimid FROM outclaims o JOIN (SELECT DISTINCT * FROM spans) s
        ON o.member_id = s.member_id AND o.prm_fromdate BETWEEN s.date_start AND s.date_end
        GROUP BY o.claimid, o.prm_fromdate HAVING count(DISTINCT s.date_start) > 1)""",
    "member months of two risk scores": "(SELECT 1 FROM covered GROUP BY member_id, elig_month HAVING count(*) > 1)",
    "members without a status": "member_time_windows WHERE elig_status_1 IS NULL",
    "members without an assignment": "members WHERE assignment_indicator IS NULL",
    "members without a birth date": "members WHERE dob IS NULL AND assignment_indicator = 'Y'",
    "attributed lines without a code": "by_stay_date WHERE prm_line IS NULL",
    "attributed lines without a cost": "by_stay_date WHERE prm_costs IS NULL",
    "lines without a from date": f"outclaims WHERE prm_fromdate IS NULL AND {IN_PERIOD.format('prm_todate')}",
    "lines without a to date": f"outclaims WHERE prm_todate IS NULL AND {IN_PERIOD.format('prm_fromdate')}",
    "lines without a case date": f"outclaims WHERE prm_fromdate_case IS NULL AND {IN_PERIOD.format('prm_fromdate')}",
    "lines without a paid date": f"outclaims WHERE paiddate IS NULL AND {IN_PERIOD.format('prm_fromdate')}",
    "stays dated into another month": """by_stay_month WHERE prm_line = 'I31'
        AND date_trunc('month', prm_fromdate) <> date_trunc('month', prm_fromdate_case)""",
    "skilled-nursing lines that are not I31 itself": "by_case_date WHERE prm_line = 'I31b'",
    "visits of cases classified twice": "(SELECT member_id, caseadmitid FROM er GROUP BY ALL HAVING count(*) > 1)",
    "usage of a line with two benefit types": "op WHERE prm_line = 'O10' AND btnumber IN (4, 10)",
    "skilled-nursing cases before a readmission": f"({oracle.READMIT_CASES_SQL})",
    "index lines of a DRG listed twice": "pac_index WHERE CAST(prm_drg AS INT) % 10 = 7",
}


@pytest.fixture(scope="module")
def database():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("case", CASES)
def test_case_occurs(database, case):
    (count,) = database.execute(oracle.full(f"SELECT count(*) FROM {CASES[case]}")).fetchone()
    assert count > 0


def test_statuses_and_bands(database):
    rows = database.execute(oracle.full("SELECT elig_status, low FROM risk_3 JOIN bands ON risk_score_avg BETWEEN low AND high")).fetchall()
    assert {status for status, _ in rows} == {"Aged Non-Dual", "Aged Dual", "Disabled", "ESRD", "Children"}
    assert len({low for _, low in rows}) == 5 and {low for _, low in rows} >= {-1.0, 2.0}
