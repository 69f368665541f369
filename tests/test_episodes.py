import random
from datetime import date, timedelta

import pytest

from cohortlens.operators.episodes import episode_flags, hospital_deaths, snf_readmit_cases
from cohortlens.plans import eol
from cohortlens.plans.eol import eol_metrics
from cohortlens.plans.pac import pac_drg_summary, pac_metrics
from helpers import claim, claim_tables, cohort_of, member, metric_list, window

JAN = date(2020, 1, 1)


def year_of_windows(members):
    starts = [date(2020, m, 1) for m in range(1, 13)]
    ends = [date(2020 + m // 12, m % 12 + 1, 1) - timedelta(days=1) for m in range(1, 13)]
    return [window(m, start, end) for m in members for start, end in zip(starts, ends)]


def test_flags_need_use_above_zero_outside_the_index_stay(spark):
    lines = [
        {"pac_caseadmitid": 1, "pac_major_category": "IP", "pac_minor_category": "Acute"},
        {"pac_caseadmitid": 1, "pac_major_category": "SNF", "prm_util": 0},
        {"pac_caseadmitid": 2, "pac_major_category": "HH", "pac_index_yn": "Y"},
        {"pac_caseadmitid": 2, "pac_major_category": "IP", "pac_minor_category": "Rehab"},
        {"pac_caseadmitid": None, "pac_major_category": "HH"},
    ]
    tables = claim_tables(spark, outclaims=[claim(1, JAN, **line) for line in lines])
    rows = {r["pac_caseadmitid"]: tuple(r)[1:] for r in episode_flags(tables.outclaims).collect()}
    assert rows == {1: ("Y", "N", "N", "N"), 2: ("N", "Y", "N", "N")}


def test_skilled_nursing_discharges_are_not_hospital_deaths(spark):
    lines = [("I11a", "20"), ("I31", "20"), ("P99", "20"), ("I12", "01"), (None, "20")]
    outclaims = [claim(i, JAN, prm_line=line, dischargestatus=status) for i, (line, status) in enumerate(lines)]
    tables = claim_tables(spark, outclaims=outclaims)
    assert [r[0] for r in hospital_deaths(tables.outclaims).collect()] == [0]


def test_pac_counts_repeated_drgs_twice_and_reports_missing_followups_as_zero(spark):
    index = {"pac_index_yn": "Y", "prm_line": "I11a", "pac_episode_end_date": date(2020, 3, 1)}
    tables = claim_tables(
        spark,
        members=[member(1, death_date=date(2020, 2, 1))],
        member_time_windows=year_of_windows([1]),
        ref_pac_benchmarks=[
            {"msdrg": "5", "benchmarks_pac_freq_wm_readm": 0.1},
            {"msdrg": "6", "benchmarks_pac_freq_wm_readm": 0.1},
            {"msdrg": "6", "benchmarks_pac_freq_wm_readm": 0.2},
            {"msdrg": "7"},
        ],
        outclaims=[
            claim(1, JAN, prm_drg="5", pac_caseadmitid=1, dischargestatus="20", **index),
            claim(1, JAN, prm_drg="6", pac_caseadmitid=None, **index),
            claim(1, JAN, prm_drg="7", pac_caseadmitid=1, **index),
            claim(1, JAN, pac_caseadmitid=1, pac_major_category="SNF", prm_util=3),
        ],
    )
    cohort = cohort_of(tables)
    values = {metric: value for _, metric, value in metric_list(pac_metrics(tables, cohort))}
    assert values.pop("pac_epi") == 3.0
    assert values.pop("pac_died_in_hosp") == 3.0
    assert values.pop("pac_snf") == 1.0
    assert set(values) == {
        f"cnt_followup_visits_within_7_days_{kind}_{line}" for kind in ("numer", "denom") for line in ("med", "sur")
    }
    assert set(values.values()) == {0.0}
    drgs = {r["prm_drg"]: (r["pac_count"], r["pac_snf_count"]) for r in pac_drg_summary(tables, cohort).collect()}
    assert drgs == {"5": (1, 1), "6": (2, 0)}


def test_stays_between_index_and_readmission_match_brute_force(spark):
    rng = random.Random(7)
    admissions, stays, outclaims = [], [], []
    for case in range(120):
        person, start = rng.randrange(8), JAN + timedelta(days=rng.randrange(300))
        end = start + timedelta(days=rng.randrange(12))
        if case % 3:
            admissions.append((person, start, end))
            outclaims.append(
                claim(person, start, caseadmitid=case, prm_line="I11a", prm_line_agg="i1", prm_todate_case=end)
            )
        else:
            stays.append((person, start, case))
            outclaims.append(claim(person, start, caseadmitid=case, prm_line="I31", prm_line_agg="i2"))
    tables = claim_tables(
        spark,
        members=[member(m) for m in range(8)],
        member_time_windows=year_of_windows(range(8)),
        outclaims=outclaims,
    )
    month = timedelta(days=30)
    expected = {
        case
        for person, start, case in stays
        for other, readmit, _ in admissions
        for third, _, index_end in admissions
        if person == other == third
        and readmit - month <= start <= readmit
        and readmit - month <= index_end <= start
    }
    found = [r[0] for r in snf_readmit_cases(tables.outclaims, cohort_of(tables)).collect()]
    assert 0 < len(expected) < len(stays)
    assert len(found) == len(set(found)) and set(found) == expected


def test_decedents_count_in_each_status_and_once_in_the_totals(spark):
    death = date(2020, 6, 15)
    windows = year_of_windows([1, 2, 3])
    windows[0]["elig_status_1"] = "Disabled"
    windows[1]["elig_status_1"] = "ESRD"
    for w in windows[24:]:
        w["elig_status_1"] = "ESRD"
    tables = claim_tables(
        spark,
        members=[
            member(1, death_date=death, endoflife_denom_yn_chemolt14days="Y"),
            member(2, death_date=date(2021, 1, 1)),
            member(3, death_date=death),
            member(4, death_date=death),
        ],
        member_time_windows=windows,
        outclaims=[
            claim(1, death - timedelta(days=31)),
            claim(1, death - timedelta(days=30)),
            claim(1, death + timedelta(days=90), prm_costs=5),
            claim(1, death - timedelta(days=200), prm_line="P82d", prm_util=2),
            claim(3, JAN, prm_line="I12", dischargestatus="20"),
        ],
    )
    rows = {(status, metric): value for status, metric, value in metric_list(eol_metrics(tables, cohort_of(tables)))}
    counts = {status: rows[status, "decedent_count"] for status in ("Aged Dual", "Disabled", "ESRD", "Non-ESRD", "All")}
    assert counts == {"Aged Dual": 1, "Disabled": 1, "ESRD": 2, "Non-ESRD": 1, "All": 2}
    assert rows["Non-ESRD", "tot_cost_final_30days"] == 15.0
    assert rows["ESRD", "tot_cost_final_30days"] == 15.0
    assert (rows["ESRD", "cnt_cancer"], rows["ESRD", "cnt_chemo"]) == (1.0, 0.0)
    assert (rows["ESRD", "cnt_death_in_hosp"], rows["Non-ESRD", "cnt_death_in_hosp"]) == (1.0, 0.0)
    assert (rows["ESRD", "cnt_hospice_never"], rows["ESRD", "cnt_hospice_lt3days"]) == (1.0, 1.0)
    assert [metric for status, metric in rows if status == "All"] == ["decedent_count"]
