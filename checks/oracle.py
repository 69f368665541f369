"""The expected results in plain SQL, written the long way: one join or branch per definition.

``CTES`` holds the domain tables and shared intermediates in dependency order; ``full`` puts the ones a query
mentions in front of it. Fractional values are summed as decimals, so that both engines add up exactly.
"""

from __future__ import annotations

import re

from checks.fixtures import PLAIN

# --- Fixed values, written out here so that a wrong digit in the library shows -------------------------
THRESHOLDS = {"Aged Non-Dual": 147189, "Aged Dual": 236991, "Disabled": 177548, "ESRD": 507077}
WELLNESS_CODES = ("G0402", "G0438", "G0439", "G0468")
PREFIXES = ("I", "I11", "P32", "O16", "P34", "P99", "P2", "P")
BANDS = (
    ("<0.50", -1.0, 0.499),
    ("0.50-0.59", 0.5, 0.599),
    ("0.60-0.69", 0.6, 0.699),
    ("0.70-0.79", 0.7, 0.799),
    ("0.80-0.89", 0.8, 0.899),
    ("0.90-0.99", 0.9, 0.999),
    ("1.00-1.09", 1.0, 1.099),
    ("1.10-1.19", 1.1, 1.199),
    ("1.20-1.34", 1.2, 1.349),
    ("1.35-1.49", 1.35, 1.499),
    ("1.50-1.74", 1.5, 1.749),
    ("1.75-2.00", 1.75, 1.999),
)
OPEN_BAND = (2.0, 500.0)
# --- End of fixed values ------------------------------------------------------------------------

CTES: dict[str, str] = dict(PLAIN)


def full(body: str, **changed: str) -> str:
    """``body`` behind the CTEs that it uses, directly or through another one; ``changed`` replaces some of them."""
    known = {**CTES, **changed}
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        for name in known:
            if name in words and name not in needed:
                needed.add(name)
                texts.append(known[name])
    ctes = [f"{name} AS ({known[name]})" for name in known if name in needed]
    return f"WITH {', '.join(ctes)}\n{body}"


def exact(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(28,8))) AS DOUBLE)"


def total(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE)"


def metric(source: str, metric_id: str, value: str, where: str = "true") -> str:
    """One metric per status; ``metric_id`` and ``value`` are SQL expressions, the latter an aggregate."""
    return (
        f"SELECT elig_status, {metric_id} AS metric_id, {value} AS metric_value "
        f"FROM {source} WHERE {where} GROUP BY elig_status, {metric_id}"
    )


def union(*parts: str) -> str:
    return "\nUNION ALL\n".join(f"({part})" for part in parts)


# --- cohort -------------------------------------------------------------------------------------

def period_sql(runout_months: int) -> str:
    return f"""
        SELECT time_period_id, reporting_date_start AS lo, reporting_date_end AS hi
        FROM time_periods WHERE months_of_claims_runout = {runout_months}
    """


CTES["period"] = period_sql(3)
# The period of the cohort and of deaths, which may be narrowed to the year to date.
CTES["cohort_period"] = "SELECT * FROM period"
YEAR_TO_DATE_SQL = "SELECT time_period_id, CAST(date_trunc('year', hi) AS DATE) AS lo, hi FROM period"


def member_months_sql(assignment: str = "current") -> str:
    by_month = "AND assignment_indicator = 'Y'" if assignment == "during_period" else ""
    assigned = {
        "current": "JOIN members a ON a.member_id = m.member_id AND a.assignment_indicator = 'Y'",
        "july_first": "JOIN members a ON a.member_id = m.member_id AND a.mem_report_hier_2 = 'Y'",
        "during_period": "",
    }[assignment]
    windows = f"""
        (SELECT w.* FROM member_time_windows w JOIN cohort_period p ON w.elig_month BETWEEN p.lo AND p.hi
         WHERE true {by_month})"""
    return f"""
        SELECT m.member_id, m.elig_month, latest.elig_status_1 AS elig_status, m.memmos, r.risk_score,
          CASE WHEN m.memmos > 0 THEN 'Y' ELSE 'N' END AS cover_medical
        FROM (SELECT member_id, elig_month, sum(memmos_medical) AS memmos
              FROM {windows} GROUP BY member_id, elig_month) m
        JOIN (SELECT *, row_number() OVER (PARTITION BY member_id, elig_month
                ORDER BY date_end DESC NULLS LAST, date_start DESC NULLS LAST, elig_status_1 DESC) AS nth
              FROM {windows}) latest
          ON latest.member_id = m.member_id AND latest.elig_month = m.elig_month AND latest.nth = 1
        LEFT JOIN (SELECT s.member_id, s.risk_score FROM risk_scores s
                   JOIN cohort_period p ON s.time_period_id = p.time_period_id) r ON r.member_id = m.member_id
        {assigned}
        WHERE latest.elig_status_1 <> 'Unknown'
    """


CTES["member_months"] = member_months_sql()
CTES["covered"] = "SELECT * FROM member_months WHERE cover_medical = 'Y'"
CTES["spans"] = "SELECT member_id, date_start, date_end FROM member_time_windows WHERE cover_medical = 'Y'"
CTES["link"] = "SELECT researcherline, btnumber FROM ref_link_hcg_researcher_line WHERE lob = 'Medicare'"


def attributed(month_date: str, covered_date: str) -> str:
    return f"""
        SELECT o.*, m.elig_status, m.elig_month AS claim_month, {covered_date} AS covered_date
        FROM outclaims o
        JOIN spans s ON o.member_id = s.member_id AND {covered_date} BETWEEN s.date_start AND s.date_end
        JOIN covered m ON o.member_id = m.member_id AND CAST(date_trunc('month', {month_date}) AS DATE) = m.elig_month
    """


_STAY = "CASE WHEN o.prm_line = 'I31' THEN o.prm_fromdate_case ELSE o.prm_fromdate END"
CTES["by_stay_month"] = attributed(_STAY, "o.prm_fromdate")
CTES["by_line_date"] = attributed("o.prm_fromdate", "o.prm_fromdate")
CTES["by_case_date"] = attributed("o.prm_fromdate_case", "o.prm_fromdate_case")
CTES["by_stay_date"] = attributed(_STAY, _STAY)

# --- risk ---------------------------------------------------------------------------------------


def average_risk_sql(digits: int) -> str:
    return f"""
        SELECT elig_status, round_even({exact('memmos * risk_score')} / {exact('memmos')}, {digits}) AS risk_score_avg
        FROM covered GROUP BY elig_status
    """


def _bound(side: int) -> str:
    whens = " ".join(f"WHEN '{band}' THEN {bounds[side]}" for band, *bounds in BANDS)
    return f"CAST(CASE riskband {whens} ELSE {OPEN_BAND[side]} END AS DOUBLE)"


CTES["risk_3"] = average_risk_sql(3)
CTES["risk_3_filled"] = "SELECT elig_status, coalesce(risk_score_avg, 0) AS risk_score_avg FROM risk_3"
CTES["risk_2"] = average_risk_sql(2)
CTES["bands"] = f"""
    SELECT btnumber, {_bound(0)} AS low, {_bound(1)} AS high, admitfactor, utilfactor
    FROM ref_hcg_bt WHERE lob = 'Medicare' AND basis = 'RS'
"""


def typed(source: str) -> str:
    return f"SELECT c.*, l.btnumber FROM {source} c LEFT JOIN link l ON c.prm_line = l.researcherline"


def strict(usage: str, risk: str, factor: str) -> str:
    """Usage (elig_status, btnumber, value) with a band, and the adjusted value."""
    return f"""
        SELECT u.elig_status, u.value, CAST(u.value AS DOUBLE) / b.{factor} AS adjusted
        FROM ({usage}) u JOIN {risk} r ON u.elig_status = r.elig_status
        LEFT JOIN bands b ON u.btnumber = b.btnumber
        WHERE r.risk_score_avg BETWEEN b.low AND b.high
    """


# --- measures -----------------------------------------------------------------------------------

FAMILIES: dict[str, dict[str, str]] = {}

CTES["threshold"] = "SELECT * FROM (VALUES {}) AS t(elig_status, yearly)".format(
    ", ".join(f"('{s}', {v})" for s, v in THRESHOLDS.items())
)
CTES["member_totals"] = """
    SELECT c.member_id, c.elig_status, c.costs, m.memmos,
      CASE WHEN t.yearly IS NULL THEN 99999999 ELSE CAST(t.yearly AS DOUBLE) * m.memmos / 12 END AS cost_limit
    FROM (SELECT member_id, elig_status, CAST(sum(prm_costs) AS DOUBLE) AS costs
          FROM by_stay_month GROUP BY member_id, elig_status) c
    LEFT JOIN (SELECT member_id, elig_status, sum(memmos) AS memmos FROM covered GROUP BY member_id, elig_status) m
      ON c.member_id = m.member_id AND c.elig_status = m.elig_status
    LEFT JOIN threshold t ON t.elig_status = c.elig_status
"""
_WELLNESS = ", ".join(f"'{code}'" for code in WELLNESS_CODES)
CTES["wellness"] = f"""
    SELECT * FROM (
      SELECT m.member_id, m.elig_month, m.elig_status, o.prm_fromdate,
        CASE WHEN CAST(date_trunc('month', m.elig_month) - INTERVAL 11 MONTH AS DATE) <= o.prm_fromdate
             THEN 1 ELSE 0 END AS tag,
        row_number() OVER (PARTITION BY m.member_id, m.elig_month ORDER BY o.prm_fromdate DESC) AS nth
      FROM covered m JOIN outclaims o ON m.member_id = o.member_id
      WHERE o.hcpcs IN ({_WELLNESS}) AND o.prm_fromdate <= last_day(m.elig_month)) v
    WHERE nth = 1
"""
CTES["wellness_month"] = "SELECT max(elig_month) AS elig_month FROM wellness"
CTES["wellness_numer"] = """
    SELECT elig_status, CAST(sum(tag) AS DOUBLE) AS n FROM wellness
    WHERE elig_month = (SELECT elig_month FROM wellness_month) GROUP BY elig_status
"""
CTES["wellness_denom"] = """
    SELECT elig_status, CAST(count(DISTINCT member_id) AS DOUBLE) AS n FROM covered
    WHERE elig_month = (SELECT elig_month FROM wellness_month) GROUP BY elig_status
"""

DISTINCT_MEMBERS = "CAST(count(DISTINCT member_id) AS DOUBLE)"


def with_all(source: str, metric_id: str) -> str:
    return union(
        f"SELECT elig_status, '{metric_id}' AS metric_id, n AS metric_value FROM {source}",
        f"SELECT 'All' AS elig_status, '{metric_id}' AS metric_id, CAST(sum(n) AS DOUBLE) AS metric_value FROM {source}",
    )


FAMILIES["basic"] = {
    "assigned_members": union(
        metric("covered", "'cnt_assigned_mems'", DISTINCT_MEMBERS),
        f"SELECT 'All' AS elig_status, 'cnt_assigned_mems' AS metric_id, {DISTINCT_MEMBERS} AS metric_value FROM covered",
    ),
    "assigned_members_non_esrd": f"""
        SELECT 'Non-ESRD' AS elig_status, 'cnt_assigned_mems_nonesrd' AS metric_id, {DISTINCT_MEMBERS} AS metric_value
        FROM covered WHERE elig_status <> 'ESRD'""",
    "member_months_total": metric("covered", "'memmos_sum'", exact("memmos")),
    "risk_score_mean": metric("covered", "'riskscr_1_avg'", f"{exact('memmos * risk_score')} / {exact('memmos')}"),
    "cost_total": metric("by_stay_month", "'prm_costs_sum_all_services'", total("prm_costs")),
    "cost_truncated": metric(
        "member_totals",
        "'prm_costs_truncated'",
        exact("CASE WHEN costs > cost_limit THEN cost_limit ELSE costs END"),
    ),
    "age_total": metric(
        "(SELECT m.elig_status, m.memmos * (date_diff('day', b.dob, m.elig_month) / CAST(365.25 AS DOUBLE)) AS years "
        "FROM covered m JOIN members b ON m.member_id = b.member_id)",
        "'total_age'",
        exact("years"),
    ),
    "wellness_visits_numer": with_all("wellness_numer", "cnt_wellness_visits_numer"),
    "wellness_visits_denom": with_all("wellness_denom", "cnt_wellness_visits_denom"),
}

CTES["ip"] = f"SELECT * FROM ({typed('by_stay_month')}) t WHERE prm_line LIKE 'I%' AND prm_line <> 'I31'"
CTES["ip_adjusted"] = """
    SELECT u.elig_status, u.prm_line, u.btnumber, u.admits,
      CAST(u.admits AS DOUBLE) / coalesce(b.admitfactor, 1) AS adjusted
    FROM (SELECT elig_status, prm_line, btnumber, sum(prm_admits) AS admits
          FROM ip GROUP BY elig_status, prm_line, btnumber) u
    LEFT JOIN risk_3_filled r ON u.elig_status = r.elig_status
    LEFT JOIN bands b ON u.btnumber = b.btnumber
    WHERE b.admitfactor IS NULL OR r.risk_score_avg BETWEEN b.low AND b.high
"""
ADMITS = total("prm_admits")
_PSP = "psp_category IS NOT NULL AND psp_preventable_yn = 'Y'"


def admits_with_twin(metric_id: str, where: str = "true") -> str:
    return union(
        metric("ip_adjusted", f"'{metric_id}'", total("admits"), where),
        metric("ip_adjusted", f"'{metric_id}_riskadj'", exact("adjusted"), where),
    )


FAMILIES["inpatient"] = {
    "pqi_admits": metric("ip", "'pqi'", ADMITS, "prm_ahrq_pqi <> 'none'"),
    "pqi_admits_by_indicator": metric("ip", "concat(prm_ahrq_pqi, '_admits')", ADMITS, "prm_ahrq_pqi <> 'none'"),
    "psp_admits": metric("ip", "'psp_admits'", ADMITS, _PSP),
    "psp_admits_by_category": metric("ip", "concat('psp_admits_', psp_category)", ADMITS, _PSP),
    "one_day_stays": union(
        metric("ip", "'Denom_1_Day_LOS'", ADMITS), metric("ip", "'Num_1_Day_LOS'", ADMITS, "prm_util = 1")
    ),
    "one_day_medical_stays": union(
        metric("ip", "'Denom_1_Day_LOS_Medical'", ADMITS, "prm_line LIKE 'I11%'"),
        metric("ip", "'Num_1_Day_LOS_Medical'", ADMITS, "prm_line LIKE 'I11%' AND prm_util = 1"),
    ),
    "acute_admits": admits_with_twin("acute"),
    "medical_admits": admits_with_twin("medical_general", "prm_line = 'I11a'"),
    "surgical_admits": admits_with_twin("surgical", "prm_line = 'I12'"),
    "readmissions": union(
        metric("ip", "'cnt_pot_readmits'", ADMITS, "prm_readmit_potential_yn = 'Y'"),
        metric("ip", "'cnt_ip_readmits'", ADMITS, "prm_readmit_all_cause_yn = 'Y'"),
    ),
    "discharges_to_snf": metric("ip", "'disch_snf'", ADMITS, "dischargestatus = '03'"),
}

CTES["op"] = f"""
    SELECT * FROM ({typed('by_line_date')}) t
    WHERE left(prm_line, 3) IN ('O14', 'O10', 'P57', 'P59', 'P33', 'P32', 'O12')
"""


def usage_with_twin(metric_id: str, where: str, extra_key: str = "") -> str:
    usage = (
        f"SELECT elig_status, btnumber, sum(prm_util) AS value FROM op WHERE {where} "
        f"GROUP BY elig_status, btnumber{extra_key}"
    )
    adjusted = f"({strict(usage, 'risk_3_filled', 'utilfactor')})"
    return union(
        metric(adjusted, f"'{metric_id}'", total("value")), metric(adjusted, f"'{metric_id}_riskadj'", exact("adjusted"))
    )


_PROCS = f"{_PSP} AND prm_line LIKE 'O12%'"
FAMILIES["outpatient"] = {
    "imaging_and_visits": union(
        usage_with_twin("high_tech_imaging", "prm_line LIKE 'O14%'"),
        usage_with_twin("observation_stays", "prm_line LIKE 'O10%'"),
        usage_with_twin("hi_tec_img_fop", "prm_line LIKE 'P57%'"),
        usage_with_twin("hi_tec_img_office", "prm_line LIKE 'P59%'"),
        usage_with_twin("urgent_care_prof", "prm_line LIKE 'P33%'"),
    ),
    "office_visits": usage_with_twin("office_visits", "prm_line IN ('P32c', 'P32d')", ", prm_line"),
    "psp_procedures": union(
        metric("op", "'psp_procs'", total("mr_cases_admits"), _PROCS),
        metric("op", "concat('psp_procs_', psp_category)", total("mr_cases_admits"), _PROCS),
    ),
}

CTES["snf"] = f"SELECT * FROM ({typed('by_case_date')}) t WHERE left(prm_line, 3) = 'I31'"
CTES["snf_usage"] = "SELECT elig_status, btnumber, sum(prm_admits) AS value FROM snf GROUP BY elig_status, btnumber"
FAMILIES["snf"] = {
    "snf_admits": "SELECT elig_status, 'SNF' AS metric_id, CAST(value AS DOUBLE) AS metric_value FROM snf_usage",
    "snf_admits_adjusted": f"""
        SELECT elig_status, 'SNF_rskadj' AS metric_id, adjusted AS metric_value
        FROM ({strict('SELECT * FROM snf_usage', 'risk_3', 'admitfactor')}) a""",
    "snf_long_stays": metric("snf", "'number_SNF_over_21_days'", ADMITS, "prm_util > 21"),
    "snf_all_cause_readmissions": metric("snf", "'number_SNF_readmits'", ADMITS, "prm_readmit_all_cause_yn = 'Y'"),
    "snf_facilities": metric("snf", "'distinct_SNFs'", "CAST(count(DISTINCT providerid) AS DOUBLE)"),
    "snf_flagged_readmissions": union(
        metric("snf", "'SNF_Readmits'", ADMITS, "snfrm_numer_yn = 'Y'"),
        metric("snf", "'SNF_Readmits_denom'", ADMITS, "snfrm_denom_yn = 'Y'"),
    ),
}

CTES["er"] = f"""
    SELECT t.*, d.prm_nyu_emergent_non_avoidable, d.prm_nyu_emergent_avoidable, d.prm_nyu_emergent_primary_care,
      d.prm_nyu_injury, d.prm_nyu_nonemergent
    FROM ({typed('by_line_date')}) t
    LEFT JOIN decor_case d ON t.member_id = d.member_id AND t.caseadmitid = d.caseadmitid
    WHERE left(t.prm_line, 3) = 'O11'
"""
CTES["er_usage"] = "SELECT elig_status, btnumber, sum(prm_util) AS value FROM er GROUP BY elig_status, btnumber"
FAMILIES["er"] = {
    "er_visits": "SELECT elig_status, 'ED' AS metric_id, CAST(value AS DOUBLE) AS metric_value FROM er_usage",
    "er_visits_adjusted": f"""
        SELECT elig_status, 'ED_rskadj' AS metric_id, adjusted AS metric_value
        FROM ({strict('SELECT * FROM er_usage', 'risk_2', 'utilfactor')}) a""",
    "er_visit_classes": union(
        *[
            metric("er", f"'{metric_id}'", exact(f"prm_util * {column}"))
            for metric_id, column in {
                "ED_emer_nec": "prm_nyu_emergent_non_avoidable",
                "ED_emer_prev": "prm_nyu_emergent_avoidable",
                "ED_emer_pricare": "prm_nyu_emergent_primary_care",
                "ED_injury": "prm_nyu_injury",
                "ED_nonemer": "prm_nyu_nonemergent",
            }.items()
        ]
    ),
}

_DIED = "dischargestatus = '20' AND prm_line LIKE 'I%' AND prm_line <> 'I31'"


def _days(condition: str) -> str:
    return f"CASE WHEN sum(CASE WHEN {condition} THEN prm_util ELSE 0 END) > 0 THEN 'Y' ELSE 'N' END"


EPISODE_FLAGS_SQL = f"""
    SELECT pac_caseadmitid,
      {_days("pac_major_category = 'IP' AND pac_minor_category = 'Acute'")} AS pac_has_ip_acute_yn,
      {_days("pac_major_category = 'IP' AND pac_minor_category = 'Rehab'")} AS pac_has_ip_rehab_yn,
      {_days("pac_major_category = 'SNF'")} AS pac_has_snf_yn,
      {_days("pac_major_category = 'HH'")} AS pac_has_hh_yn
    FROM outclaims WHERE pac_index_yn = 'N' AND pac_caseadmitid IS NOT NULL GROUP BY pac_caseadmitid
"""
CTES["flags"] = EPISODE_FLAGS_SQL
CTES["hospital_deaths"] = f"SELECT DISTINCT member_id FROM outclaims WHERE {_DIED}"
CTES["pac_index"] = """
    SELECT c.*, f.pac_has_ip_acute_yn, f.pac_has_ip_rehab_yn, f.pac_has_snf_yn, f.pac_has_hh_yn,
      CASE WHEN d.death_date <= c.pac_episode_end_date THEN 'Y' ELSE 'N' END AS died
    FROM by_stay_month c
    JOIN ref_pac_benchmarks b ON c.prm_drg = b.msdrg AND b.benchmarks_pac_freq_wm_readm IS NOT NULL
    LEFT JOIN flags f ON c.pac_caseadmitid = f.pac_caseadmitid
    LEFT JOIN (SELECT m.member_id, m.death_date FROM members m JOIN hospital_deaths h ON m.member_id = h.member_id) d
      ON c.member_id = d.member_id
    WHERE c.pac_index_yn = 'Y'
"""


def followups(kind: str, suffix: str, line: str) -> str:
    hit = f"followup_visit_within_7_days_{kind}_yn = 'Y' AND prm_line = '{line}'"
    return metric(
        "pac_index",
        f"'cnt_followup_visits_within_7_days_{kind}_{suffix}'",
        total(f"CASE WHEN {hit} THEN 1 ELSE 0 END"),
    )


FAMILIES["pac"] = {
    "pac_episodes": metric("pac_index", "'pac_epi'", ADMITS),
    "pac_hospital_deaths": metric("pac_index", "'pac_died_in_hosp'", ADMITS, "died = 'Y'"),
    "pac_post_acute_use": union(
        metric("pac_index", "'pac_ipreadmit'", ADMITS, "pac_has_ip_acute_yn = 'Y'"),
        metric("pac_index", "'pac_snf'", ADMITS, "pac_has_snf_yn = 'Y'"),
        metric("pac_index", "'pac_rehab'", ADMITS, "pac_has_ip_rehab_yn = 'Y'"),
        metric("pac_index", "'pac_hh'", ADMITS, "pac_has_hh_yn = 'Y'"),
    ),
    "pac_followup_visits": union(
        *[followups(kind, *line) for kind in ("numer", "denom") for line in (("med", "I11a"), ("sur", "I12"))]
    ),
}


def _drg_count(flag: str) -> str:
    return f"CAST(sum(CASE WHEN {flag} = 'Y' THEN prm_admits ELSE 0 END) AS BIGINT)"


PAC_DRG_SQL = f"""
    SELECT elig_status, prm_drg, CAST(sum(prm_admits) AS BIGINT) AS pac_count,
      {_drg_count('pac_has_ip_acute_yn')} AS pac_acute_count, {_drg_count('pac_has_ip_rehab_yn')} AS pac_rehab_count,
      {_drg_count('pac_has_snf_yn')} AS pac_snf_count, {_drg_count('pac_has_hh_yn')} AS pac_hh_count,
      {_drg_count('died')} AS pac_death_count
    FROM pac_index GROUP BY elig_status, prm_drg
"""

_LINE_SUMS = {"cost": "prm_costs", "util": "prm_util", "admits": "prm_admits"}
FAMILIES["lines"] = {
    "prefix_totals": union(
        *[
            metric("by_stay_date", f"'{prefix}_{name}'", total(column), f"prm_line LIKE '{prefix}%'")
            for prefix in PREFIXES
            for name, column in _LINE_SUMS.items()
        ]
    ),
    "line_totals": union(
        *[metric("by_stay_date", f"prm_line || '_{name}'", total(column)) for name, column in _LINE_SUMS.items()]
    ),
}

# --- end of life --------------------------------------------------------------------------------


CTES["seen"] = "SELECT DISTINCT member_id, elig_status FROM member_months WHERE memmos <> 0"
CTES["deaths"] = """
    SELECT s.member_id, m.death_date,
      CASE WHEN m.death_date BETWEEN p.lo AND p.hi THEN 1 ELSE 0 END AS death_flag,
      CASE WHEN m.endoflife_denom_yn_chemolt14days = 'Y' THEN 1 ELSE 0 END AS cnt_cancer,
      CASE WHEN m.endoflife_numer_yn_chemolt14days = 'Y' THEN 1 ELSE 0 END AS cnt_chemo
    FROM (SELECT DISTINCT member_id FROM seen) s
    LEFT JOIN members m ON s.member_id = m.member_id CROSS JOIN cohort_period p
"""
CTES["eol_members"] = """
    SELECT d.*, coalesce(c.cost, 0) AS final_cost, CASE WHEN x.member_id IS NULL THEN 0 ELSE 1 END AS in_hosp,
      CASE WHEN coalesce(h.days, 0) = 0 THEN 1 ELSE 0 END AS never,
      CASE WHEN coalesce(h.days, 0) IN (1, 2) THEN 1 ELSE 0 END AS lt3
    FROM deaths d
    LEFT JOIN (SELECT o.member_id, sum(o.prm_costs) AS cost
               FROM outclaims o JOIN deaths e ON o.member_id = e.member_id
               WHERE date_diff('day', o.prm_todate, e.death_date) <= 30 GROUP BY o.member_id) c
      ON d.member_id = c.member_id
    LEFT JOIN (SELECT member_id, sum(prm_util) AS days FROM outclaims WHERE prm_line IN ('P82d', 'P82e')
               GROUP BY member_id) h ON d.member_id = h.member_id
    LEFT JOIN hospital_deaths x ON d.member_id = x.member_id
    WHERE d.death_flag = 1
"""
CTES["eol_rows"] = """
    SELECT s.elig_status, m.* FROM eol_members m JOIN seen s ON m.member_id = s.member_id
    UNION ALL
    SELECT DISTINCT 'Non-ESRD' AS elig_status, m.* FROM eol_members m
    JOIN seen s ON m.member_id = s.member_id WHERE s.elig_status <> 'ESRD'
"""
FAMILIES["eol"] = {
    "decedents": union(
        metric("eol_rows", "'decedent_count'", total("death_flag")),
        f"SELECT 'All' AS elig_status, 'decedent_count' AS metric_id, {DISTINCT_MEMBERS} AS metric_value "
        "FROM eol_rows HAVING count(*) > 0",
    ),
    "cancer_decedents": union(
        metric("eol_rows", "'cnt_cancer'", total("cnt_cancer")), metric("eol_rows", "'cnt_chemo'", total("cnt_chemo"))
    ),
    "final_month_cost": metric("eol_rows", "'tot_cost_final_30days'", total("final_cost")),
    "hospital_decedents": metric("eol_rows", "'cnt_death_in_hosp'", total("in_hosp")),
    "hospice_use": union(
        metric("eol_rows", "'cnt_hospice_never'", total("never")),
        metric("eol_rows", "'cnt_hospice_lt3days'", total("lt3")),
    ),
}

# --- wide summaries -----------------------------------------------------------------------------

BETOS_SQL = """
    SELECT prm_betos_code, prm_line, runout_7_yn, runout_14_yn, fromdate_elig_yn, todate_elig_yn, elig_status,
      CAST(sum(prm_costs) AS DOUBLE) AS costs
    FROM (
      SELECT o.*, m.elig_status,
        CASE WHEN o.paiddate <= p.hi + 7 THEN 'Y' ELSE 'N' END AS runout_7_yn,
        CASE WHEN o.paiddate <= p.hi + 14 THEN 'Y' ELSE 'N' END AS runout_14_yn,
        CASE WHEN o.prm_fromdate BETWEEN p.lo AND p.hi THEN 'Y' ELSE 'N' END AS fromdate_elig_yn,
        CASE WHEN o.prm_todate BETWEEN p.lo AND p.hi THEN 'Y' ELSE 'N' END AS todate_elig_yn
      FROM outclaims o CROSS JOIN period p
      JOIN covered m ON o.member_id = m.member_id
        AND CAST(date_trunc('month', CASE WHEN o.prm_fromdate BETWEEN p.lo AND p.hi
                                          THEN o.prm_fromdate ELSE o.prm_todate END) AS DATE) = m.elig_month
      WHERE o.prm_fromdate BETWEEN p.lo AND p.hi OR o.prm_todate BETWEEN p.lo AND p.hi) c
    GROUP BY prm_betos_code, prm_line, runout_7_yn, runout_14_yn, fromdate_elig_yn, todate_elig_yn, elig_status
"""

SUFFIXES = ("", "_14", "_21", "_3mos", "_3mos_7")
_CUTOFFS = {
    "_14": "p.hi + 14",
    "_21": "p.hi + 21",
    "_3mos": "CAST(p.hi + INTERVAL 3 MONTH AS DATE)",
    "_3mos_7": "CAST(p.hi + INTERVAL 3 MONTH AS DATE) + 7",
}
_ADD_ONS = {
    "ime": "prm_capital_ime_amount + o.prm_operational_ime_amount",
    "dsh": "prm_capital_ds_amount + o.prm_operational_ds_amount",
    "ucc": "prm_hipps_dsh_amount",
}


def _paid_by(value: str, suffix: str) -> str:
    return f"CASE WHEN paiddate <= cutoff{suffix} THEN {value} ELSE 0 END" if suffix else value


def truncation_basis(basis: str) -> str:
    signed = ", ".join(
        f"CASE WHEN o.prm_costs < 0 THEN -1 * (o.{v}) ELSE o.{v} END AS {name}" for name, v in _ADD_ONS.items()
    )
    cutoffs = ", ".join(f"{value} AS cutoff{s}" for s, value in _CUTOFFS.items())
    return f"""
        SELECT o.member_id, m.elig_status, '{basis}' AS date_flag, o.claimid, o.prm_costs, o.paiddate, {signed}, {cutoffs}
        FROM outclaims o JOIN period p ON o.{basis} BETWEEN p.lo AND p.hi
        JOIN covered m ON o.member_id = m.member_id AND CAST(date_trunc('month', o.{basis}) AS DATE) = m.elig_month
    """


_ADD_ON_COLUMNS = [(f"{a}_costs{s}", _paid_by(a, s)) for s in SUFFIXES for a in _ADD_ONS]
_COST_COLUMNS = [f"costs{s}" for s in SUFFIXES]
ALL_COST_COLUMNS = _COST_COLUMNS + [name for name, _ in _ADD_ON_COLUMNS]
CTES["trunc_lines"] = union(truncation_basis("prm_fromdate"), truncation_basis("prm_todate"))
CTES["trunc_costs"] = "SELECT member_id, elig_status, date_flag, {} FROM trunc_lines GROUP BY ALL".format(
    ", ".join(f"sum({_paid_by('prm_costs', s)}) AS costs{s}" for s in SUFFIXES)
)
CTES["trunc_add_ons"] = "SELECT member_id, elig_status, date_flag, {} FROM (SELECT DISTINCT {} FROM trunc_lines) d GROUP BY ALL".format(
    ", ".join(f"sum({name}) AS {name}" for name, _ in _ADD_ON_COLUMNS),
    "member_id, elig_status, date_flag, claimid, " + ", ".join(f"{value} AS {name}" for name, value in _ADD_ON_COLUMNS),
)
CTES["trunc_members"] = """
    SELECT m.member_id, m.elig_status, f.date_flag, m.memmos, {}
    FROM (SELECT member_id, elig_status, sum(memmos) AS memmos FROM covered GROUP BY member_id, elig_status) m
    CROSS JOIN (VALUES ('prm_fromdate'), ('prm_todate')) AS f(date_flag)
    LEFT JOIN trunc_costs c ON m.member_id = c.member_id AND m.elig_status = c.elig_status AND f.date_flag = c.date_flag
    LEFT JOIN trunc_add_ons a ON m.member_id = a.member_id AND m.elig_status = a.elig_status AND f.date_flag = a.date_flag
""".format(", ".join(f"coalesce({c}, 0) AS {c}" for c in ALL_COST_COLUMNS))


def _reduced(suffix: str) -> str:
    return f"(costs{suffix} - ime_costs{suffix} - dsh_costs{suffix} - ucc_costs{suffix})"


TRUNCATION_SQL = """
    SELECT m.elig_status, date_flag, {memmos} AS memmos, {costs}, {limited}
    FROM trunc_members m LEFT JOIN threshold t ON m.elig_status = t.elig_status GROUP BY m.elig_status, date_flag
""".format(
    memmos=exact("memmos"),
    costs=", ".join(f"{total(c)} AS {c}" for c in ALL_COST_COLUMNS),
    limited=", ".join(
        f"{total(_reduced(s))} AS costs{s}_reduced, "
        + exact(
            "least(CASE WHEN t.yearly IS NULL THEN 99999999999 ELSE CAST(t.yearly AS DOUBLE) * memmos / 12 END, "
            f"CAST({_reduced(s)} AS DOUBLE))"
        )
        + f" AS costs{s}_truncated"
        for s in SUFFIXES
    ),
)

# --- report -------------------------------------------------------------------------------------


def family(name: str) -> str:
    return union(*FAMILIES[name].values())


ROLLED_FAMILIES = ("basic", "inpatient", "outpatient", "snf", "er", "pac", "lines")
CTES["rolled"] = union(*[family(name) for name in ROLLED_FAMILIES])


def rollup_sql(source: str) -> str:
    return f"""
        SELECT 'Non-ESRD' AS elig_status, metric_id,
          list_reduce(list_sort(list(metric_value) FILTER (metric_value IS NOT NULL)), lambda a, b: a + b) AS metric_value
        FROM {source} WHERE elig_status IN ('Aged Non-Dual', 'Aged Dual', 'Disabled') GROUP BY metric_id
    """


def consolidated_sql(name: str) -> str:
    return f"""
        SELECT elig_status, metric_id, CAST(sum(CAST(metric_value AS DECIMAL(28,8))) AS DOUBLE) AS metric_value
        FROM ({family(name)}) s GROUP BY elig_status, metric_id
    """


ADDITIVE = "(SELECT * FROM rolled WHERE metric_id NOT IN ('riskscr_1_avg', 'distinct_SNFs', 'cnt_assigned_mems'))"


def report_sql(client: str, label: str, summed: str = "rolled") -> str:
    """``summed`` is what the Non-ESRD rows add up."""
    stacked = union("SELECT * FROM rolled", rollup_sql(summed), family("eol"))
    return f"""
        SELECT '{client}' AS name_client, '{label}' AS time_period, elig_status, '' AS metric_category, metric_id,
          '' AS metric_name, metric_value,
          replace('{client}' || '_{label}_' || elig_status || '_' || metric_id, ' ', '') AS idx
        FROM ({stacked}) s
    """


def labelled_sql(body: str, client: str, label: str) -> str:
    return f"SELECT '{client}' AS name_client, '{label}' AS time_period, s.* FROM ({body}) s"


# --- operators that yield a table -----------------------------------------------------------------

READMIT_CASES_SQL = """
    SELECT DISTINCT s.caseadmitid
    FROM (SELECT member_id, caseadmitid, min(prm_fromdate_case) AS readmit_start FROM outclaims
          WHERE prm_line_agg = 'i1' GROUP BY member_id, caseadmitid) r
    JOIN (SELECT member_id, caseadmitid, max(prm_fromdate_case) AS snf_start FROM snf
          GROUP BY member_id, caseadmitid) s ON r.member_id = s.member_id
    JOIN (SELECT member_id, caseadmitid, max(prm_todate_case) AS index_end FROM outclaims
          WHERE prm_line_agg = 'i1' GROUP BY member_id, caseadmitid) i ON r.member_id = i.member_id
    WHERE s.snf_start BETWEEN r.readmit_start - 30 AND r.readmit_start
      AND i.index_end BETWEEN r.readmit_start - 30 AND s.snf_start
"""


def attributed_sql(source: str) -> str:
    return f"""
        SELECT member_id, elig_status, claim_month, covered_date, prm_line, CAST(count(*) AS BIGINT) AS lines,
          {total('prm_costs')} AS costs
        FROM {source} GROUP BY member_id, elig_status, claim_month, covered_date, prm_line
    """


def claim_months_sql() -> str:
    dates = {"line": "o.prm_fromdate", "case": "o.prm_fromdate_case", "stay": _STAY}
    return union(
        *[
            f"SELECT '{name}' AS month_by, CAST(date_trunc('month', {value}) AS DATE) AS claim_month, "
            f"CAST(count(*) AS BIGINT) AS lines FROM outclaims o GROUP BY 1, 2"
            for name, value in dates.items()
        ]
    )


COLLAPSED_SQL = """
    SELECT member_id, elig_month, sum(memmos_medical) AS memmos,
      first(elig_status_1 ORDER BY date_end DESC NULLS LAST, date_start DESC NULLS LAST, elig_status_1 DESC NULLS LAST) AS elig_status
    FROM member_time_windows JOIN period ON elig_month BETWEEN lo AND hi GROUP BY member_id, elig_month
"""
# Every day on which a window starts or has ended, and how many windows hold the days up to the next such day.
SPANS_SQL = """
    SELECT * FROM (
    WITH held AS (SELECT * FROM spans WHERE date_start <= date_end),
    days AS (SELECT DISTINCT member_id, day FROM (
      SELECT member_id, date_start AS day FROM held UNION ALL SELECT member_id, date_end + 1 FROM held)),
    stretches AS (SELECT member_id, day, lead(day) OVER (PARTITION BY member_id ORDER BY day) - 1 AS last FROM days),
    counted AS (SELECT s.member_id, s.day, s.last, count(h.member_id) AS copies FROM stretches s
      LEFT JOIN held h ON h.member_id = s.member_id AND s.day BETWEEN h.date_start AND h.date_end GROUP BY ALL),
    joined AS (SELECT *, copies IS DISTINCT FROM lag(copies) OVER (PARTITION BY member_id ORDER BY day) AS fresh FROM counted),
    runs AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY member_id ORDER BY day) AS run FROM joined)
    SELECT member_id, min(day) AS date_start, max(last) AS date_end, CAST(any_value(copies) AS BIGINT) AS copies
    FROM runs WHERE copies > 0 GROUP BY member_id, run) s
"""
COVERAGE_SQL = """
    SELECT member_id, date_start, date_end, CAST(count(*) AS BIGINT) AS copies FROM spans
    GROUP BY member_id, date_start, date_end
"""
RISK_SQL = "SELECT s.member_id, s.risk_score FROM risk_scores s JOIN period p ON s.time_period_id = p.time_period_id"
AVERAGE_RISK_SQL = """
    SELECT a.elig_status, a.risk_score_avg AS risk_3_digits, b.risk_score_avg AS risk_2_digits
    FROM risk_3 a JOIN risk_2 b ON a.elig_status = b.elig_status
"""
BENEFIT_TYPES_SQL = """
    SELECT elig_status, prm_line, btnumber, CAST(sum(prm_admits) AS BIGINT) AS admits
    FROM ip GROUP BY elig_status, prm_line, btnumber
"""
RISK_ADJUSTED_SQL = """
    SELECT elig_status, prm_line, btnumber, CAST(admits AS BIGINT) AS admits, adjusted FROM ip_adjusted
"""
TRUNCATED_MEMBERS_SQL = """
    SELECT member_id, elig_status, costs, memmos, least(costs, cost_limit) AS costs_truncated FROM member_totals
"""
RUNOUT_MEMBERS_SQL = "SELECT member_id, elig_status, date_flag, memmos, {} FROM trunc_members".format(
    ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ALL_COST_COLUMNS)
)
CLAIM_ADD_ONS_SQL = """
    SELECT date_flag, elig_status, CAST(count(*) AS BIGINT) AS sets, {}
    FROM (SELECT DISTINCT member_id, elig_status, date_flag, claimid, ime, dsh, ucc,
            (CASE WHEN paiddate <= cutoff_14 THEN 1 ELSE 0 END + CASE WHEN paiddate <= cutoff_21 THEN 1 ELSE 0 END
             + CASE WHEN paiddate <= cutoff_3mos THEN 1 ELSE 0 END
             + CASE WHEN paiddate <= cutoff_3mos_7 THEN 1 ELSE 0 END) AS met
          FROM trunc_lines) d
    GROUP BY date_flag, elig_status
""".format(", ".join(f"{total(a)} AS {a}" for a in _ADD_ONS))
INDEX_SUMMARY_SQL = """
    SELECT elig_status, prm_drg, died, CAST(sum(prm_admits) AS BIGINT) AS admits, CAST(count(*) AS BIGINT) AS lines
    FROM pac_index GROUP BY elig_status, prm_drg, died
"""

