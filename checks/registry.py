"""Every registered query with the SQL that says what it should return."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.fixtures import domain_tables
from cohortlens.config import UNLISTED_THRESHOLD_BASIC, Assignment, ReportConfig
from cohortlens.functions.numbers import from_ticks
from cohortlens.operators import attribution, cohort as cohorts, cost, episodes, risk, rollup
from cohortlens.operators.cohort import Cohort, build_cohort
from cohortlens.plans import basic, betos, eol, er, inpatient, lines, outpatient, pac, report, snf, truncation
from cohortlens.sources.staging import CHECKPOINT_DIR, staging_folder
from cohortlens.sources.store import read_claim_store, save_claim_store
from cohortlens.sources.tables import ClaimTables, read_claim_tables

CLIENT = "Sample Client"
CURRENT = ReportConfig(client=CLIENT, assignment=Assignment.CURRENT)
LABEL = "1999Q1_1999Q4"

Plan = Callable[[ClaimTables, Cohort], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    expected: str


REGISTRY: dict[str, Query] = {}


def register(name: str, plan: Plan, expected: str, config: ReportConfig = CURRENT, **changed: str) -> None:
    """A plan over the domain tables and the cohort of ``config``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = domain_tables(spark, sf_dir)
        return plan(tables, build_cohort(tables, config))

    REGISTRY[name] = Query(run, oracle.full(expected, **changed))


# --- cohort -------------------------------------------------------------------------------------


def member_months(_: ClaimTables, cohort: Cohort) -> DataFrame:
    return cohort.member_months


YTD = ReportConfig(runout_months=6, year_to_date=True, assignment=Assignment.CURRENT)
YTD_CTES = {"period": oracle.period_sql(6), "cohort_period": oracle.YEAR_TO_DATE_SQL}
ALL_MONTHS = "SELECT * FROM member_months"

register("member_months_current", member_months, ALL_MONTHS)
for mode in (Assignment.JULY_FIRST, Assignment.DURING_PERIOD):
    register(
        f"member_months_{mode.value}",
        member_months,
        ALL_MONTHS,
        ReportConfig(assignment=mode),
        member_months=oracle.member_months_sql(mode.value),
    )
register("member_months_year_to_date", member_months, ALL_MONTHS, YTD, **YTD_CTES)
register(
    "member_month_coverage",
    lambda t, c: cohorts.collapse_windows(t.member_time_windows.where(c.period.holds("elig_month"))),
    oracle.COLLAPSED_SQL,
)
register("period_risk_scores", lambda t, c: cohorts.period_risk_scores(t.risk_scores, c.period), oracle.RISK_SQL)
register("coverage_windows", lambda t, c: c.windows, oracle.COVERAGE_SQL)
register("coverage_spans", lambda t, c: c.spans, oracle.SPANS_SQL)

# --- attribution --------------------------------------------------------------------------------

POLICIES = {
    "by_stay_month": attribution.BY_STAY_MONTH,
    "by_line_date": attribution.BY_LINE_DATE,
    "by_case_date": attribution.BY_CASE_DATE,
    "by_stay_date": attribution.BY_STAY_DATE,
}


def claim_months(tables: ClaimTables, _: Cohort) -> DataFrame:
    """Lines per month under each way of dating a line, from one scan."""
    dated = [
        policy.dated(tables.outclaims.select("prm_line", "prm_fromdate", "prm_fromdate_case")).select(
            F.lit(policy.month_by).alias("month_by"), "claim_month"
        )
        for policy in (attribution.BY_LINE_DATE, attribution.BY_CASE_DATE, attribution.BY_STAY_DATE)
    ]
    return (
        dated[0].unionByName(dated[1]).unionByName(dated[2])
        .groupBy("month_by", "claim_month").agg(F.count(F.lit(1)).alias("lines"))
    )


def attributed_claims(policy: attribution.AttributionPolicy) -> Plan:
    def plan(tables: ClaimTables, cohort: Cohort) -> DataFrame:
        daily = attribution.daily_sums(
            tables.outclaims, cohort, policy, ["prm_line"], {"lines": "1", "costs": "prm_costs"}
        )
        return (
            attribution.attribute(daily, cohort, policy)
            .groupBy("member_id", "elig_status", "claim_month", "covered_date", "prm_line")
            .agg(
                F.sum(F.col("lines") * F.col("copies")).alias("lines"),
                F.sum(F.col("costs") * F.col("copies")).cast("double").alias("costs"),
            )
        )

    return plan


register("claim_months", claim_months, oracle.claim_months_sql())
for policy_name, attribution_policy in POLICIES.items():
    register(
        f"attributed_claims_{policy_name}", attributed_claims(attribution_policy), oracle.attributed_sql(policy_name)
    )

# --- risk, cost and episode operators -------------------------------------------------------------


def average_risks(_: ClaimTables, cohort: Cohort) -> DataFrame:
    three, two = (risk.average_risk(cohort.covered_months, digits) for digits in (3, 2))
    return three.withColumnRenamed("risk_score_avg", "risk_3_digits").join(
        two.withColumnRenamed("risk_score_avg", "risk_2_digits"), "elig_status"
    )


def admits_by_benefit_type(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    summary = inpatient.admission_summary(tables, cohort, [])
    return risk.with_benefit_type(summary, tables.ref_link_hcg_researcher_line).select(
        "elig_status", "prm_line", "btnumber", "admits"
    )


def risk_adjusted_admits(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    return inpatient.risk_adjusted_admits(tables, cohort, admits_by_benefit_type(tables, cohort)).select(
        "elig_status", "prm_line", "btnumber", "admits", "adjusted"
    )


def truncated_member_costs(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    return basic.member_costs(tables, cohort).select(
        "member_id",
        "elig_status",
        F.col("costs").cast("double").alias("costs"),
        "memmos",
        F.expr(cost.truncated("costs", UNLISTED_THRESHOLD_BASIC)).alias("costs_truncated"),
    )


def claim_add_ons(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    return (
        truncation.claim_amounts(tables, cohort)
        .groupBy("date_flag", "elig_status")
        .agg(
            F.count(F.lit(1)).alias("sets"),
            *[F.expr(f"{from_ticks(f'sum({a})')} AS {a}") for a in truncation.ADD_ONS],
        )
    )


def member_runout_costs(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    keys = ["member_id", "elig_status", "date_flag", "memmos"]
    costs = truncation.member_costs(tables, cohort)
    return costs.selectExpr(*keys, *[f"{from_ticks(c)} AS {c}" for c in truncation.COST_COLUMNS])


def pac_index_lines(tables: ClaimTables, cohort: Cohort) -> DataFrame:
    return (
        pac.index_summary(tables, cohort)
        .groupBy("elig_status", "prm_drg", "died")
        .agg(F.sum("admits").alias("admits"), F.sum("lines").alias("lines"))
    )


register("average_risk", average_risks, oracle.AVERAGE_RISK_SQL)
register("admits_by_benefit_type", admits_by_benefit_type, oracle.BENEFIT_TYPES_SQL)
register("risk_adjusted_admits", risk_adjusted_admits, oracle.RISK_ADJUSTED_SQL)
register("truncated_member_costs", truncated_member_costs, oracle.TRUNCATED_MEMBERS_SQL)
register("claim_add_ons", claim_add_ons, oracle.CLAIM_ADD_ONS_SQL)
register("member_runout_costs", member_runout_costs, oracle.RUNOUT_MEMBERS_SQL)
register("episode_flags", lambda t, c: episodes.episode_flags(t.outclaims), oracle.EPISODE_FLAGS_SQL)
register(
    "hospital_deaths", lambda t, c: episodes.hospital_deaths(t.outclaims), "SELECT member_id FROM hospital_deaths"
)
register("pac_index_lines", pac_index_lines, oracle.INDEX_SUMMARY_SQL)
register(
    "snf_readmit_cases", lambda t, c: episodes.snf_readmit_cases(t.outclaims, c), oracle.READMIT_CASES_SQL
)

# --- measures -----------------------------------------------------------------------------------


def only(frame: DataFrame, *metric_ids: str) -> DataFrame:
    return frame.where(F.col("metric_id").isin(*metric_ids))


def snf_part(measures: list) -> Plan:
    return lambda t, c: snf.snf_metrics(t, c, measures=measures, adjusted=False)


def er_part(measures: list) -> Plan:
    return lambda t, c: er.er_metrics(t, c, measures=measures, adjusted=False)


def inpatient_counts(measures: list) -> Plan:
    return lambda t, c: inpatient.inpatient_metrics(t, c, counts=measures)


def inpatient_adjusted(measures: list) -> Plan:
    return lambda t, c: inpatient.inpatient_metrics(t, c, adjusted=measures)


MEASURE_PLANS: dict[str, Plan] = {
    "assigned_members": lambda t, c: only(basic.assigned_members(c), "cnt_assigned_mems"),
    "assigned_members_non_esrd": lambda t, c: only(basic.assigned_members(c), "cnt_assigned_mems_nonesrd"),
    "member_months_total": lambda t, c: only(basic.membership(c), "memmos_sum"),
    "risk_score_mean": lambda t, c: only(basic.membership(c), "riskscr_1_avg"),
    "cost_total": lambda t, c: only(basic.costs(t, c), "prm_costs_sum_all_services"),
    "cost_truncated": lambda t, c: only(basic.costs(t, c), "prm_costs_truncated"),
    "age_total": basic.member_age,
    "wellness_visits_numer": lambda t, c: only(basic.wellness_visits(t, c), "cnt_wellness_visits_numer"),
    "wellness_visits_denom": lambda t, c: only(basic.wellness_visits(t, c), "cnt_wellness_visits_denom"),
    "pqi_admits": inpatient_counts(inpatient.PQI[:1]),
    "pqi_admits_by_indicator": inpatient_counts(inpatient.PQI[1:]),
    "psp_admits": inpatient_counts(inpatient.PSP_ADMITS[:1]),
    "psp_admits_by_category": inpatient_counts(inpatient.PSP_ADMITS[1:]),
    "one_day_stays": inpatient_counts(inpatient.ONE_DAY),
    "one_day_medical_stays": inpatient_counts(inpatient.ONE_DAY_MEDICAL),
    "acute_admits": inpatient_adjusted(inpatient.ACUTE),
    "medical_admits": inpatient_adjusted(inpatient.MEDICAL),
    "surgical_admits": inpatient_adjusted(inpatient.SURGICAL),
    "readmissions": inpatient_counts(inpatient.READMITS),
    "discharges_to_snf": inpatient_counts(inpatient.SNF_DISCHARGE),
    "imaging_and_visits": lambda t, c: outpatient.outpatient_metrics(t, c, adjusted=outpatient.IMAGING_AND_VISITS),
    "office_visits": lambda t, c: outpatient.outpatient_metrics(t, c, adjusted=outpatient.OFFICE_VISITS),
    "psp_procedures": lambda t, c: outpatient.outpatient_metrics(t, c, counts=outpatient.PSP_PROCEDURES),
    "snf_admits": snf_part(snf.ADMITS),
    "snf_admits_adjusted": lambda t, c: only(snf.snf_metrics(t, c, measures=snf.ADMITS), snf.ADJUSTED_ID),
    "snf_long_stays": snf_part(snf.LONG_STAYS),
    "snf_all_cause_readmissions": snf_part(snf.ALL_CAUSE_READMITS),
    "snf_facilities": snf_part(snf.FACILITIES),
    "snf_flagged_readmissions": snf_part(snf.FLAGGED_READMITS),
    "er_visits": er_part(er.VISITS),
    "er_visits_adjusted": lambda t, c: only(er.er_metrics(t, c, measures=er.VISITS), er.ADJUSTED_ID),
    "er_visit_classes": er_part(er.CLASSIFIED),
    "pac_episodes": lambda t, c: pac.pac_metrics(t, c, pac.EPISODES),
    "pac_hospital_deaths": lambda t, c: pac.pac_metrics(t, c, pac.DEATHS),
    "pac_post_acute_use": lambda t, c: pac.pac_metrics(t, c, pac.POST_ACUTE_USE),
    "pac_followup_visits": lambda t, c: pac.pac_metrics(t, c, pac.FOLLOWUPS),
    "prefix_totals": lambda t, c: lines.line_metrics(t, c, lines.PREFIX_MEASURES),
    "line_totals": lambda t, c: lines.line_metrics(t, c, lines.LINE_MEASURES),
    "decedents": lambda t, c: eol.eol_metrics(t, c, eol.DECEDENTS),
    "cancer_decedents": lambda t, c: eol.eol_metrics(t, c, eol.CANCER),
    "final_month_cost": lambda t, c: eol.eol_metrics(t, c, eol.FINAL_COST),
    "hospital_decedents": lambda t, c: eol.eol_metrics(t, c, eol.HOSPITAL_DEATHS),
    "hospice_use": lambda t, c: eol.eol_metrics(t, c, eol.HOSPICE),
}
EXPECTED_MEASURES = {name: sql for family in oracle.FAMILIES.values() for name, sql in family.items()}
for measure_name, measure_plan in MEASURE_PLANS.items():
    register(measure_name, measure_plan, EXPECTED_MEASURES[measure_name])

FAMILY_PLANS: dict[str, Plan] = {
    "basic": basic.basic_metrics,
    "inpatient": inpatient.inpatient_metrics,
    "outpatient": outpatient.outpatient_metrics,
    "snf": snf.snf_metrics,
    "er": er.er_metrics,
    "pac": pac.pac_metrics,
    "lines": lines.line_metrics,
    "eol": eol.eol_metrics,
}
for family_name, family_plan in FAMILY_PLANS.items():
    register(f"{family_name}_metrics", family_plan, oracle.family(family_name))
register("snf_metrics_consolidated", lambda t, c: snf.snf_metrics(t, c, True), oracle.consolidated_sql("snf"))
register("er_metrics_consolidated", lambda t, c: er.er_metrics(t, c, True), oracle.consolidated_sql("er"))
# End-of-life measures follow a cohort that is narrowed to the year to date.
register("eol_metrics_year_to_date", eol.eol_metrics, oracle.family("eol"), YTD, **YTD_CTES)

# --- summaries and reports ----------------------------------------------------------------------

register("pac_drg_summary", pac.pac_drg_summary, oracle.PAC_DRG_SQL)
register("betos_summary", betos.betos_summary, oracle.BETOS_SQL)
register("truncation_summary", truncation.truncation_summary, oracle.TRUNCATION_SQL)
register(
    "non_esrd_line_rollup",
    lambda t, c: rollup.non_esrd_rollup(lines.line_metrics(t, c)),
    oracle.rollup_sql(f"({oracle.family('lines')})"),
)


def labelled(plan: Plan) -> Plan:
    return lambda t, c: rollup.labelled(plan(t, c), CLIENT, c.report_period.label)


register("pac_drg_report", labelled(pac.pac_drg_summary), oracle.labelled_sql(oracle.PAC_DRG_SQL, CLIENT, LABEL))
register("betos_report", labelled(betos.betos_summary), oracle.labelled_sql(oracle.BETOS_SQL, CLIENT, LABEL))
register(
    "truncation_report",
    labelled(truncation.truncation_summary),
    oracle.labelled_sql(oracle.TRUNCATION_SQL, CLIENT, LABEL),
)


def run_folder(spark: SparkSession) -> str:
    """The session's shared folder; where a local session names none, a temporary one."""
    if spark.conf.get(CHECKPOINT_DIR, None) or not spark.sparkContext.master.startswith("local["):
        return staging_folder(spark)
    folder = tempfile.mkdtemp(prefix="cohortlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def report_metrics(config: ReportConfig) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: report.build_report(domain_tables(spark, sf_dir), config, run_folder(spark)).metrics


def from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line measures over tables that were written as files and are read back by the library's reader."""
    folder = run_folder(spark)
    for name, frame in vars(domain_tables(spark, sf_dir)).items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    tables = read_claim_tables(spark, folder, reference_folder=folder)
    return lines.line_metrics(tables, build_cohort(tables, CURRENT))


def from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line measures over claims that were bucketed by member, into as many buckets as shuffles have partitions: a task
    sorts a whole bucket, so their number has to follow the size of the claims as that of the partitions does."""
    folder, prefix = run_folder(spark), f"store_{uuid.uuid4().hex}_"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    save_claim_store(domain_tables(spark, sf_dir), folder, prefix, buckets=buckets)
    tables = read_claim_store(spark, folder, prefix)
    return lines.line_metrics(tables, build_cohort(tables, CURRENT))


REGISTRY["lines_metrics_from_files"] = Query(from_files, oracle.full(oracle.family("lines")))
REGISTRY["lines_metrics_from_store"] = Query(from_store, oracle.full(oracle.family("lines")))
REGISTRY["metrics_report"] = Query(report_metrics(CURRENT), oracle.full(oracle.report_sql(CLIENT, LABEL)))
REGISTRY["metrics_report_additive"] = Query(
    report_metrics(replace(CURRENT, additive_rollup_only=True)),
    oracle.full(oracle.report_sql(CLIENT, LABEL, oracle.ADDITIVE)),
)
for mode in (Assignment.JULY_FIRST, Assignment.DURING_PERIOD):
    REGISTRY[f"metrics_report_{mode.value}"] = Query(
        report_metrics(replace(CURRENT, assignment=mode)),
        oracle.full(oracle.report_sql(CLIENT, LABEL), member_months=oracle.member_months_sql(mode.value)),
    )

SCENARIOS = {
    "year_to_date": ReportConfig(CLIENT, 6, year_to_date=True, assignment=Assignment.CURRENT),
    "rolling": ReportConfig(CLIENT, 6, assignment=Assignment.CURRENT),
}
_SCENARIO_CTES = {"year_to_date": YTD_CTES, "rolling": {"period": oracle.period_sql(6)}}
REGISTRY["scenario_reports"] = Query(
    lambda spark, sf_dir: report.run_scenarios(domain_tables(spark, sf_dir), SCENARIOS, run_folder(spark)).metrics,
    oracle.union(
        *[
            f"SELECT '{name}' AS scenario, r.* FROM "
            f"({oracle.full(oracle.report_sql(CLIENT, '1998Q4_1999Q3'), **_SCENARIO_CTES[name])}) r"
            for name in SCENARIOS
        ]
    ),
)
