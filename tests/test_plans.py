"""What the physical plans look like."""

import re

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import domain_tables
from checks.registry import CURRENT, REGISTRY, SCENARIOS
from cohortlens import build_cohort, read_claim_tables
from cohortlens.operators.cohort import join_cohorts
from cohortlens.operators.key_filter import key_filter, may_hold
from cohortlens.plans import basic, betos, er, inpatient, lines, outpatient, pac, report, snf, truncation
from cohortlens.sources.sinks import save_table
from cohortlens.sources.staging import stage, stage_together
from cohortlens.sources.store import read_claim_store, save_claim_store
from helpers import cohort_of, metric_list

SF_DIR = "/root/testdata/sf0.001"
# Scans of the claims a plan may make.
SCANS = {
    "basic_metrics": 2,
    "inpatient_metrics": 1,
    "outpatient_metrics": 1,
    "snf_metrics": 1,
    "er_metrics": 1,
    "pac_metrics": 3,
    "lines_metrics": 1,
    "eol_metrics": 1,
    "betos_summary": 1,
    "truncation_summary": 1,
}


@pytest.fixture(scope="module", autouse=True)
def whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def final_plan(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", SCANS)
def test_families_share_their_scans_and_stay_in_the_jvm(spark, name):
    plan = final_plan(REGISTRY[name].run(spark, SF_DIR))
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan)) == SCANS[name]
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "rank(", "row_number("):
        assert unwanted not in plan
    # the one window there is runs over the days on which a member's coverage changes
    assert all("member_id" in line and "change" in line for line in plan.splitlines() if "Window " in line)


def scans(frame) -> int:
    return len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", final_plan(frame)))


def test_families_of_a_report_share_one_scan_and_one_calendar_join(spark):
    tables = domain_tables(spark, SF_DIR)
    shared = report.claim_parts(tables, cohort_of(tables, CURRENT))["lines"]
    assert scans(shared) == 1
    by_day = [line for line in final_plan(shared).splitlines() if "Join [" in line and "covered_date" in line]
    assert len(by_day) == 1


def test_scenarios_scan_the_claims_no_more_often_than_one_report(spark):
    tables = domain_tables(spark, SF_DIR)
    cohorts = [build_cohort(tables, config) for config in SCENARIOS.values()]
    alone, joint = report.claim_parts(tables, cohorts[0]), report.claim_parts(tables, join_cohorts(cohorts))
    assert {name: scans(part) for name, part in joint.items()} == {name: scans(part) for name, part in alone.items()}
    assert sum(scans(part) for part in alone.values()) == 7
    for plan in (truncation.truncation_summary, betos.betos_summary):
        assert scans(plan(tables, join_cohorts(cohorts))) == scans(plan(tables, cohorts[0])) == 1


def test_families_read_only_what_is_staged(spark, tmp_path):
    tables = domain_tables(spark, SF_DIR)
    cohort = cohort_of(tables, CURRENT)
    cohort = cohort.with_member_months(stage(cohort.member_months, str(tmp_path), "member_months"))
    parts = stage_together(report.claim_parts(tables, cohort), str(tmp_path), "claim_parts")
    for name, family in report.metric_families(tables, cohort, CURRENT, parts).items():
        assert scans(family) == 0, name


def test_lines_are_added_up_before_their_date_bases_are_told_apart(spark):
    tables = domain_tables(spark, SF_DIR)
    plan = final_plan(truncation.claim_amounts(tables, cohort_of(tables, CURRENT)))
    first_sum = plan[: plan.rindex("FileScan parquet [l_orderkey")].rindex("partial_sum(costs")
    assert "Generate inline(filter(array(" in plan[:first_sum] and "Generate inline(filter(array(" not in plan[first_sum:]


def test_flags_are_summed_for_episodes_with_index_lines_only(spark):
    tables = domain_tables(spark, SF_DIR)
    cohort = cohort_of(tables, CURRENT)
    episodes = pac.index_episodes(tables, cohort)
    all_lines = tables.outclaims.where("pac_index_yn = 'N' AND pac_caseadmitid IS NOT NULL")
    passed = may_hold(all_lines, "pac_caseadmitid", key_filter(episodes, "pac_caseadmitid"))
    wanted = episodes.select("pac_caseadmitid").distinct()
    needed = all_lines.join(wanted, "pac_caseadmitid", "left_semi").count()
    assert needed <= passed.count() <= needed + 5 < all_lines.count() / 3
    few = may_hold(all_lines, "pac_caseadmitid", key_filter(episodes.limit(3), "pac_caseadmitid"))
    assert few.count() < needed / 2


@pytest.mark.parametrize("name", ["basic_metrics", "pac_metrics", "attributed_claims_by_stay_month"])
def test_no_join_tests_days_with_the_member_as_its_only_key(spark, name):
    plan = REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    by_day = [line for line in plan.splitlines() if "Join [" in line and "covered_date" in line.split("], ", 2)[2]]
    assert by_day
    assert not [line for line in by_day if re.search(r"Join \[[^,\]]+\],", line)]


MEMBER_JOINS = [
    "member_months_current", "line_totals", "cost_total", "er_visits", "inpatient_metrics", "betos_summary",
    "truncation_summary", "wellness_visits_numer", "age_total", "decedents", "pac_episodes",
]


def broadcast_keys(frame) -> list[str]:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Broadcast(?:HashJoin \[([a-z_]+)|NestedLoopJoin)", plan)


@pytest.mark.parametrize("name", MEMBER_JOINS)
def test_members_months_and_parts_are_not_broadcast_on_an_estimate(spark, name):
    """Estimates are of compressed files and do not count what an explode adds; here every one is below the threshold."""
    keys = broadcast_keys(REGISTRY[name].run(spark, SF_DIR))
    assert not {"", "member_id", "_member", "case_member", "l_partkey"} & set(keys)


@pytest.mark.parametrize("name", ["line_totals", "er_visits", "truncation_summary", "pac_episodes"])
def test_orders_are_not_broadcast_on_an_estimate(spark, name):
    """Their keys are three tenths of the estimate of their file, which is compressed."""
    assert "l_orderkey" not in broadcast_keys(REGISTRY[name].run(spark, SF_DIR))


@pytest.mark.parametrize(
    "name", [*(f"attributed_claims_{policy}" for policy in registry.POLICIES), "discharges_to_snf", "imaging_and_visits"]
)
def test_what_lines_are_attributed_to_is_not_broadcast_on_an_estimate(spark, name):
    """Each way of dating a line has joins of its own with members, months and spans."""
    keys = broadcast_keys(REGISTRY[name].run(spark, SF_DIR))
    assert not {"", "member_id", "_member", "l_partkey", "l_orderkey"} & set(keys)


def test_staged_months_are_not_broadcast_on_an_estimate(spark, tmp_path):
    tables = domain_tables(spark, SF_DIR)
    cohort = cohort_of(tables, CURRENT)
    cohort = cohort.with_member_months(stage(cohort.member_months, str(tmp_path), "member_months"))
    for frame in (cohort.calendar, basic.costs(tables, cohort), basic.member_age(tables, cohort)):
        assert "member_id" not in broadcast_keys(frame)


@pytest.mark.parametrize("name", ["member_month_coverage", "coverage_windows", "member_months_current", "coverage_spans"])
def test_windows_are_dealt_out_before_they_are_added_up(spark, name):
    """There is little to add up in the task that reads them, which would hold all its groups at once."""
    plan = REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for scan in re.finditer(r"FileScan parquet \[c_custkey", plan):
        below = plan[plan[: scan.start()].rindex("Exchange hashpartitioning(member_id") : scan.start()]
        assert "Aggregate" not in below and "Sort " not in below


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    derived = domain_tables(spark, SF_DIR)
    for name, frame in vars(derived).items():
        frame.write.parquet(f"{path}/{name}.parquet")
    return read_claim_tables(spark, path)


@pytest.mark.parametrize(
    ("plan", "filters"),
    [
        (inpatient.inpatient_metrics, ["StringStartsWith(prm_line,I)", "GreaterThanOrEqual(prm_fromdate,1999-01-01)"]),
        (outpatient.outpatient_metrics, ["StringStartsWith(prm_line,O14)", "LessThanOrEqual(prm_fromdate,1999-12-31)"]),
        (snf.snf_metrics, ["StringStartsWith(prm_line,I31)", "GreaterThanOrEqual(prm_fromdate_case,1999-01-01)"]),
        (er.er_metrics, ["StringStartsWith(prm_line,O11)", "GreaterThanOrEqual(prm_fromdate,1999-01-01)"]),
        (pac.pac_metrics, ["EqualTo(pac_index_yn,Y)", "EqualTo(pac_index_yn,N)"]),
        (truncation.truncation_summary, ["Or(And(GreaterThanOrEqual(prm_fromdate,1999-01-01)"]),
        (basic.wellness_visits, ["In(hcpcs, [G0402,G0438,G0439,G0468])", "LessThanOrEqual(prm_fromdate,1999-12-31)"]),
        (lines.line_metrics, ["And(EqualTo(prm_line,I31),And(GreaterThanOrEqual(prm_fromdate_case,1999-01-01)"]),
    ],
)
def test_filters_reach_the_claims_scan(spark, tables, plan, filters):
    text = plan(tables, cohort_of(tables))._jdf.queryExecution().executedPlan().toString()
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text))
    assert all(f in pushed for f in filters)


def test_scans_read_only_the_columns_they_need(spark, tables):
    text = lines.line_metrics(tables, cohort_of(tables))._jdf.queryExecution().executedPlan().toString()
    (schema,) = [s for s in re.findall(r"ReadSchema: struct<(.*?)>", text) if "prm_costs" in s]
    assert {c.split(":")[0] for c in schema.split(",")} >= {"member_id", "prm_line", "prm_costs"}
    assert schema.count(":") == 7


def test_bucketed_claims_meet_the_calendar_where_they_lie(spark, tmp_path):
    derived = domain_tables(spark, SF_DIR)
    save_claim_store(derived, str(tmp_path), "plan_test_", buckets=16)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = read_claim_store(spark, str(tmp_path), "plan_test_")
        for plan, joins in ((lines.line_metrics, 1), (basic.costs, 2)):
            frame = plan(tables, cohort_of(tables, CURRENT))
            text = frame._jdf.queryExecution().executedPlan().toString()
            before = text[: text.index("FileScan parquet spark_catalog.default.plan_test_outclaims")].splitlines()
            # up from the scan: the sums per day, and the joins to months and spans of days, without an exchange
            up, depth = [], float("inf")
            for line in reversed(before):
                at = len(line) - len(line.lstrip(" :+-*"))
                if at < depth:
                    up.append(line.strip(" :+-*"))
                    depth = at
            first_exchange = next(i for i, line in enumerate(up) if line.startswith("Exchange"))
            assert sum("SortMergeJoin" in line for line in up[:first_exchange]) == joins
        assert metric_list(frame) == metric_list(basic.costs(derived, cohort_of(derived, CURRENT)))
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE plan_test_outclaims")


def test_buckets_of_the_registered_store_follow_the_shuffle_partitions(spark, monkeypatch):
    asked = []

    def save(tables, folder, prefix, buckets):
        asked.append(buckets)
        raise InterruptedError

    monkeypatch.setattr(registry, "save_claim_store", save)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        with pytest.raises(InterruptedError):
            REGISTRY["lines_metrics_from_store"].run(spark, SF_DIR)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert asked == [5]


def test_writing_few_files_leaves_the_stage_before_it_its_tasks(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 16).select((F.col("id") % 7).alias("k"), "id")
    save_table(rows, f"{tmp_path}/few", max_files=3)
    assert 1 <= len(list((tmp_path / "few").glob("part-*"))) <= 3 and spark.read.parquet(f"{tmp_path}/few").count() == 1000
    plan = rows.hint("rebalance", 3)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_NONE" in plan and "Coalesce" not in plan


def test_members_are_counted_with_one_exchange_by_member(spark, tmp_path):
    tables = domain_tables(spark, SF_DIR)
    cohort = cohort_of(tables, CURRENT)
    cohort = cohort.with_member_months(stage(cohort.member_months, str(tmp_path), "member_months"))
    plan = basic.assigned_members(cohort)._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), 8\)", re.sub(r"#\d+L?", "", plan))
    assert exchanges == ["elig_status", "statuses", "member_id"]  # the first two are of one row for each set of statuses
