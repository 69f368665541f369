import csv
import glob
import os
from dataclasses import fields, replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.fixtures import domain_tables
from cohortlens import Assignment, ClaimTables, ReportConfig, build_report, read_claim_tables, run_scenarios, write_report
from cohortlens.plans.er import er_metrics
from cohortlens.plans.snf import snf_metrics
from cohortlens.sources.sinks import export_text
from cohortlens.sources.staging import staging_folder
from cohortlens.sources.tables import read_table
from helpers import cohort_of, metric_list

SF_DIR = "/root/testdata/sf0.001"
CONFIG = ReportConfig(client="Some Client", assignment=Assignment.CURRENT)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The domain tables as parquet files."""
    path = str(tmp_path_factory.mktemp("tables"))
    tables = domain_tables(spark, SF_DIR)
    for field in fields(ClaimTables):
        getattr(tables, field.name).write.parquet(f"{path}/{field.name}.parquet")
    return path


@pytest.fixture(scope="module")
def written(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("report"))
    return path, write_report(read_claim_tables(spark, folder), CONFIG, path)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_files_read_back_as_the_derived_tables(spark, folder):
    derived, read = domain_tables(spark, SF_DIR), read_claim_tables(spark, folder, reference_folder=folder)
    for field in fields(ClaimTables):
        before, after = getattr(derived, field.name), getattr(read, field.name)
        assert dict(after.dtypes) == dict(before.dtypes)
        assert after.count() == before.count()


def test_money_in_doubles_is_read_as_decimals_and_missing_columns_are_named(spark, folder, tmp_path):
    claims = spark.read.parquet(f"{folder}/outclaims.parquet")
    claims.withColumn("prm_costs", F.col("prm_costs").cast("double")).write.parquet(f"{tmp_path}/outclaims.parquet")
    assert dict(read_table(spark, str(tmp_path), "outclaims").dtypes)["prm_costs"] == "decimal(18,4)"
    spark.read.parquet(f"{folder}/members.parquet").drop("dob").write.parquet(f"{tmp_path}/members.parquet")
    with pytest.raises(ValueError, match="members lacks the columns dob"):
        read_table(spark, str(tmp_path), "members")


def test_text_files_hold_the_report(spark, written):
    path, report = written
    for name, frame in {
        "metrics": report.metrics,
        "pac_drg_summary": report.pac_drg_summary,
        "betos_summary": report.betos,
        "truncation_summary": report.truncation,
    }.items():
        (part,) = glob.glob(f"{path}/{name}.txt/part-*")
        with open(part, newline="") as lines:
            header, *rows = csv.reader(lines, delimiter="|")
        assert header == frame.columns
        assert len(rows) == frame.count() > 0
        assert {row[0] for row in rows} == {"Some Client"}
        assert {row[1] for row in rows} == {"1999Q1_1999Q4"}


def test_blank_columns_are_written_as_nothing(written):
    path, _ = written
    (part,) = glob.glob(f"{path}/metrics.txt/part-*")
    with open(part) as lines:
        next(lines)
        assert all(line.split("|")[3] == line.split("|")[5] == "" for line in lines)


def test_family_files_make_up_the_metrics(spark, written):
    path, report = written
    families = [
        spark.read.parquet(f"{path}/{name}.parquet")
        for name in (
            "basic_metrics", "inpatient_metrics", "outpatient_metrics", "snf_metrics", "er_metrics", "pac_metrics",
            "mr_line_metrics", "eol_metrics",
        )
    ]
    stacked = families[0]
    for family in families[1:]:
        stacked = stacked.unionByName(family)
    eol_rolled = families[-1].where("elig_status = 'Non-ESRD'")
    plain = report.metrics.where("elig_status <> 'Non-ESRD'").select("elig_status", "metric_id", "metric_value")
    assert rows_of(plain) == rows_of(stacked.where("elig_status <> 'Non-ESRD'"))
    rolled = report.metrics.where("elig_status = 'Non-ESRD'").select("elig_status", "metric_id", "metric_value")
    assert set(rows_of(eol_rolled)) <= set(rows_of(rolled))


def test_the_clean_rollup_leaves_out_what_does_not_add_up(spark, folder, tmp_path):
    config = ReportConfig(assignment=Assignment.CURRENT, additive_rollup_only=True, consolidate_usage=True)
    metrics = build_report(read_claim_tables(spark, folder), config, str(tmp_path)).metrics
    rolled = {r["metric_id"] for r in metrics.where("elig_status = 'Non-ESRD'").collect()}
    assert "memmos_sum" in rolled
    assert not rolled & {"riskscr_1_avg", "distinct_SNFs", "cnt_assigned_mems"}


def test_consolidated_usage_is_the_sum_over_benefit_types(spark):
    tables = domain_tables(spark, SF_DIR)
    cohort = cohort_of(tables)
    for plan, ids in ((snf_metrics, ("SNF", "SNF_rskadj")), (er_metrics, ("ED", "ED_rskadj"))):
        apart, together = metric_list(plan(tables, cohort)), metric_list(plan(tables, cohort, consolidate=True))
        sums = {}
        for status, metric, value in apart:
            sums[status, metric] = sums.get((status, metric), 0.0) + value
        assert len({(s, m) for s, m, _ in together}) == len(together)
        for status, metric, value in together:
            if metric in ids:
                assert abs(value - sums[status, metric]) < 1e-6


def session_like(master: str, checkpoint_dir: str | None):
    conf = SimpleNamespace(get=lambda key, default=None: checkpoint_dir or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_staging_needs_a_shared_folder():
    assert staging_folder(session_like("yarn", "/shared/x/")).startswith("/shared/x/cohortlens-")
    for master in ("yarn", "local[8]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging_folder(session_like(master, None))


def test_a_written_report_leaves_its_tables_and_nothing_else(written):
    path, _ = written
    parts = ("metrics", "pac_drg_summary", "betos_summary", "truncation_summary")
    families = ("basic", "inpatient", "outpatient", "snf", "er", "pac", "mr_line", "eol")
    expected = {f"{p}{kind}" for p in parts for kind in (".parquet", ".txt")} | {f"{f}_metrics.parquet" for f in families}
    assert set(os.listdir(path)) == expected | {"member_months.parquet"}


@pytest.mark.parametrize(("column", "value"), [("prm_util", 1.5), ("prm_costs", 1.23456), ("prm_admits", 3e10)])
def test_numbers_that_a_type_would_change_are_errors(spark, folder, tmp_path, column, value):
    claims = spark.read.parquet(f"{folder}/outclaims.parquet").withColumn(column, F.lit(value))
    claims.limit(5).write.parquet(f"{tmp_path}/outclaims.parquet")
    with pytest.raises(Exception, match=f"outclaims.{column} holds"):
        read_table(spark, str(tmp_path), "outclaims").select(column).collect()


def test_whole_numbers_in_doubles_are_read_as_they_are(spark, folder, tmp_path):
    claims = spark.read.parquet(f"{folder}/outclaims.parquet")
    claims.withColumn("prm_util", F.col("prm_util").cast("double")).write.parquet(f"{tmp_path}/outclaims.parquet")
    assert rows_of(read_table(spark, str(tmp_path), "outclaims").select("prm_util")) == rows_of(claims.select("prm_util"))


def test_scenarios_have_the_rows_of_their_own_reports(spark, folder, tmp_path):
    tables = read_claim_tables(spark, folder)
    scenarios = {
        "now": ReportConfig(client="One", assignment=Assignment.CURRENT),
        "ytd": ReportConfig(client="Two", assignment=Assignment.DURING_PERIOD, year_to_date=True),
        "same": ReportConfig(client="One", assignment=Assignment.CURRENT),
        "other period": ReportConfig(runout_months=6, year_to_date=True),
        "clean": ReportConfig(client="Three", additive_rollup_only=True, consolidate_usage=True),
    }
    joint = run_scenarios(tables, scenarios, f"{tmp_path}/joint")
    for number, (name, config) in enumerate(scenarios.items()):
        alone = build_report(tables, config, f"{tmp_path}/{number}")
        for part in ("metrics", "pac_drg_summary", "betos", "truncation"):
            whole = getattr(joint, part)
            assert whole.columns[0] == "scenario"
            mine = whole.where(F.col("scenario") == name).drop("scenario")
            assert mine.columns == getattr(alone, part).columns
            assert rows_of(mine) == rows_of(getattr(alone, part)), (name, part)


def test_a_scenario_without_members_has_its_totals(spark, folder, tmp_path):
    tables = read_claim_tables(spark, folder)
    nobody = replace(tables, members=tables.members.withColumn("mem_report_hier_2", F.lit("N")))
    scenarios = {
        "some": ReportConfig(assignment=Assignment.CURRENT), "none": ReportConfig(assignment=Assignment.JULY_FIRST)
    }
    joint = run_scenarios(nobody, scenarios, f"{tmp_path}/joint").metrics
    alone = build_report(nobody, scenarios["none"], f"{tmp_path}/alone").metrics
    assert rows_of(joint.where("scenario = 'none'").drop("scenario")) == rows_of(alone)
    assert alone.count() == 2


@pytest.mark.parametrize("parts", [1, 5])
def test_text_of_many_tasks_is_one_file_in_order(spark, tmp_path, parts):
    rows = spark.range(0, 500, 1, parts).select("id", F.expr("if(id % 9 = 0, 'a|b \"c\"', '')").alias("odd|name"))
    export_text(rows, f"{tmp_path}/one.txt")
    assert [name for name in os.listdir(f"{tmp_path}/one.txt") if name.startswith("part-")] == ["part-00000.csv"]
    with open(f"{tmp_path}/one.txt/part-00000.csv", newline="") as lines:
        header, *found = csv.reader(lines, delimiter="|", escapechar="\\")
    assert header == ["id", "odd|name"] and found == [[str(i), 'a|b "c"' if i % 9 == 0 else ""] for i in range(500)]
    export_text(rows.limit(0), f"{tmp_path}/none.txt", header=False)
    assert open(f"{tmp_path}/none.txt/part-00000.csv").read() == ""
    export_text(rows, f"{tmp_path}/many.txt", single_file=False)
    assert len([name for name in os.listdir(f"{tmp_path}/many.txt") if name.startswith("part-")]) == parts
