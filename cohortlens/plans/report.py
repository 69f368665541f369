"""The whole report: every metric on one labelled frame, the three summaries, their files, and scenario runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import ReportConfig
from cohortlens.operators.cohort import Coverage, build_cohort, join_cohorts
from cohortlens.operators.measures import evaluate, stack
from cohortlens.operators.rollup import label_metrics, labelled, non_esrd_rollup
from cohortlens.operators.shared_scan import LineFamily, family_sums, shared_sums
from cohortlens.plans import basic, eol, er, inpatient, lines, outpatient, pac, snf
from cohortlens.plans.betos import betos_summary
from cohortlens.plans.truncation import truncation_summary
from cohortlens.sources.sinks import export_text, save_table
from cohortlens.sources.staging import remove, stage, stage_together, staging_folder
from cohortlens.sources.tables import ClaimTables

# Metrics whose sum over statuses is not their value for the statuses together.
NON_ADDITIVE = ("riskscr_1_avg", "distinct_SNFs", "cnt_assigned_mems")


FAMILY_NAMES = (
    "basic_metrics",
    "inpatient_metrics",
    "outpatient_metrics",
    "snf_metrics",
    "er_metrics",
    "pac_metrics",
    "mr_line_metrics",
    "eol_metrics",
)
# File names of the report's parts.
PART_FILES = {
    "metrics": "metrics",
    "pac_drg_summary": "pac_drg_summary",
    "betos": "betos_summary",
    "truncation": "truncation_summary",
}


@dataclass(frozen=True)
class Report:
    """The four result frames, labelled with client and period."""

    metrics: DataFrame
    pac_drg_summary: DataFrame
    betos: DataFrame
    truncation: DataFrame


# The families that date a line's month and coverage alike, and so share one scan of the claims.
LINE_FAMILIES = (inpatient.FAMILY, outpatient.FAMILY, snf.FAMILY, er.FAMILY, lines.FAMILY)


def claim_parts(tables: ClaimTables, cohort: Coverage) -> dict[str, DataFrame]:
    """What the metric families read of the claims, summed; of all scenarios, where the cohort has several."""
    return {
        "lines": shared_sums(tables.outclaims, cohort, LINE_FAMILIES),
        "claim_costs": basic.member_claim_costs(tables, cohort),
        "visits": basic.wellness_months(tables, cohort),
        "pac_index": pac.index_summary(tables, cohort),
        "care": eol.final_care(tables, cohort),
    }


def metric_families(
    tables: ClaimTables, cohort: Coverage, config: ReportConfig, parts: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The long metric frames by family; end-of-life brings its own Non-ESRD rows."""

    def summary(family: LineFamily) -> DataFrame:
        return family_sums(parts["lines"], LINE_FAMILIES, family)

    consolidate = config.consolidate_usage
    return {
        "basic_metrics": basic.basic_metrics(tables, cohort, parts["claim_costs"], parts["visits"]),
        "inpatient_metrics": inpatient.inpatient_metrics(tables, cohort, summary=summary(inpatient.FAMILY)),
        "outpatient_metrics": outpatient.outpatient_metrics(tables, cohort, summary=summary(outpatient.FAMILY)),
        "snf_metrics": snf.snf_metrics(tables, cohort, consolidate, summary=summary(snf.FAMILY)),
        "er_metrics": er.er_metrics(tables, cohort, consolidate, visits=summary(er.FAMILY)),
        "pac_metrics": evaluate(parts["pac_index"], pac.MEASURES),
        "mr_line_metrics": lines.line_metrics(tables, cohort, summary=summary(lines.FAMILY)),
        "eol_metrics": eol.eol_metrics(tables, cohort, care=parts["care"]),
    }


def staged_families(
    tables: ClaimTables, cohort: Coverage, config: ReportConfig, parts: dict[str, DataFrame], folder: str
) -> DataFrame:
    """All families in one frame with a ``family`` column, computed by one job."""
    families = metric_families(tables, cohort, config, parts)
    named = [stack([frame]).select(F.lit(name).alias("family"), "*") for name, frame in families.items()]
    return stage(reduce(DataFrame.unionByName, named), folder, "family_metrics")


def stacked_metrics(families: DataFrame, config: ReportConfig) -> DataFrame:
    """All families, with the Non-ESRD roll-up of every one but end-of-life."""
    rolled = families.where(F.col("family") != "eol_metrics")
    left_out = NON_ADDITIVE if config.additive_rollup_only else ()
    return stack([families, non_esrd_rollup(rolled, left_out)])


def report_of(
    tables: ClaimTables, cohort: Coverage, config: ReportConfig, client: str | Column, folder: str
) -> Report:
    """The report of a cohort, or of all scenarios of a joint one, told apart by their numbers."""
    parts = stage_together(claim_parts(tables, cohort), folder, "claim_parts")
    families = staged_families(tables, cohort, config, parts, folder)
    label = cohort.report_period.label
    return Report(
        metrics=label_metrics(stacked_metrics(families, config), client, label),
        pac_drg_summary=labelled(pac.drg_counts(parts["pac_index"]), client, label),
        betos=labelled(betos_summary(tables, cohort), client, label),
        truncation=labelled(truncation_summary(tables, cohort), client, label),
    )


def build_report(tables: ClaimTables, config: ReportConfig, folder: str | None = None) -> Report:
    """Compute the report. What its parts share is staged in ``folder``, or else below the checkpoint folder.

    The frames read what is staged, so the folder has to stay until they have been used; ``write_report`` removes
    its own.
    """
    folder = folder or staging_folder(tables.outclaims.sparkSession)
    cohort = build_cohort(tables, config)
    cohort = cohort.with_member_months(stage(cohort.member_months, folder, "member_months"))
    return report_of(tables, cohort, config, config.client, folder)


def write_report(tables: ClaimTables, config: ReportConfig, path: str) -> Report:
    """Write the report's tables as parquet and its four parts as delimited text, and read the tables back."""
    spark, scratch = tables.outclaims.sparkSession, f"{path}/_staged"
    computed = build_report(tables, config, scratch)
    save_table(spark.read.parquet(f"{scratch}/member_months.parquet"), f"{path}/member_months.parquet")
    families = spark.read.parquet(f"{scratch}/family_metrics.parquet")
    for name in FAMILY_NAMES:
        save_table(families.where(F.col("family") == name).drop("family"), f"{path}/{name}.parquet", max_files=10)

    written = {}
    for part, file_name in PART_FILES.items():
        written[part] = stage(getattr(computed, part), path, file_name)
        export_text(written[part], f"{path}/{file_name}.txt")
    remove(spark, scratch)
    return Report(**written)


def run_scenarios(tables: ClaimTables, scenarios: dict[str, ReportConfig], folder: str | None = None) -> Report:
    """Several configurations of the report, stacked and told apart by a leading ``scenario`` column.

    Scenarios that differ in their cohorts and clients only are computed together: claims are read, attributed and summed
    once, whatever the number of scenarios. Others have a run of their own, in a folder of its own below ``folder``, or
    else below the checkpoint folder.
    """
    folder = folder or staging_folder(tables.outclaims.sparkSession)
    together: dict[tuple, dict[str, ReportConfig]] = {}
    for name, config in scenarios.items():
        shared = config.runout_months, config.consolidate_usage, config.additive_rollup_only
        together.setdefault(shared, {})[name] = config
    reports = [
        joint_report(tables, configs, f"{folder}/{number}") for number, configs in enumerate(together.values())
    ]
    return Report(
        **{
            field.name: reduce(DataFrame.unionByName, [getattr(report, field.name) for report in reports])
            for field in fields(Report)
        }
    )


def joint_report(tables: ClaimTables, configs: dict[str, ReportConfig], folder: str) -> Report:
    """The report of scenarios of one report period, by name; each part of it is one plan for all of them."""
    each = {name: build_cohort(tables, config) for name, config in configs.items()}
    months = stage_together({name: cohort.member_months for name, cohort in each.items()}, folder, "member_months")
    cohort = join_cohorts([cohort.with_member_months(months[name]) for name, cohort in each.items()])

    def of_number(values: Sequence[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("scenario") + 1)

    config = next(iter(configs.values()))
    report = report_of(tables, cohort, config, of_number([c.client for c in configs.values()]), folder)
    names = of_number(list(configs))
    return Report(**{field.name: getattr(report, field.name).withColumn("scenario", names) for field in fields(Report)})
