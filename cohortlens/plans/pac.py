"""Post-acute-care episode measures and their summary by DRG."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numbers import is_yes
from cohortlens.operators.attribution import BY_STAY_MONTH, attribute, daily_sums
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.episodes import eligible_drgs, episode_flags, hospital_deaths
from cohortlens.operators.key_filter import key_filter, may_hold
from cohortlens.operators.measures import Measure, evaluate
from cohortlens.sources.tables import ClaimTables

EPISODES = [Measure("pac_epi", "admits")]
DEATHS = [Measure("pac_died_in_hosp", "admits", "died = 'Y'")]
POST_ACUTE_USE = [
    Measure("pac_ipreadmit", "admits", "pac_has_ip_acute_yn = 'Y'"),
    Measure("pac_snf", "admits", "pac_has_snf_yn = 'Y'"),
    Measure("pac_rehab", "admits", "pac_has_ip_rehab_yn = 'Y'"),
    Measure("pac_hh", "admits", "pac_has_hh_yn = 'Y'"),
]
# Counted in the value, not the filter: statuses with index lines but no such visit report 0.
FOLLOWUPS = [
    Measure("cnt_followup_visits_within_7_days_numer_med", "if(numer AND prm_line = 'I11a', lines, 0)"),
    Measure("cnt_followup_visits_within_7_days_denom_med", "if(denom AND prm_line = 'I11a', lines, 0)"),
    Measure("cnt_followup_visits_within_7_days_numer_sur", "if(numer AND prm_line = 'I12', lines, 0)"),
    Measure("cnt_followup_visits_within_7_days_denom_sur", "if(denom AND prm_line = 'I12', lines, 0)"),
]
MEASURES = [*EPISODES, *DEATHS, *POST_ACUTE_USE, *FOLLOWUPS]

DRG_COUNTS = {
    "pac_acute_count": "pac_has_ip_acute_yn",
    "pac_rehab_count": "pac_has_ip_rehab_yn",
    "pac_snf_count": "pac_has_snf_yn",
    "pac_hh_count": "pac_has_hh_yn",
    "pac_death_count": "died",
}


def pac_metrics(tables: ClaimTables, cohort: Coverage, measures: list[Measure] | None = None) -> DataFrame:
    return evaluate(index_summary(tables, cohort), measures or MEASURES)


def pac_drg_summary(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    return drg_counts(index_summary(tables, cohort))


def drg_counts(summary: DataFrame) -> DataFrame:
    """Index admissions per status and DRG: all of them, and those followed by each kind of use or by death."""
    followed = [f"sum(if({flag} = 'Y', admits, 0)) AS {name}" for name, flag in DRG_COUNTS.items()]
    return summary.groupBy(*status_keys(summary), "prm_drg").agg(
        F.sum("admits").alias("pac_count"), *map(F.expr, followed)
    )


def index_summary(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Attributed index lines of eligible DRGs, summed per status, DRG, service line and episode flag.

    Flags are only summed for episodes that have such lines: a filter of bounded size over these episodes drops most
    other lines where they are read, and the join that follows drops the rest.
    """
    episodes = index_episodes(tables, cohort)
    # every episode has lines; the condition keeps all columns in the plan, so that Spark computes it once for both uses
    wanted = key_filter(episodes.where("lines > 0 OR admits > 0"), "pac_caseadmitid")
    flags = episode_flags(may_hold(tables.outclaims, "pac_caseadmitid", wanted))
    flag_names = [c for c in flags.columns if c != "pac_caseadmitid"]
    summed = (
        episodes.join(flags, "pac_caseadmitid", "left")
        .groupBy(*cohort.status_columns, "prm_drg", "prm_line", "numer", "denom", "died", *flag_names)
        .agg(F.sum("admits").alias("admits"), F.sum("lines").alias("lines"))
    )
    return cohort.expanded(summed)


def index_episodes(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Attributed index lines of eligible DRGs, summed per status and episode.

    Lines are narrowed to the cohort and summed per episode before benchmarks and flags are joined. The many
    lines without an episode thereby meet the joins as a few rows, where they would otherwise all hash to one
    partition; so do the lines of a frequent DRG.
    """
    index_lines = (
        tables.outclaims.where(F.col("pac_index_yn") == "Y")
        .withColumn("numer", is_yes("followup_visit_within_7_days_numer_yn"))
        .withColumn("denom", is_yes("followup_visit_within_7_days_denom_yn"))
    )
    dims = ["prm_drg", "prm_line", "numer", "denom", "pac_caseadmitid"]
    daily = daily_sums(
        index_lines, cohort, BY_STAY_MONTH, [*dims, "pac_episode_end_date"], {"admits": "prm_admits", "lines": "1"}
    )
    died = F.coalesce(F.col("death_date") <= F.col("pac_episode_end_date"), F.lit(False))
    by_episode = (
        attribute(daily, cohort, BY_STAY_MONTH)
        .join(deaths(tables).hint("merge"), "member_id", "left")
        .withColumn("died", F.when(died, "Y").otherwise("N"))
        .groupBy(*cohort.status_columns, "died", *dims)
        .agg(*[F.sum(F.col(c) * F.col("copies")).alias(c) for c in ("admits", "lines")])
    )
    return by_episode.join(eligible_drgs(tables.ref_pac_benchmarks), "prm_drg")


def deaths(tables: ClaimTables) -> DataFrame:
    """Death dates of members who died in hospital."""
    return tables.members.join(hospital_deaths(tables.outclaims), "member_id", "left_semi").select(
        "member_id", "death_date"
    )
