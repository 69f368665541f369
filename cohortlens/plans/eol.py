"""End-of-life measures of the members who died in the period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.config import HOSPICE_LINES
from cohortlens.functions.numbers import is_yes
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.episodes import died_in_hospital
from cohortlens.operators.measures import Measure, dims_of, evaluate
from cohortlens.operators.rollup import NON_ESRD
from cohortlens.plans.basic import ALL, ESRD
from cohortlens.sources.tables import ClaimTables

# "All" only counts decedents; its rows carry no other measure.
_IN_GROUP = f"elig_status <> '{ALL}'"
DECEDENTS = [Measure("decedent_count", "members")]
CANCER = [
    Measure("cnt_cancer", "cnt_cancer", _IN_GROUP),
    Measure("cnt_chemo", "cnt_chemo", _IN_GROUP),
]
FINAL_COST = [Measure("tot_cost_final_30days", "final_cost", _IN_GROUP, ("final_cost",))]
HOSPITAL_DEATHS = [Measure("cnt_death_in_hosp", "death_in_hosp", _IN_GROUP, ("death_in_hosp",))]
HOSPICE = [
    Measure("cnt_hospice_never", "hospice_never", _IN_GROUP, ("hospice_never",)),
    Measure("cnt_hospice_lt3days", "hospice_lt3", _IN_GROUP, ("hospice_lt3",)),
]
MEASURES = [*DECEDENTS, *CANCER, *FINAL_COST, *HOSPITAL_DEATHS, *HOSPICE]
FINAL_DAYS = 30


def eol_metrics(
    tables: ClaimTables, cohort: Coverage, measures: list[Measure] | None = None, care: DataFrame | None = None
) -> DataFrame:
    """Measures per status, over all non-ESRD statuses (each member once) and, for decedents, over everyone.

    ``care`` is the ``final_care`` of the members, where it has been taken.
    """
    measures = measures or MEASURES
    people = decedents(tables, cohort)
    if dims_of(measures):
        people = with_final_care(people, final_care(tables, cohort) if care is None else care)
    others = [c for c in people.columns if c == "scenario"]
    values = [c for c in people.columns if c not in ("member_id", "death_date", "statuses", *others)]
    non_esrd = F.when(F.exists("statuses", lambda s: s != ESRD), F.lit(NON_ESRD))
    groups = F.array_compact(F.concat(F.col("statuses"), F.array(non_esrd, F.lit(ALL))))
    totals = (
        people.select(*others, F.explode(groups).alias("elig_status"), *values)
        .groupBy(*others, "elig_status")
        .agg(*[F.sum(c).alias(c) for c in values])
    )
    return evaluate(totals, measures)


def decedents(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Cohort members who died in the period, with the set of statuses they were seen in."""
    months = cohort.member_months
    keys = [*(key for key in status_keys(months) if key != "elig_status"), "member_id"]
    died = cohort.dying(tables.members).select(
        *keys,
        "death_date",
        is_yes("endoflife_denom_yn_chemolt14days").cast("int").alias("cnt_cancer"),
        is_yes("endoflife_numer_yn_chemolt14days").cast("int").alias("cnt_chemo"),
        F.lit(1).alias("members"),
    )
    seen = months.where(F.col("memmos") != 0).groupBy(*keys).agg(F.collect_set("elig_status").alias("statuses"))
    return died.join(seen.hint("merge"), keys)


def final_care(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Per member who died in the cohort's range: cost in the last 30 days or later, hospice days, death in hospital.

    Claims need not be attributed. They are summed per member and end date before they meet the decedents; how they
    meet them is left to the session's broadcast threshold and to adaptive execution.
    """
    care = tables.outclaims.groupBy("member_id", "prm_todate").agg(
        F.sum("prm_costs").alias("cost"),
        F.sum(F.when(F.col("prm_line").isin(*HOSPICE_LINES), F.col("prm_util"))).alias("hospice_days"),
        F.bool_or(died_in_hospital()).alias("death_in_hosp"),
    )
    died = tables.members.where(cohort.period.holds("death_date")).select("member_id", "death_date")
    final = F.datediff("death_date", "prm_todate") <= FINAL_DAYS
    return (
        care.join(died, "member_id")
        .groupBy("member_id")
        .agg(
            F.sum(F.when(final, F.col("cost"))).alias("final_cost"),
            F.coalesce(F.sum("hospice_days"), F.lit(0)).alias("hospice_days"),
            F.bool_or("death_in_hosp").alias("death_in_hosp"),
        )
    )


def with_final_care(people: DataFrame, care: DataFrame) -> DataFrame:
    """Add each decedent's final cost, hospital death and hospice use."""
    days = F.coalesce("hospice_days", F.lit(0))
    return (
        people.join(care, "member_id", "left")
        .withColumns(
            {
                "final_cost": F.coalesce("final_cost", F.lit(0)),
                "death_in_hosp": F.coalesce("death_in_hosp", F.lit(False)).cast("int"),
                "hospice_never": (days == 0).cast("int"),
                "hospice_lt3": days.isin(1, 2).cast("int"),
            }
        )
        .drop("hospice_days")
    )
