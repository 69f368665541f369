"""Membership, risk, cost, age and wellness-visit measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import UNLISTED_THRESHOLD_BASIC, WELLNESS_HCPCS
from cohortlens.functions.numbers import exact_sum, weighted_mean
from cohortlens.operators.attribution import BY_STAY_MONTH, attributed_sums
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.cost import truncated
from cohortlens.operators.measures import metric_rows, stack, wide_to_metrics
from cohortlens.operators.rollup import NON_ESRD
from cohortlens.sources.tables import ClaimTables

ALL = "All"
ESRD = "ESRD"


# Months that a mask of visits can hold, twelve of them before the first month of the cohort.
MASK_MONTHS = 62
RECENT_MONTHS = 12


def basic_metrics(
    tables: ClaimTables, cohort: Coverage, claim_costs: DataFrame | None = None, visits: DataFrame | None = None
) -> DataFrame:
    """All basic measures; ``claim_costs`` and ``visits`` are what they read of the claims, where it has been taken."""
    return stack(
        [
            assigned_members(cohort),
            membership(cohort),
            member_age(tables, cohort),
            costs(tables, cohort, claim_costs),
            wellness_visits(tables, cohort, visits),
        ]
    )


def assigned_members(cohort: Coverage) -> DataFrame:
    """Distinct covered members per status, over all statuses, and over all but ESRD.

    Members are counted by the set of statuses they were seen in, so each is a single row of one shuffle; which groups a
    set belongs to is worked out on the few sets there are.
    """
    months = cohort.covered_months
    others = [key for key in status_keys(months) if key != "elig_status"]
    status = F.col("statuses")
    non_esrd = F.when(F.exists(status, lambda s: s != ESRD), F.lit(NON_ESRD))
    groups = F.array_compact(F.concat(status, F.array(F.lit(ALL), non_esrd)))
    metric_id = F.when(F.col("elig_status") == NON_ESRD, "cnt_assigned_mems_nonesrd").otherwise("cnt_assigned_mems")
    return (
        months.groupBy(*others, "member_id")
        .agg(F.sort_array(F.collect_set("elig_status")).alias("statuses"))
        .groupBy(*others, "statuses")
        .agg(F.count(F.lit(1)).alias("members"))
        .select(*others, "members", F.explode(groups).alias("elig_status"))
        .groupBy(*others, "elig_status")
        .agg(F.sum("members").cast("double").alias("metric_value"))
        .withColumn("metric_id", metric_id)
    )


def membership(cohort: Coverage) -> DataFrame:
    """Covered member months and their mean risk score per status."""
    months = cohort.covered_months
    totals = months.groupBy(*status_keys(months)).agg(
        exact_sum("memmos").alias("memmos_sum"),
        weighted_mean("risk_score", "memmos").alias("riskscr_1_avg"),
    )
    return wide_to_metrics(totals, ["memmos_sum", "riskscr_1_avg"])


def member_age(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Age in years at each member month, weighted by its covered share."""
    births = tables.members.select("member_id", "dob")
    months = cohort.covered_months
    totals = (
        months.join(births.hint("merge"), "member_id")
        .groupBy(*status_keys(months))
        .agg(exact_sum("memmos * (datediff(elig_month, dob) / 365.25D)").alias("total_age"))
    )
    return metric_rows(totals, "total_age", "total_age")


def member_claim_costs(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Attributed cost per member and status."""
    summed = attributed_sums(
        tables.outclaims, cohort, BY_STAY_MONTH, dims=[], sums={"costs": "prm_costs"}, per_member=True
    )
    return cohort.expanded(summed)


def member_costs(tables: ClaimTables, cohort: Coverage, claim_costs: DataFrame | None = None) -> DataFrame:
    """Attributed cost and covered months per member and status, for members with attributed claims.

    Both sides are stacked and summed together, so they meet in one shuffle instead of a join.
    """
    costs = member_claim_costs(tables, cohort) if claim_costs is None else claim_costs
    keys = ["member_id", *status_keys(cohort.covered_months)]
    months = cohort.covered_months.select(*keys, "memmos")
    return (
        costs.withColumn("has_claims", F.lit(True))
        .unionByName(months, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.sum("costs").alias("costs"),
            exact_sum("memmos").alias("memmos"),
            F.bool_or("has_claims").alias("has_claims"),
        )
        .where("has_claims")
    )


def costs(tables: ClaimTables, cohort: Coverage, claim_costs: DataFrame | None = None) -> DataFrame:
    """Total cost, and total cost with each member's cost cut at the prorated yearly limit."""
    cut = truncated("costs", UNLISTED_THRESHOLD_BASIC)
    members = member_costs(tables, cohort, claim_costs)
    totals = members.groupBy(*status_keys(members)).agg(
        F.sum("costs").alias("prm_costs_sum_all_services"),
        exact_sum(f"if(costs IS NULL, NULL, {cut})").alias("prm_costs_truncated"),
    )
    return wide_to_metrics(totals, ["prm_costs_sum_all_services", "prm_costs_truncated"])


def month_number(date: str | Column) -> Column:
    return 12 * F.year(date) + F.month(date)


def visit_bit(cohort: Coverage, date: str | Column) -> Column:
    """The bit of a date's month: 1 for the twelfth month before the cohort's first one, 0 for all earlier ones."""
    start, end = cohort.period.start, cohort.period.end
    before_first = 12 * start.year + start.month - RECENT_MONTHS
    if 12 * end.year + end.month - before_first >= MASK_MONTHS:
        raise ValueError(f"a period of more than {MASK_MONTHS - RECENT_MONTHS - 1} months does not fit a mask of months")
    return F.greatest(month_number(date) - before_first, F.lit(0))


def wellness_months(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Per member a mask of the months with a wellness visit, up to the end of the cohort's period.

    Visits may be any claim, covered or not. Bits are merged before the shuffle; later visits are not read.
    """
    visits = tables.outclaims.where(F.col("hcpcs").isin(*WELLNESS_HCPCS) & (F.col("prm_fromdate") <= cohort.last_day))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), visit_bit(cohort, "prm_fromdate"))
    return visits.select("member_id", bit.alias("bit")).groupBy("member_id").agg(F.bit_or("bit").alias("visits"))


def wellness_visits(tables: ClaimTables, cohort: Coverage, visits: DataFrame | None = None) -> DataFrame:
    """Members with a wellness visit in the twelve months up to the report month, and all members of that month.

    The report month is the latest cohort month in which some member has had a visit, now or earlier. A visit up to a
    month leaves a bit at or below that of the month, and a recent one leaves it among the last twelve of these.
    """
    visits = wellness_months(tables, cohort) if visits is None else visits
    months = cohort.covered_months
    keys = status_keys(months)
    others = [key for key in keys if key != "elig_status"]
    # moved left until the month's own bit is the highest, bits of later months have dropped out
    up_to = F.call_function("shiftleft", F.col("visits"), F.lit(63) - visit_bit(cohort, "elig_month"))
    by_month = (
        months.join(visits.hint("merge"), "member_id", "left")
        .withColumn("up_to", F.coalesce(up_to, F.lit(0)))
        .withColumn("seen", F.col("up_to") != 0)
        .withColumn("recent", F.shiftrightunsigned("up_to", 64 - RECENT_MONTHS) != 0)
        .groupBy("elig_month", *keys, "member_id")
        .agg(F.bool_or("seen").alias("seen"), F.bool_or("recent").alias("recent"))
        .groupBy("elig_month", *keys)
        .agg(
            F.count(F.lit(1)).alias("cnt_wellness_visits_denom"),
            F.count_if("seen").alias("seen"),
            F.count_if("recent").alias("recent"),
        )
    )
    # At most one row per month and status from here on; the report month is picked without a second pass.
    status_rows = F.collect_list(
        F.struct(
            "elig_status",
            F.when(F.col("seen") > 0, F.col("recent").cast("double")).alias("cnt_wellness_visits_numer"),
            F.col("cnt_wellness_visits_denom").cast("double").alias("cnt_wellness_visits_denom"),
        )
    )
    names = ["cnt_wellness_visits_numer", "cnt_wellness_visits_denom"]
    with_visits = F.when(F.col("seen") > 0, F.col("elig_month"))
    report_month = cohort.in_each_scenario(
        by_month.groupBy(*others, "elig_month").agg(status_rows.alias("rows"), F.sum("seen").alias("seen")),
        F.max_by("rows", with_visits).alias("rows"),
    )
    total = F.struct(
        F.lit(ALL).alias("elig_status"),
        *[
            F.aggregate(
                F.col("rows")[name],
                F.lit(None).cast("double"),
                lambda running, value: F.coalesce(running + value, running, value),
            ).alias(name)
            for name in names
        ],
    )
    rows = F.concat(F.coalesce(F.col("rows"), F.array()), F.array(total))
    return (
        wide_to_metrics(report_month.select(*others, F.inline(rows)), names)
        .where(F.col("metric_value").isNotNull() | (F.col("elig_status") == ALL))
    )
