"""Member costs net of add-on payments, cut at the yearly limit, at several paid-date cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import UNLISTED_THRESHOLD_SUMMARY
from cohortlens.functions.dates import ReportingPeriod, month_of
from cohortlens.functions.numbers import exact_sum, exact_sum_sql, from_ticks, to_ticks
from cohortlens.operators.cohort import Coverage, status_keys
from cohortlens.operators.cost import cutoffs_met, met_cutoff, truncated
from cohortlens.sources.tables import ClaimTables

DATE_BASES = ("prm_fromdate", "prm_todate")
ADD_ONS = {
    "ime": "prm_capital_ime_amount + prm_operational_ime_amount",
    "dsh": "prm_capital_ds_amount + prm_operational_ds_amount",
    "ucc": "prm_hipps_dsh_amount",
}
# Paid-date cut-offs in ascending order; the columns without a suffix are not cut.
CUTOFFS = ("_14", "_21", "_3mos", "_3mos_7")
SUFFIXES = ("", *CUTOFFS)
COST_COLUMNS = [f"costs{s}" for s in SUFFIXES] + [f"{a}_costs{s}" for s in SUFFIXES for a in ADD_ONS]


def runout_cutoffs(period: ReportingPeriod) -> dict[str, Column]:
    return {
        "_14": period.after_end(days=14),
        "_21": period.after_end(days=21),
        "_3mos": period.after_end(months=3),
        "_3mos_7": period.after_end(months=3, days=7),
    }


def truncation_summary(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Costs, add-ons, net costs and truncated net costs per status and date basis."""
    members = member_costs(tables, cohort)
    keys = [*status_keys(members), "date_flag"]
    limited = members.selectExpr(
        *keys,
        "memmos",
        *COST_COLUMNS,
        *[
            column
            for s in SUFFIXES
            for column in (
                f"{_net(s)} AS costs{s}_reduced",
                f"{truncated(from_ticks(_net(s)), UNLISTED_THRESHOLD_SUMMARY)} AS costs{s}_truncated",
            )
        ],
    )
    inexact = {"memmos", *(f"costs{s}_truncated" for s in SUFFIXES)}
    sums = [
        f"{exact_sum_sql(c) if c in inexact else from_ticks(f'sum({c})')} AS {c}"
        for c in limited.columns
        if c not in keys
    ]
    return limited.groupBy(*keys).agg(*map(F.expr, sums))


def _net(suffix: str) -> str:
    return f"(costs{suffix}" + "".join(f" - {add_on}_costs{suffix}" for add_on in ADD_ONS) + ")"


def member_costs(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Covered months, costs and add-ons (in ticks) of every covered member, per status and date basis.

    Members without claims in the period have costs of 0. Their months are stacked under the claim sums and
    added up with them, which needs one shuffle where outer joins would need one per side.
    """
    amounts = claim_amounts(tables, cohort)

    def by_cutoff(value: str, suffix: str) -> str:
        return f"if({met_cutoff('met', CUTOFFS, suffix)}, {value}, 0)" if suffix else value

    keys = ["member_id", *status_keys(amounts), "date_flag"]
    sums = [f"sum({by_cutoff('costs', s)}) AS costs{s}" for s in SUFFIXES]
    sums += [f"sum({by_cutoff(a, s)}) AS {a}_costs{s}" for s in SUFFIXES for a in ADD_ONS]
    costs = amounts.groupBy(*keys).agg(*map(F.expr, sums))
    bases = F.explode(F.array(*map(F.lit, DATE_BASES)))
    months = cohort.covered_months.select("member_id", *status_keys(amounts), "memmos", bases.alias("date_flag"))
    return (
        costs.unionByName(months, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(exact_sum("memmos").alias("memmos"), *[F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in COST_COLUMNS])
    )


def claim_amounts(tables: ClaimTables, cohort: Coverage) -> DataFrame:
    """Attributed cost with the add-ons of its claim, in ticks, once per distinct set of add-ons and met cut-offs.

    Add-ons are repeated on the lines of a claim and count once, cost is per line and counts every time: cost is
    summed within the group that makes the add-ons distinct. Lines paid on two sides of a cut-off stay apart.

    Both date bases come from one scan, and lines are added up before they are told apart: the first sum has the months
    of both bases in its key, NULL outside the period, and so one row for each line at most.
    """
    period = cohort.report_period
    months = {basis: f"{basis}_month" for basis in DATE_BASES}
    sign = "if(prm_costs < 0, -1, 1)"
    summed = (
        tables.outclaims.where(period.holds("prm_fromdate") | period.holds("prm_todate"))
        .select(
            "member_id",
            "claimid",
            F.expr(f"{to_ticks('prm_costs')} AS costs"),
            *[F.expr(f"{sign} * {to_ticks(amount)} AS {name}") for name, amount in ADD_ONS.items()],
            cutoffs_met("paiddate", runout_cutoffs(period)).alias("met"),
            *[F.when(period.holds(basis), month_of(basis)).alias(month) for basis, month in months.items()],
        )
        .groupBy("member_id", "claimid", *ADD_ONS, "met", *months.values())
        .agg(F.sum("costs").alias("costs"))
    )
    bases = F.array(
        *[F.struct(F.lit(basis).alias("date_flag"), F.col(month).alias("elig_month")) for basis, month in months.items()]
    )
    by_basis = summed.select(
        "member_id", "claimid", *ADD_ONS, "met", "costs",
        F.inline(F.filter(bases, lambda basis: basis["elig_month"].isNotNull())),
    )
    rows = cohort.expanded(by_basis.join(cohort.status_months.hint("merge"), ["member_id", "elig_month"]))
    return rows.groupBy("date_flag", "member_id", *status_keys(rows), "claimid", *ADD_ONS, "met").agg(
        F.sum(F.col("costs") * F.col("copies")).alias("costs")
    )
