"""One scan of the claims for several measure families.

Each line carries a mask with a bit for each family that reads it. Lines are summed per member, month, covered date, mask
and those dimensions that the families in the mask need, and are attributed once; the mask is expanded on the few rows
that are left. A family reads its own lines at its own grain, as if it had scanned the claims alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import SNF_LINE
from cohortlens.functions.dates import month_of
from cohortlens.operators.attribution import (
    BY_LINE_DATE,
    BY_STAY_DATE,
    AttributionPolicy,
    attribute,
    attributed_sums,
    can_fall_in,
)
from cohortlens.operators.cohort import Coverage, status_keys

MASK = "families"


@dataclass(frozen=True)
class LineFamily:
    """The lines a family reads, the dimensions it tells apart and the values it adds up, as SQL over a claim line.

    ``policy`` has to date a line's month and its coverage alike.
    """

    where: str
    policy: AttributionPolicy
    sums: dict[str, str]
    dims: dict[str, str] = field(default_factory=dict)

    def with_dims(self, names: Sequence[str]) -> LineFamily:
        """The family with only these of its dimensions."""
        return LineFamily(self.where, self.policy, self.sums, {name: self.dims[name] for name in names})


def shared_sums(claims: DataFrame, cohort: Coverage, families: Sequence[LineFamily]) -> DataFrame:
    """Attributed sums of all families by status, mask and dimension; ``family_sums`` reads one of them.

    Where the cohort has several scenarios, their mask is expanded like that of the families, on these sums.
    """
    if not all(f.policy.single_date for f in families):
        raise ValueError("families share a scan only where the month and the covered day come from one date")
    dims, sums = merged(f.dims for f in families), merged(f.sums for f in families)
    lines = dated_lines(in_reach(claims, cohort, families), families)
    needed = {
        name: sum(1 << at for at, f in enumerate(families) if name in f.dims) for name in dims
    }
    everyone = (1 << len(families)) - 1
    daily = lines.groupBy(
        "member_id",
        "claim_month",
        "covered_date",
        MASK,
        # a dimension splits only the lines of those families that tell it apart
        *[F.expr(value if needed[name] == everyone else f"if({MASK} & {needed[name]} <> 0, {value}, NULL)").alias(name)
          for name, value in dims.items()],
    ).agg(*[F.expr(f"sum({value}) AS {name}") for name, value in sums.items()])
    summed = (
        attribute(daily, cohort, BY_STAY_DATE)
        .groupBy(*cohort.status_columns, MASK, *dims)
        .agg(*[F.expr(f"sum({name} * copies) AS {name}") for name in sums])
    )
    return cohort.expanded(summed)


def family_sums(shared: DataFrame, families: Sequence[LineFamily], family: LineFamily) -> DataFrame:
    """What ``family`` would have summed on its own: by status and its dimensions."""
    return (
        shared.where(F.expr(f"{MASK} & {1 << families.index(family)} <> 0"))
        .groupBy(*status_keys(shared), *family.dims)
        .agg(*[F.sum(name).alias(name) for name in family.sums])
    )


def own_sums(claims: DataFrame, cohort: Coverage, family: LineFamily) -> DataFrame:
    """One family's sums from a scan of its own, by status and its dimensions."""
    lines = claims.where(family.where).withColumns({name: F.expr(value) for name, value in family.dims.items()})
    return cohort.expanded(attributed_sums(lines, cohort, family.policy, list(family.dims), family.sums))


def merged(expressions: Sequence[dict[str, str]]) -> dict[str, str]:
    """All names of several dictionaries; one name means one thing."""
    out: dict[str, str] = {}
    for some in expressions:
        for name, value in some.items():
            if out.setdefault(name, value) != value:
                raise ValueError(f"{name} is {out[name]} in one family and {value} in another")
    return out


def in_reach(claims: DataFrame, cohort: Coverage, families: Sequence[LineFamily]) -> DataFrame:
    """Lines that some family reads and whose date for it can fall in a cohort month."""
    by_policy: dict[AttributionPolicy, list[str]] = {}
    for family in families:
        by_policy.setdefault(family.policy, []).append(family.where)
    if "true" in by_policy.get(BY_STAY_DATE, []):
        by_policy.pop(BY_LINE_DATE, None)  # the lines of these are among those
    conditions = [
        can_fall_in(cohort, policy) & F.expr("true" if "true" in some else " OR ".join(f"({where})" for where in some))
        for policy, some in by_policy.items()
    ]
    return claims.where(reduce(lambda some, one: some | one, conditions))


def dated_lines(claims: DataFrame, families: Sequence[LineFamily]) -> DataFrame:
    """A row per line and date by which some family counts it, with ``claim_month``, ``covered_date`` and the mask.

    Families that date a line alike share a row, and so do all of them where a line and its case begin on one day.
    """
    by_line, by_case = F.lit(0), F.lit(0)
    on_case = F.col("prm_line") == SNF_LINE
    for at, family in enumerate(families):
        bit = F.when(F.expr(family.where), 1 << at).otherwise(0)
        if family.policy.covered_on == "line":
            by_line = by_line.bitwiseOR(bit)
        elif family.policy.covered_on == "case":
            by_case = by_case.bitwiseOR(bit)
        else:
            by_line = by_line.bitwiseOR(F.when(on_case, 0).otherwise(bit))
            by_case = by_case.bitwiseOR(F.when(on_case, bit).otherwise(0))
    policies = {f.policy for f in families}
    if len(policies) == 1:
        return policies.pop().dated(claims.withColumn(MASK, by_line.bitwiseOR(by_case)))

    def counted(date: str, mask: Column) -> Column:
        return F.struct(F.col(date).alias("covered_date"), mask.alias(MASK))

    together = F.array(counted("prm_fromdate", F.col("_line").bitwiseOR(F.col("_case"))))
    apart = F.array(counted("prm_fromdate", F.col("_line")), counted("prm_fromdate_case", F.col("_case")))
    rows = F.filter(
        F.when(F.col("prm_fromdate") == F.col("prm_fromdate_case"), together).otherwise(apart),
        lambda row: (row[MASK] != 0) & row["covered_date"].isNotNull(),
    )
    dated = claims.withColumns({"_line": by_line, "_case": by_case}).select("*", F.inline(rows))
    return dated.withColumn("claim_month", month_of("covered_date"))
