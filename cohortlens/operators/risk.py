"""Benefit types, risk bands and risk adjustment of usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import OPEN_RISK_BAND, RISK_BANDS
from cohortlens.functions.numbers import weighted_mean
from cohortlens.operators.cohort import status_keys

MEDICARE = "Medicare"
HCC_BASIS = "RS"


def with_benefit_type(summary: DataFrame, ref_link: DataFrame) -> DataFrame:
    """Add ``btnumber`` by service line. A line listed twice counts twice, an unlisted one gets NULL.

    Joined to summaries, never to claim lines; the reference table's size on file decides the join strategy.
    """
    mapping = ref_link.where(F.col("lob") == MEDICARE).select(F.col("researcherline").alias("prm_line"), "btnumber")
    return summary.join(mapping, "prm_line", "left")


def average_risk(covered_months: DataFrame, digits: int, null_as_zero: bool = False) -> DataFrame:
    """Memmos-weighted mean risk score per status, rounded half-even."""
    mean = F.bround(weighted_mean("risk_score", "memmos"), digits)
    if null_as_zero:
        mean = F.coalesce(mean, F.lit(0.0))
    return covered_months.groupBy(*status_keys(covered_months)).agg(mean.alias("risk_score_avg"))


def band_table(ref_hcg_bt: DataFrame) -> DataFrame:
    """Adjustment factors per benefit type with the closed risk interval of their band."""

    def bound(side: int) -> str:
        whens = " ".join(f"WHEN '{band}' THEN {bounds[side]}D" for band, bounds in RISK_BANDS.items())
        return f"CASE riskband {whens} ELSE {OPEN_RISK_BAND[side]}D END"

    return ref_hcg_bt.where((F.col("lob") == MEDICARE) & (F.col("basis") == HCC_BASIS)).selectExpr(
        "btnumber",
        f"{bound(0)} AS band_low",
        f"{bound(1)} AS band_high",
        "admitfactor",
        "utilfactor",
        "pmpmfactor",
    )


def _in_band() -> Column:
    return F.col("risk_score_avg").between(F.col("band_low"), F.col("band_high"))


def adjust_strict(usage: DataFrame, risk: DataFrame, bands: DataFrame, factor: str, value: str) -> DataFrame:
    """Keep usage whose benefit type has a band for the status's risk; add ``adjusted`` = value / factor.

    Usage without such a band is lost, the raw value included.
    """
    return (
        usage.join(risk, status_keys(usage))
        .join(bands, "btnumber")
        .where(_in_band())
        .withColumn("adjusted", F.expr(f"try_divide(CAST({value} AS double), {factor})"))
    )


def adjust_lenient(usage: DataFrame, risk: DataFrame, bands: DataFrame, factor: str, value: str) -> DataFrame:
    """Like the strict form, but usage without a factor is kept at factor 1.

    A benefit type whose factors are NULL is kept once per band, whatever the risk.
    """
    return (
        usage.join(risk, status_keys(usage), "left")
        .join(bands, "btnumber", "left")
        .where(F.col(factor).isNull() | _in_band())
        .withColumn("adjusted", F.expr(f"try_divide(CAST({value} AS double), coalesce({factor}, 1D))"))
    )
