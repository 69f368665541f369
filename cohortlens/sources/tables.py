"""The input tables: the columns the measures read, and the reader that loads them."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column types by table. ``None`` keeps the type found in the file: identifiers may be strings or numbers.
_MONEY = "decimal(18,4)"
_OUTCLAIMS = {
    **dict.fromkeys(("member_id", "claimid", "caseadmitid", "pac_caseadmitid", "providerid")),
    **dict.fromkeys(
        ("prm_fromdate", "prm_todate", "prm_fromdate_case", "prm_todate_case", "paiddate", "pac_episode_end_date"),
        "date",
    ),
    **dict.fromkeys(
        (
            "prm_line", "prm_line_agg", "prm_betos_code", "prm_drg", "hcpcs", "dischargestatus", "psp_category",
            "psp_preventable_yn", "prm_ahrq_pqi", "pac_index_yn", "pac_major_category", "pac_minor_category",
            "prm_readmit_potential_yn", "prm_readmit_all_cause_yn", "snfrm_numer_yn", "snfrm_denom_yn",
            "followup_visit_within_7_days_numer_yn", "followup_visit_within_7_days_denom_yn",
        ),
        "string",
    ),
    **dict.fromkeys(("prm_util", "prm_admits", "mr_cases_admits"), "int"),
    **dict.fromkeys(
        (
            "prm_costs", "prm_capital_ime_amount", "prm_operational_ime_amount", "prm_capital_ds_amount",
            "prm_operational_ds_amount", "prm_hipps_dsh_amount",
        ),
        _MONEY,
    ),
}

NYU_PREFIX = "prm_nyu_"

COLUMNS: dict[str, dict[str, str | None]] = {
    "member_time_windows": {
        "member_id": None,
        "elig_month": "date",
        "date_start": "date",
        "date_end": "date",
        "assignment_indicator": "string",
        "elig_status_1": "string",
        "memmos_medical": "double",
        "cover_medical": "string",
    },
    "time_periods": {
        "time_period_id": None,
        "months_of_claims_runout": "int",
        "reporting_date_start": "date",
        "reporting_date_end": "date",
    },
    "members": {
        "member_id": None,
        "assignment_indicator": "string",
        "mem_report_hier_2": "string",
        "dob": "date",
        "death_date": "date",
        "endoflife_numer_yn_chemolt14days": "string",
        "endoflife_denom_yn_chemolt14days": "string",
    },
    "risk_scores": {"member_id": None, "time_period_id": None, "risk_score": "double"},
    "outclaims": _OUTCLAIMS,
    "decor_case": {"member_id": None, "caseadmitid": None},
    "ref_link_hcg_researcher_line": {"lob": "string", "researcherline": "string", "btnumber": "int"},
    "ref_hcg_bt": {
        "lob": "string",
        "basis": "string",
        "btnumber": "int",
        "riskband": "string",
        "admitfactor": "double",
        "utilfactor": "double",
        "pmpmfactor": "double",
    },
    "ref_pac_benchmarks": {"msdrg": "string", "benchmarks_pac_freq_wm_readm": "double"},
}


@dataclass(frozen=True)
class ClaimTables:
    """One lazy DataFrame per input table."""

    member_time_windows: DataFrame
    time_periods: DataFrame
    members: DataFrame
    risk_scores: DataFrame
    outclaims: DataFrame
    decor_case: DataFrame
    ref_link_hcg_researcher_line: DataFrame
    ref_hcg_bt: DataFrame
    ref_pac_benchmarks: DataFrame


def read_claim_tables(spark: SparkSession, folder: str, reference_folder: str | None = None) -> ClaimTables:
    """Read ``<folder>/<table>.parquet`` for every table.

    The benefit-type tables are read from ``reference_folder`` when they are kept apart from client data.
    """
    shared = {"ref_link_hcg_researcher_line", "ref_hcg_bt"} if reference_folder else set()
    return ClaimTables(
        **{
            field.name: read_table(spark, reference_folder if field.name in shared else folder, field.name)
            for field in fields(ClaimTables)
        }
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table, narrowed to the columns the measures read and cast to their declared types.

    A cast to the type a column already has is dropped by Catalyst, so filters still reach the scan.
    """
    return conform(spark.read.parquet(f"{folder}/{name}.parquet"), name)


def conform(frame: DataFrame, name: str) -> DataFrame:
    """The declared columns in their declared types; a number that its type would change is an error with its name."""
    declared = COLUMNS[name]
    missing = sorted(set(declared) - set(frame.columns))
    if missing:
        raise ValueError(f"table {name} lacks the columns {', '.join(missing)}")
    found = dict(frame.dtypes)
    columns = [as_declared(name, c, found[c], kind).alias(c) if kind else F.col(c) for c, kind in declared.items()]
    if name == "decor_case":
        columns += [F.col(c).cast("double").alias(c) for c in frame.columns if c.startswith(NYU_PREFIX)]
    return frame.select(*columns)


def as_declared(table: str, column: str, found: str, kind: str) -> Column:
    """A cast; where it can round (whole numbers and money), it is checked by casting back."""
    given, cast = F.col(column), F.col(column).cast(kind)
    if found == kind or not (kind == "int" or kind.startswith("decimal")):
        return cast
    held = F.col(column).try_cast(kind)
    message = F.concat(F.lit(f"{table}.{column} holds "), given.cast("string"), F.lit(f", which {kind} would change"))
    return F.when(given.isNull() | (held.cast(found) == given), held).otherwise(F.raise_error(message).cast(kind))
