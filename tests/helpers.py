"""Small hand-made claim tables."""

from __future__ import annotations

from dataclasses import fields
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cohortlens import Assignment, ClaimTables, Cohort, ReportConfig, build_cohort
from cohortlens.sources.tables import COLUMNS

NYU = (
    "prm_nyu_emergent_non_avoidable",
    "prm_nyu_emergent_avoidable",
    "prm_nyu_emergent_primary_care",
    "prm_nyu_injury",
    "prm_nyu_nonemergent",
)
SCHEMAS = {name: {c: kind or "bigint" for c, kind in columns.items()} for name, columns in COLUMNS.items()}
SCHEMAS["decor_case"].update(dict.fromkeys(NYU, "double"))

PERIODS = [
    {
        "time_period_id": 1,
        "months_of_claims_runout": 3,
        "reporting_date_start": date(2020, 1, 1),
        "reporting_date_end": date(2020, 12, 31),
    }
]
BANDS = (
    "<0.50 0.50-0.59 0.60-0.69 0.70-0.79 0.80-0.89 0.90-0.99 1.00-1.09 1.10-1.19 1.20-1.34 1.35-1.49 1.50-1.74 "
    "1.75-2.00 >2.00"
).split()
CURRENT = ReportConfig(client="c", assignment=Assignment.CURRENT)


def frame(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = SCHEMAS[name]
    unknown = {key for row in rows for key in row} - set(schema)
    assert not unknown, f"{name} has no {unknown}"

    def literal(column: str, given) -> str:
        text = "NULL" if given is None else "'" + str(given).replace("'", "\\'") + "'"
        return f"CAST({text} AS {schema[column]})"

    values = [f"({', '.join(literal(c, row.get(c)) for c in schema)})" for row in rows or [{}]]
    table = spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS t({', '.join(schema)})")
    return table if rows else table.limit(0)


def claim_tables(spark: SparkSession, **rows: list[dict]) -> ClaimTables:
    rows.setdefault("time_periods", PERIODS)
    return ClaimTables(**{f.name: frame(spark, f.name, rows.get(f.name, [])) for f in fields(ClaimTables)})


def window(member: int, start: date, end: date, **other) -> dict:
    return {
        "member_id": member,
        "elig_month": start.replace(day=1),
        "date_start": start,
        "date_end": end,
        "assignment_indicator": "Y",
        "elig_status_1": "Aged Dual",
        "memmos_medical": 1.0,
        "cover_medical": "Y",
        **other,
    }


def member(member_id: int, **other) -> dict:
    return {"member_id": member_id, "assignment_indicator": "Y", "mem_report_hier_2": "Y", **other}


def claim(member_id: int, day: date, **other) -> dict:
    return {
        "member_id": member_id,
        "claimid": 1,
        "prm_fromdate": day,
        "prm_todate": day,
        "prm_fromdate_case": day,
        "prm_todate_case": day,
        "paiddate": day,
        "prm_line": "P32c",
        "prm_costs": 10,
        "prm_util": 1,
        "prm_admits": 1,
        "mr_cases_admits": 1,
        "prm_ahrq_pqi": "none",
        "psp_preventable_yn": "N",
        "pac_index_yn": "N",
        **other,
    }


def cohort_of(tables: ClaimTables, config: ReportConfig = CURRENT) -> Cohort:
    return build_cohort(tables, config)


def metric_list(df: DataFrame) -> list[tuple]:
    return sorted(
        ((r["elig_status"], r["metric_id"], r["metric_value"]) for r in df.collect()),
        key=lambda row: tuple(str(v) for v in row),
    )
