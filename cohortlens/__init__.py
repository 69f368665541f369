"""Member-month cohorts and claims measures as Spark DataFrame plans."""

from cohortlens.config import Assignment, ReportConfig
from cohortlens.operators.cohort import Cohort, build_cohort, build_member_months
from cohortlens.plans.report import build_report, run_scenarios, write_report
from cohortlens.sources.store import read_claim_store, save_claim_store
from cohortlens.sources.tables import ClaimTables, read_claim_tables

__all__ = [
    "Assignment",
    "ClaimTables",
    "Cohort",
    "ReportConfig",
    "build_cohort",
    "build_member_months",
    "build_report",
    "read_claim_store",
    "read_claim_tables",
    "run_scenarios",
    "save_claim_store",
    "write_report",
]
