"""Post-acute episodes, deaths in hospital, and the stay-to-readmission interval match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import SNF_LINE
from cohortlens.operators.attribution import BY_CASE_DATE, attribute, in_cohort_months
from cohortlens.operators.cohort import Coverage

DIED = "20"
INPATIENT_GROUP = "i1"
READMIT_DAYS = 30


def died_in_hospital() -> Column:
    """Discharged dead from an inpatient line that is not a skilled-nursing one."""
    line = F.col("prm_line")
    return (F.col("dischargestatus") == DIED) & line.startswith("I") & (line != SNF_LINE)


def hospital_deaths(claims: DataFrame) -> DataFrame:
    """Members with such a discharge."""
    return claims.where(died_in_hospital()).select("member_id").distinct()


def episode_flags(claims: DataFrame) -> DataFrame:
    """Per episode: whether its lines other than the index stay hold each kind of post-acute use."""
    major, minor = F.col("pac_major_category"), F.col("pac_minor_category")
    kinds = {
        "pac_has_ip_acute_yn": (major == "IP") & (minor == "Acute"),
        "pac_has_ip_rehab_yn": (major == "IP") & (minor == "Rehab"),
        "pac_has_snf_yn": major == "SNF",
        "pac_has_hh_yn": major == "HH",
    }
    used = {name: F.sum(F.when(kind, F.col("prm_util")).otherwise(0)) > 0 for name, kind in kinds.items()}
    # An episode id of NULL is not an episode: it would be one huge group that no index line can match.
    return (
        claims.where((F.col("pac_index_yn") == "N") & F.col("pac_caseadmitid").isNotNull())
        .groupBy("pac_caseadmitid")
        .agg(*[F.when(use, "Y").otherwise("N").alias(name) for name, use in used.items()])
    )


def eligible_drgs(benchmarks: DataFrame) -> DataFrame:
    """DRGs with a benchmark. A DRG listed twice counts its lines twice."""
    return benchmarks.where(F.col("benchmarks_pac_freq_wm_readm").isNotNull()).select(
        F.col("msdrg").alias("prm_drg")
    )


def snf_readmit_cases(claims: DataFrame, cohort: Coverage) -> DataFrame:
    """Skilled-nursing cases lying between an inpatient stay and a readmission within 30 days of it.

    The stay begins in the 30 days up to the readmission; the index admission ends in those same days, but not
    after the stay began. A case qualifies by existence, so the nearest admission on each side decides, and no
    chains are written out.
    """
    admissions = (
        claims.where(F.col("prm_line_agg") == INPATIENT_GROUP)
        .groupBy("member_id", "caseadmitid")
        .agg(F.min("prm_fromdate_case").alias("admit_start"), F.max("prm_todate_case").alias("admit_end"))
    )
    readmissions = admissions.select("member_id", F.col("admit_start").alias("readmit_start")).distinct()
    index_ends = admissions.select("member_id", F.col("admit_end").alias("index_end")).distinct()

    lines = BY_CASE_DATE.dated(
        in_cohort_months(claims.where(F.col("prm_line").startswith(SNF_LINE)), cohort, BY_CASE_DATE)
    )
    daily = lines.select("member_id", "caseadmitid", "claim_month", "covered_date").distinct()
    stays = (
        attribute(daily, cohort, BY_CASE_DATE)
        .groupBy("member_id", "caseadmitid")
        .agg(F.max("covered_date").alias("snf_start"))
    )

    # Stays that start on one day share their matches, so days are matched, and cases come back at the end.
    starts = stays.select("member_id", "snf_start").distinct()
    # Of the index admissions that ended before the stay, the last one is the most likely to be in reach of a
    # readmission; of the readmissions after it, the first one. If those two are not in reach, none are.
    last_end = _nearest(starts, index_ends, "index_end", before=True)
    first_readmit = _nearest(starts, readmissions, "readmit_start", before=False)
    in_reach = (
        last_end.join(first_readmit, ["member_id", "snf_start"])
        .where(F.datediff("readmit_start", "index_end") <= READMIT_DAYS)
        .select("member_id", "snf_start")
    )
    return stays.join(in_reach, ["member_id", "snf_start"], "left_semi").select("caseadmitid").distinct()


def _nearest(starts: DataFrame, events: DataFrame, event: str, before: bool) -> DataFrame:
    """The event date nearest to each start, on the given side of it and at most 30 days away.

    Days fall into buckets of 31, so the days in reach of a start touch two of them, and the match is an equi-join
    on (member, bucket). Events and starts are distinct days: a bucket holds at most 31 of each, however many
    admissions a member has.
    """
    start = F.col("snf_start")
    first, last = (F.date_sub(start, READMIT_DAYS), start) if before else (start, F.date_add(start, READMIT_DAYS))
    buckets = F.array_distinct(F.array(_bucket(first), _bucket(last)))
    in_reach = starts.withColumn("bucket", F.explode(buckets)).join(
        events.withColumn("bucket", _bucket(F.col(event))), ["member_id", "bucket"]
    )
    return (
        in_reach.where(F.col(event).between(first, last))
        .groupBy("member_id", "snf_start")
        .agg((F.max if before else F.min)(event).alias(event))
    )


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / (READMIT_DAYS + 1))
