"""The Non-ESRD roll-up and the labels of the final report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import NON_ESRD_STATUSES
from cohortlens.functions.numbers import ordered_sum
from cohortlens.operators.cohort import status_keys

NON_ESRD = "Non-ESRD"


def non_esrd_rollup(metrics: DataFrame, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Sum every metric over the three statuses that are not ESRD.

    This also adds up averages and distinct counts; ``leave_out`` names metrics to skip. Rows are chosen
    inside the aggregation, not by a filter that would be pushed into the metric plans: the plans then stay
    equal to those of the unrolled rows, and Spark reuses their exchanges.
    """
    if leave_out:
        metrics = metrics.where(~F.col("metric_id").isin(*leave_out))
    inside = F.col("elig_status").isin(*NON_ESRD_STATUSES)
    others = [key for key in status_keys(metrics) if key != "elig_status"]
    return (
        metrics.groupBy(*others, "metric_id")
        .agg(
            ordered_sum(F.when(inside, F.col("metric_value"))).alias("metric_value"),
            F.count_if(inside).alias("inside_rows"),
        )
        .where(F.col("inside_rows") > 0)
        .select(*others, F.lit(NON_ESRD).alias("elig_status"), "metric_id", "metric_value")
    )


def label_metrics(metrics: DataFrame, client: str | Column, period_label: str) -> DataFrame:
    """Client, period and two blank columns around each metric, and a key without spaces; a scenario stays in front."""
    return labelled(metrics, client, period_label).select(
        *[key for key in status_keys(metrics) if key != "elig_status"],
        "name_client",
        "time_period",
        "elig_status",
        F.lit("").alias("metric_category"),
        "metric_id",
        F.lit("").alias("metric_name"),
        "metric_value",
        F.expr("replace(name_client || '_' || time_period || '_' || elig_status || '_' || metric_id, ' ', '')").alias(
            "idx"
        ),
    )


def labelled(frame: DataFrame, client: str | Column, period_label: str) -> DataFrame:
    """Client and period before each row; a scenario stays in front."""
    front = [key for key in status_keys(frame) if key != "elig_status"]
    rest = [c for c in frame.columns if c not in front]
    return frame.select(*front, F.lit(client).alias("name_client"), F.lit(period_label).alias("time_period"), *rest)
