"""Measures as data, and the one-pass evaluation that turns a summary into the long metric frame."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numbers import EXACT, exact_sum_sql
from cohortlens.operators.cohort import status_keys

METRIC_COLUMNS = ["elig_status", "metric_id", "metric_value"]


@dataclass(frozen=True)
class Measure:
    """A sum of ``value`` over the summary rows that satisfy ``where``, in SQL expressions.

    ``id_from`` names the metric per row instead of by a fixed id. ``dims`` are the summary dimensions that
    the expressions read; a plan groups by the union of its measures' dimensions and nothing more.
    """

    metric_id: str
    value: str
    where: str = "true"
    dims: tuple[str, ...] = ()
    id_from: str | None = None


def dims_of(measures: Iterable[Measure]) -> list[str]:
    return list(dict.fromkeys(dim for measure in measures for dim in measure.dims))


def evaluate(summary: DataFrame, measures: list[Measure], by: tuple[str, ...] = ()) -> DataFrame:
    """Evaluate every measure in one pass over ``summary``, per status (and scenario) and ``by``.

    Each summary row is turned into the contributions it makes, so a status without qualifying rows gets no
    metric row, and one whose qualifying values are all NULL gets NULL. Two measures that arrive at the same
    id stay two rows.
    """
    keys = [*status_keys(summary), *by]
    # One SQL expression for the lot: building it column by column costs a driver round trip for each.
    contributions = ", ".join(
        f"struct(coalesce({m.where}, false) AS keep, {position} AS measure, "
        f"{m.id_from or quoted(m.metric_id)} AS metric_id, CAST({m.value} AS {EXACT}) AS part)"
        for position, m in enumerate(measures)
    )
    return (
        summary.selectExpr(*keys, f"inline(filter(array({contributions}), c -> c.keep))")
        .groupBy(*keys, "measure", "metric_id")
        .agg(F.sum("part").cast("double").alias("metric_value"))
        .select(*keys, "metric_id", "metric_value")
    )


def again(where: str = "true") -> Measure:
    """A measure over metric rows that were evaluated at a finer grain: same ids, values added up."""
    return Measure("", "metric_value", where, id_from="metric_id")


def ids_of(measures: Iterable[Measure]) -> str:
    """A SQL condition that holds for the fixed ids of ``measures``."""
    return f"metric_id IN ({', '.join(quoted(m.metric_id) for m in measures)})"


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def usage_of(rows: DataFrame, measures: list[Measure], value: str) -> DataFrame:
    """The sum of ``measures`` per status and benefit type, out of finer metric rows.

    Types that only other measures have are dropped after the sum: a filter on the id would be pushed into the
    plan of ``rows``, which then could not be shared with those who read all of them.
    """
    wanted = ids_of(measures)
    return (
        rows.groupBy(*status_keys(rows), "btnumber")
        .agg(
            F.expr(f"{exact_sum_sql(f'if({wanted}, metric_value, NULL)')} AS {value}"),
            F.expr(f"bool_or({wanted}) AS present"),
        )
        .where("present")
        .drop("present")
    )


def metric_rows(frame: DataFrame, metric_id: str, value: str) -> DataFrame:
    """One column of an already aggregated frame as metric rows."""
    return frame.select(
        *status_keys(frame), F.lit(metric_id).alias("metric_id"), F.col(value).cast("double").alias("metric_value")
    )


def wide_to_metrics(frame: DataFrame, values: list[str]) -> DataFrame:
    """Metric columns of a one-row-per-status frame as long rows, in one pass."""
    keys = status_keys(frame)
    doubled = frame.select(*keys, *[F.col(v).cast("double").alias(v) for v in values])
    return doubled.unpivot(keys, values, "metric_id", "metric_value")


def stack(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of metric frames on one schema."""
    first, *rest = [f.select(*status_keys(f), "metric_id", "metric_value") for f in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first
