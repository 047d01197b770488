"""Data-quality checks. Each returns a small report frame; nothing is collected except failed report rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import is_blank
from hirelake.operators.joins import orphan_keys


class QualityError(RuntimeError):
    """A check of severity ``error`` failed."""


@dataclass(frozen=True)
class Expectation:
    """``check`` is ``not_null``, ``accepted_values`` or ``unique``."""

    check: str
    column: str
    values: tuple[str, ...] = ()
    severity: str = "error"


def expect_not_null(column: str, severity: str = "error") -> Expectation:
    return Expectation("not_null", column, severity=severity)


def expect_unique(column: str, severity: str = "error") -> Expectation:
    return Expectation("unique", column, severity=severity)


def expect_accepted_values(column: str, values: Sequence[str], severity: str = "error") -> Expectation:
    return Expectation("accepted_values", column, tuple(values), severity)


def _report(df: DataFrame) -> DataFrame:
    return df.select("check_name", "column_name", "severity", "failed", (F.col("failed") == 0).alias("ok"))


def _row_violations(e: Expectation) -> Column:
    column = F.col(e.column)
    wrong = column.isNull() if e.check == "not_null" else column.isNotNull() & ~column.isin(*e.values)
    return F.count(F.when(wrong, 1))


def _row_checks(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """All row-wise checks in one aggregate: one scan, one row per task shuffled."""
    counts = df.agg(*[_row_violations(e).alias(f"_{i}") for i, e in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(e.check).alias("check_name"),
            F.lit(e.column).alias("column_name"),
            F.lit(e.severity).alias("severity"),
            F.col(f"_{i}").alias("failed"),
        )
        for i, e in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _unique_checks(df: DataFrame, checks: Sequence[Expectation]) -> DataFrame:
    """All uniqueness checks in one pass over (column, value) pairs; counts are partial before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(e.column).cast("string").alias("v")) for i, e in enumerate(checks)])
    repeated = (
        df.select(F.inline(pairs)).where(F.col("v").isNotNull())
        .groupBy("i", "v").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    )
    counts = repeated.agg(*[F.count_if(F.col("i") == i).alias(f"_{i}") for i in range(len(checks))])
    rows = [
        F.struct(
            F.lit(e.check).alias("check_name"),
            F.lit(e.column).alias("column_name"),
            F.lit(e.severity).alias("severity"),
            F.col(f"_{i}").alias("failed"),
        )
        for i, e in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def run_expectations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Report (check_name, column_name, severity, failed, ok): failed rows, or repeated values for ``unique``."""
    row_wise = [e for e in expectations if e.check != "unique"]
    unique = [e for e in expectations if e.check == "unique"]
    parts = []
    if row_wise:
        parts.append(_row_checks(df, row_wise))
    if unique:
        parts.append(_unique_checks(df, unique))
    return _report(reduce(DataFrame.unionByName, parts))


class Observed:
    """Expectations of a frame, checked while the frame is written or read for something else.

    Row-wise expectations are aggregates that the same pass computes: read ``frame`` in place of the frame, run the action, then
    ask for the ``report``. Uniqueness needs a grouping of its own and stays with :func:`run_expectations`. A task that
    runs again after a lost executor may count its rows twice, so ``failed`` is exact where it is 0 and else a lower
    bound of the work to do; figures that must be exact are not taken from here.
    """

    def __init__(self, df: DataFrame, expectations: Sequence[Expectation], **more: Column):
        self.expectations = [e for e in expectations if e.check != "unique"]
        self._observation, self._spark = Observation(), df.sparkSession
        counts = [_row_violations(e).alias(f"_{i}") for i, e in enumerate(self.expectations)]
        self.frame = df.observe(self._observation, *counts, *[c.alias(name) for name, c in more.items()])

    def value(self, name: str):
        """One of the ``more`` aggregates; waits for the action."""
        return self._observation.get[name]

    def report(self) -> DataFrame:
        """(check_name, column_name, severity, failed, ok), as :func:`run_expectations` gives it; waits for the action."""
        found = self._observation.get
        rows = [(e.check, e.column, e.severity, found[f"_{i}"]) for i, e in enumerate(self.expectations)]
        return _report(self._spark.createDataFrame(rows, "check_name string, column_name string, severity string, failed long"))


def unique_only(expectations: Sequence[Expectation]) -> list[Expectation]:
    return [e for e in expectations if e.check == "unique"]


def expect_relationship(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, severity: str = "warn"
) -> DataFrame:
    """Report of child rows whose non-null key the parent does not have."""
    failed = orphan_keys(child, child_key, parent, parent_key).agg(
        F.coalesce(F.sum("child_rows"), F.lit(0)).cast("long").alias("failed")
    )
    return _report(
        failed.select(
            F.lit("relationship").alias("check_name"),
            F.lit(child_key).alias("column_name"),
            F.lit(severity).alias("severity"),
            "failed",
        )
    )


def check_non_empty(tables: Mapping[str, DataFrame]) -> None:
    """Raise on the first table without rows; reads one row per table, not the table."""
    for name, df in tables.items():
        if df.isEmpty():
            raise QualityError(f"{name} is empty")


RATIOS = ("unknown_remote_ratio", "unknown_seniority_ratio", "empty_skills_ratio")


def _ratio_conditions() -> dict[str, Column]:
    return {
        "unknown_remote_ratio": F.col("remote_type") == rules.UNKNOWN,
        "unknown_seniority_ratio": F.col("seniority") == rules.UNKNOWN,
        "empty_skills_ratio": is_blank(F.col("skills")),
    }


def conditional_ratio(matching: Column, total: Column) -> Column:
    """Exact share as a decimal; null when there are no rows."""
    return (matching.cast("decimal(19,0)") / F.nullif(total, F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,18)")


def quality_ratios(postings: DataFrame) -> DataFrame:
    """One row: total_rows and the three ratios, from a single pass."""
    conditions = _ratio_conditions()
    counts = postings.agg(
        F.count("*").alias("total_rows"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )
    return counts.select(
        "total_rows", *[conditional_ratio(F.col(n), F.col("total_rows")).alias(n) for n in conditions]
    )


def check_ratio_max(postings: DataFrame, limit: float = 0.80) -> DataFrame:
    """Report (check_name, total_rows, ratio, max_ratio, ok): a ratio above the limit fails, and so does a table without rows."""
    cap = F.lit(str(limit)).cast("decimal(38,18)")
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("ratio")) for n in RATIOS])
    ratios = quality_ratios(postings).select("total_rows", F.inline(rows))
    return ratios.select(
        "check_name", "total_rows", "ratio", cap.alias("max_ratio"), F.coalesce(F.col("ratio") <= cap, F.lit(False)).alias("ok")
    )


def checked_metrics(metrics: DataFrame, limit: float = 0.80) -> DataFrame:
    """Check the rows of :func:`run_metrics`: raise where a table has no rows; report the ratios as :func:`check_ratio_max`.

    Nothing but the metrics is read, one row a metric.
    """
    empty = metrics.where("metric_name = 'row_count' AND metric_value = 0").orderBy("layer_name", "source_name").collect()
    if empty:
        raise QualityError("; ".join(f"{r['source_name']} ({r['layer_name']}) is empty" for r in empty))
    cap = F.lit(str(limit)).cast("decimal(38,18)")
    return metrics.where("layer_name = 'quality'").select(
        F.col("metric_name").alias("check_name"), F.col("metric_value").alias("ratio"), cap.alias("max_ratio"),
        F.coalesce(F.col("metric_value") <= cap, F.lit(False)).alias("ok"))


def freshness_status(age_seconds: int | None, warn_days: int = 2, error_days: int = 3) -> str:
    """``pass``, ``warn`` or ``error`` for the age of the newest row; ``error`` too when nothing is loaded."""
    if age_seconds is None or age_seconds > error_days * 86_400:
        return "error"
    return "warn" if age_seconds > warn_days * 86_400 else "pass"


def loaded_until(column: str = "fetched_at") -> Column:
    """Aggregate: the newest load in seconds since 1970, null when nothing is loaded; counting a row twice changes nothing."""
    return F.max(F.unix_seconds(F.try_to_timestamp(F.col(column))))


def freshness(df: DataFrame, now: datetime, column: str = "fetched_at", warn_days: int = 2, error_days: int = 3) -> DataFrame:
    """One row (max_loaded_at, age_seconds, status); status is pass, warn or error, error too when nothing is loaded."""
    newest = df.agg(F.max(F.try_to_timestamp(F.col(column))).alias("max_loaded_at"))
    aged = newest.withColumn("age_seconds", F.lit(int(now.timestamp())) - F.unix_seconds("max_loaded_at"))
    age, day = F.col("age_seconds"), 86_400
    status = F.when(age.isNull() | (age > error_days * day), "error").when(age > warn_days * day, "warn").otherwise("pass")
    return aged.withColumn("status", status)


def run_metrics(
    silver: Mapping[str, DataFrame], unified: DataFrame, run_date: date, run_name: str
) -> DataFrame:
    """Row counts of every silver table and of the unified table, and the three ratios: one row per metric."""
    tagged = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("s")) for name, df in silver.items()])
    counts = tagged.agg(*[F.count_if(F.col("s") == name).alias(f"n_{name}") for name in silver])
    one_row = counts.crossJoin(F.broadcast(quality_ratios(unified)))

    def metric(source: str, layer: str, name: str, value: Column) -> Column:
        return F.struct(
            F.lit(run_date).alias("run_date"),
            F.lit(run_name).alias("dag_id"),
            F.lit(source).alias("source_name"),
            F.lit(layer).alias("layer_name"),
            F.lit(name).alias("metric_name"),
            value.cast("decimal(38,18)").alias("metric_value"),
        )

    rows = [metric(name, "silver", "row_count", F.col(f"n_{name}")) for name in silver]
    rows.append(metric("all_sources", "gold", "row_count", F.col("total_rows")))
    rows += [metric("all_sources", "quality", name, F.col(name)) for name in RATIOS]
    return one_row.select(F.inline(F.array(*rows)))


def require_ok(report: DataFrame) -> None:
    """Raise if a report holds a failed check of severity ``error`` (reports have one row per check)."""
    failed = report.where(~F.col("ok"))
    if "severity" in report.columns:
        failed = failed.where(F.col("severity") == "error")
    rows = failed.collect()
    if rows:
        raise QualityError("; ".join(str(r.asDict()) for r in rows))
