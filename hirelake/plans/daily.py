"""One day end to end: silver tables, staging, deduplicated postings, marts, checks, metrics."""

from __future__ import annotations

import logging
from datetime import datetime, time, timezone

from pyspark.sql import DataFrame, SparkSession

from hirelake.functions import rules
from hirelake.operators.quality import (
    Observed,
    checked_metrics,
    expect_relationship,
    freshness_status,
    loaded_until,
    require_ok,
    run_expectations,
    run_metrics,
    unique_only,
)
from hirelake.params import RunParams
from hirelake.plans import gold
from hirelake.plans.cards import run_cards
from hirelake.plans.details import DETAIL_SOURCES, run_details
from hirelake.plans.silver import run_silver
from hirelake.session import size_to_input, written_once
from hirelake.sources.files import size_of
from hirelake.sources.lake import day_inputs
from hirelake.sources.tables import (
    append_run_metrics, clear_intermediate, clear_table, scan_clean, shown_by_views, silver_path,
)
from hirelake.sources.warehouse import write_jdbc_append, write_jdbc_replace

log = logging.getLogger(__name__)


def run_gold(spark: SparkSession, params: RunParams) -> dict[str, DataFrame]:
    """Marts and the unified and deduplicated postings; raises when a check of severity error fails.

    Row-wise expectations of the staged, unified and deduplicated postings and of the marts are counted by the writes
    that compute them. The ratio and non-empty checks read the metrics, which one narrow scan gives.
    """
    clean = {s: scan_clean(spark, silver_path(params.silver, s), row_ids=True) for s in rules.SOURCES}
    stored = {s: gold.stage(spark, clean[s], f"{params.gold}/staging/{s}") for s in rules.SOURCES}
    unified = gold.unified(stored)

    staged = {s: Observed(df, gold.staging_expectations(s)) for s, df in stored.items()}
    all_rows = Observed(gold.unified({s: o.frame for s, o in staged.items()}), gold.UNIFIED_EXPECTATIONS, newest=loaded_until())
    best = Observed(gold.deduped(all_rows.frame), gold.DEDUPED_EXPECTATIONS)
    deduped = written_once(best.frame, "deduped")
    computed = gold.marts(deduped)
    watched = {name: Observed(computed[name], e) for name, e in gold.MART_EXPECTATIONS.items()}
    for name, mart in computed.items():
        frame = watched[name].frame if name in watched else mart
        frame.write.mode("overwrite").parquet(f"{params.gold}/{name}")
    marts = {name: spark.read.parquet(f"{params.gold}/{name}") for name in computed}

    for observed in (*staged.values(), all_rows, best, *watched.values()):
        require_ok(observed.report())
    unique = {s: (df, gold.staging_expectations(s)) for s, df in stored.items()} | {
        "deduped": (deduped, gold.DEDUPED_EXPECTATIONS), **{n: (marts[n], e) for n, e in gold.MART_EXPECTATIONS.items()}}
    for df, expectations in unique.values():
        if unique_only(expectations):
            require_ok(run_expectations(df, unique_only(expectations)))
    require_ok(expect_relationship(deduped, "source_job_uid", unified, "source_job_uid"))
    # what the day wrote, not all history
    today = {s: scan_clean(spark, silver_path(params.silver, s), params.dt) for s in rules.SOURCES}
    metrics = written_once(run_metrics(today, unified, params.run_date, params.run_name), "metrics")
    require_ok(checked_metrics(metrics, params.max_unknown_ratio))
    _log_freshness(all_rows.value("newest"), params)
    append_run_metrics(metrics, f"{params.gold}/run_metrics")
    if params.jdbc:
        for name, mart in marts.items():
            write_jdbc_replace(mart, params.jdbc, name)
        write_jdbc_append(metrics, params.jdbc, "run_metrics")
    return {**marts, "unified": unified, "deduped": deduped}


def _log_freshness(newest: int | None, params: RunParams) -> None:
    """Age of the newest posting at the end of the run day. It is reported and stops no run."""
    end = int(datetime.combine(params.run_date, time.max, timezone.utc).timestamp())
    status = freshness_status(None if newest is None else end - newest)
    if status != "pass":
        log.log(logging.ERROR if status == "error" else logging.WARNING, "freshness of postings on %s: %s", params.dt, status)


def run_day(spark: SparkSession, params: RunParams, *, parse: bool = False) -> dict[str, DataFrame]:
    """Silver and gold of a day; with ``parse`` its raw result pages and posting pages first."""
    if not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):  # nobody has stated sizes
        size_to_input(spark, size_of(spark, *[g for s in rules.SOURCES for g in day_inputs(params.bronze, s, params.dt)]))
    for source in rules.SOURCES if parse else ():
        run_cards(spark, params, source)
        if source in DETAIL_SOURCES:
            run_details(spark, params, source)
    for source in rules.SOURCES:
        run_silver(spark, params, source)
    return run_gold(spark, params)


def run_clear(spark: SparkSession, params: RunParams, keep_days: float = 7) -> list[str]:
    """Delete what no name has shown for so many days: old versions of days, compacted batches, intermediate tables.

    A state that was current within that time is kept whole, so the days must exceed the longest run and reader.
    """
    keep, texts = keep_days * 86_400, shown_by_views(spark, params.catalog)
    paths = [silver_path(params.silver, s) for s in rules.SOURCES] + [f"{params.gold}/staging/{s}" for s in rules.SOURCES]
    gone = [f"{path}/{name}" for path in paths for name in clear_table(spark, path, keep, texts)]
    return gone + clear_intermediate(spark, keep, texts)
