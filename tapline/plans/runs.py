"""Tables of export runs: KPI summary, latest finished runs, throughput and step summary.

Inputs are DataFrames of runs (``id``, ``status``, ``row_count``, ``started_at``,
``completed_at``) and of step timings (``step``, ``type``, ``invocations``, ``failures``,
``total_nanos``). All work is aggregation or top-k; none of it gathers a run list on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("queued", "running", "completed", "failed")
FINISHED = ("completed", "failed")
# Fixed values, equal to the reference's defaults.
DEFAULT_MAX_FINISHED = 200
DEFAULT_SLOW_STEP_MS = 50


def run_kpis(runs: DataFrame) -> DataFrame:
    """One row: runs in total, per status, and rows over all runs (partial aggregation per task)."""
    status = F.lower(F.col("status"))
    return runs.agg(
        F.count(F.lit(1)).alias("jobs_total"),
        *[F.count_if(status == s).alias(s) for s in ("running", "queued", "completed", "failed")],
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("rows_total"))


def latest_runs(runs: DataFrame, max_finished: int = DEFAULT_MAX_FINISHED) -> DataFrame:
    """The newest ``max_finished`` finished runs (by numeric id) plus every unfinished run.

    The limit is the feature: a bounded history. It runs as a per-partition top-k merged once,
    never as a global sort or a single-partition window.
    """
    finished = F.lower(F.col("status")).isin(*FINISHED)
    kept = runs.filter(finished).orderBy(F.col("id").cast("long").desc()).limit(int(max_finished))
    return kept.unionByName(runs.filter(~finished | F.col("status").isNull()))


def elapsed_ms(started: Column, completed: Column, now: Column | None = None) -> Column:
    """Milliseconds from start to end (or ``now`` while running); 0 before the start, never negative."""
    end = F.coalesce(completed, now if now is not None else F.localtimestamp())
    millis = F.timestamp_diff("MILLISECOND", started, end)
    return F.when(started.isNull(), F.lit(0)).otherwise(F.greatest(millis, F.lit(0))).cast("long")


def with_throughput(runs: DataFrame, now: Column | None = None) -> DataFrame:
    """Adds ``duration_ms`` (null unless finished), ``elapsed_ms`` and ``rows_per_second``."""
    started, completed = F.col("started_at"), F.col("completed_at")
    duration = F.when(started.isNotNull() & completed.isNotNull(),
                      F.timestamp_diff("MILLISECOND", started, completed))
    elapsed = elapsed_ms(started, completed, now)
    rate = F.when(elapsed > 0, F.col("row_count") * F.lit(1000.0) / elapsed).otherwise(F.lit(0.0))
    return runs.select("*", duration.alias("duration_ms"), elapsed.alias("elapsed_ms"),
                       rate.alias("rows_per_second"))


def round3(col: Column) -> Column:
    """Round half up to 3 decimals, as ``Math.round(v * 1000) / 1000``."""
    return F.floor(col * F.lit(1000.0) + F.lit(0.5)) / F.lit(1000.0)


def step_view(steps: DataFrame, slow_threshold_ms: int = DEFAULT_SLOW_STEP_MS) -> DataFrame:
    """Per step: total ms, average ms per row (3 decimals) and a slow flag."""
    total_ms = F.floor(F.col("total_nanos") / F.lit(1_000_000)).cast("long")
    avg = F.when(F.col("invocations") == 0, F.lit(0.0)) \
        .otherwise(round3((F.col("total_nanos") / F.lit(1_000_000.0)) / F.col("invocations")))
    return steps.select("step", "type", F.col("invocations").alias("rows"), F.col("failures").alias("errors"),
                        total_ms.alias("duration_ms"), avg.alias("avg_per_row_ms"),
                        (total_ms >= F.lit(slow_threshold_ms)).alias("slow"))


def step_summary(steps: DataFrame, slow_threshold_ms: int = DEFAULT_SLOW_STEP_MS) -> DataFrame:
    """Step timings summed over many runs (grouped by step and type), then :func:`step_view`.

    Partial aggregation happens before the shuffle, so a hot step costs one row per task.
    """
    summed = steps.groupBy("step", "type").agg(
        F.sum("invocations").cast("long").alias("invocations"),
        F.sum("failures").cast("long").alias("failures"),
        F.sum("total_nanos").cast("long").alias("total_nanos"))
    return step_view(summed, slow_threshold_ms)
