"""Run tables: KPIs, bounded history, throughput and step summary."""

from datetime import datetime

from pyspark.sql import functions as F

from tapline.plans import latest_runs, run_kpis, step_summary, step_view, with_throughput


def runs(spark):
    rows = [(1, "completed", 100, datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 2)),
            (2, "failed", 0, datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 0)),
            (3, "running", 50, datetime(2024, 1, 1, 0, 0, 0), None),
            (4, "queued", 0, None, None),
            (5, "completed", 10, datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 1))]
    return spark.createDataFrame(rows, "id long, status string, row_count long, started_at timestamp_ntz, "
                                       "completed_at timestamp_ntz")


def test_kpis(spark):
    row = run_kpis(runs(spark)).collect()[0]
    assert row.asDict() == {"jobs_total": 5, "running": 1, "queued": 1, "completed": 2, "failed": 1,
                            "rows_total": 160}


def test_latest_keeps_unfinished(spark):
    got = sorted(r.id for r in latest_runs(runs(spark), 2).collect())
    assert got == [3, 4, 5, 2][:0] + [2, 3, 4, 5]


def test_throughput(spark):
    got = {r.id: (r.duration_ms, r.elapsed_ms, r.rows_per_second)
           for r in with_throughput(runs(spark), now=F.lit(datetime(2024, 1, 1, 0, 0, 4))).collect()}
    assert got[1] == (2000, 2000, 50.0)
    assert got[2] == (0, 0, 0.0)
    assert got[3] == (None, 4000, 12.5)
    assert got[4] == (None, 0, 0.0)


def test_step_view_and_summary(spark):
    steps = spark.createDataFrame([("rename", "rename", 3, 0, 1_500_000), ("map", "map", 0, 0, 0),
                                   ("map", "map", 4, 1, 60_000_000)],
                                  "step string, type string, invocations long, failures long, total_nanos long")
    view = {r.step: r for r in step_view(steps.limit(2)).collect()}
    assert (view["rename"].duration_ms, view["rename"].avg_per_row_ms, view["rename"].slow) == (1, 0.5, False)
    assert view["map"].avg_per_row_ms == 0.0
    summary = {r.step: r for r in step_summary(steps).collect()}
    assert (summary["map"].rows, summary["map"].errors, summary["map"].duration_ms, summary["map"].slow) == \
        (4, 1, 60, True)
    assert summary["map"].avg_per_row_ms == 15.0
