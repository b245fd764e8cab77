"""Row caps by quotas and row numbers of failures, both by counts and prefix sums over partitions."""

import re

import pytest
from pyspark.sql import functions as F

from tapline import TransformError, build_pipeline, export
from tapline.sources import cap_rows, query_source

SF = "/root/testdata/sf0.001"


@pytest.fixture
def lines(spark, out):
    path = out("lines")
    spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity").repartition(7).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cap", [1, 7, 2999, 5999, 6000, 9000])
def test_cap_of_a_scan(spark, lines, cap):
    capped = cap_rows(lines, cap)
    assert capped.columns == lines.columns and capped.count() == min(cap, lines.count())
    assert capped.exceptAll(lines).count() == 0
    assert not re.search(r"SinglePartition|GlobalLimit|Exchange hashpartitioning", plan_of(capped))


@pytest.mark.parametrize("cap", [1, 100, 3000, 6000, 7000])
def test_cap_of_an_ordered_query(spark, lines, cap):
    lines.createOrReplaceTempView("capped_lines")
    order = "l_orderkey DESC, l_linenumber, l_quantity"
    capped = cap_rows(query_source(spark, f"SELECT * FROM capped_lines ORDER BY {order}"), cap)
    assert "SinglePartition" not in plan_of(capped)
    want = sorted(map(tuple, lines.collect()), key=lambda r: (-r[0], r[1], r[2]))[:cap]
    assert [tuple(r) for r in capped.collect()] == want


def test_cap_of_filters_joins_and_random_columns(spark, lines):
    assert cap_rows(lines.filter("l_quantity > 25"), 900).filter("l_quantity <= 25").count() == 0
    joined = lines.join(lines.groupBy("l_orderkey").count(), "l_orderkey")
    assert cap_rows(joined, 50).count() == 50
    shuffled = lines.withColumn("x", F.rand()).filter("x < 0.5")
    assert cap_rows(shuffled, 100).count() == 100
    assert cap_rows(lines.limit(0), 5).count() == 0
    assert cap_rows(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "A int, a_ string"), 2).count() == 2


def test_cap_of_empty_partitions(spark):
    df = spark.range(0, 40, 1, 8).filter("id % 10 = 9")
    assert [r["id"] for r in cap_rows(df, 3).collect()] == [9, 19, 29]


def statuses(spark, bad):
    """Rows over five partitions; those of the numbers (from 1) in ``bad`` have no mapping."""
    status = F.when((F.col("id") + 1).isin(*bad), "X").otherwise("F") if bad else F.lit("F")
    return spark.range(0, 1000, 1, 5).select("id", status.alias("status"))


MAP = {"type": "map", "column": "status", "mapping": {"F": "Finished"}, "unmatched": "fail"}


@pytest.mark.parametrize("bad", [(1,), (200,), (201,), (777, 999), (1000,), (950, 3, 420)])
def test_first_failing_row(spark, bad):
    found = build_pipeline([MAP]).plan(statuses(spark, bad)).first_failure()
    assert (found.row, found.step) == (min(bad), "map")
    assert str(found) == f'Transform "map" failed at row {min(bad)}: no mapping for a value in column "status".'


def test_no_failure_and_later_steps(spark):
    assert build_pipeline([MAP]).plan(statuses(spark, ())).first_failure() is None
    assert build_pipeline(inline=["rename:status=s"]).plan(statuses(spark, (4,))).first_failure() is None
    two = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "expression", "outputField": "x", "expression": "1 / (id - 600)"}, {**MAP, "name": "second"}]})
    assert two.plan(statuses(spark, (800,))).first_failure().step == "expression"
    assert two.plan(statuses(spark, (600, 601))).first_failure() .row == 600
    assert two.plan(statuses(spark, (600, 601))).first_failure().step == "second"


def test_rows_are_numbered_in_the_query_s_order(spark):
    statuses(spark, (11, 500)).createOrReplaceTempView("numbered")
    src = query_source(spark, "SELECT * FROM numbered ORDER BY id DESC")
    assert build_pipeline([MAP]).plan(src).first_failure().row == 501


def test_an_export_names_the_row(spark, out):
    with pytest.raises(TransformError, match=r'^Transform "map" failed at row 640: no mapping for a value in column "status"\.$'):
        export(spark, df=statuses(spark, (640, 900)), fmt="csv", output=out(), transforms=[MAP])
