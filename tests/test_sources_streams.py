"""Sources (SQL text, JDBC) and the pipeline over a stream."""

import uuid

import pytest
from pyspark.sql import functions as F

from tapline import SourceError, build_pipeline, export, scratch_path
from tapline.sources import jdbc_source, query_source, register_tables, sql_text
from tapline.streaming import read_stream, start_stream_export

SF = "/root/testdata/sf0.001"


def test_sql_text(tmp_path):
    f = tmp_path / "q.sql"
    f.write_text("  SELECT 1 AS a \n")
    assert sql_text(sql_file=str(f)) == "SELECT 1 AS a"
    with pytest.raises(SourceError, match="exactly one"):
        sql_text("SELECT 1", str(f))
    with pytest.raises(SourceError, match="exactly one"):
        sql_text()


def test_registered_views_prune_columns(spark):
    register_tables(spark, SF, ["orders"])
    df = query_source(spark, "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_jdbc_query_and_partitioned_read(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    spark.range(0, 100).select(F.col("id").alias("ID"), (F.col("id") % 7).alias("GRP")) \
        .write.format("jdbc").option("url", url).option("dbtable", "T").save()
    one = jdbc_source(spark, url, "SELECT ID, GRP FROM T WHERE GRP = 3")
    assert one.columns == ["id", "grp"] and one.count() == 14
    parts = jdbc_source(spark, url, "SELECT ID, GRP FROM T", partition_column="ID", lower_bound=0,
                        upper_bound=100, num_partitions=4)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 100


def test_export_from_jdbc(spark, out):
    url = f"jdbc:derby:memory:e{uuid.uuid4().hex[:8]};create=true"
    spark.sql("SELECT 'P001' AS BOOKING_ID, 2 AS ATTENDEES UNION ALL SELECT 'P002', 5") \
        .write.format("jdbc").option("url", url).option("dbtable", "BOOKINGS").save()
    result = export(spark, jdbc={"url": url}, sql="SELECT BOOKING_ID, ATTENDEES FROM BOOKINGS",
                    fmt="ndjson", output=out("jdbc"))
    assert result.row_count == 2
    assert [c["output_name"] for c in result.columns] == ["booking_id", "attendees"]


def test_pipeline_over_a_stream(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    stream = read_stream(spark, SF, orders.schema, glob_filter="orders.parquet")
    pipeline = build_pipeline(inline=["keep:o_orderkey,o_orderstatus", "rename:o_orderstatus=status",
                                      "map:status=F>Finished"])
    target = scratch_path(spark, "stream")
    query = start_stream_export(stream, pipeline, "ndjson", target, checkpoint=scratch_path(spark, "ckpt"))
    query.awaitTermination()
    back = spark.read.json(target)
    assert back.count() == orders.count()
    assert back.filter("status = 'Finished'").count() == orders.filter("o_orderstatus = 'F'").count()
    metrics = [p["observedMetrics"].get("tapline_pipeline") for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["rows_in"] for m in metrics) == orders.count()


def test_only_queries_are_accepted(spark):
    register_tables(spark, SF, ["nation"])
    for text in ["DROP VIEW nation", "INSERT INTO nation VALUES (1, 'x', 1)", "SHOW TABLES", "selec 1"]:
        with pytest.raises(SourceError):
            query_source(spark, text)
    assert spark.catalog.tableExists("nation")
    assert query_source(spark, "WITH a AS (SELECT n_name FROM nation) SELECT * FROM a;").count() == 25
    top = query_source(spark, "SELECT n_nationkey FROM nation ORDER BY n_nationkey DESC LIMIT 3").collect()
    assert [r.n_nationkey for r in top] == [24, 23, 22]


def test_describe_and_dry_run(spark, out):
    from tapline import describe

    register_tables(spark, SF, ["orders"])
    cols = describe(spark, sql="SELECT o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(12,2)) AS Price "
                               "FROM orders", inline=["mask:o_orderkey"]).collect()
    assert [(c.output_name, c.type, c.sensitive) for c in cols] == [
        ("o_orderkey", "string", True), ("o_orderdate", "string", False), ("price", "decimal(12,2)", False)]
    assert cols[2].label == "Price" and (cols[2].precision, cols[2].scale) == (12, 2)
    path = out("dry")
    result = export(spark, sql="SELECT * FROM no_such_table", fmt="csv", output=path, dry_run=True,
                    inline=["mask:x"])
    assert result.dry_run and result.row_count == 0
    assert not spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))


def test_csv_stream_has_header_per_file(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    stream = read_stream(spark, SF, orders.schema, glob_filter="orders.parquet")
    target = scratch_path(spark, "stream-csv")
    pipeline = build_pipeline(inline=["keep:o_orderkey,o_orderstatus"])
    query = start_stream_export(stream, pipeline, "csv", target, checkpoint=scratch_path(spark, "ckpt-csv"))
    query.awaitTermination()
    back = spark.read.option("header", "true").option("recursiveFileLookup", "true").csv(target)
    assert back.columns == ["o_orderkey", "o_orderstatus"]
    assert back.count() == orders.count()


def test_jdbc_predicates_split_a_skewed_key(spark):
    url = f"jdbc:derby:memory:p{uuid.uuid4().hex[:8]};create=true"
    # a third of the rows share one key
    spark.sql("SELECT id AS ID, CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS K FROM range(0, 900)") \
        .write.format("jdbc").option("url", url).option("dbtable", "S").save()
    preds = [f"MOD(ID, 4) = {i}" for i in range(4)]
    df = jdbc_source(spark, url, "SELECT ID, K FROM S", predicates=preds)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 900
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) <= 226


def test_writers_ignore_max_records_per_file(spark, out):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        df = spark.range(0, 100, numPartitions=1).withColumnRenamed("id", "n")
        j, c = out("mrj"), out("mrc")
        export(spark, df=df, fmt="json", output=j)
        export(spark, df=df, fmt="csv", output=c)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    import glob as _glob
    import json as _json
    import os as _os

    jfiles = sorted(_glob.glob(_os.path.join(j.replace("file:", ""), "part-*")))
    assert len(jfiles) == 1 and len(_json.load(open(jfiles[0]))) == 100
    assert spark.read.option("header", "true").csv(c).count() == 100


def test_stream_with_fail_strategy_and_failing_capable_step(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    stream = read_stream(spark, SF, orders.schema, glob_filter="orders.parquet")
    pipeline = build_pipeline({"errorStrategy": "fail", "transforms": [
        {"type": "keep", "columns": ["o_orderkey", "o_orderstatus"]},
        {"type": "map", "column": "o_orderstatus", "mapping": {"F": "F", "O": "O", "P": "P"}, "unmatched": "fail"}]})
    target = scratch_path(spark, "stream-fail")
    query = start_stream_export(stream, pipeline, "parquet", target, checkpoint=scratch_path(spark, "ckpt-fail"))
    query.awaitTermination()
    assert spark.read.parquet(target).count() == orders.count()


def test_jdbc_bounds_found_automatically(spark):
    url = f"jdbc:derby:memory:b{uuid.uuid4().hex[:8]};create=true"
    spark.range(100, 600).select(F.col("id").alias("ID")).write.format("jdbc").option("url", url) \
        .option("dbtable", "B").save()
    df = jdbc_source(spark, url, "SELECT ID FROM B", partition_column="ID", num_partitions=5)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 500
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert sizes == [100] * 5
