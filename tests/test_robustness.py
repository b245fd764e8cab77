"""What must hold when something goes wrong: run-time errors, restarts, empty parts, failing writes."""

import csv
import glob
import io
import json
import os
import time
import uuid
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapline import OutputError, Pipeline, TaplineError, TransformError, build_pipeline, export
from tapline.operators import Capabilities, ColumnStep, PandasStep, StepOutput, parse_literal
from tapline.session import shared_dir
from tapline.sources import cap_rows, jdbc_source
from tapline.streaming import read_stream, start_stream_export
from tapline.streaming.stream import default_checkpoint


def parts(path):
    return sorted(glob.glob(os.path.join(path.replace("file:", ""), "part-*")))


# ------------------------------------------------------------------------------------------ row cap

def test_cap_keeps_first_rows_in_order_over_several_parts(spark):
    rows = spark.range(0, 5000, numPartitions=4).withColumn("v", (F.col("id") * 7919) % 5000).orderBy("v")
    capped = cap_rows(rows, 3000)
    assert capped.rdd.getNumPartitions() > 1
    placed = capped.withColumn("p", F.spark_partition_id()).collect()
    assert [r["v"] for r in placed] == list(range(3000))
    assert len({r["p"] for r in placed}) > 1


def test_cap_of_duplicate_and_clashing_names(spark):
    frame = spark.sql("SELECT id AS _place, id AS a, id AS A FROM range(10)")
    assert cap_rows(frame, 4).columns == ["_place", "a", "A"] and cap_rows(frame, 4).count() == 4
    assert cap_rows(frame, 99).count() == 10 and cap_rows(frame, None).count() == 10


@pytest.mark.parametrize("cap", [0, -1])
def test_cap_must_be_positive(spark, out, cap):
    with pytest.raises(TaplineError, match="greater than 0"):
        cap_rows(spark.range(3), cap)
    with pytest.raises(TaplineError, match="greater than 0"):
        export(spark, df=spark.range(3), fmt="csv", output=out("cap"), max_rows=cap)


# --------------------------------------------------------------------------------- run-time errors

DIVIDE = {"type": "expression", "outputField": "q", "expression": "a div b + a div b"}


def numbers(spark):
    return spark.createDataFrame([(8, 2, "x"), (8, 0, "y"), (None, 1, "z")], "a int, b int, c string")


def test_expression_errors_follow_the_strategy(spark):
    planned = build_pipeline({"errorStrategy": "skipRow", "transforms": [DIVIDE]}).plan(numbers(spark))
    assert {r["c"]: r["q"] for r in planned.df.collect()} == {"x": "8", "z": None}
    metrics = planned.metrics()
    assert (metrics["rows_in"], metrics["rows_out"], metrics["rows_dropped_by_error"]) == (3, 2, 1)
    assert metrics["steps"][0]["failures"] == 1
    with pytest.raises(Exception, match='Transform "expression" failed'):
        build_pipeline({"transforms": [DIVIDE]}).apply(numbers(spark)).collect()


@pytest.mark.parametrize("expression", ["CAST(c AS INT)", "element_at(array(1), b)", "raise_error(c)", "if(b = 0, raise_error('e'), c)"])
def test_all_kinds_of_errors_are_row_failures(spark, expression):
    got = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "expression", "outputField": "q", "expression": expression}]}).apply(numbers(spark)).count()
    assert got < 3


def test_expression_text_is_canonical(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-06 07:08:00' AS t, 1.50BD AS d, CAST('hi' AS BINARY) AS b")
    row = build_pipeline(inline=["expression:t2=to_timestamp_ntz(t)", "expression:b2=CAST(b AS BINARY)", "expression:d2=d"]).apply(frame).first()
    assert (row["t2"], row["d2"]) == ("2024-05-06T07:08", "1.50")


@pytest.mark.parametrize("call", ["`reflect`('java.lang.System','getProperty','os.name')", "reflect/**/('java.lang.Math','abs',1)",
                                  "concat('a', java_method('java.util.UUID','randomUUID'))", "try_reflect('java.lang.Math','abs',1)"])
def test_calls_into_the_jvm_are_refused_however_written(spark, call):
    with pytest.raises(TransformError, match="calls into the JVM"):
        build_pipeline(inline=[f"expression:x={call}"]).apply(numbers(spark))
    from tapline.operators import StepRegistry
    from tapline.operators.custom import filter_provider

    with pytest.raises(TransformError, match="calls into the JVM"):
        build_pipeline([{"type": "filter", "condition": f"{call} IS NOT NULL"}],
                       registry=StepRegistry({"filter": filter_provider})).apply(numbers(spark))


def test_a_raising_custom_step_fails_only_its_rows(spark):
    def raises_for_y(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["c"] == "y").any():
            raise ValueError("y")
        return batch[["c"]]

    step = PandasStep("picky", raises_for_y, T.StructType([T.StructField("c", T.StringType())]))
    planned = Pipeline.of(step, error_strategy="skipRow").plan(numbers(spark).coalesce(1))
    assert sorted(r["c"] for r in planned.df.collect()) == ["x", "z"]
    assert planned.metrics()["steps"][0]["failures"] == 1
    with pytest.raises(Exception, match='Transform "picky" failed'):
        Pipeline.of(step).apply(numbers(spark)).collect()


def test_capabilities_are_enforced(spark):
    adds = ColumnStep("adds", lambda row: StepOutput(row.passthrough() + [("n", F.lit("1"))]))
    with pytest.raises(TransformError, match="declared not to"):
        Pipeline.of(adds).apply(numbers(spark))
    whole = ColumnStep("whole", lambda row: StepOutput(row.passthrough()), capabilities=Capabilities(row_level=False))
    assert Pipeline.of(whole).apply(numbers(spark)).count() == 3
    stream = spark.readStream.format("rate").load()
    with pytest.raises(TransformError, match="cannot run on a stream"):
        Pipeline.of(whole).apply(stream)


def test_literals():
    wide = T.DecimalType(38, 10)
    assert parse_literal("1234567890123456789012345678.5", wide, "default", "c") == Decimal("1234567890123456789012345678.5")
    for bad in ("1_000", "٣", "1e99999", "NaN", "12345678901234567890123456789", "0.00000000001"):
        with pytest.raises(TransformError):
            parse_literal(bad, wide, "default", "c")
    with pytest.raises(TransformError):
        parse_literal("1_000", T.IntegerType(), "default", "c")


def test_a_large_mapping_plans_quickly_and_maps_right(spark):
    mapping = {f"k{i}": (None if i % 11 == 0 else f"v{i}") for i in range(20_000)}
    frame = spark.range(0, 20_010).select(F.concat(F.lit("k"), "id").alias("k"))
    began = time.monotonic()
    mapped = build_pipeline([{"type": "map", "column": "k", "mapping": mapping}]).apply(frame)
    assert time.monotonic() - began < 2
    got = [r["k"] for r in mapped.collect()]
    assert got == [mapping.get(f"k{i}", f"k{i}") for i in range(20_010)]


# ------------------------------------------------------------------------------------- part files

def holes(spark, keep):
    """Four partitions of ids, of which only those in ``keep`` have rows."""
    return spark.range(0, 40, numPartitions=4).filter((F.col("id") / 10).cast("int").isin(keep))


@pytest.mark.parametrize("single", [False, True])
@pytest.mark.parametrize("keep", [[1, 2, 3], [0, 1, 3], [0, 1, 2], [2], []])
def test_every_part_file_is_whole(spark, out, keep, single):
    ids = [i for i in range(40) if i // 10 in keep]
    for pretty in (False, True):
        path = out("array")
        export(spark, df=holes(spark, keep), fmt="json", output=path, pretty=pretty, single_file=single)
        found = [json.load(open(f)) for f in parts(path)]
        assert [r["id"] for doc in found for r in doc] == ids and (len(found) == 1 or all(found))
    for fmt, sep in (("csv", ","), ("tsv", "\t")):
        path = out(fmt)
        export(spark, df=holes(spark, keep).selectExpr("id", "'a' AS b"), fmt=fmt, output=path, single_file=single)
        texts = [open(f, newline="", encoding="utf-8").read() for f in parts(path)]
        tables = [list(csv.reader(io.StringIO(t), delimiter=sep)) for t in texts]
        assert all(t[0] == ["id", "b"] for t in tables) and [int(r[0]) for t in tables for r in t[1:]] == ids
        assert not single or len(texts) == 1


def test_cells_that_end_with_a_line_separator(spark, out):
    path = out("ls")
    export(spark, df=spark.createDataFrame([("abc \u2028",), ("abc ",)], "v string").coalesce(1), fmt="csv", output=path)
    assert open(parts(path)[0], encoding="utf-8", newline="").read() == 'v\r\nabc \u2028\r\n"abc "\r\n'


# ---------------------------------------------------------------------------------- publish safety

def test_a_failing_unstaged_overwrite_keeps_the_old_output(spark, out):
    path = out("unstaged")
    export(spark, df=spark.range(5), fmt="ndjson", output=path, staged=False)
    broken = spark.range(100, 110).select(F.when(F.col("id") > 104, F.raise_error(F.lit("x")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(TaplineError):
        export(spark, df=broken, fmt="ndjson", output=path, staged=False, overwrite=True)
    assert sorted(r["id"] for r in spark.read.json(path).collect()) == list(range(5))
    export(spark, df=spark.range(20, 23), fmt="ndjson", output=path, staged=False, overwrite=True)
    assert sorted(r["id"] for r in spark.read.json(path).collect()) == [20, 21, 22]
    export(spark, df=spark.range(0), fmt="json", output=path, staged=False, overwrite=True)
    assert [open(f).read().strip() for f in parts(path)] == ["[]"]


def test_metadata_is_guarded_like_the_output(spark, out):
    meta = out("meta")
    export(spark, df=spark.range(2), fmt="csv", output=out("m1"), metadata_path=meta)
    before = open(meta.replace("file:", "")).read()
    second = out("m2")
    with pytest.raises(OutputError, match="Metadata file already exists"):
        export(spark, df=spark.range(3), fmt="csv", output=second, metadata_path=meta)
    assert open(meta.replace("file:", "")).read() == before and not os.path.exists(second.replace("file:", ""))
    export(spark, df=spark.range(3), fmt="csv", output=second, metadata_path=meta, overwrite=True)
    assert json.load(open(meta.replace("file:", "")))["rowCount"] == 3


# ----------------------------------------------------------------------------------------- streams

@pytest.mark.parametrize("fmt", ["parquet", "ndjson", "csv", "tsv"])
def test_a_restarted_stream_goes_on_where_it_stopped(spark, out, fmt):
    source, target = out("in"), out("out")
    for round_ in range(3):
        spark.range(100 * round_, 100 * round_ + 100).write.mode("append").parquet(source)
        stream = read_stream(spark, source, spark.range(0).schema, glob_filter="*.parquet")
        start_stream_export(stream, build_pipeline(inline=["rename:id=n"]), fmt, target).awaitTermination()
    if fmt == "parquet":
        back = spark.read.parquet(target)
    elif fmt == "ndjson":
        back = spark.read.json(target)
    else:
        back = spark.read.option("header", "true").option("sep", "," if fmt == "csv" else "\t").option(
            "recursiveFileLookup", "true").csv(target)
    assert sorted(int(r["n"]) for r in back.collect()) == list(range(300))


def test_a_stream_refuses_an_output_without_its_checkpoint(spark, out):
    source, target = out("in"), out("out")
    spark.range(10).write.parquet(source)
    spark.range(10).write.parquet(target)
    stream = read_stream(spark, source, spark.range(0).schema, glob_filter="*.parquet")
    with pytest.raises(OutputError, match="no progress of a stream"):
        start_stream_export(stream, build_pipeline(inline=["rename:id=n"]), "parquet", target)
    assert default_checkpoint("s3a://bucket/a/b/") == "s3a://bucket/a/.b.checkpoint"


def test_no_machine_local_folder_off_local_mode(spark, monkeypatch):
    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(TaplineError, match="spark.checkpoint.dir"):
        shared_dir(Session())


# -------------------------------------------------------------------------------------------- JDBC

@pytest.mark.parametrize("sql_type,value", [("decimal(12,2)", "CAST(id AS DECIMAL(12,2)) + 0.50"), ("bigint", "id"),
                                            ("double", "CAST(id AS DOUBLE) / 4"), ("date", "DATE_ADD(DATE'2020-01-01', CAST(id AS INT))")])
def test_jdbc_finds_bounds_of_any_key(spark, sql_type, value):
    url = f"jdbc:derby:memory:b{uuid.uuid4().hex[:8]};create=true"
    keyed = spark.sql(f"SELECT CAST(CASE WHEN id % 10 = 0 THEN NULL ELSE {value} END AS {sql_type}) AS K, id AS ID FROM range(0, 100)")
    keyed.write.format("jdbc").option("url", url).option("dbtable", "T").save()
    read = jdbc_source(spark, url, "SELECT K, ID FROM T", partition_column="K", num_partitions=3, options={"queryTimeout": 60})
    assert read.rdd.getNumPartitions() == 3
    assert sorted(r["id"] for r in read.collect()) == list(range(100))


def test_jdbc_fetch_size_must_be_positive(spark):
    with pytest.raises(TaplineError, match="fetch_size"):
        jdbc_source(spark, "jdbc:derby:memory:none", "SELECT 1", fetch_size=0)
